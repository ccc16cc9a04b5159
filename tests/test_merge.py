from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import bag
from gridwright.operators.merge import fill_from, fill_value, left_merge


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [("f1", "p1", 1, "cityA"), (None, "p1", 1, "cityB"), ("f2", "p2", 2, "cityC"), ("f3", None, 3, "cityD")],
        "firm string, position string, level int, firm_city string",
    )
    right = spark.createDataFrame(
        [
            ("f1", "p1", 1, 5, "x"),
            ("f1", "p1", 1, 6, "y"),  # fan-out: two staff groups
            (None, "p1", 1, 7, None),  # NULL branch matches NULL firm
            ("f9", "p9", 9, 8, "z"),  # no grid row
            ("f3", None, 3, 9, "w"),  # NULL position matches NULL position
        ],
        "branch string, position string, pay_level int, headcount bigint, city string",
    )
    return left, right


def test_null_safe_left_merge(sides):
    left, right = sides
    out = left_merge(left, right, ["firm", "position", "level"], ["branch", "position", "pay_level"])
    assert out.columns == ["firm", "position", "level", "firm_city", "branch", "pay_level", "headcount", "city"]
    assert bag(out) == Counter(
        {
            ("f1", "p1", 1, "cityA", "f1", 1, 5, "x"): 1,
            ("f1", "p1", 1, "cityA", "f1", 1, 6, "y"): 1,
            (None, "p1", 1, "cityB", None, 1, 7, None): 1,
            ("f2", "p2", 2, "cityC", None, None, None, None): 1,
            ("f3", None, 3, "cityD", "f3", 3, 9, "w"): 1,
        }
    )


def test_plain_equality_differs(sides):
    left, right = sides
    out = left_merge(left, right, ["firm", "position", "level"], ["branch", "position", "pay_level"], null_safe=False)
    got = bag(out)
    assert got[(None, "p1", 1, "cityB", None, None, None, None)] == 1
    assert got[("f3", None, 3, "cityD", None, None, None, None)] == 1


def test_same_name_keys(spark):
    a = spark.createDataFrame([("c", 1, 10.0), (None, 1, 20.0)], "city string, level int, salary double")
    b = spark.createDataFrame([("c", 1, "br"), (None, 1, "nb")], "city string, level int, branch string")
    out = left_merge(a, b, on=["city", "level"])
    assert out.columns == ["city", "level", "salary", "branch"]
    assert bag(out) == Counter({("c", 1, 10.0, "br"): 1, (None, 1, 20.0, "nb"): 1})


def test_text_grade_raises(spark):
    a = spark.createDataFrame([("c", 1)], "city string, level int")
    b = spark.createDataFrame([("c", "1")], "city string, level string")
    with pytest.raises(TypeError):
        left_merge(a, b, on=["city", "level"])


def test_int_with_long_key_is_fine(spark):
    a = spark.createDataFrame([("c", 1)], "city string, level int")
    b = spark.createDataFrame([("c", 1, 3)], "city string, level bigint, n int")
    assert left_merge(a, b, on=["city", "level"]).count() == 1


def test_column_clash_raises(spark):
    a = spark.createDataFrame([("c", 1)], "city string, n int")
    b = spark.createDataFrame([("c", 2)], "city string, n int")
    with pytest.raises(ValueError):
        left_merge(a, b, on=["city"])


def test_missing_key_raises(spark):
    a = spark.createDataFrame([("c", 1)], "city string, n int")
    with pytest.raises(KeyError):
        left_merge(a, a.select("city"), ["nope"], ["city"])


def test_empty_right_keeps_left(spark):
    a = spark.createDataFrame([("c", 1)], "city string, level int")
    b = spark.createDataFrame([], "city string, level int, headcount bigint")
    out = left_merge(a, b, on=["city", "level"])
    assert bag(out) == Counter({("c", 1, None): 1})


def test_fills(spark):
    df = spark.createDataFrame([(None, "x", None), ("a", "y", 3)], "city string, firm_city string, n bigint")
    out = fill_value(fill_from(df, "city", "firm_city"), "n", 0)
    assert dict(out.dtypes)["n"] == "bigint"
    assert bag(out) == Counter({("x", "x", 0): 1, ("a", "y", 3): 1})


def _pandas_bag(left_rows, right_rows, left_on, right_on, lcols, rcols):
    import pandas as pd

    lp = pd.DataFrame(left_rows, columns=lcols, dtype=object)
    rp = pd.DataFrame(right_rows, columns=rcols, dtype=object)
    out = lp.merge(rp, left_on=left_on, right_on=right_on, how="left")
    out = out.astype(object).where(out.notna(), None)
    return Counter(tuple(r) for r in out.itertuples(index=False)), list(out.columns)


_key = st.sampled_from(["a", "b", None])
_lvl = st.sampled_from([1, 2, None])


def test_left_merge_matches_dataframe_library_semantics(spark):
    """NULL keys match NULL keys, rows fan out, unmatched rows keep NULLs and
    a shared key name is kept once -- as the dataframe library merges."""

    @settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
    @given(
        st.lists(st.tuples(_key, _lvl, st.integers(0, 9)), max_size=8),
        st.lists(st.tuples(_key, _lvl, st.integers(10, 19)), max_size=8),
    )
    def check(left_rows, right_rows):
        lcols, rcols = ["firm", "level", "x"], ["branch", "level", "y"]
        left = spark.createDataFrame(left_rows, "firm string, level int, x int")
        right = spark.createDataFrame(right_rows, "branch string, level int, y int")
        got = left_merge(left, right, ["firm", "level"], ["branch", "level"])
        expected, cols = _pandas_bag(left_rows, right_rows, ["firm", "level"], ["branch", "level"], lcols, rcols)
        assert got.columns == cols
        assert bag(got) == expected

    check()


@pytest.mark.parametrize("null_safe", [True, False])
def test_split_skew_form_gives_the_same_rows(spark, null_safe):
    left = spark.createDataFrame([("a", 1, 10), ("a", 1, 11), (None, 1, 12), (None, None, 13), ("z", 9, 14), ("z", 9, 14)],
                                 "k string, l int, v int")
    right = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), (None, 1, "n"), (None, 1, "n"), ("q", 1, "q")],
                                  "k string, l int, w string")
    plain = left_merge(left, right, on=["k", "l"], null_safe=null_safe)
    split = left_merge(left, right, on=["k", "l"], null_safe=null_safe, split_skew=True)
    assert split.schema == plain.schema and Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))
    for empty in (left_merge(left.limit(0), right, on=["k", "l"], split_skew=True),
                  left_merge(left, right.limit(0), on=["k", "l"], split_skew=True)):
        assert empty.schema == plain.schema
    named = left_merge(left, right.toDF("k2", "l2", "w"), ["k", "l"], ["k2", "l2"], split_skew=True)
    assert named.columns == ["k", "l", "v", "k2", "l2", "w"] and named.where("v = 14 and k2 is null").count() == 2
