from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import bag
from gridwright.functions import date_parts, label_columns, month_start, run_date
from gridwright.operators.filters import (
    exclude_containing,
    exclude_equal,
    exclude_values,
    where_all,
    where_equal,
    where_null,
)
from gridwright.operators.reduce import count_by, distinct_keys, expand_levels, union_levels


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame(
        [("a", "ДОМ", 1), ("b", "ГРП", 2), ("c", None, 3), ("Курьер (на аутсорсе)", "X", 4), (None, "X", 5),
         ("2.03. Фед.развитие сайта", "X", 6), ("d", "X", 7)],
        "position string, prefix string, n int",
    )


def test_exclusions_drop_nulls(names):
    assert sorted(r.n for r in exclude_values(names, "prefix", ["ДОМ", "ГРП"]).collect()) == [4, 5, 6, 7]
    assert sorted(r.n for r in exclude_equal(names, "position", "2.03. Фед.развитие сайта").collect()) == [
        1, 2, 3, 4, 7
    ]
    assert sorted(r.n for r in exclude_containing(names, "position", "(на аутсорсе)").collect()) == [
        1, 2, 3, 6, 7
    ]
    assert sorted(r.n for r in exclude_values(names, "prefix", []).collect()) == [1, 2, 4, 5, 6, 7]


def test_contains_is_literal(spark):
    df = spark.createDataFrame([("50% off",), ("a_b",), ("ab",)], "s string")
    assert [r.s for r in exclude_containing(df, "s", "%").collect()] == ["a_b", "ab"]
    assert sorted(r.s for r in exclude_containing(df, "s", "_").collect()) == ["50% off", "ab"]


def test_collation_option(spark):
    df = spark.createDataFrame([("Promo",), ("other",)], "prefix string")
    assert [r.prefix for r in exclude_values(df, "prefix", ["PROMO"], collation="UTF8_LCASE").collect()] == ["other"]
    assert exclude_values(df, "prefix", ["PROMO"]).count() == 2


def test_masks(names):
    assert [r.n for r in where_equal(names, prefix="X", position="d").collect()] == [7]
    assert [r.n for r in where_null(names, "position").collect()] == [5]
    assert [r.n for r in where_all(names, F.col("n") > 5, F.col("prefix") == "X").collect()] == [6, 7]


def test_count_by_hidden_keys(spark):
    df = spark.createDataFrame(
        [("p", 1, "r1"), ("p", 1, "r1"), ("p", 1, "r2"), ("q", 2, "r1")], "position string, level int, rrs string"
    )
    out = count_by(df, ["position", "level"], ["rrs"], name="headcount")
    assert out.columns == ["position", "level", "headcount"]
    assert bag(out) == Counter({("p", 1, 2): 1, ("p", 1, 1): 1, ("q", 2, 1): 1})
    with pytest.raises(KeyError):
        count_by(df, ["position"], ["rrs"], output=["position", "nope"])


def test_distinct_keys_keeps_null(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "t string, c int")
    assert bag(distinct_keys(df, ["t", "c"])) == Counter({(None, 1): 1, ("a", 1): 1})


def test_expand_equals_union(spark):
    df = spark.createDataFrame([("f", "p"), ("f", "p"), (None, "q")], "firm string, position string")
    a, b = expand_levels(df, (1, 2, 3)), union_levels(df, (1, 2, 3))
    assert dict(a.dtypes)["level"] == "int"
    assert bag(a) == bag(b)
    assert a.count() == 9
    with pytest.raises(ValueError):
        expand_levels(df, ())


def test_expand_has_no_union_or_exchange(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    plan = expand_levels(df, (1, 2, 3))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Union" not in plan and "Exchange" not in plan


def test_scalar_functions(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 23, 0),)], "ts timestamp")
    p = date_parts("ts")
    r = df.select(p["year"], p["month"], p["day"], month_start("ts"), run_date("2024-06-30")).first()
    assert tuple(r) == (2024, 2, 29, dt.date(2024, 2, 1), dt.date(2024, 6, 30))
    assert label_columns(df, ["x"]).columns == ["x"]
    with pytest.raises(ValueError):
        label_columns(df, ["x", "y"])


def test_rtrim_collation_ignores_case_and_trailing_blanks(spark):
    df = spark.createDataFrame([("2.03. фед.развитие сайта  ",), ("другое",)], "position string")
    kept = exclude_equal(df, "position", "2.03. Фед.развитие сайта", collation="UTF8_LCASE_RTRIM")
    assert [r.position for r in kept.collect()] == ["другое"]
    assert exclude_equal(df, "position", "2.03. Фед.развитие сайта").count() == 2
