from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import bag, rows
from gridwright.operators.quality import (
    distinct_where,
    duplicate_groups,
    first_n,
    first_n_then_sort,
    group_sizes,
    null_census,
    ordered_nulls_last,
)
from gridwright.plans.quality_report import quality_report


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame(
        [
            ("T", "c1", "b1", "p", 1, 10.0, "L", 2),
            ("T", "c1", "b1", "p", 1, 10.0, "L", 2),
            ("T", "c1", None, "p", 2, None, "L", 0),
            ("T", None, None, "q", 1, float("nan"), "L", 0),
            ("T", "c2", "b2", "q", 3, 30.0, None, 1),
        ],
        "territory string, city string, branch string, position string, level int, salary double, "
        "leader_level string, headcount bigint",
    )


def test_null_census(grid):
    out = null_census(grid)
    assert out.count() == 1
    r = out.first().asDict()
    assert r == {"territory": 0, "city": 1, "branch": 2, "position": 0, "level": 0, "salary": 2,
                 "leader_level": 1, "headcount": 0}
    assert dict(out.dtypes)["city"] == "bigint"
    assert null_census(grid, ["branch"]).first()[0] == 2


def test_group_sizes_drop_null_keys(grid):
    out = group_sizes(grid, ["city", "branch", "level"])
    assert bag(out) == Counter({("c1", "b1", 1, 2): 1, ("c2", "b2", 3, 1): 1})
    assert rows(duplicate_groups(grid, ["city", "branch", "level"])) == [("c1", "b1", 1, 2)]


def test_distinct_where_keeps_null(grid):
    out = distinct_where(grid, F.col("branch").isNull(), "city")
    assert bag(out) == Counter({("c1",): 1, (None,): 1})


def test_ordered_nulls_last(grid):
    assert [r.city for r in ordered_nulls_last(grid, ["city"]).collect()] == ["c1", "c1", "c1", "c2", None]


def test_first_n_then_sort_limits_first(spark):
    df = spark.createDataFrame([(i, 10 - i) for i in range(10)], "k int, v int")
    out = first_n_then_sort(df, 3, ["k"], ["v"])
    assert [tuple(r) for r in out.collect()] == [(2, 8), (1, 9), (0, 10)]
    assert [r.k for r in first_n(df, 2, ["v"]).collect()] == [9, 8]
    with pytest.raises(ValueError):
        first_n(df, 2, [])


def test_quality_report(grid):
    rep = quality_report(grid)
    assert set(rep) == {"null_census", "group_sizes", "duplicates", "cities_without_pay", "cities_without_branch"}
    assert bag(rep["cities_without_pay"]) == Counter({("c1",): 1})


def test_report_summary(grid):
    from gridwright.plans.quality_report import report_summary

    s = report_summary(grid)
    assert s["null_census"]["branch"] == 2
    assert s["repeated_tuples"] == 1 and s["rows_in_repeated_tuples"] == 2
    assert s["cities_without_pay"] == 1 and s["cities_without_branch"] == 2


def test_the_published_report_equals_the_report_of_the_rows(spark):
    """The NULL census comes from the publish write; one scan gives the rest."""
    import importlib

    from conftest import bag
    from gridwright.session import scratch_path
    from gridwright.sinks.publish import publish

    Q = importlib.import_module("gridwright.plans.quality_report")  # the package exports a function of that name
    schema = ("territory string, city string, branch string, position string, level int, salary double, "
              "leader_level string, headcount bigint")
    rows = spark.createDataFrame([
        ("t", "a", "b", "p", 1, 1.0, "l", 2), ("u", "a", "b", "p", 1, 1.0, "l", 2), ("t", "a", None, "p", 1, 1.0, "l", 0),
        ("t", None, None, "p", 1, None, None, 0), (None, "c", "d", "p", 2, float("nan"), "l", 0)], schema)
    root = scratch_path(spark, "report")
    for name, df in (("rep_full", rows), ("rep_empty", rows.limit(0))):
        publish(df, name, root, layout=None)
        want, got = Q.quality_report(df), Q.published_report(spark, root, name)
        for figure in want:
            assert got[figure].columns == want[figure].columns, figure
            assert bag(got[figure]) == bag(want[figure]), figure
        assert Q.summary_of(got) == Q.report_summary(df)
    figures = {(r.figure, r.item): r.value for r in Q.profile_rows(Q.published_report(spark, root, "rep_full")).collect()}
    assert figures[("nulls", "salary")] == 2 and figures[("nulls", "headcount")] == 0
    assert figures[("repeated_tuples", None)] == 1 and figures[("rows_in_repeated_tuples", None)] == 2
    assert figures[("cities_without_branch", "a")] == 1 and figures[("cities_without_pay", None)] == 1
    # every frame of the report reads the folded rows, none the published files
    commits = importlib.import_module("gridwright.sinks.commits")
    path = commits.CommitLog(spark, root, "rep_full").latest().path.split("/")[-1]
    for df in Q.published_report(spark, root, "rep_full").values():
        assert path not in df._jdf.queryExecution().optimizedPlan().toString()
        assert not any(path in f for f in df.inputFiles())
