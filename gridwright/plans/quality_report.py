"""Quality report over the published mart (G6): the checks the source
notebook ran by hand, as lazy DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridwright.operators.filters import where_equal
from gridwright.operators.quality import (
    distinct_where,
    duplicate_groups,
    first_n,
    first_n_then_sort,
    group_sizes,
    null_census,
)
from gridwright.operators.sizing import materialize
from gridwright.sinks.commits import Commit, pinned

# Columns of the duplicate census: the published columns without territory.
DUPLICATE_KEYS = ["city", "position", "level", "salary", "branch", "leader_level", "headcount"]


def quality_report(pay_grid: DataFrame) -> dict[str, DataFrame]:
    """``null_census``: NULLs per column (one row); ``group_sizes``: rows per
    distinct tuple of ``DUPLICATE_KEYS`` (NULL-key rows dropped);
    ``duplicates``: those tuples occurring more than once;
    ``cities_without_pay``: distinct cities of rows lacking a salary;
    ``cities_without_branch``: distinct cities of rows lacking a branch."""
    return {
        "null_census": null_census(pay_grid),
        "group_sizes": group_sizes(pay_grid, DUPLICATE_KEYS),
        "duplicates": duplicate_groups(pay_grid, DUPLICATE_KEYS),
        "cities_without_pay": distinct_where(pay_grid, F.col("salary").isNull(), "city"),
        "cities_without_branch": distinct_where(pay_grid, F.col("branch").isNull(), "city"),
    }


def report_summary(pay_grid: DataFrame) -> dict:
    """``summary_of`` the report over a frame."""
    return summary_of(quality_report(pay_grid))


def summary_of(rep: dict[str, DataFrame]) -> dict:
    """Bounded figures for a run log: the one-row NULL census, the number of
    repeated tuples and their rows, and the number of cities lacking pay or
    a branch. Every figure is an aggregate, so only single rows reach the
    driver."""
    census = rep["null_census"].first().asDict()
    dups = rep["duplicates"].agg(
        F.count(F.lit(1)).alias("tuples"), F.coalesce(F.sum("size"), F.lit(0)).alias("rows")
    ).first()
    return {
        "null_census": census,
        "repeated_tuples": int(dups["tuples"]),
        "rows_in_repeated_tuples": int(dups["rows"]),
        "cities_without_pay": rep["cities_without_pay"].count(),
        "cities_without_branch": rep["cities_without_branch"].count(),
    }


def published_sizes(spark: SparkSession, commit: Commit) -> DataFrame:
    """The one scan behind the report of a published version: rows per distinct
    tuple of ``DUPLICATE_KEYS``, NULL keys kept, written to the shared folder.
    Every other figure of the report is a fold of these."""
    rows = spark.read.schema(commit.schema).format(commit.detail["format"]).load(commit.path)
    return materialize(rows.groupBy(*DUPLICATE_KEYS).agg(F.count(F.lit(1)).alias("size")), "published-sizes")


def published_report(spark: SparkSession, root: str, name: str) -> dict[str, DataFrame]:
    """``quality_report`` of the newest published version, from what its write
    observed (the NULL census, kept in the manifest) and at most one scan of
    its files. The version is pinned during that scan."""
    with pinned(spark, root, name) as (commit, _):
        sizes = published_sizes(spark, commit)
    census = T.StructType([T.StructField(c, T.LongType()) for c in commit.schema.names])
    sized = sizes.dropna(subset=DUPLICATE_KEYS)
    return {
        "null_census": spark.createDataFrame([tuple(commit.detail["nulls"][c] for c in commit.schema.names)], census),
        "group_sizes": sized,
        "duplicates": sized.where(F.col("size") > 1),
        "cities_without_pay": distinct_where(sizes, F.col("salary").isNull(), "city"),
        "cities_without_branch": distinct_where(sizes, F.col("branch").isNull(), "city"),
    }


def profile_rows(report: dict[str, DataFrame]) -> DataFrame:
    """The whole report as one relation: figure, item (a column or a city),
    value. Repeated tuples are summed up; cities are listed with value 1."""
    census = report["null_census"]
    per_column = F.explode(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("value")) for c in census.columns]))
    nulls = census.select(per_column.alias("x")).select(F.lit("nulls").alias("figure"), "x.item", "x.value")

    def summed(figure: str, value: Column) -> DataFrame:
        return report["duplicates"].agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("value")).select(
            F.lit(figure).alias("figure"), F.lit(None).cast("string").alias("item"), "value")

    def listed(figure: str) -> DataFrame:
        return report[figure].select(
            F.lit(figure).alias("figure"), F.col("city").alias("item"), F.lit(1).cast("bigint").alias("value"))

    parts = [nulls, summed("repeated_tuples", F.count(F.lit(1))), summed("rows_in_repeated_tuples", F.sum("size")),
             listed("cities_without_pay"), listed("cities_without_branch")]
    return reduce(DataFrame.unionByName, parts)


def branch_spot_check(pay_grid: DataFrame, branch: str, n: int = 270) -> DataFrame:
    """The first ``n`` mart rows of one branch, in a total order (F6 + O2)."""
    return first_n(where_equal(pay_grid, branch=branch), n, list(pay_grid.columns))


def firm_branch_sample(staffed_grid: DataFrame, firm: str, n: int = 135) -> DataFrame:
    """The first ``n`` staffed-grid rows of one firm serving as its own
    branch, then sorted by position and grade (F8 + O3)."""
    masked = where_equal(staffed_grid, firm=firm, branch=firm)
    return first_n_then_sort(masked, n, list(staffed_grid.columns), ["position", "level"])
