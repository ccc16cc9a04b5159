"""Data-quality census and display operators.

All of them stay distributed: the census is one aggregate row, group sizes
are a partial + final aggregate, the first-n operators use Spark's top-k
(``TakeOrderedAndProject``), which keeps at most n rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_missing(df: DataFrame, c: str) -> Column:
    # The dataframe library the census mirrors counts NaN as missing.
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def null_counts(df: DataFrame) -> dict[str, Column]:
    """For each column the aggregate that counts its NULLs, for use in another
    job over the same rows."""
    return {c: F.count_if(_is_missing(df, c)) for c in df.columns}


def null_census(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: for each column, how many rows hold NULL (A5; A6 with one
    column). Columns keep their names; counts are bigint."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(*[F.count_if(_is_missing(df, c)).cast(T.LongType()).alias(c) for c in cols])


def group_sizes(df: DataFrame, keys: list[str], name: str = "size") -> DataFrame:
    """Row count per distinct key tuple, rows with a NULL in any key dropped
    first (the dataframe ``groupby`` default) (A7)."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicate_groups(df: DataFrame, keys: list[str], name: str = "size") -> DataFrame:
    """Key tuples that occur more than once (the duplicate census)."""
    return group_sizes(df, keys, name).where(F.col(name) > 1)


def distinct_where(df: DataFrame, condition: Column, col: str) -> DataFrame:
    """Distinct values of ``col`` among rows meeting ``condition``, NULL
    included (A8)."""
    return df.where(condition).select(col).distinct()


def ordered_nulls_last(df: DataFrame, cols: list[str], descending: bool = False) -> DataFrame:
    """Sort ascending with NULLs last, the other engine's default (O1).
    Spark's ascending default puts NULLs first."""
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in cols]
    return df.orderBy(*order)


def first_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a total order (O2). The order must be given:
    "natural order" is not deterministic on a distributed table."""
    if not order:
        raise ValueError("first_n needs an explicit order to be deterministic")
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def first_n_then_sort(df: DataFrame, n: int, order: list[str], then_by: list[str]) -> DataFrame:
    """Take the first ``n`` rows by ``order``, *then* sort those by
    ``then_by`` (O3). Not a top-k by ``then_by``: the limit is applied first."""
    head = first_n(df, n, order)
    return head.orderBy(*[F.col(c).asc_nulls_last() for c in then_by])
