"""Predicates with SQL three-valued logic.

Every exclusion drops rows whose tested value is NULL, as ``NOT IN``,
``<>`` and ``NOT LIKE`` do in SQL. All of them are plain Catalyst
expressions, so they are pushed below joins and into the parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(col: str, collation: str | None) -> Column:
    c = F.col(col)
    return F.collate(c, collation) if collation else c


def exclude_values(df: DataFrame, col: str, values, collation: str | None = None) -> DataFrame:
    """``col NOT IN (values)``; NULL excluded (F1)."""
    values = list(values)
    if not values:
        return df.where(F.col(col).isNotNull())
    return df.where(~_text(col, collation).isin(values))


def exclude_equal(df: DataFrame, col: str, value, collation: str | None = None) -> DataFrame:
    """``col <> value``; NULL excluded (F2)."""
    return df.where(_text(col, collation) != F.lit(value))


def exclude_containing(df: DataFrame, col: str, substring: str, collation: str | None = None) -> DataFrame:
    """``col NOT LIKE '%substring%'`` with the substring taken literally; NULL
    excluded (F3, E6). ``contains`` avoids LIKE's wildcard escaping."""
    return df.where(~_text(col, collation).contains(F.lit(substring)))


def where_equal(df: DataFrame, **equal) -> DataFrame:
    """Conjunction of ``col = value`` masks."""
    if not equal:
        return df
    return df.where(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in equal.items()]))


def where_null(df: DataFrame, col: str) -> DataFrame:
    """``col IS NULL``."""
    return df.where(F.col(col).isNull())


def where_all(df: DataFrame, *conditions: Column) -> DataFrame:
    """Conjunction of arbitrary masks (F8)."""
    if not conditions:
        return df
    return df.where(reduce(lambda a, b: a & b, conditions))
