"""Grouping without aggregates, counting with hidden keys, grade expansion
(A1, A3, A4, P7, X1, U1, P2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """``GROUP BY keys`` with no aggregate: one row per distinct key tuple,
    NULL forming its own value. Planned as a partial + final hash aggregate."""
    return df.select(*keys).distinct()


def count_by(
    df: DataFrame,
    keys: list[str],
    hidden: list[str] = (),
    *,
    name: str = "count",
    output: list[str] | None = None,
) -> DataFrame:
    """``count(*)`` grouped by ``keys + hidden``, with the hidden keys left out
    of the result, so equal visible rows may repeat (bag semantics).

    ``output`` fixes the column order (it may interleave the count column);
    by default the visible keys come first, then the count.
    """
    group = list(keys) + [h for h in hidden if h not in keys]
    counted = df.groupBy(*group).agg(F.count(F.lit(1)).alias(name))
    cols = output if output is not None else list(keys) + [name]
    missing = [c for c in cols if c not in counted.columns]
    if missing:
        raise KeyError(f"output columns not produced: {missing}")
    return counted.select(*cols)


def expand_levels(df: DataFrame, levels: tuple[int, ...] | list[int], name: str = "level") -> DataFrame:
    """Every row repeated once per grade, the grade in a new int column.

    One pass, no shuffle: ``explode`` of a literal array, the rows of each
    input row generated next to it in the same task.
    """
    if not levels:
        raise ValueError("levels must not be empty")
    arr = F.array(*[F.lit(int(v)).cast(T.IntegerType()) for v in levels])
    return df.withColumn(name, F.explode(arr))


def union_levels(df: DataFrame, levels: tuple[int, ...] | list[int], name: str = "level") -> DataFrame:
    """The literal form of ``expand_levels``: one copy per grade with a
    constant column, stacked by ``UNION ALL`` (U1 + P2). Same multiset."""
    if not levels:
        raise ValueError("levels must not be empty")
    copies = [df.withColumn(name, F.lit(int(v)).cast(T.IntegerType())) for v in levels]
    return reduce(lambda a, b: a.unionByName(b), copies)
