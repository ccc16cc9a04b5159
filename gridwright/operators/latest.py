"""Latest record per key, ties kept.

``latest_per_group`` keeps every row whose ordering value equals the maximum
of its group. Ties are kept, so ``row_number`` / ``max_by`` would be wrong.

The physical strategies give the same multiset:

``auto`` (default)
    Chosen from a sketch of the keys (``choose_strategy``: one aggregation over
    the key columns, nothing shuffled but sketches). Where the maxima are few
    against the rows, ``maxima``. Where there are nearly as many groups as rows,
    writing the maxima gains nothing: ``window``, the single shuffle -- unless
    the sketch shows a group too big for one task, then ``agg_join``.

``maxima``
    As ``agg_join``, but the maxima table is computed first and written to
    the shared checkpoint folder (lineage cut), its rows counted during that
    same write job; only if its estimated size fits under the broadcast cap
    is it broadcast -- then the big input is filtered map-side and never
    shuffled. Otherwise the shuffle semi-join below is used. The input is
    read twice either way (once for the maxima), never shuffled whole by the
    group key alone.

``agg_join``
    1. ``groupBy(keys).max(order)`` -- partial aggregation on the map side,
       so only (groups x map tasks) rows cross the network.
    2. left-semi join of the input with that table on ``keys + [order]``.
    The big side is hash-partitioned on the keys *and* the ordering value,
    so one group holding a third of all rows is still spread over many tasks
    (its rows differ in the ordering value); only rows that tie on the
    maximum meet in one partition, and AQE's skew-join split handles those.
    The maxima table is broadcast by the planner when its estimated size is
    under ``spark.sql.autoBroadcastJoinThreshold``, or by AQE from runtime
    statistics; there is no unconditional broadcast hint.

``window``
    ``max(order) OVER (PARTITION BY keys)`` then a filter: the literal SQL
    form. One shuffle, but each group is sorted and scanned in one task, so a
    hot key becomes a straggler. Kept for small inputs and for testing.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridwright.operators.sizing import fits_one_task, small_side

STRATEGIES = ("auto", "maxima", "agg_join", "window")
# Strategies that run small jobs while the plan is built.
MEASURED = ("auto", "maxima")
# Groups per row from which the maxima count as no reduction.
NO_REDUCTION = 0.5
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class KeySketch:
    """What decides: rows, about how many groups, and about how many rows the
    biggest group has."""

    rows: int
    groups: int
    biggest: int


def _tasks(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def sketch_keys(df: DataFrame, keys: list[str]) -> KeySketch:
    if not keys:
        n = df.count()
        return KeySketch(n, min(n, 1), n)
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    # Enough counters to see a group with more than a task's share of the rows.
    tracked = min(1 << 18, max(1024, 16 * _tasks(df)))
    got = df.select(hashed.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("h").alias("groups"),
        F.expr(f"approx_top_k(h, 1, {tracked})").alias("top")).first()
    return KeySketch(got["rows"], got["groups"], got["top"][0]["count"] if got["top"] else 0)


def choose_strategy(df: DataFrame, keys: list[str]) -> str:
    """``maxima``, ``window`` or ``agg_join`` for this input (see the module
    notes). A group is too big for a window when it has more rows than a task
    gets on average, so a window never sees a hot group. An input that one
    task can hold has none: it takes the window unsketched."""
    if fits_one_task(df):
        log.info("latest by %s: fits one task -> window", keys)
        return "window"
    s = sketch_keys(df, keys)
    if s.groups < NO_REDUCTION * s.rows or not s.rows:
        chosen = "maxima"
    else:
        chosen = "window" if s.biggest <= max(1, s.rows // _tasks(df)) else "agg_join"
    log.info("latest by %s: %d rows, about %d groups, the biggest about %d rows -> %s",
             keys, s.rows, s.groups, s.biggest, chosen)
    return chosen


def _key_equal(left: str, right: str, null_safe: bool) -> Column:
    return F.col(left).eqNullSafe(F.col(right)) if null_safe else F.col(left) == F.col(right)


def group_max(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """One row per group with the maximum of ``value`` (partial + final agg)."""
    return df.groupBy(*keys).agg(F.max(value).alias(alias))


def latest_per_group(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    *,
    null_safe_keys: bool = True,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``order_col`` equals the group maximum; ties kept.

    ``null_safe_keys=True`` treats NULL keys as one group (window semantics);
    ``False`` drops rows with a NULL key (join-back semantics, as in an
    equality join against a grouped sub-query). Rows with a NULL ordering
    value never qualify. ``broadcast_bytes`` caps the broadcast of the
    maxima under ``maxima`` (default: the session's autoBroadcastJoinThreshold).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    keys = list(keys)
    if strategy == "auto":
        strategy = choose_strategy(df, keys)
    if strategy == "window":
        max_col = f"__max_{order_col}"
        out = (
            df.withColumn(max_col, F.max(order_col).over(Window.partitionBy(*keys)))
            .where(F.col(order_col) == F.col(max_col))
            .drop(max_col)
        )
        if not null_safe_keys and keys:
            out = out.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        return out

    right_keys = [f"__lk{i}" for i in range(len(keys))]
    maxima = group_max(df, keys, order_col, "__lmax").select(
        *[F.col(k).alias(r) for k, r in zip(keys, right_keys)], "__lmax"
    )
    if strategy == "maxima":
        maxima = small_side(maxima.where(F.col("__lmax").isNotNull()), "latest-maxima", broadcast_bytes)
    cond = [_key_equal(k, r, null_safe_keys) for k, r in zip(keys, right_keys)]
    cond.append(F.col(order_col) == F.col("__lmax"))
    return df.join(maxima, reduce(lambda a, b: a & b, cond), "left_semi")


def with_group_max(
    df: DataFrame,
    keys: list[str],
    value: str,
    alias: str,
    *,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Every row of ``df`` plus the maximum of ``value`` over its group.

    NULL keys form one group. ``agg_join`` pre-aggregates and joins back on
    the keys (AQE splits a skewed key on the big side); ``maxima`` does the
    same but broadcasts the materialised maxima when they measure under the
    cap, so the big side is not shuffled; ``window`` is the literal
    ``MAX() OVER (PARTITION BY ...)``; ``auto`` chooses.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if strategy == "auto":
        strategy = choose_strategy(df, list(keys))
    if strategy == "window":
        return df.withColumn(alias, F.max(value).over(Window.partitionBy(*keys)))
    right_keys = [f"__gk{i}" for i in range(len(keys))]
    maxima = group_max(df, keys, value, alias).select(
        *[F.col(k).alias(r) for k, r in zip(keys, right_keys)], alias
    )
    if strategy == "maxima":
        maxima = small_side(maxima, "group-maxima", broadcast_bytes)
    cond = reduce(lambda a, b: a & b, [_key_equal(k, r, True) for k, r in zip(keys, right_keys)])
    return df.join(maxima, cond, "inner").drop(*right_keys)


def last_day_in_month(
    df: DataFrame,
    keys: list[str],
    ts_col: str,
    *,
    strategy: str = "auto",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Rows dated (any time) on the last day, within their calendar month,
    on which the key has a row: ``MAX(DAY(ts))`` per (keys, year, month)
    joined back on all four parts (A2 + J7, or the W3 window form).

    Rows with a NULL key or NULL timestamp are dropped, as the equality join
    of the source query drops them.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    keys = list(keys)
    if strategy == "window":
        day = F.to_date(F.col(ts_col))
        w = Window.partitionBy(*keys, F.trunc(F.col(ts_col), "month"))
        out = (
            df.withColumn("__lday", F.max(day).over(w))
            .where(day == F.col("__lday"))
            .drop("__lday")
        )
        if keys:
            out = out.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        return out
    parts = df.withColumns(
        {
            "__y": F.year(ts_col),
            "__m": F.month(ts_col),
            "__d": F.dayofmonth(ts_col),
        }
    )
    out = latest_per_group(
        parts, keys + ["__y", "__m"], "__d", null_safe_keys=False, strategy=strategy, broadcast_bytes=broadcast_bytes
    )
    return out.drop("__y", "__m", "__d")
