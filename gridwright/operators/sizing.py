"""Size checks behind every explicit broadcast.

A relation is broadcast only after its real bytes (text, binary and arrays by
their own length) have been summed while it was written, and are under a cap.
Anything larger takes the shuffle join.
"""

from __future__ import annotations

import logging
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
# In-memory hashed relations take roughly twice the raw row width.
HASH_OVERHEAD = 2.0
# Row header, null bits and pointer of one hashed row.
ROW_OVERHEAD = 16
log = logging.getLogger(__name__)


def parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    n, unit = int(m.group(1)), m.group(2).lower()
    if unit not in _UNITS:
        raise ValueError(f"unknown unit in {text!r}")
    return n * _UNITS[unit]


def broadcast_cap(df: DataFrame, cap_bytes: int | None = None) -> int:
    """The cap: given, else the session's autoBroadcastJoinThreshold
    (-1 disables broadcasting)."""
    if cap_bytes is not None:
        return int(cap_bytes)
    return parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def _fixed_width(dt: T.DataType) -> int | None:
    """In-memory bytes of a fixed-width type; None when the size depends on the value."""
    if isinstance(dt, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    return None


def _value_bytes(col, dt: T.DataType):
    """Column with the bytes one value takes: exact for text, binary and
    arrays of fixed-width elements; other nested values count as the length
    of their JSON text."""
    fixed = _fixed_width(dt)
    if fixed is not None:
        return F.lit(fixed).cast("long")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)).cast("long") + F.lit(8)
    if isinstance(dt, T.ArrayType) and _fixed_width(dt.elementType) is not None:
        return F.coalesce(F.greatest(F.size(col), F.lit(0)), F.lit(0)).cast("long") * max(
            8, _fixed_width(dt.elementType)
        ) + F.lit(24)
    return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)).cast("long") + F.lit(24)


def row_bytes(df: DataFrame):
    """Column with the in-memory bytes of one row of ``df``."""
    total = F.lit(ROW_OVERHEAD).cast("long")
    for f in df.schema.fields:
        total = total + _value_bytes(df[f"`{f.name}`"], f.dataType)
    return total


def materialize_observed(
    df: DataFrame, name: str = "materialized", aggregates: dict[str, Column] | None = None
) -> tuple[DataFrame, dict]:
    """``(stored, observed)``: compute ``df`` once and cut its lineage.

    Written as parquet under the shared folder named by
    ``spark.checkpoint.dir`` and read back (survives executor loss; never a
    machine-local copy). ``rows``, real in-memory ``bytes`` (text and binary
    by their own length) and any further ``aggregates`` are observed during
    the same write job, so measuring costs no extra job. (An RDD checkpoint
    would compute an unpersisted input twice.)"""
    from gridwright.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    obs = Observation(f"{name}-size-{uuid.uuid4().hex[:8]}")
    df.observe(
        obs, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"),
        *[c.alias(k) for k, c in (aggregates or {}).items()],
    ).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(obs.get)


def materialize_measured(df: DataFrame, name: str = "materialized") -> tuple[DataFrame, int, int]:
    """``materialize_observed`` as ``(stored, rows, bytes)``."""
    stored, got = materialize_observed(df, name)
    return stored, int(got["rows"]), int(got["bytes"])


def materialize_counted(df: DataFrame, name: str = "materialized") -> tuple[DataFrame, int]:
    """``materialize_measured`` without the bytes."""
    return materialize_measured(df, name)[:2]


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """``materialize_measured`` without the figures."""
    return materialize_measured(df, name)[0]


def measured_bytes(df: DataFrame) -> int:
    """In-memory bytes of a relation by one aggregation job over it."""
    return int(df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0])


def fits_one_task(df: DataFrame) -> bool:
    """The planner's estimate of the whole relation is under the session's
    advisory partition size. Such a relation needs no measuring: whatever its
    keys are, one task holds it. (The estimate bounds joins from above.)"""
    advisory = parse_bytes(df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= advisory


def broadcast_if_small(
    df: DataFrame, cap_bytes: int | None = None, size_bytes: int | None = None
) -> tuple[DataFrame, bool]:
    """``(F.broadcast(df), True)`` when ``df``'s measured size (with the
    hashed relation's overhead) is under the cap, else ``(df, False)``.
    ``df`` should already be materialised; pass its bytes when known."""
    cap = broadcast_cap(df, cap_bytes)
    if cap <= 0:
        return df, False
    size = measured_bytes(df) if size_bytes is None else size_bytes
    if size * HASH_OVERHEAD <= cap:
        return F.broadcast(df), True
    return df, False


def small_side(df: DataFrame, name: str, cap_bytes: int | None = None) -> DataFrame:
    """``measured_side`` without the decision."""
    return measured_side(df, name, cap_bytes)[0]


def measured_side(df: DataFrame, name: str, cap_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Materialise a relation expected to be small (a dimension-derived map,
    an aggregate) and broadcast it when its measured size is under the cap.

    The planner cannot know such a relation is small -- its static estimate
    for a join or aggregate is bounded by its inputs -- so without this the
    big side of the join would be shuffled before AQE sees the real size.
    """
    stored, rows, size = materialize_measured(df, name)
    out, broadcast = broadcast_if_small(stored, cap_bytes, size)
    log.info(
        "%s: %d rows, %d bytes measured, cap %d bytes -> %s",
        name, rows, size, broadcast_cap(stored, cap_bytes),
        "broadcast" if broadcast else "shuffle join",
    )
    return out, broadcast
