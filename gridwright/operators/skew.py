"""Heavy keys of a relation, found by a sketch while it is written.

``approx_top_k`` over the hash of the keys runs in the write itself. A key with
more rows than one task should read is *hot*; the rows of the hashes that the
sketch names are then counted exactly, so a key counts as hot only if it is
there, whatever the sketch or the hash say. NULL is a key like any other.

At most ``MAX_HOT`` keys can be hot: a key needs over 1/``MAX_HOT`` of the rows.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridwright.operators.sizing import broadcast_if_small, materialize_observed, parse_bytes

MAX_HOT = 4096
# Counters of the sketch: it errs by less than rows / MAX_HOT.
TRACKED = 1 << 16
SLICES = "__slices"
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Written:
    """A relation in the shared folder with what was observed while writing it."""

    frame: DataFrame
    rows: int
    bytes: int
    top: tuple[tuple[int, int], ...]  # hash of the keys and its approximate rows

    def slice_rows(self) -> int:
        """Rows that one task should read: the session's advisory partition size."""
        advisory = parse_bytes(
            self.frame.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
        return max(1, self.rows * advisory // max(1, self.bytes))


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def top_keys(keys: list[str]) -> Column:
    """Aggregate: the heaviest hashes of the keys."""
    columns = ", ".join(f"`{k}`" for k in keys)
    return F.expr(f"approx_top_k(xxhash64({columns}), {MAX_HOT}, {TRACKED})")


def write_with_sketch(df: DataFrame, keys: list[str], name: str) -> Written:
    """Write ``df`` once to the shared folder; rows, bytes and the heaviest
    keys are observed during the write."""
    stored, got = materialize_observed(df, name, {"top": top_keys(keys)})
    return Written(stored, got["rows"], got["bytes"], tuple((r["item"], r["count"]) for r in got["top"] or ()))


def sketched_side(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, Written | None]:
    """The relation, written and measured, and marked for broadcast if it is
    under the cap; else with its sketch for a merge that splits hot keys."""
    found = write_with_sketch(df, keys, name)
    out, small = broadcast_if_small(found.frame, None, found.bytes)
    log.info("%s: %d rows, %d bytes measured -> %s", name, found.rows, found.bytes, "broadcast" if small else "shuffle join")
    return out, None if small else found


def hot_keys(written: Written, keys: list[str], null_safe: bool = True, slice_rows: int | None = None) -> DataFrame | None:
    """The hot keys, each with the number of slices that its rows should be
    dealt into (``SLICES``); None if there are none. A key with a NULL is left
    out unless NULL matches NULL."""
    per_slice = slice_rows or written.slice_rows()
    least = max(per_slice, written.rows // MAX_HOT) + 1
    hashes = [h for h, n in written.top if n >= least]
    if not hashes:
        return None
    candidates = written.frame.where(key_hash(keys).isin(hashes))
    if not null_safe:
        candidates = candidates.dropna(subset=list(keys))
    counted = candidates.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    slices = F.ceil(F.col("__n") / per_slice).cast("int").alias(SLICES)
    found = counted.where(F.col("__n") >= least).select(*[F.col(f"`{k}`") for k in keys], slices)
    rows = found.collect()  # at most MAX_HOT
    log.info("%d hot keys on %s, dealt into %s slices", len(rows), keys, [r[SLICES] for r in rows])
    if not rows:
        return None
    schema = T.StructType([written.frame.schema[k] for k in keys] + [T.StructField(SLICES, T.IntegerType())])
    return written.frame.sparkSession.createDataFrame(rows, schema)
