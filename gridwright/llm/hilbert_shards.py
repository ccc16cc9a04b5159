"""Sharding by a Hilbert curve over document metadata.

Each document is a point of metadata: id and size cut at their quantiles,
language and source by hash.
Sorting by the point's index on a Hilbert curve keeps documents that are near
in all dimensions near in the order; the order is cut into runs, one per
shard, so the files of a shard cover a small box of the metadata space and a
predicate on any of the dimensions prunes files by their min/max.

The order is made by a range exchange of narrow rows (no text), each range is
numbered where it lies, and the offsets of the ranges (one row per partition)
turn that into the row's global position. Nothing is sorted in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import written

# Bits of each dimension; the curve has 2 ** (4 * BITS) cells.
BITS = 8
DIMENSIONS = ("doc_id", "size", "lang", "source")


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points, shape (n, dims), each
    coordinate below 2 ** bits (Skilling's transpose form, all rows at once)."""
    x = points.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    q = 1 << (bits - 1)
    while q > 1:
        low, bit = np.uint64(q - 1), np.uint64(q)
        for i in range(dims):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap if i else np.uint64(0)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[dims - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= turn
    index = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << one) | ((x[i] >> np.uint64(b)) & one)
    return index


def quantile_cells(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Cell of each number: how many of the ascending bounds it reaches."""
    return np.searchsorted(bounds, values, side="right")


def hilbert_column(bounds: list[np.ndarray], *columns: Column, bits: int = BITS) -> Column:
    """Index of the point whose first coordinates are numbers, cut at their
    ``bounds``, and whose others are cells."""

    @F.pandas_udf("bigint")
    def index(*values: pd.Series) -> pd.Series:
        points = [v.to_numpy(np.int64) for v in values]
        points[: len(bounds)] = [quantile_cells(v, b) for v, b in zip(points, bounds)]
        return pd.Series(hilbert_index(np.stack(points, 1), bits).astype(np.int64))

    return index(*columns)


def quantile_bounds(rows: DataFrame, *columns: str, bits: int = BITS) -> list[np.ndarray]:
    """Bounds that cut each column's values into 2 ** ``bits`` cells of about
    equal numbers of rows (approximate quantiles over all rows, one bounded
    sketch a column). However far off a few values are, the others keep their cells."""
    cells = 1 << bits
    shares = F.array(*[F.lit(k / cells) for k in range(1, cells)])
    found = rows.agg(*[F.percentile_approx(c, shares, 8 * cells).alias(c) for c in columns]).first()
    return [np.array(v if v else [], np.int64) for v in found]


def hashed_cell(value: Column, bits: int = BITS) -> Column:
    """Cell of a category; null goes to cell 0."""
    cell = F.pmod(F.xxhash64(value.cast("string")), F.lit((1 << bits) - 1)) + 1
    return F.when(value.isNull(), 0).otherwise(cell).cast("int")


def curve_positions(documents: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """The ``carried`` columns, doc_id, size, text_crc32, hilbert, position (0-based, gapless, in curve
    order). Ties on the curve are ordered by text, then id, then the number
    of the stored row, so equal texts of one cell are neighbours, and any
    number of equal rows still spreads over several ranges."""
    data = F.encode(F.col("text").cast("string"), "UTF-8")
    rows = documents.select(
        *carried, F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(data), F.lit(0)).cast("bigint") + 16).alias("size"),
        F.crc32(F.coalesce(data, F.lit(b""))).alias("text_crc32"),
        F.xxhash64(F.coalesce(data, F.lit(b""))).alias("text_hash"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    )
    facts = written(rows.withColumn("row", F.monotonically_increasing_id()), "shard-facts")
    # A null id lies below all others.
    point = F.coalesce("doc_id", F.lit(-(2**63))), F.col("size"), hashed_cell(F.col("lang")), hashed_cell(F.col("source"))
    placed = facts.select(
        *carried, "doc_id", "size", "text_crc32", "text_hash", "row",
        hilbert_column(quantile_bounds(facts, "doc_id", "size"), *point).alias("hilbert"),
    )
    order = ["hilbert", "text_hash", "doc_id", "row"]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {"part": F.spark_partition_id(), "nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    numbered = written(ranged, "shard-order")
    # One row per partition; the running sum over them is the only global step.
    counts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()
    at, offsets = 0, {}
    for part, n in sorted(counts):
        offsets[part] = at
        at += n
    spark = documents.sparkSession
    starts = spark.createDataFrame([(p, o, at) for p, o in offsets.items()] or [(0, 0, 0)],
                                   "part int, start bigint, total bigint")
    return numbered.join(F.broadcast(starts), "part").select(
        *carried, "doc_id", "size", "text_crc32", "hilbert", (F.col("start") + F.col("nth")).alias("position"), "total"
    )


def hilbert_shards(documents: DataFrame, shards: int = 40) -> DataFrame:
    """Put every document into one of ``shards`` runs of the Hilbert order.

    The law is ``rows``: run lengths differ by at most one. Returns doc_id,
    size (UTF-8 bytes of the text, none for null, plus 16), text_crc32
    (unsigned; 0 for a null or empty text), law, shard, slot (gapless from 0
    inside the shard, in curve order), grown_shard (null under this law) and
    hilbert. Repeated rows each get a slot of their own; null ids and
    metadata go to cell 0; a text of any length counts by its bytes; extra
    columns are not read; an empty table gives no rows.
    """
    return assigned(documents, shards)


def assigned(documents: DataFrame, shards: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """``hilbert_shards`` with the ``carried`` columns of the documents in front."""
    if shards < 1:
        raise ValueError("shards must be positive")
    rows = curve_positions(documents, carried)
    # The first `total % shards` runs are one longer than the others.
    base, longer = F.floor(F.col("total") / shards).cast("bigint"), F.col("total") % shards
    head = longer * (base + 1)
    in_head = F.col("position") < head
    shard = F.when(in_head, F.floor(F.col("position") / (base + 1))).otherwise(
        longer + F.floor((F.col("position") - head) / F.greatest(base, F.lit(1))))
    slot = F.when(in_head, F.col("position") % (base + 1)).otherwise(
        (F.col("position") - head) % F.greatest(base, F.lit(1)))
    return rows.select(
        *carried, "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        slot.cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )


def write_shards(documents: DataFrame, folder: str, shards: int = 40) -> DataFrame:
    """Write the documents as parquet under ``folder/shard=N``, each shard
    sorted by slot, and return the assignment (doc_id, shard, slot). Rows meet
    their slot by a row number stored with them, so each row, with a null or a
    repeated id too, is written once. Documents have no columns named shard or slot."""
    rows = written(documents.select(F.struct("*").alias("doc")).withColumn("__row", F.monotonically_increasing_id()),
                   "shard-documents")
    facts = rows.select("__row", *(F.col(f"doc.{c}").alias(c) for c in ("doc_id", "text", "lang", "source")))
    placed = written(assigned(facts, shards, ("__row",)).select("__row", "doc_id", "shard", "slot"), "shard-assignment")
    (
        rows.join(placed.drop("doc_id"), "__row").select("doc.*", "shard", "slot")
        .repartitionByRange(4 * shards, "shard", "slot")
        .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    )
    return placed.drop("__row")
