"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.operators.sizing import broadcast_if_small, materialize, materialize_measured

# Upper bound of every broadcast made here, in measured in-memory bytes. A side
# beyond it takes the shuffle join of the same plan.
BROADCAST_CAP = 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes: A-Z in lower case, cut at runs of ASCII
    white space, which is what bytes.lower and bytes.split do (none for null)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(divisor)


def hashed_sample(df: DataFrame, key: Column, size: int) -> DataFrame:
    """About ``size`` rows (all, if there are fewer): those whose key hashes
    into the lowest share of the hash space. One count job; nothing is sorted
    and no task sends more than its share."""
    share = min(1.0, size / max(1, df.count()))
    return df.where(F.xxhash64(key) <= F.lit(int(-(2**63) + share * (2**64 - 2**12))))


def small_or_shuffled(df: DataFrame, name: str, cap: int = BROADCAST_CAP) -> DataFrame:
    """Write ``df`` once and mark it for broadcast when its measured bytes
    are under ``cap``; otherwise return it unmarked for a shuffle join."""
    stored, _, size = materialize_measured(df, name)
    return broadcast_if_small(stored, cap, size)[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as parquet in the shared checkpoint folder."""
    return materialize(df, name)


def byte_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """A list<int64> Arrow array from int64 numpy arrays, without boxing."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` (bounds what a task holds).
    Memory of finished batches goes back to the system: workers live on."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def kept_by_text(documents: DataFrame, keep: Callable[[list[str | None]], np.ndarray], rows: int) -> DataFrame:
    """The documents (all columns) whose text ``keep`` accepts; it gets the
    whole texts of at most ``rows`` documents at a time."""
    at = [c.lower() for c in documents.columns].index("text")

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, rows):
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return documents.mapInArrow(accepted, documents.schema)


def runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of one key at a time, from rows sorted by their first ``keys``
    (integer) columns. Holds one key's rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        found = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)], 1)
        starts = [0, *(np.flatnonzero((found[1:] != found[:-1]).any(1)) + 1).tolist(), len(found)]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(found[lo].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def tied_edges(ids: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few edges that connect what the links between rows p[k] and q[k]
    connect: each linked row with the smallest id it reaches. At most one edge
    per row, however many links there are."""
    label = ids.copy()
    while True:
        least = label.copy()
        np.minimum.at(least, p, label[q])
        np.minimum.at(least, q, label[p])
        if (least == label).all():
            break
        label = least
    ends = np.union1d(p, q)
    ends = ends[ids[ends] != label[ends]]
    return ids[ends], label[ends]
