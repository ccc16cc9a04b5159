from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_brute import DOCS

from gridwright.llm import hilbert_shards as hs
from gridwright.session import scratch_path


def check(rows, docs, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(k, 0) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(docs) and set(counts) <= set(range(shards))
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    data = lambda t: (t or "").encode()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len(data(t)) + 16, zlib.crc32(data(t))) for i, t in docs)


@pytest.mark.parametrize("n", [0, 1, 7, 40, 41, 333])
def test_law_and_slots(spark, n):
    docs = [(k, None if k % 11 == 5 else "é" * (k % 7) + "t" * (k % 50)) for k in range(n)]
    rows = hs.hilbert_shards(spark.createDataFrame([(i, t, "en" if i % 3 else None, f"s{i % 4}", 0) for i, t in docs], DOCS))
    check(rows.collect(), docs, 40)


def test_repeated_rows_nulls_and_clashing_names(spark):
    docs = [(1, "same")] * 50 + [(None, None)] * 9 + [(2, "")]
    df = spark.createDataFrame([(i, t, None, None, 0, 1, 2) for i, t in docs], DOCS + ", part int, shard int")
    check(hs.hilbert_shards(df, 7).collect(), docs, 7)
    with pytest.raises(ValueError):
        hs.hilbert_shards(df, 0)


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_unit_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hs.hilbert_index(grid, bits)
    assert sorted(index.tolist()) == list(range(len(grid)))
    walk = grid[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_runs_prune_on_several_dimensions(spark):
    """A shard's box is narrower than the table's in ids and in sizes at once."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = hs.hilbert_shards(df).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append((r.doc_id, np.log2(r.size)))
    every = np.array([(r.doc_id, np.log2(r.size)) for r in rows])
    spread = np.mean([np.ptp(np.array(v), axis=0) for v in by.values()], 0) / np.ptp(every, axis=0)
    assert (spread < 0.75).all()


def test_written_shards(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = scratch_path(spark, "shards")
    placed = hs.write_shards(df, folder, 8)
    back = spark.read.parquet(folder)
    assert back.count() == df.count() == placed.count()
    assert {r.doc_id: r.shard for r in back.collect()} == {r.doc_id: r.shard for r in placed.collect()}


def test_written_shards_with_null_and_repeated_ids(spark):
    docs = [(None, f"text {k}") for k in range(9)] + [(5, "same")] * 6 + [(5, f"other {k}") for k in range(4)] + [(6, None)]
    df = spark.createDataFrame([(i, t, "en", None, 0) for i, t in docs], DOCS)
    folder = scratch_path(spark, "shards")
    placed = hs.write_shards(df, folder, 3)
    back = spark.read.parquet(folder).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(docs)
    assert Counter((r.doc_id, r.shard, r.slot) for r in back) == Counter(tuple(r) for r in placed.collect())
    assert len({(r.shard, r.slot) for r in back}) == len(docs)


def test_equal_rows_are_dealt_over_several_ranges(spark, monkeypatch):
    """Half of the rows are equal in id, text and metadata: no range holds them all."""
    sizes = []
    written = hs.written

    def spied(df, name):
        out = written(df, name)
        if name == "shard-order":
            sizes.extend(r["count"] for r in out.groupBy("part").count().collect())
        return out

    monkeypatch.setattr(hs, "written", spied)
    df = spark.range(20_000).selectExpr(
        "if(id % 2 = 0, null, id) AS doc_id", "if(id % 2 = 0, '', concat('t', id)) AS text",
        "'en' AS lang", "'s' AS source", "0 AS n_chars").repartition(8)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert hs.hilbert_shards(df).count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert max(sizes) < 2 * 20_000 / 8


def test_one_far_id_leaves_the_other_cells_alone(spark):
    """Quantile cells: shards still cover narrow runs of ids beside an id of 2**60."""
    df = spark.range(4000).selectExpr("if(id = 7, bigint(pow(2, 60)), id) AS doc_id", "'text' AS text",
                                      "'en' AS lang", "'s' AS source", "0 AS n_chars")
    by = defaultdict(list)
    for r in hs.hilbert_shards(df).collect():
        if r.doc_id < 4000:
            by[r.shard].append(r.doc_id)
    assert np.mean([max(v) - min(v) for v in by.values()]) < 400


def test_slots_follow_a_plain_sort_by_the_curve(spark):
    """Shards and slots one after the other visit the curve's indexes in order, computed apart from Spark."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(hs.hilbert_shards(df).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in rows] == sorted(r.hilbert for r in rows)
    ids, sizes = np.sort([r.doc_id for r in rows]), np.sort([r.size for r in rows])
    cells = df.select(
        "doc_id", hs.hashed_cell(df.lang).alias("lang"), hs.hashed_cell(df.source).alias("source")).collect()
    meta = {c.doc_id: (c.lang, c.source) for c in cells}
    n, top = len(rows), 1 << hs.BITS
    bounds = [[v[max(0, -(-k * n // top) - 1)] for k in range(1, top)] for v in (ids, sizes)]
    points = np.array([(np.searchsorted(bounds[0], r.doc_id, "right"), np.searchsorted(bounds[1], r.size, "right"),
                        *meta[r.doc_id]) for r in rows])
    assert hs.hilbert_index(points, hs.BITS).tolist() == [r.hilbert for r in rows]
