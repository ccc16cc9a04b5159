from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from llm_brute import near_vectors

from gridwright.llm import cap_filters

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def rows_of(seed=2, n=160, dims=64):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        x = rng.normal(size=dims)
        for c in range(int(rng.integers(1, 6))):
            noise = rng.normal(size=dims)
            noise *= np.linalg.norm(x) / np.linalg.norm(noise) * (0.17 + 0.02 * c if c else 0)
            rows.append((len(rows) * 3, [float(v) for v in np.float32(x + noise)], int(k % 3)))
    return rows


def result(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.vec_id: (r.n_links, r.component_id) for r in cap_filters.near_vectors(df, **kw).collect()}


def test_equals_brute_force(spark):
    rows = rows_of()
    assert result(spark, rows) == near_vectors(rows)


def test_chunks_of_a_crowded_filter(spark):
    """A group larger than a chunk: counted once per pair, over several units."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=32)
    rows = [(k, [float(v) for v in np.float32(x + 0.05 * rng.normal(size=32))], 1) for k in range(150)]
    expected = near_vectors(rows)
    assert result(spark, rows, chunk=40) == expected and max(n for n, _ in expected.values()) > 100


def test_unusable_vectors_labels_lengths_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [-1.0, 0.0], 1)]
    got = result(spark, rows)
    assert got == near_vectors(rows) and got[1] == (2, 1) and got[12] == (2, 1) and got[11] == (0, 11)
    twice = spark.createDataFrame([(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)], SCHEMA)
    out = cap_filters.near_vectors(twice).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in out) == [
        ("5", 2, 5, True), ("5", 2, 5, True), ("None", 2, 5, False)]


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(1, [1.0], 1, 2, 3)], SCHEMA + ", rid int, component int")
    assert cap_filters.near_vectors(df).count() == 1
    assert cap_filters.near_vectors(df.limit(0)).count() == 0


def test_decoding_lists_exactly_the_exceeding_filters():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code = cap_filters.product_code(64)
    (a, one), (b, two) = code
    every = ((x[:, a] @ one.T)[:, :, None] + (x[:, b] @ two.T)[:, None]).reshape(20, -1)
    for k, found in enumerate(cap_filters.decode_caps(x, code, 0.08)):
        assert found.tolist() == np.flatnonzero(every[k] >= every[k].max() - 0.08).tolist()


def pairs_at(cosine, n, dims, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine**2) * z


@pytest.mark.parametrize(("dims", "rows"), [(64, 50), (64, 2_000), (64, 16_000), (64, 256_000), (64, 10**7), (256, 10**6)])
def test_recall_at_the_threshold(dims, rows):
    code = cap_filters.product_code(dims, cap_filters.blocks_for(dims, rows))
    one, two = (cap_filters.decode_caps(v, code) for v in pairs_at(0.98, 3000, dims))
    missed = sum(not len(np.intersect1d(p, q)) for p, q in zip(one, two, strict=True))
    assert missed <= 3


def test_a_vector_meets_few_others_at_every_size():
    """Unlinked vectors sharing a filter, counted: bounded a row, not a share of all rows."""
    for rows in (1_000, 4_000, 16_000, 64_000):
        x, _ = pairs_at(0.98, rows, 64, seed=rows)
        found = cap_filters.decode_caps(x, cap_filters.product_code(64, cap_filters.blocks_for(64, rows)))
        _, held = np.unique(np.concatenate(found), return_counts=True)
        assert (held * (held - 1) / 2).sum() / rows < 8


def test_blocks_follow_the_rows():
    assert [cap_filters.blocks_for(64, n) for n in (1, 1_000, 10_000, 100_000, 10**7)] == [2, 3, 4, 5, 6]
    assert [cap_filters.blocks_for(d, 10**6) for d in (1, 2, 8)] == [2, 2, 2]


def test_larger_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "blocks_for", lambda dims, rows: 4)
    rows = rows_of(seed=5)
    assert result(spark, rows) == near_vectors(rows)


def test_many_units_in_one_table():
    """Units of several sizes and vector lengths at once, against all pairs."""
    rng = np.random.default_rng(3)
    rows, rep = [], 0
    for filter_, (dims, n) in enumerate([(3, 2), (3, 90), (3, 5), (4, 3), (4, 1), (4, 70)]):
        for _ in range(n):
            v = rng.normal(size=dims).astype(np.float32)
            rows.append((1, dims, filter_, 0, 0, 0, rep, 1, v, np.array([filter_])))
            rep += 1
    names = ["label", "dims", "filter", "i", "j", "own", "rep", "weight", "embedding", "caps"]
    table = pa.Table.from_arrays([pa.array([r[k] for r in rows]) for k in range(10)], names=names)
    got = {}
    for a, b, n in cap_filters.unit_links(table, 0.9):
        if b is None:
            for r, c in zip(a.tolist(), n.tolist(), strict=True):
                got[r] = got.get(r, 0) + c
    expected = {}
    for one in rows:
        v = one[8].astype(float)
        links = sum(float(v @ w[8]) / np.linalg.norm(v) / np.linalg.norm(w[8].astype(float)) >= 0.9
                    for w in rows if w[2] == one[2] and w[6] != one[6])
        if links:
            expected[one[6]] = links
    assert got == expected and len(got) > 50
    sliced = [b for b in table.to_batches(max_chunksize=7)]
    whole = list(cap_filters.whole_units(iter(sliced)))
    assert sum(t.num_rows for t in whole) == len(rows)
    seen = [u for t in whole for u in sorted(set(t.column("filter").to_pylist()))]
    assert seen == list(range(6))
