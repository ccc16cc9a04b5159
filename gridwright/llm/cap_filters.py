"""Embedding near-duplicates by spherical-cap filters.

The filters are the words of a random product code: the vector is cut into
blocks, each block has the code of a randomly rotated cross-polytope (plus and
minus the rows of two Hadamard transforms with random signs), and a filter is
one code word per block. A vector lies in the cap of every filter whose inner
product with it exceeds its own largest one less a reach; these are
list-decoded from the sorted inner products of the blocks, without looking at
the filters below the bound. Vectors that share a filter are compared by their
exact cosine in double precision.

The size of the code follows the data: every label gets as many blocks as it
takes for at least ``FILTERS_PER_ROW`` filters a vector, so a filter holds few
vectors by chance, however many there are, and what a vector meets does not
grow with its label. Two vectors at cosine 0.98 differ by 0.2 at most, seen by
a random direction as noise of deviation 0.2 / sqrt(dimensions). The reach is
that times 2.4 for two blocks, 1.6 for three and 1.3 beyond: more words mean
more filters near the best one, and a pair has to miss on all of both lists.
Measured misses at exactly 0.98: at most 1 in 5,000 for every size of code,
and fewer for closer pairs.

Equal vectors are one row with a weight. Filters that hold one vector are
dropped before any vector is sent. The rows of a filter are cut into chunks by
a hash, and every pair of chunks is one unit of work of bounded size, so a
filter that holds a third of all vectors is spread over many tasks. A unit
returns link counts and a few edges that connect its links, never its pairs; a
pair that shares several filters counts in the smallest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import in_slices, small_or_shuffled, tied_edges, written
from gridwright.llm.components import connected_components

COSINE = 0.98
# Blocks of the code: at least BLOCKS, more until the code has
# FILTERS_PER_ROW filters for each vector of a label, at most MOST_BLOCKS.
BLOCKS, MOST_BLOCKS = 2, 6
FILTERS_PER_ROW = 64
SEED = 20240229
CHUNK = 4096
BATCH_ROWS = 1024
# Rows multiplied at a time inside a unit (bounds its memory). Units of at most
# SMALL rows are compared together, PAIRS pairs at a time.
TILE = 1024
SMALL = 64
PAIRS = 1 << 15


def hadamard(n: int) -> np.ndarray:
    h = np.ones((1, 1))
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h / np.sqrt(n)


def block_edges(dims: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dims, max(1, min(blocks, dims)) + 1).astype(int)


def filters_of(dims: int, blocks: int) -> int:
    """Number of filters: the product of the blocks' code words."""
    return math.prod(2 << int(n - 1).bit_length() for n in np.diff(block_edges(dims, blocks)))


def blocks_for(dims: int, rows: int) -> int:
    """The fewest blocks with enough filters for ``rows`` vectors (the most
    filters, if none has)."""
    sizes = range(BLOCKS, max(BLOCKS, min(MOST_BLOCKS, dims // 4)) + 1)
    return next((b for b in sizes if filters_of(dims, b) >= FILTERS_PER_ROW * rows),
                max(sizes, key=lambda b: filters_of(dims, b)))


def reach_of(dims: int, blocks: int) -> float:
    return max(1.3, 4.8 / blocks) * 0.2 / math.sqrt(dims)


@lru_cache(64)
def product_code(dims: int, blocks: int = BLOCKS, seed: int = SEED) -> list[tuple[slice, np.ndarray]]:
    """For each block: its dimensions, and its code words as rows of unit length / sqrt(blocks)."""
    rng = np.random.default_rng([seed, dims])
    edges = block_edges(dims, blocks)
    blocks = len(edges) - 1
    code = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        n = 1 << int(hi - lo - 1).bit_length()
        signs = rng.choice([-1.0, 1.0], (2, n))
        words = ((hadamard(n) * signs[0]) @ (hadamard(n) * signs[1]))[:, : hi - lo]
        words /= np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-12)
        code.append((slice(int(lo), int(hi)), np.concatenate([words, -words]) / np.sqrt(blocks)))
    return code


def decode_caps(vectors: np.ndarray, code, reach: float | None = None) -> list[np.ndarray]:
    """Sorted filter numbers of each unit vector: all whose inner product is
    within ``reach`` of the vector's largest."""
    reach = reach_of(vectors.shape[1], max(BLOCKS, len(code))) if reach is None else reach
    parts = [vectors[:, at] @ words.T for at, words in code]
    order = [np.argsort(-p, axis=1) for p in parts]
    ranked = [np.take_along_axis(p, o, 1) for p, o in zip(parts, order, strict=True)]
    best = sum(r[:, 0] for r in ranked)
    tails = np.cumsum([r[:, 0] for r in ranked[::-1]], axis=0)[::-1]  # best of this block and those after it
    owner, number, value = np.arange(len(vectors)), np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
    for k, (words, o, r) in enumerate(zip(code, order, ranked, strict=True)):
        after = tails[k + 1] if k + 1 < len(code) else np.zeros(len(vectors))
        # The words of this block that can still reach the bound are a prefix of its order.
        least = best[owner] - reach - value - after[owner]
        width = (r[owner] >= least[:, None]).sum(1)
        take = np.repeat(np.arange(len(owner)), width)
        nth = np.arange(len(take)) - np.repeat(np.cumsum(width) - width, width)
        who = owner[take]
        number = number[take] * len(words[1]) + o[who, nth]
        value = value[take] + r[who, nth]
        owner = who
    by = np.lexsort((number, owner))
    return np.split(number[by], np.cumsum(np.bincount(owner, minlength=len(vectors)))[:-1])


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Written once: rep, label, embedding, weight -- one row per (label, vector)."""
    return written(
        rows.groupBy("label", "embedding").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("weight")),
        "cap-vectors",
    )


def cap_entries(vectors: DataFrame, reach: float | None) -> DataFrame:
    """A narrow row per vector and cap: label, dims, filter, rep."""
    key = ["label", "dims"]
    sized = vectors.withColumn("dims", F.size("embedding"))
    rows = small_or_shuffled(sized.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")), "cap-sizes")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BATCH_ROWS):
            label, dims, rep, count = (batch.column(k).to_numpy() for k in range(4))
            for d, n in set(zip(dims.tolist(), count.tolist(), strict=True)):
                at = np.flatnonzero((dims == d) & (count == n))
                x = np.stack([batch.column(4)[int(i)].values.to_numpy() for i in at]).astype(np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                found = decode_caps(x, product_code(d, blocks_for(d, n)), reach)
                each = np.repeat(at, [len(v) for v in found])
                yield pa.record_batch([pa.array(c) for c in (label[each], dims[each], np.concatenate(found), rep[each])],
                                      names=[*key, "filter", "rep"])

    return sized.join(rows, key).select(*key, "rep", "rows", "embedding").mapInArrow(
        decode, "label int, dims int, filter bigint, rep bigint")


def unit_rows(vectors: DataFrame, entries: DataFrame, chunk: int) -> DataFrame:
    """Each vector once for every unit (pair of chunks i <= j of a filter that
    holds several vectors) it takes part in, with all such filters of it."""
    key = ["label", "dims", "filter"]
    crowded = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(
        *key, F.ceil(F.col("c") / chunk).cast("int").alias("chunks"))
    met = entries.join(small_or_shuffled(crowded, "cap-crowded"), key).groupBy("rep").agg(
        F.collect_list(F.struct("filter", "chunks")).alias("met"))  # one vector's own filters
    rows = vectors.join(met, "rep").withColumns(
        {"dims": F.size("embedding"), "caps": F.sort_array("met.filter"), "at": F.explode("met")})
    own = F.pmod(F.xxhash64("rep"), F.col("at.chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("at.chunks") - 1))
    return rows.withColumn("filter", F.col("at.filter")).withColumn("own", own).withColumn("other", other).select(
        *key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
        "rep", "weight", "embedding", "caps")


def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables that hold each of their units whole (rows are sorted
    by unit, the first five columns)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = unit_starts(batch)
        first = [batch.column(k)[0].as_py() for k in range(5)]
        if held and first != [held[0].column(k)[0].as_py() for k in range(5)]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        last = int(starts[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def unit_starts(rows) -> np.ndarray:
    found = np.stack([rows.column(k).to_numpy() for k in range(5)], 1)
    return np.concatenate([[0], np.flatnonzero((found[1:] != found[:-1]).any(1)) + 1])


def near_pairs(starts, own, unit, rep, x, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The linked pairs (rows p[k] and q[k]) of units of rows of one length,
    a bounded number of compared pairs at a time.

    Rows of one chunk meet the rows of the other (all rows each other when
    the unit is a chunk with itself). ``unit`` gives the chunks (i, j) of each."""
    lengths = np.sqrt((x * x).sum(1))
    ends = np.append(starts[1:], len(rep))
    few = (ends - starts <= SMALL) & (unit[:, 0] == unit[:, 1])
    # Small units together: every row with those after it.
    row = np.concatenate([np.arange(s, e) for s, e in zip(starts[few], ends[few], strict=True)] or [np.zeros(0, int)])
    after = np.repeat(ends[few], (ends - starts)[few]) - row - 1
    total = np.cumsum(after)
    cuts = np.searchsorted(total, np.arange(PAIRS, total[-1] if len(total) else 0, PAIRS))
    for r, n in zip(np.split(row, cuts), np.split(after, cuts), strict=True):
        p = np.repeat(r, n)
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n)
        near = np.einsum("ij,ij->i", x[p], x[q]) / (lengths[p] * lengths[q]) >= cosine
        yield p[near], q[near]
    for k in np.flatnonzero(~few):
        i, j = unit[k]
        first = starts[k] + np.flatnonzero(own[starts[k] : ends[k]] == i)
        second = first if i == j else starts[k] + np.flatnonzero(own[starts[k] : ends[k]] == j)
        for at in range(0, len(first), TILE):
            a = first[at : at + TILE]
            for to in range(0, len(second), TILE):
                b = second[to : to + TILE]
                near = (x[a] @ x[b].T) / (lengths[a][:, None] * lengths[b][None, :]) >= cosine
                if i == j:
                    near &= rep[a][:, None] < rep[b][None, :]
                p, q = np.nonzero(near)
                yield a[p], b[q]


def _smallest_shared(caps: list[np.ndarray], p: np.ndarray, q: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """Of the links (p, q), those whose smallest shared filter is that of
    their unit, ``cap`` of either row."""
    here = np.ones(len(p), bool)
    rows = np.unique(np.concatenate([p, q]))
    below = [caps[r][caps[r] < cap[r]] for r in rows]
    width = max((len(v) for v in below), default=0)
    if not width:
        return here
    place = np.full(rows.max() + 1, -1)
    place[rows] = np.arange(len(rows))
    smaller = np.full((len(rows), width), -1, np.int64)  # the filters of each row below this one
    for k, v in enumerate(below):
        smaller[k, : len(v)] = v
    step = max(1, (1 << 22) // (width * width))
    for at in range(0, len(p), step):
        one, two = smaller[place[p[at : at + step]]], smaller[place[q[at : at + step]]]
        shared = (one[:, :, None] == two[:, None, :]) & (one >= 0)[:, :, None]
        here[at : at + step] = ~shared.any((1, 2))
    return here


def unit_links(t: pa.Table, cosine: float) -> list[tuple[np.ndarray, np.ndarray | None, np.ndarray]]:
    """Weighted link counts (vector, none, n) and edges that connect what the
    links connect (a, b, zeros), of the units of a table. A pair counts only
    in the unit of the smallest filter that both share."""
    out = []
    dims = t.column("dims").to_numpy()
    for d in np.unique(dims):
        part = t if (dims == d).all() else t.filter(pa.array(dims == d)).combine_chunks()
        own, rep, weight, cap = (part.column(k).to_numpy() for k in ("own", "rep", "weight", "filter"))
        starts = unit_starts(part)
        unit = np.stack([part.column(k).to_numpy()[starts] for k in ("i", "j")], 1)
        x = pc.list_flatten(part.column("embedding")).to_numpy().astype(np.float64).reshape(-1, int(d))
        caps = [v.values.to_numpy() for v in part.column("caps")]
        for p, q in near_pairs(starts, own, unit, rep, x, cosine):
            if not len(p):
                continue
            a, b = tied_edges(rep, p, q)
            out.append((a, b, np.zeros(len(a), np.int64)))
            here = _smallest_shared(caps, p, q, cap)
            ends, others = np.concatenate([p[here], q[here]]), np.concatenate([weight[q[here]], weight[p[here]]])
            who, back = np.unique(rep[ends], return_inverse=True)
            out.append((who, None, np.bincount(back, others, len(who)).astype(np.int64)))
    return out


def run_units(units: DataFrame, cosine: float) -> DataFrame:
    """(a, b, n): counts as (vector, null, n), edges as (a, b, 0)."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_units(batches):
            for a, b, n in unit_links(t, cosine):
                b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
                yield pa.record_batch([pa.array(a, pa.int64()), b, pa.array(n, pa.int64())], names=["a", "b", "n"])

    key = ["label", "dims", "filter", "i", "j"]
    dealt = units.select(*key, "own", "rep", "weight", "embedding", "caps").repartition(*key)
    return dealt.sortWithinPartitions(*key).mapInArrow(links, "a bigint, b bigint, n bigint")


def near_vectors(
    embeddings: DataFrame, cosine: float = COSINE, reach: float | None = None, chunk: int = CHUNK
) -> DataFrame:
    """Near-duplicate vectors among rows of equal, not null label.

    One row per row of ``embeddings`` (vec_id, embedding, label): vec_id,
    n_links (other rows linked directly), component_id (smallest vec_id
    reachable, itself included) and kept (vec_id = component_id). A vector
    that is null, zero, or holds a null or non-finite component, and one
    without a label, links with nothing. Vectors of different lengths do not
    link. Repeated rows link with each other as vectors of their own; a null
    vec_id takes part but cannot name a component. An empty table gives no rows.
    """
    vector = F.col("embedding").cast("array<float>")
    usable = (
        F.col("label").isNotNull() & vector.isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        & F.exists(vector, lambda v: v != 0)
    )
    rows = written(
        embeddings.select(
            F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
            F.when(usable, vector).alias("embedding"),
        ).withColumn("rid", F.monotonically_increasing_id()), "cap-rows")
    vectors = distinct_vectors(rows.where("embedding is not null"))
    units = unit_rows(vectors, written(cap_entries(vectors, reach), "cap-entries"), chunk)
    found = written(run_units(units, cosine), "cap-links")
    linked = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    edges = found.where("b is not null").select("a", "b")
    comps = written(connected_components(edges, "cap-components"), "cap-component")
    placed = written(
        vectors.join(linked, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
            "label", "embedding", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component")), "cap-placed")
    whole = written(rows.where("embedding is not null").join(placed, ["label", "embedding"]).select(
        "vec_id", "n_links", "component"), "cap-whole")
    names = whole.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    tied = whole.join(small_or_shuffled(names, "cap-names"), "component").select("vec_id", "n_links", "component_id")
    alone = rows.where("embedding is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = tied.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
