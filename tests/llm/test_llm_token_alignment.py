"""Token alignment against whole-text tokenizers and plain counting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_brute import DOCS

import __spark_entry__ as se
from gridwright.llm import token_alignment as ta
from gridwright.llm.perfect_hash import PerfectHash

SF = "/root/testdata/sf0.001"
PATHS = (ta.tokenizer_path(ta.TOKENIZER_A), ta.tokenizer_path(ta.TOKENIZER_B))
PARTS = [*"abcthe  \n\n\t\r.,'s12é ﬁ▁<>|\x1c\x85　日本語🙂́\x00", "<|endoftext|>", "<s>", "<0x41>", "the", "ing",
         " ", " ", " ", "\n", "'ll", "\\", " ", "ß", "Ж"]


@pytest.fixture(scope="module")
def aligner():
    return ta.Aligner(*PATHS)


def plain(aligner, text):
    """Groups of (A ids, B ids) by the tokenizers on the whole text."""
    if not text:
        return []
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(aligner.bytes_a[i] for i in a) != whole or b"".join(aligner.bytes_b[i] for i in b) != whole:
        return []
    ends_a, ends_b = {}, {}
    for ids, widths, ends in ((a, aligner.width_a, ends_a), (b, aligner.width_b, ends_b)):
        at = 0
        for k, i in enumerate(ids):
            at += widths[i]
            ends[at] = k + 1
    out, p, q = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        out.append((a[p : ends_a[end]], b[q : ends_b[end]]))
        p, q = ends_a[end], ends_b[end]
    return out


def brute(aligner, docs):
    """The rows of the query, counted with dictionaries."""
    groups = [(i, plain(aligner, t)) for i, t in docs]
    count = Counter((a[-1], b[-1]) for _, g in groups for a, b in g)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    rows = []
    for i, g in groups:
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                     sum(count[k] == best[k[1]] for k in links), sum(count[k] for k in links),
                     hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return Counter(rows)


def some_texts(n, seed=5):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randrange(0, 40))) for _ in range(n)]


def test_stretches_give_the_tokens_of_the_whole_text(aligner):
    texts = some_texts(4000)
    valid = 0
    for text, codes in zip(texts, aligner.encoded(texts), strict=True):
        want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain(aligner, text))
        assert ("" if codes is None else ";".join(aligner.groups[c] for c in codes)) == want, repr(text)
        valid += codes is not None
    assert valid > 2000


def test_the_rank_encoder_agrees_with_the_file_on_every_entry(aligner):
    entries = []
    for token in aligner.bytes_a:
        try:
            entries.append(token.decode())
        except UnicodeDecodeError:
            continue
    want = [e.ids for e in aligner.a.encode_batch(entries, add_special_tokens=False)]
    assert [aligner.ranks.encode_ordinary(e) for e in entries] == want and len(entries) > 49000


def test_shedding_changes_nothing(aligner, monkeypatch):
    monkeypatch.setattr(ta, "REMEMBERED", 200)
    small, texts = ta.Aligner(*PATHS), some_texts(1500, 9)
    seen = 0
    for at in range(0, len(texts), 50):
        if small.full():
            small.shed()
            assert len(small.codes) <= 101 == len(small.groups) + 101 - len(small.codes)
            seen += 1
        part = texts[at : at + 50]
        for text, codes, again in zip(part, small.encoded(part), aligner.encoded(part), strict=True):
            assert (codes is None) == (again is None)
            if codes is not None:
                assert [small.groups[c] for c in codes] == [aligner.groups[c] for c in again], repr(text)
                assert [small.n_a[codes].sum(), small.n_groups[codes].sum()] == [
                    aligner.n_a[again].sum(), aligner.n_groups[again].sum()]
    assert seen > 2


def test_bound_on_the_pairs(aligner):
    ends = {}
    for i, t in enumerate(aligner.bytes_b):
        ends.setdefault(t, []).append(i)
    draw = random.Random(1)
    some = draw.sample(range(50256), 300)
    linked = sum(a.endswith(b) or b.endswith(a) for a in (aligner.bytes_a[i] for i in some) for b in aligner.bytes_b)
    bound = aligner.pair_bound()
    assert 300_000 < bound < 500_000 and linked / 300 == pytest.approx(bound / 50256, rel=0.35)


def test_perfect_hash():
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 64, 1000, 50_000):
        keys = np.unique(draw.integers(0, 2**62, n * 2 + 5))[:n]
        draw.shuffle(keys)
        h = PerfectHash(keys)
        assert sorted(h.index(keys)) == list(range(n))  # perfect and minimal
        assert (h.keys[h.verified(keys)] == keys.astype(np.uint64)).all() if n else len(h) == 0
        foreign = np.setdiff1d(draw.integers(0, 2**62, 500), keys)
        assert (h.verified(foreign) == -1).all()
    with pytest.raises(ValueError):
        PerfectHash(np.array([5, 5]))


def test_dense_vectors_refuse_a_foreign_pair():
    counts = ta.PairCounts(np.array([1, 2, 3]), 10)
    assert counts.dense(np.array([3, 3, 1]), np.array([2, 3, 4])).sum() == 9
    with pytest.raises(KeyError):
        counts.dense(np.array([4]), np.array([1]))


@pytest.mark.parametrize("slots", [1, 2, 3, 16, 17, 50])
def test_tree_sum(spark, slots):
    draw = np.random.default_rng(slots)
    vectors = [draw.integers(-5, 2**40, 7) for _ in range(slots)]
    rows = [(k, bytearray(v.tobytes())) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "slot int, vector binary").repartition(5)
    total = ta.tree_sum(df, fan_in=4)
    assert (np.frombuffer(total, "<i8") == np.sum(vectors, axis=0)).all()
    assert ta.tree_sum(df.limit(0)) is None


ODD = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "the cat\nthe  cat\n"), (5, "the cat\nthe  cat\n"), (None, "the cat"),
       (6, "\n"), (7, "\n\n the"), (8, "x" * 3000 + " " + "the cat " * 3000), (9, "<|endoftext|><s></s>"), (10, "\x00 \x00")]


def as_rows(df):
    from pyspark.sql import functions as F

    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return Counter(map(tuple, df.withColumn("groups", digest).collect()))


def test_odd_documents(spark, aligner):
    docs = spark.createDataFrame([(i, t, None, "s", 0, 7, "x") for i, t in ODD], DOCS + ", n_a int, groups string")
    assert as_rows(ta.align_documents(docs.repartition(5))) == brute(aligner, ODD)
    assert ta.align_documents(docs.limit(0)).count() == 0
    only = ta.align_documents(docs.where("doc_id in (1, 4)")).collect()
    assert {(r.doc_id, r.n_links, r.count_sum, r.groups) for r in only} == {(1, 0, 0, ""), (4, 0, 0, "")}


def test_given_counts(spark, aligner):
    docs = spark.createDataFrame([(1, "the cat", None, None, 0), (2, "zebra", None, None, 0)], DOCS)
    counts = ta.pair_counts(docs.where("doc_id = 1"))
    rows = {r.doc_id: r for r in ta.align_documents(docs, counts=counts).collect()}
    assert rows[1].count_sum == rows[1].n_links == rows[1].n_best > 0
    assert rows[2].n_links > 0 == rows[2].n_best and rows[2].count_sum == 0


def test_query_against_brute_force(spark, aligner):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Counter(map(tuple, se.queries()["op11_token_alignment"](spark, SF).collect()))
    assert got == brute(aligner, docs)
