"""Fill-in-the-middle against a plain version."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_brute import DOCS
from pyspark.sql import functions as F

import __spark_entry__ as se
from gridwright.llm import infill

SF = "/root/testdata/sf0.001"


def plain(doc_id, text, seed=7, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def some_texts(n, seed=3):
    draw = random.Random(seed)
    parts = ["\n", "\n", "a", "é", "🙂", "bc", "\r", "<", "P>", "<S", " "]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(0, 80))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 2, 3, 8, 1024])
def test_cuts_of_the_tree(block):
    for text in ["", "\n", "a", "a\n", *some_texts(60, block)]:
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        data = text.encode()
        tree = infill.BlockTree(np.frombuffer(data, np.uint8), block)
        assert tree.total() == len(units)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert tree.cut(k) == (len(head.encode()), len(head))


def test_rows_against_plain(spark):
    docs = [(i, t) for i, t in enumerate(some_texts(800))] + [
        (-5, "one\ntwo"), (None, "one\ntwo\n"), (3, None), (3, None), (4, ""), (6, "x <M>\ny"), (7, "é\n" * 90_000),
        (8, "z" * 200_000)]
    df = spark.createDataFrame([(i, t, None, None, 0, "x") for i, t in docs], DOCS + ", output string").repartition(3)
    for options in ({}, {"block": 5}, {"seed": 11, "fim_percent": 60, "spm_percent": 20}):
        made = infill.fill_in_middle(df, **options).withColumn("back", infill.restored(F.col("output"), F.col("form")))
        rows = made.collect()
        got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows)
        o = (options.get("seed", 7), options.get("fim_percent", 100), options.get("spm_percent", 50))
        assert got == Counter((i, *plain(i, t, *o)) for i, t in docs)
        assert Counter((r.doc_id, r.back) for r in rows) == Counter((i, t or "") for i, t in docs)
    assert infill.fill_in_middle(df.limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = Counter()
    for d in docs:
        n, form, p, m, out = plain(d.doc_id, d.text)
        want[(d.doc_id, n, form, p, m, hashlib.sha256(out.encode()).hexdigest(),
              hashlib.sha256((d.text or "").encode()).hexdigest())] += 1
    rows = se.queries()["op13_fill_in_middle"](spark, SF).collect()
    assert Counter(map(tuple, rows)) == want and {r.form for r in rows} >= {"psm", "spm"}
