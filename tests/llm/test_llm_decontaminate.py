from __future__ import annotations

import numpy as np
from llm_brute import contaminations

from gridwright.llm import decontaminate


def data(seed=5):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("klmnopqrst"), 4))
    items = [(k, " ".join(word() for _ in range(int(rng.integers(6, 60))))) for k in range(30)]
    items += [(100, items[0][1]), (101, None), (102, ""), (103, "just four words here"), (104, "  ")]
    docs = []
    for d in range(60):
        w = [word() for _ in range(int(rng.integers(0, 300)))]
        if d % 2 and items[d % 30][1]:
            item = items[d % 30][1].split()
            for _ in range(d % 5):  # some words of the planted item differ
                item[int(rng.integers(0, len(item)))] = word()
            w[len(w) // 2 : len(w) // 2] = item
        docs.append((d, "  ".join(w).upper() if d % 7 == 0 else "\n".join(w)))
    docs += [(900, None), (901, ""), (902, "Just four\twords HERE"), (903, items[3][1] + " " + items[4][1])]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def test_equals_exact_containment(spark):
    docs, items = data()
    found = decontaminate.contaminations(*frames(spark, docs, items)).collect()
    got = {(r.doc_id, r.item_id): (r.item_shingles, r.matched) for r in found}
    expected = contaminations(docs, items)
    assert got == expected and len(found) == len(got) and (902, 103) in got and len(got) > 15
    assert all(abs(r.containment - r.matched / r.item_shingles) < 1e-12 for r in found)


def test_only_built_in_functions(spark):
    docs, items = data()
    found = decontaminate.contaminations(*frames(spark, docs, items))
    plan = found._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "Cartesian"):
        assert word not in plan


def test_repeated_rows_null_ids_and_empty_tables(spark):
    item = " ".join(f"i{k}" for k in range(20))
    docs = [(1, "x " + item), (1, "x " + item), (None, item), (1, "clean words only in this text")]
    d, b = frames(spark, docs, [(7, item), (7, item), (None, item)])
    got = sorted((str(r.doc_id), str(r.item_id)) for r in decontaminate.contaminations(d, b).collect())
    assert got == [("1", "7"), ("1", "None"), ("None", "7"), ("None", "None")]
    assert [r.text for r in decontaminate.decontaminated(d, b).collect()] == ["clean words only in this text"]
    assert decontaminate.contaminations(d.limit(0), b).count() == 0
    assert decontaminate.contaminations(d, b.limit(0)).count() == 0
    assert decontaminate.decontaminated(d, b.limit(0)).count() == 4


def test_columns_are_kept_and_long_texts_searched_whole(spark):
    item = " ".join(f"i{k}" for k in range(20))
    long = " ".join(f"w{k}" for k in range(30_000))
    df = spark.createDataFrame([(1, long + " " + item, 1, 2), (2, long, 3, 4), (3, None, 5, 6)],
                               "doc_id bigint, text string, s int, item_id int")
    b = spark.createDataFrame([(1, item, 9)], "item_id bigint, text string, w int")
    kept = decontaminate.decontaminated(df, b)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_short_items_inside_long_documents(spark):
    """Items of one to four words are found where their words stand in a row; SQL agrees."""
    import duckdb

    docs = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "beta gamma x delta epsilon"), (3, "Beta"),
            (4, "zeta eta"), (5, "eta zeta"), (6, None), (7, "beta gamma delta epsilon"), (8, "w " * 5000 + "zeta  ETA"),
            (9, "one two three four five six")]
    items = [(1, "beta gamma delta epsilon"), (2, "zeta\teta"), (3, "beta"), (4, "one two three four five six"),
             (5, "gamma x delta"), (6, ""), (7, None)]
    d, b = frames(spark, docs, items)
    got = {(r.doc_id, r.item_id): (r.item_shingles, r.matched) for r in decontaminate.contaminations(d, b).collect()}
    assert got == contaminations(docs, items)
    assert set(got) == {(1, 1), (7, 1), (1, 2), (4, 2), (8, 2), (1, 3), (2, 3), (3, 3), (7, 3), (9, 4), (2, 5)}
    con = duckdb.connect()
    documents, benchmark = d.toPandas(), b.toPandas()  # noqa: F841
    sql = con.sql(decontaminate.ORACLE_SQL).fetchall()
    assert {(r[0], r[1]): (r[2], r[3]) for r in sql} == got and len(sql) == len(got)
    only = [i for i in items if i[0] == 2]  # a single length, of two words
    d, b = frames(spark, docs, only)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminations(d, b).collect()} == {(1, 2), (4, 2), (8, 2)}
    assert sorted(r.doc_id for r in decontaminate.decontaminated(d, b).collect()) == [2, 3, 5, 6, 7, 9]
