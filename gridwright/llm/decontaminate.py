"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents may be very long, so similarity of the two
sets says little; what counts is containment: the share of an item's 5-word
shingles that occur in the document.

* Items are partitioned by the size of their shingle set (powers of two). Each
  partition has its own sketch length: the smallest ``k`` MinHash values of an
  item, with ``k`` large enough that a document holding ``CONTAINMENT`` of the
  largest item of the partition must hit the sketch.
* Every shingle of every document is looked up among the sketches. The share
  of an item's sketch that a document hits estimates its containment; a pair
  stays when it has the hits that the bound guarantees (no pair at or above
  the bound is lost).
* Candidates are verified by exact containment of the shingles' words.

Only DataFrame functions are used; the shingle hash runs in generated code.
The sketches, and the candidates of the second pass, are broadcast when their
measured size allows; otherwise the same joins shuffle and AQE splits hot
keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import small_or_shuffled, written

WIDTH = 5
# Percent of an item's shingles that a contaminated document holds at least.
CONTAINMENT = 75


def word_list(text: Column) -> Column:
    """Lower-cased words between runs of ASCII white space."""
    return F.array_remove(F.split(F.lower(text.cast("string")), r"[\x20\x09-\x0D]+"), "")


def item_shingles(df: DataFrame, words: str, shingle) -> DataFrame:
    """``df`` with a row per shingle of its ``words`` column: column ``s`` =
    shingle(list of the five word columns). Fewer words are one shingle (with
    nulls for the missing words), no words are none."""
    count = F.greatest(F.size(words) - WIDTH + 1, F.when(F.size(words) > 0, 1).otherwise(0))
    at = F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)))
    word = [F.get(words, F.col("__at") + k) for k in range(WIDTH)]
    return df.withColumn("__at", at).withColumn("s", shingle(word)).drop("__at")


def item_widths(benchmark: DataFrame) -> list[int]:
    """The lengths of the items' shingles: five words, and the word count of
    each shorter item (at most five values)."""
    size = F.least(F.size(word_list(F.col("text"))), F.lit(WIDTH))
    rows = benchmark.select(size.alias("n")).where("n > 0").distinct().collect()
    return sorted(r["n"] for r in rows) or [WIDTH]


def document_shingles(df: DataFrame, words: str, shingle, widths: list[int]) -> DataFrame:
    """``df`` with a row per run of each of ``widths`` words: ``s`` as in
    ``item_shingles``, so a run equals the item of just its words."""
    size = F.size(words)

    def runs(width: int) -> Column:
        return F.when(size >= width, F.sequence(F.lit(0), size - width))

    if len(widths) == 1:
        w = widths[0]
        word = [F.get(words, F.col("__at") + k) if k < w else F.lit(None).cast("string") for k in range(WIDTH)]
        return df.withColumn("__at", F.explode(runs(w))).withColumn("s", shingle(word)).drop("__at")
    # Position and length in one number: 8 * position + length.
    none = F.array().cast("array<int>")

    def starts_of(width: int) -> Column:
        return F.transform(F.coalesce(runs(width), none), lambda p: p * 8 + width)

    starts = F.concat(*[starts_of(w) for w in widths])
    at, width = F.floor(F.col("__at") / 8).cast("int"), F.col("__at") % 8
    word = [F.when(width > k, F.get(words, at + k)) for k in range(WIDTH)]
    return df.withColumn("__at", F.explode(starts)).withColumn("s", shingle(word)).drop("__at")


def shingle_hash(word: list[Column]) -> Column:
    return F.xxhash64(*word)


def shingle_text(word: list[Column]) -> Column:
    return F.concat_ws(" ", *word)


def shown(n: Column, containment: int) -> Column:
    """Sketch values of which a set at the bound must hold one: all but the
    ``n - ceil(containment n)`` it may lack, of which one more."""
    return n - F.ceil(n * containment / F.lit(100)) + 1


def item_sketches(benchmark: DataFrame, containment: int) -> DataFrame:
    """(s, item_id, item_key, n, k, hits): a row per MinHash value of an item.
    n: its shingles, k: its sketch length, hits: what a document at the bound
    hits at least."""
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.xxhash64(F.col("text").cast("string")).alias("item_key"),
        word_list(F.col("text")).alias("w"),
    )
    hashes = item_shingles(items, "w", shingle_hash).groupBy("item_id", "item_key").agg(
        F.sort_array(F.collect_set("s")).alias("all"))  # one item's own shingles
    n = F.size("all")
    largest = F.pow(F.lit(2), F.floor(F.log2(n)) + 1) - 1  # of the size partition
    k = F.least(shown(largest, containment), n).cast("int")
    sketch = hashes.select("item_id", "item_key", n.alias("n"), k.alias("k"), "all")
    return sketch.select(
        "item_id", "item_key", "n", "k", (F.col("k") - shown(F.col("n"), containment) + 1).alias("hits"),
        F.explode(F.slice("all", F.lit(1), F.col("k"))).alias("s"),
    )


def sketch_candidates(
    documents: DataFrame, benchmark: DataFrame, containment: int, widths: list[int]
) -> DataFrame:
    """(doc_id, doc_key, item_id, item_key, n, estimate) of the pairs whose
    sketch hits reach the bound. doc_key and item_key hash the texts."""
    sketches = small_or_shuffled(item_sketches(benchmark, containment), "decontaminate-sketches")
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("doc_key"),
        word_list(F.col("text")).alias("w"),
    )
    hits = document_shingles(docs, "w", shingle_hash, widths).select("doc_id", "doc_key", "s").join(sketches, "s")
    return (
        hits.groupBy("doc_id", "doc_key", "item_id", "item_key", "n", "k", "hits")
        .agg(F.size(F.collect_set("s")).alias("got"))  # at most k values of one item
        .where("got >= hits")
        .select("doc_id", "doc_key", "item_id", "item_key", "n", (F.col("got") / F.col("k")).alias("estimate"))
    )


def contaminations(documents: DataFrame, benchmark: DataFrame, containment: int = CONTAINMENT) -> DataFrame:
    """Documents that contain a test item.

    Returns (doc_id, doc_key, item_id, item_shingles, matched, containment,
    estimate), one row per pair of a document text and an item: doc_key is
    xxhash64 of the text, matched counts the item's distinct shingles found in
    the whole text. A null, empty or blank text (of a document or an item) has
    no shingles and matches nothing; an item of fewer than five words is one
    shingle of its own length, found wherever a document holds those words in
    a row (a one-word item thus in every document with that word). Repeated
    rows count once; two texts under one id are two documents; a null id
    stays null. Very long texts are looked up whole, a row per shingle.
    Further columns, whatever their names, are not read. Empty tables give no rows.
    """
    if not 0 < containment <= 100:
        raise ValueError("containment is a percentage")
    widths = item_widths(benchmark)
    pairs = written(sketch_candidates(documents, benchmark, containment, widths), "decontaminate-candidates")
    items = item_shingles(
        benchmark.select(
            F.col("item_id").cast("bigint").alias("item_id"),
            F.xxhash64(F.col("text").cast("string")).alias("item_key"), word_list(F.col("text")).alias("w")),
        "w", shingle_text).select("item_id", "item_key", "s").distinct()
    # The texts of candidate documents only, then their shingles against those of their items.
    wanted = small_or_shuffled(pairs.select("doc_key").distinct(), "decontaminate-wanted")
    docs = documents.select(F.xxhash64(F.col("text").cast("string")).alias("doc_key"), "text").join(wanted, "doc_key")
    once = docs.groupBy("doc_key", "text").agg(F.lit(1).alias("one")).select("doc_key", word_list(F.col("text")).alias("w"))
    known = small_or_shuffled(items, "decontaminate-items")
    found = (
        document_shingles(once, "w", shingle_text, widths).select("doc_key", "s")
        .join(known, "s").distinct()
        .groupBy("doc_key", "item_id", "item_key").agg(F.count(F.lit(1)).alias("matched"))
    )
    found = written(found, "decontaminate-found")
    return (
        pairs.join(found, (pairs.doc_key == found.doc_key) & pairs.item_id.eqNullSafe(found.item_id)
                   & (pairs.item_key == found.item_key))
        .where(F.col("matched") * 100 >= F.col("n") * containment)
        .select("doc_id", pairs.doc_key, pairs.item_id, F.col("n").cast("bigint").alias("item_shingles"), "matched",
                (F.col("matched") / F.col("n")).alias("containment"), "estimate")
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, containment: int = CONTAINMENT) -> DataFrame:
    """The documents (all columns) that contain no test item."""
    found = contaminations(documents.select("doc_id", "text"), benchmark, containment)
    gone = small_or_shuffled(found.select(F.col("doc_key").alias("__gone")).distinct(), "decontaminate-gone")
    return documents.join(gone, F.xxhash64(F.col("text").cast("string")) == F.col("__gone"), "left_anti")


# Exact containment over all documents and items.
ORACLE_SQL = f"""
WITH d AS (
  SELECT DISTINCT doc_id, text,
         list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w
  FROM documents),
i AS (
  SELECT DISTINCT item_id, text,
         list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w
  FROM benchmark),
widths AS (SELECT DISTINCT least(len(w), {WIDTH}) AS m FROM i WHERE len(w) > 0),
dw AS (SELECT doc_id, text, w, m FROM d JOIN widths ON len(w) >= m),
ds AS (
  SELECT DISTINCT doc_id, text, array_to_string(w[k:k + m - 1], ' ') AS s
  FROM dw, LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS k)),
its AS (
  SELECT DISTINCT item_id, text, array_to_string(w[k:k + {WIDTH - 1}], ' ') AS s
  FROM i, LATERAL (SELECT unnest(range(1, greatest(len(w) - {WIDTH - 2}, least(len(w), 1) + 1))) AS k)),
n AS (SELECT item_id, text, count(*) AS n FROM its GROUP BY ALL),
m AS (
  SELECT ds.doc_id, ds.text AS doc_text, its.item_id, its.text AS item_text, count(*) AS matched
  FROM ds JOIN its USING (s) GROUP BY ALL)
SELECT m.doc_id, m.item_id, n.n AS item_shingles, m.matched, CAST(m.matched AS DOUBLE) / n.n AS containment
FROM m JOIN n ON m.item_id = n.item_id AND m.item_text = n.text
WHERE m.matched * 100 >= n.n * {CONTAINMENT}
"""
