"""Toxicity by classifier chains.

Categories are predicted one after another; the linear model of a category
sees the words of the text and the probabilities of all earlier categories.
The kinds of toxicity come first, and whether a text is toxic at all is the
last link, so that verdict comes through the whole chain. So that a later
model does not trust earlier ones more than they deserve, it is trained on
their out-of-fold predictions: every training document gets the earlier
probabilities from models that did not see it, nor chose their features by it.

The features are words and their beginnings (4 to 6 letters), kept when they
are far more frequent in documents of some category than elsewhere. Those
statistics are counted by Spark, once for every fold, over the bounded training
sample (``SAMPLE_DOCS`` labelled documents, by the hash of their id); the
``FEATURES`` strongest of all folds, and of all folds but one, go to the
driver, where the chain is trained in numpy. Scoring runs
in tasks over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import hashed_sample, in_slices, small_or_shuffled, written

SAMPLE_DOCS = 20_000
FEATURES = 4096
BEGINNINGS = (4, 5, 6)
# A feature needs this many documents of a category, and this many times the
# frequency it has outside the category.
LEAST_DOCS = 3
LEAST_LIFT = 4.0
FOLDS = 4
STEPS = 400
# Probability of `toxic` from which a text counts as toxic.
ACCEPT = 0.3
BATCH_ROWS = 256
REMEMBERED_WORDS = 400_000
WORD = re.compile(r"[^\W\d_]+")

# The chain over the label columns, in order: the two kinds, then toxic at all.
CATEGORIES = ("toxic_prose", "toxic_junk", "toxic")


def label_columns() -> dict[str, Column]:
    """0/1 labels of the categories from the columns ``toxic`` and ``quality``;
    null where those known do not decide it (what is not toxic is no kind of it)."""
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    kinds = {"toxic_prose": toxic & good, "toxic_junk": toxic & ~good, "toxic": toxic}
    return {k: c.cast("int") for k, c in kinds.items()}


def features_of(word: str) -> list[str]:
    """A word and its beginnings (marked, so they differ from whole words)."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


@dataclass
class Chain:
    """Linear models in chain order: ``weights[k]`` has a weight per feature,
    one per earlier category, and the bias last."""

    categories: tuple[str, ...]
    features: dict[str, int]
    weights: list[np.ndarray]
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def feature_ids(self, word: str) -> tuple[int, ...]:
        return tuple(self.features[f] for f in features_of(word) if f in self.features)

    def design(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of the features that occur in each whole text."""
        if len(self.seen) > REMEMBERED_WORDS:
            self.seen.clear()
        out = []
        for text in texts:
            words = set(WORD.findall(text.lower())) if text else set()
            for w in words.difference(self.seen):
                self.seen[w] = self.feature_ids(w)
            found = set().union(*map(self.seen.__getitem__, words)) if words else set()
            out.append(np.array(sorted(found), np.int64))
        return out

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """(texts, categories): each category's probability, in chain order."""
        rows = self.design(texts)
        p = np.zeros((len(texts), len(self.categories)))
        for k, w in enumerate(self.weights):
            p[:, k] = _sigmoid(_linear(rows, w, p[:, :k], len(self.features)))
        return p


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def _linear(rows: list[np.ndarray], w: np.ndarray, earlier: np.ndarray, n: int) -> np.ndarray:
    """Sum of a row's feature weights, plus the earlier categories' and the bias."""
    sizes = np.array([len(r) for r in rows], np.int64)
    ids = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    return np.bincount(owner, w[ids], len(rows)) + earlier @ w[n : n + earlier.shape[1]] + w[-1]


def _fit_linear(rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Logistic regression (Adam on the whole sample, class-balanced, ridge)."""
    w = np.zeros(n + earlier.shape[1] + 1)
    rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    weight = np.where(y == 1, 0.5 / rate, 0.5 / (1 - rate)) / len(y)
    sizes = np.array([len(r) for r in rows], np.int64)
    ids = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p = _sigmoid(np.bincount(owner, w[ids], len(rows)) + earlier @ w[n : n + earlier.shape[1]] + w[-1])
        d = (p - y) * weight
        g = np.concatenate([np.bincount(ids, d[owner], n), earlier.T @ d, [d.sum()]])
        g[:-1] += 1e-5 * w[:-1]
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w


def train_chain(
    categories: tuple[str, ...], features: list[str], rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray,
    chosen: list[np.ndarray] | None = None,
) -> Chain:
    """Fit the chain; ``folds`` gives each training row its fold, NaN marks an
    unknown label. ``rows`` may hold ids beyond ``features``: those chosen
    without some fold only. ``chosen[f]`` are the ids chosen without fold f."""
    n = len(features)
    top = max([n, *(int(r[-1]) + 1 for r in rows if len(r))])

    def only(ids: np.ndarray) -> list[np.ndarray]:
        allowed = np.zeros(top, bool)
        allowed[ids] = True
        return [r[allowed[r]] for r in rows]

    final = only(np.arange(n))
    without = [only(ids) for ids in chosen] if chosen else [final] * FOLDS
    chain = Chain(categories, {f: i for i, f in enumerate(features)}, [])
    held = np.zeros((len(rows), len(categories)))  # out-of-fold probabilities
    for k in range(len(categories)):
        y, earlier = labels[:, k].astype(float), held[:, :k]
        known = ~np.isnan(y)
        for fold in range(FOLDS):
            out = np.flatnonzero(folds == fold)
            rest = np.flatnonzero((folds != fold) & known)
            if len(out) and len(rest):
                w = _fit_linear([without[fold][i] for i in rest], earlier[rest], y[rest], top)
                held[out, k] = _sigmoid(_linear([without[fold][i] for i in out], w, earlier[out], top))
        used = np.flatnonzero(known)
        chain.weights.append(
            _fit_linear([final[i] for i in used], earlier[used], y[used], n) if len(used) else np.zeros(n + k + 1))
    return chain


def training_sample(documents: DataFrame, labels: DataFrame, sample_docs: int) -> DataFrame:
    """Written once: key, fold, one 0/1 column per category (null: unknown),
    text. A document with several label rows takes the largest of each."""
    marked = labels.where(F.col("toxic").isNotNull() | F.col("quality").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), *[c.alias(k) for k, c in label_columns().items()])
    known = marked.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(k).alias(k) for k in CATEGORIES])
    chosen = hashed_sample(known, F.col("doc_id"), sample_docs).withColumn("key", F.xxhash64("doc_id"))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    each = texts.join(small_or_shuffled(chosen, "toxicity-chosen"), "doc_id").where("text is not null").groupBy(
        "key", *CATEGORIES).agg(F.min("text").alias("text"))  # one row per id
    return written(
        each.select("key", F.pmod("key", F.lit(FOLDS)).cast("int").alias("fold"), *CATEGORIES, "text"),
        "toxicity-sample")


def feature_counts(sample: DataFrame) -> DataFrame:
    """Written once: (f, fold, n, k.., known_k..), the documents of each fold that
    hold a feature, of every category, and with a known label of it."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]+)"), F.lit(1)))

    def beginnings(n: int) -> Column:
        longer = F.filter("words", lambda w: F.length(w) > n)
        return F.transform(longer, lambda w: F.concat(F.substring(w, F.lit(1), F.lit(n)), F.lit("*")))

    begin = [beginnings(n) for n in BEGINNINGS]
    each = sample.withColumn("words", words).select(
        "fold", *CATEGORIES, F.explode(F.array_distinct(F.concat("words", *begin))).alias("f"))
    return written(each.groupBy("f", "fold").agg(*_counted()), "toxicity-counts")


def _counted() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in CATEGORIES],
            *[F.count(k).alias("known_" + k) for k in CATEGORIES]]


def strongest_features(counts: DataFrame, totals: list, without: int | None = None, limit: int = FEATURES) -> list[str]:
    """The features that tell a category best, by the documents of all folds but one."""
    names = ["n", *CATEGORIES, *("known_" + k for k in CATEGORIES)]
    used = counts if without is None else counts.where(F.col("fold") != without)
    summed = used.groupBy("f").agg(*[F.sum(c).alias(c) for c in names]).where(f"n >= {LEAST_DOCS}")
    whole = {c: sum(t[c] for t in totals if t["fold"] != without) for c in names}
    scores = []
    for k in CATEGORIES:
        inside, outside = float(whole[k]), float(whole["known_" + k] - whole[k])
        if inside and outside:
            share = F.col(k) / F.lit(inside)
            rest = (F.col("known_" + k) - F.col(k) + 0.5) / F.lit(outside)
            strong = (F.col(k) >= LEAST_DOCS) & (share >= LEAST_LIFT * rest)
            scores.append(F.when(strong, (share - rest) * F.log(share / rest)).otherwise(F.lit(0.0)))
    if not scores:
        return []
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    rows = summed.select("f", best.alias("best")).where("best > 0").orderBy(F.desc("best"), "f").limit(limit).collect()
    return [r["f"] for r in rows]


def fit(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Chain | None:
    """Train the chain on about ``sample_docs`` labelled documents; None
    when no category has both kinds of labels or no feature tells them. Each
    link learns from the documents that have its own label."""
    sample = training_sample(documents, labels, sample_docs)
    counts = feature_counts(sample)
    totals = sample.groupBy("fold").agg(*_counted()).collect()  # a row per fold
    features = strongest_features(counts, totals)
    if not features:
        return None
    lists = [strongest_features(counts, totals, fold) for fold in range(FOLDS)]
    ids = {f: i for i, f in enumerate(dict.fromkeys([*features, *(f for few in lists for f in few)]))}
    probe = Chain(CATEGORIES, ids, [])

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BATCH_ROWS):
            found = probe.design(batch.column(len(CATEGORIES) + 2).to_pylist())
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array([r.astype(np.int32) for r in found], pa.list_(pa.int32()))],
                names=["key", "fold", *CATEGORIES, "ids"])

    rows = sample.mapInArrow(
        present, "key bigint, fold int, " + ", ".join(f"{k} int" for k in CATEGORIES) + ", ids array<int>").collect()
    rows = sorted(rows, key=lambda r: (r["key"], r["ids"]))
    return train_chain(
        CATEGORIES, features, [np.array(r["ids"], np.int64) for r in rows],
        np.array([[np.nan if r[k] is None else r[k] for k in CATEGORIES] for r in rows], float),
        np.array([r["fold"] for r in rows]), [np.array([ids[f] for f in few], np.int64) for few in lists])


def score_toxicity(documents: DataFrame, labels: DataFrame, chain: Chain | None = None) -> DataFrame:
    """Probabilities of the toxicity categories for every whole text.

    Returns doc_id, one probability per category (``toxic_prose``,
    ``toxic_junk``, ``toxic``) and is_toxic (toxic, the last link, >= 0.3; a
    score at the bound counts). A null or empty text has no features and gets
    the chain's base rates; without anything to learn from all probabilities
    are 0. Only the whole text enters a prediction, as a set of features, so a
    very long text costs its own length. Repeated rows are scored each;
    further columns, whatever their names, are not read; an empty table gives
    no rows. Labels may be null, one or both, and repeated.
    """
    chain = chain or fit(documents, labels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BATCH_ROWS):
            texts = batch.column(1).to_pylist()
            p = chain.probabilities(texts) if chain else np.zeros((len(texts), len(CATEGORIES)))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(p[:, k]) for k in range(len(CATEGORIES))), pa.array(p[:, -1] >= ACCEPT)],
                names=["doc_id", *CATEGORIES, "is_toxic"])

    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(rows, "doc_id bigint, " + ", ".join(f"{k} double" for k in CATEGORIES) + ", is_toxic boolean")
