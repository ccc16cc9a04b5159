"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. Every passage is encoded
(byte-class bigrams, repetition at short lags, word shapes; one hidden layer),
gated attention weights say how much each passage counts, and the weighted
passage representation is scored. Only document labels are needed: the
attention learns which passages decide.

The model is trained in numpy on the driver on a bounded sample of labelled
documents (``SAMPLE_DOCS``, by the hash of their id; at most
``SAMPLE_PASSAGES`` evenly spaced passages of each). Scoring runs in tasks and
takes every passage of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import byte_lists, crc_mod, hashed_sample, in_slices, kept_by_text, small_or_shuffled

PASSAGE = 512
LAGS = tuple(range(2, 18))
HIDDEN = 24
GATE = 12
EPOCHS = 25
SEED = 5
SAMPLE_DOCS = 5000
SAMPLE_PASSAGES = 12
BATCH_ROWS = 64
# Passages encoded at a time.
TILE = 512
# Score from which a document is predicted to be of label 1.
ACCEPT = 0.3
# Learning rows: crc32(doc_id) modulo FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 5, 0


def _byte_classes() -> np.ndarray:
    """Class of each byte: padding, space, line feed, other blank, digit, lower,
    upper, full stop, comma, ! ? ; :, brackets and quotes, | and /, symbols,
    control, UTF-8 continuation, UTF-8 lead."""
    kind = np.full(256, 12, np.int64)
    kind[0x80:0xC0], kind[0xC0:] = 14, 15
    kind[:32], kind[127] = 13, 13
    kind[0] = 0
    for n, chars in ((1, " "), (2, "\n"), (3, "\t\r\v\f"), (4, "0123456789"), (7, "."), (8, ","), (9, "!?;:"),
                     (10, "()[]{}\"'`"), (11, "|/\\")):
        for c in chars:
            kind[ord(c)] = n
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1] = 5, 6
    return kind


KIND = _byte_classes()
KINDS = 16
FEATURES = KINDS * KINDS + len(LAGS) + 3


def passages_of(text: str) -> np.ndarray:
    """All bytes of a text, as zero-padded rows of ``PASSAGE``; an empty text is one empty passage."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, -(-len(data) // PASSAGE))
    out = np.zeros(n * PASSAGE, np.uint8)
    out[: len(data)] = data
    return out.reshape(n, PASSAGE)


def passage_features(rows: np.ndarray) -> np.ndarray:
    """Features of passages (n, PASSAGE): square roots of the shares of byte-class
    bigrams, share of bytes equal to the byte ``lag`` before, the largest of
    those, filled share, and mean word length."""
    n = len(rows)
    kind = KIND[rows]
    real = np.maximum((rows != 0).sum(1), 1).astype(np.float32)
    pair = kind[:, :-1] * KINDS + kind[:, 1:] + (np.arange(n) * KINDS * KINDS)[:, None]
    grams = np.bincount(pair.ravel(), minlength=n * KINDS * KINDS).reshape(n, -1).astype(np.float32)
    grams[:, 0] = 0  # padding after padding
    same = np.empty((n, len(LAGS)), np.float32)
    filled = rows != 0
    for k, lag in enumerate(LAGS):
        same[:, k] = ((rows[:, lag:] == rows[:, :-lag]) & filled[:, lag:]).sum(1) / real
    blanks = np.maximum(((kind == 1) | (kind == 2)).sum(1), 1)
    rest = np.stack([same.max(1), real / PASSAGE, np.minimum(real / blanks / 20, 2)], 1)
    return np.concatenate([np.sqrt(grams / real[:, None]), same, rest.astype(np.float32)], 1)


@dataclass
class AttentionModel:
    """Weights; ``mean`` and ``scale`` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray  # (features, HIDDEN)
    encode_bias: np.ndarray
    tanh_gate: np.ndarray  # (HIDDEN, GATE)
    sigmoid_gate: np.ndarray  # (HIDDEN, GATE)
    attend: np.ndarray  # (GATE,)
    weigh: np.ndarray  # (HIDDEN,)
    bias: np.ndarray  # (1,)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags; rows of ``x`` from starts[i] to starts[i + 1] are bag i."""
        h = np.tanh(x @ self.encode + self.encode_bias)
        t, s = np.tanh(h @ self.tanh_gate), _sigmoid(h @ self.sigmoid_gate)
        e = (t * s) @ self.attend
        sizes = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"h": h, "t": t, "s": s, "a": a, "bag": bag, "z": z, "p": _sigmoid(z @ self.weigh + self.bias)}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of each whole text."""
        rows = [passages_of(t or "") for t in texts]
        starts = np.cumsum([0, *(len(r) for r in rows[:-1])])
        every = np.concatenate(rows)
        x = np.concatenate([
            ((passage_features(every[lo : lo + TILE]) - self.mean) / self.scale).astype(np.float32)
            for lo in range(0, len(every), TILE)
        ])
        return self.forward(x, starts)["p"]


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> AttentionModel:
    """Fit on bags of passage features and 0/1 labels (Adam, cross entropy, weight decay)."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), np.maximum(every.std(0), 0.02)
    bags = [((b - mean) / scale).astype(np.float32) for b in bags]
    normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    rate = min(max(float(np.mean(labels)), 0.01), 0.99)
    m = AttentionModel(mean, scale, normal(FEATURES, HIDDEN), np.zeros(HIDDEN, np.float32), normal(HIDDEN, GATE),
                       normal(HIDDEN, GATE), normal(GATE), normal(HIDDEN),
                       np.array([np.log(rate / (1 - rate))], np.float32))
    names = [f.name for f in fields(m)][2:]
    first = {k: np.zeros_like(getattr(m, k)) for k in names}
    second = {k: np.zeros_like(getattr(m, k)) for k in names}
    step, batch = 0, 64
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            take = order[lo : lo + batch]
            starts = np.cumsum([0, *(len(bags[i]) for i in take[:-1])])
            grads = _gradients(m, np.concatenate([bags[i] for i in take]), starts, labels[take])
            step += 1
            size = 0.004 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k in names:
                g = grads[k] + 1e-4 * getattr(m, k)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                getattr(m, k)[...] -= size * first[k] / (np.sqrt(second[k]) + 1e-8)
    return m


def _gradients(m: AttentionModel, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = m.forward(x, starts)
    h, t, s, a, bag = f["h"], f["t"], f["s"], f["a"], f["bag"]
    d = (f["p"] - y) / len(starts)
    dz = d[:, None] * m.weigh
    # Through the weighted mean and the softmax of the attention.
    da = (h * dz[bag]).sum(1)
    de = a * (da - np.add.reduceat(a * da, starts)[bag])
    dt = de[:, None] * m.attend * s * (1 - t * t)
    ds = de[:, None] * m.attend * t * s * (1 - s)
    dh = a[:, None] * dz[bag] + dt @ m.tanh_gate.T + ds @ m.sigmoid_gate.T
    dh *= 1 - h * h
    return {"encode": x.T @ dh, "encode_bias": dh.sum(0), "tanh_gate": h.T @ dt, "sigmoid_gate": h.T @ ds,
            "attend": (t * s).T @ de, "weigh": f["z"].T @ d, "bias": np.array([d.sum()])}


def fit(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> AttentionModel | None:
    """Train on labelled documents outside the held-out fold; None without any.

    About ``sample_docs`` of them, drawn by the hash of their id.
    A document with several labels takes their majority (a tie counts as 1);
    null labels do not count.
    """
    known = labels.where(
        F.col("quality").isNotNull() & (F.coalesce(crc_mod(F.col("doc_id"), FOLDS), F.lit(HELD_OUT)) != HELD_OUT)
    ).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        (F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("quality"))
    chosen = hashed_sample(known, F.col("doc_id"), sample_docs).withColumn("o", F.xxhash64("doc_id"))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # About sample_docs rows of 16 bytes: measured all the same.
    texts = texts.join(small_or_shuffled(chosen, "quality-sample"), "doc_id").select("o", "doc_id", "quality", "text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BATCH_ROWS):
            o, doc_id, quality, text = batch.columns
            found = []
            for t in text.to_pylist():
                rows = passages_of(t or "")
                at = np.unique(np.linspace(0, len(rows) - 1, min(len(rows), SAMPLE_PASSAGES)).astype(int))
                found.append(np.round(passage_features(rows[at]) * 10_000).astype(np.int64).ravel())
            yield pa.record_batch([o, doc_id, quality, byte_lists(found)], names=["o", "doc_id", "quality", "bag"])

    # One row per id, however often it is repeated.
    rows = texts.mapInArrow(bags, "o bigint, doc_id bigint, quality int, bag array<bigint>").groupBy(
        "o", "doc_id", "quality").agg(F.min(F.col("bag").cast("array<smallint>")).alias("bag")).collect()
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: (r["o"], r["doc_id"]))
    return train([np.array(r["bag"], np.float32).reshape(-1, FEATURES) / 10_000 for r in rows],
                 np.array([r["quality"] for r in rows], np.float32))


def score_quality(documents: DataFrame, labels: DataFrame, model: AttentionModel | None = None) -> DataFrame:
    """Score every whole text.

    Returns doc_id, held_out (crc32 of the id as text, modulo 5, is 0; false
    for a null id), score (0 to 1, higher: label 1 is likelier) and predicted
    (1 when score >= 0.3). A null text is scored as the empty text. Without
    any label to learn from all scores are 0.5. Only the text enters a score.
    Repeated rows are scored each; an empty table gives no rows.
    """
    model = model or fit(documents, labels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BATCH_ROWS):
            if batch.num_rows:
                texts = batch.column(2).to_pylist()
                score = np.asarray(model.scores(texts) if model else np.full(len(texts), 0.5), np.float64)
                yield pa.record_batch(
                    [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(rows, "doc_id bigint, held_out boolean, score double, predicted int")


def of_quality(documents: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The documents (all columns) with a score of at least ``accept``; all of
    them when there is nothing to learn from."""
    model = fit(documents, labels)
    if model is None:
        return documents

    return kept_by_text(documents, lambda texts: np.asarray(model.scores(texts)) >= accept, BATCH_ROWS)
