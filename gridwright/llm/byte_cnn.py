"""Language identification by a convolutional network over bytes.

Texts are cut into windows of ``WINDOW`` bytes. Bytes are embedded, filters of
several widths run over the embedding, each filter's maximum over the window
is kept, and a softmax over those gives the window's language. A document's
prediction is the softmax of its windows' mean logits, weighted by their real
bytes, over the whole text.

The network is trained in numpy on the driver, on a bounded sample of labelled
documents (``SAMPLE_DOCS``, taken by the hash of their id, ``SAMPLE_PIECES``
windows of each). The bound of the filter is told from all documents spared for
it. Scoring runs in tasks over Arrow batches, ``TILE`` windows
at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import crc_mod, in_slices, kept_by_text, small_or_shuffled
from gridwright.operators.sizing import materialize_counted

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 4
EPOCHS = 12
SEED = 11
SAMPLE_DOCS = 6000
SAMPLE_PIECES = 3
TILE = 256
BATCH_ROWS = 256
UNDETERMINED = "und"
# Learning rows: crc32(doc_id) modulo FOLDS is not HELD_OUT. Of them, those
# with remainder TRIAL modulo TRIALS are kept for the bound of the filter.
FOLDS, HELD_OUT = 4, 2
TRIALS, TRIAL = 16, 3
# Share of rightly told trial documents that may lie below the filter's
# reference score, and how many of them it takes.
TRIAL_TAIL, LEAST_TRIALS = 0.001, 500


@dataclass
class ByteNet:
    """Weights of the network; ``classes`` in the order of its outputs."""

    classes: list[str]
    embed: np.ndarray  # (256, EMBEDDING)
    kernel: np.ndarray  # (max width * EMBEDDING, filters), zero beyond a filter's width
    shift: np.ndarray  # (filters,)
    dense: np.ndarray  # (filters, classes)
    bias: np.ndarray  # (classes,)

    def convolved(self, windows: np.ndarray) -> np.ndarray:
        """Filter responses (rows, steps, filters) of uint8 windows (rows, bytes)."""
        rows, length = windows.shape
        width, taps = self.embed.shape[1], len(self.kernel)
        steps = length - taps // width + 1
        x = self.embed[windows].reshape(rows, -1)
        patches = np.lib.stride_tricks.sliding_window_view(x, taps, axis=1)[:, ::width]
        return (np.ascontiguousarray(patches).reshape(rows * steps, taps) @ self.kernel).reshape(rows, steps, -1)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        top = self.convolved(windows).max(1) + self.shift
        return np.maximum(top, 0) @ self.dense + self.bias


def has_letter(text: str | None) -> bool:
    """Whether a text holds a character of Unicode category L (digits like
    "²" are none), as ``\\p{L}`` finds it in Spark."""
    return text is not None and any(map(str.isalpha, text))


def windows_of(text: str, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text as windows (zero-padded), and each one's real bytes."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, -(-len(data) // length))
    padded = np.zeros(n * length, np.uint8)
    padded[: len(data)] = data
    weight = np.full(n, length)
    weight[-1] = max(1, len(data) - (n - 1) * length)
    return padded.reshape(n, length), weight


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(pieces: list[str], labels: list[str], epochs: int = EPOCHS, seed: int = SEED) -> ByteNet:
    """Fit the network on labelled text pieces (Adam, class-balanced cross entropy)."""
    classes = sorted(set(labels))
    if not classes:
        raise ValueError("no labelled text to learn from")
    rng = np.random.default_rng(seed)
    found = [windows_of(p) for p in pieces]
    x = np.concatenate([w for w, _ in found])
    weight = np.concatenate([n for _, n in found]) / WINDOW
    code = {c: k for k, c in enumerate(classes)}
    y = np.repeat([code[v] for v in labels], [len(w) for w, _ in found])
    share = np.bincount(y, weight, len(classes))
    weight = weight * (share.sum() / len(classes) / np.maximum(share, 1e-9))[y]
    span, filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((span * EMBEDDING, filters), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[: w * EMBEDDING, k * FILTERS : (k + 1) * FILTERS] = 1
    net = ByteNet(
        classes,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        (rng.normal(0, 0.35, mask.shape) * mask).astype(np.float32),
        np.zeros(filters, np.float32),
        rng.normal(0, 0.2, (filters, len(classes))).astype(np.float32),
        np.zeros(len(classes), np.float32),
    )
    names = ("embed", "kernel", "shift", "dense", "bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step, batch = 0, 64
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(order), batch):
            take = order[lo : lo + batch]
            grads = _gradients(net, x[take], y[take], weight[take] / weight[take].sum(), mask)
            step += 1
            for k in names:
                g = grads[k]
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                getattr(net, k)[...] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return net


def _gradients(net: ByteNet, x: np.ndarray, y: np.ndarray, weight: np.ndarray, mask: np.ndarray) -> dict:
    """Gradients of the weighted cross entropy; maxima pass theirs to the
    bytes they were found at."""
    rows, span = len(x), len(net.kernel) // EMBEDDING
    out = net.convolved(x)
    at = out.argmax(1)
    top = np.take_along_axis(out, at[:, None], 1)[:, 0] + net.shift
    hidden = np.maximum(top, 0)
    d_out = _softmax(hidden @ net.dense + net.bias)
    d_out[np.arange(rows), y] -= 1
    d_out = (d_out * weight[:, None]).astype(np.float32)
    d_top = (d_out @ net.dense.T) * (top > 0)
    seen = x[np.arange(rows)[:, None, None], at[:, :, None] + np.arange(span)]  # (rows, filters, span)
    patch = net.embed[seen].reshape(rows, -1, span * EMBEDDING)
    d_patch = (d_top[:, :, None] * net.kernel.T[None]).reshape(-1, EMBEDDING)
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, seen.ravel(), d_patch)
    return {
        "embed": d_embed,
        "kernel": np.einsum("rf,rfk->kf", d_top, patch) * mask,
        "shift": d_top.sum(0),
        "dense": hidden.T @ d_out,
        "bias": d_out.sum(0),
    }


def predict(net: ByteNet, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and its probability for each whole text."""
    owner, tiles, weights = [], [], []
    for i, text in enumerate(texts):
        if has_letter(text):
            w, n = windows_of(text)
            tiles.append(w)
            weights.append(n)
            owner.append(np.full(len(w), i))
    langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if not tiles:
        return langs, scores
    x, weight, owner = np.concatenate(tiles), np.concatenate(weights).astype(float), np.concatenate(owner)
    logits = np.concatenate([net.logits(x[lo : lo + TILE]) for lo in range(0, len(x), TILE)])
    total = np.zeros((len(texts), len(net.classes)))
    np.add.at(total, owner, logits * weight[:, None])
    share = _softmax(total / np.maximum(np.bincount(owner, weight, len(texts)), 1)[:, None])
    for i in np.unique(owner):
        best = int(share[i].argmax())
        langs[i], scores[i] = net.classes[best], float(share[i, best])
    return langs, scores


def equal_share(counts: list[int], total: int) -> float:
    """The number of rows that each group may give so that all give ``total`` (or all they have)."""
    left = float(total)
    for k, n in enumerate(sorted(counts)):
        fair = left / (len(counts) - k)
        if n > fair:
            return fair
        left -= n
    return float(max(counts, default=0))


def learnable() -> Column:
    return (F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
            & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT))


def fit(documents: DataFrame, sample_docs: int = SAMPLE_DOCS, spare_trials: bool = False) -> ByteNet | None:
    """Train on labelled rows outside the held-out fold; None without any.

    About ``sample_docs`` documents at most, drawn by the hash of their id, an
    equal number of each language (all of one that has fewer, which leaves
    more to the others); of each, ``SAMPLE_PIECES`` evenly spaced pieces of a
    window's length. ``spare_trials`` leaves the trial documents out.
    """
    text = F.col("text").cast("string")
    piece = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_PIECES - 1)),
        lambda k: F.substring(text, (1 + F.floor(F.length(text) * k / SAMPLE_PIECES)).cast("int"), F.lit(WINDOW)),
    )
    known = documents.where(learnable()).select("doc_id", "lang", "text")
    if spare_trials:
        known = known.where(crc_mod(F.col("doc_id"), TRIALS) != TRIAL)
    spoken = small_or_shuffled(known.groupBy("lang").agg(F.count(F.lit(1)).alias("__docs")), "language-counts")
    most = equal_share([r["__docs"] for r in spoken.collect()], sample_docs)  # a row per class of the network
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 53)).cast("double") * F.col("__docs") <= F.lit(most * float(1 << 53))
    chosen = known.join(spoken, "lang").where(drawn & text.rlike(r"\p{L}"))
    # One row per id, however often it is repeated.
    each = chosen.groupBy("doc_id").agg(
        F.min(F.struct(F.col("lang").cast("string").alias("lang"), piece.alias("pieces"))).alias("m"))
    rows = sorted(each.select("doc_id", "m.lang", "m.pieces").collect())
    found = [(p, r["lang"]) for r in rows for p in dict.fromkeys(r["pieces"]) if has_letter(p)]
    return train([p for p, _ in found], [v for _, v in found]) if found else None


def identify_languages(documents: DataFrame, net: ByteNet | None = None) -> DataFrame:
    """Predict the language of every whole text.

    Returns doc_id, held_out (crc32 of the id as text, modulo 4, is 2; false
    for a null id, which is not learned from either), lang_pred and score (0
    to 1). ``und`` with score 0 for a null text, a text without a letter
    (Unicode category L), and for all texts when there is nothing to learn
    from. Only the text enters a prediction; of equal probabilities the first
    language in order wins. All windows of a very long text count; it is held
    by one task. Repeated rows are predicted each; further columns, whatever
    their names, are not read; an empty table gives no rows.
    """
    net = net or fit(documents)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BATCH_ROWS):
            texts = batch.column(2).to_pylist()
            langs, scores = predict(net, texts) if net else ([UNDETERMINED] * len(texts), np.zeros(len(texts)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(langs), pa.array(scores)],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    held_out = F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(rows, "doc_id bigint, held_out boolean, lang_pred string, score double")


def least_known_score(documents: DataFrame, net: ByteNet) -> float:
    """The score below which a text counts as in none of the learned languages.

    All labelled documents that ``fit`` has spared are predicted; all but
    ``TRIAL_TAIL`` of those told rightly lie above the reference, and the bound
    is half-way between it and what mere chance gives. With fewer than
    ``LEAST_TRIALS`` of them it is chance. The scores are written once; the
    two next to the reference are the only ones that reach the driver.
    """
    chance = 1 / len(net.classes)
    known = documents.where(learnable() & (crc_mod(F.col("doc_id"), TRIALS) == TRIAL))

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BATCH_ROWS):
            langs, scores = predict(net, batch.column(1).to_pylist())
            told = [s for s, v, t in zip(scores, langs, batch.column(0).to_pylist(), strict=True) if v == t]
            yield pa.record_batch([pa.array(told, pa.float64())], names=["score"])

    texts = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    told, rows = materialize_counted(texts.mapInArrow(right, "score double"), "trial-scores")
    if rows < LEAST_TRIALS:
        return chance
    place = TRIAL_TAIL * (rows - 1)
    lowest = told.orderBy("score").limit(int(place) + 2)
    upper, lower = [r["score"] for r in lowest.orderBy(F.col("score").desc()).limit(2).collect()]
    return (chance + lower + (upper - lower) * (place - int(place))) / 2


def in_known_language(documents: DataFrame, least_score: float | None = None, net: ByteNet | None = None) -> DataFrame:
    """The documents (all columns) whose text is in one of the learned
    languages with at least ``least_score`` (unset: ``least_known_score``).
    Undetermined ones, null and empty texts among them, go; repeated rows are
    judged alike; nothing is kept when there is nothing to learn from."""
    net = net or fit(documents, spare_trials=True)

    if net is None:
        return documents.where(F.lit(False))
    bound = least_known_score(documents, net) if least_score is None else least_score

    def keep(texts: list[str | None]) -> np.ndarray:
        langs, scores = predict(net, texts)
        return (np.array(langs) != UNDETERMINED) & (scores >= bound)

    return kept_by_text(documents, keep, BATCH_ROWS)
