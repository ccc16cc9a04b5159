"""Alignment of the tokens of two tokenizers, with corpus-wide pair counts.

Tokenizer A is a byte-level BPE run over a space and the text, tokenizer B a
sentencepiece BPE run over the text (it adds that space), so the tokens of
both spell the same bytes. Offsets where a token of A and one of B both end
cut the two sequences into groups; the tokens that end there are linked.

Two passes over the documents:

1. Every task aligns its documents and counts its linked id pairs. The
   distinct pairs get a minimal perfect hash; the tasks' counts become dense
   vectors indexed by it, which are summed in a tree.
2. The documents are aligned again; the counts of their links are looked up
   in the dense vector by the hash, which verifies the key.

Two linked tokens end at the same byte, so the bytes of one are a suffix of
the bytes of the other. That bounds the distinct pairs by the vocabularies
(``Aligner.pair_bound``, under half a million for the default ones) at every
size of the corpus: the hash and the vectors stay that small.

Both tokenizers treat the stretches between lone blanks apart, so stretches
are aligned once and remembered (``REMEMBERED``); each text is a sequence of
remembered stretches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import in_slices, written
from gridwright.llm.perfect_hash import PerfectHash

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
# Stretches a worker remembers before it sheds the rare ones, and documents at a time.
REMEMBERED = 300_000
BATCH_ROWS = 64
# Dense vectors added up by one task of the tree.
FAN_IN = 16
# A text of words with lone spaces and line feeds between them, and the places
# where any other text may be cut: before a lone space and around a lone line
# feed, between characters that no definition of white space contains.
WORDS = re.compile(r" ?\S+|\n(?!\s)")
CUTS = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
WORD = re.compile(r" ?\S+")
# The pre-tokenizer that A must have.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
GROUPS = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups string"
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_level_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable characters
    of Latin-1 stand for themselves, the other bytes for the characters from
    U+0100 on, in order."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b.astype(np.int64)


class Aligner:
    """Aligns texts stretch by stretch and remembers the stretches.

    A stretch has a code; ``n_a``, ``n_b``, ``n_groups`` and ``sound`` (its
    tokens spell its bytes) are arrays over codes, ``groups`` their texts (left
    out unless ``with_groups``), and the links of code c are
    ``pairs[first[c]:first[c + 1]]``. Codes hold until ``generation`` changes.

    A's ids are made from the merges of its file by the rank encoder of
    tiktoken, which is several times faster on words; texts with other blanks
    than lone ones go through the file's own tokenizer. Both give the same ids.
    """

    def __init__(self, a_path: str, b_path: str, with_groups: bool = True):
        import public_tokenizers
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        self.with_groups, self.a_path = with_groups, a_path
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["pre_tokenizer"] != BYTE_LEVEL or spec["normalizer"] or spec["model"]["type"] != "BPE":
            raise ValueError(f"not a plain byte-level BPE tokenizer: {a_path}")
        byte = byte_level_alphabet()
        self.bytes_a = [b""] * (1 + max(t["id"] for t in [*spec["added_tokens"], {"id": len(spec["model"]["vocab"]) - 1}]))
        for entry, i in spec["model"]["vocab"].items():
            self.bytes_a[i] = bytes(byte.get(c, 0) for c in entry)
        special = {t["id"] for t in spec["added_tokens"]}
        merged = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"][m.replace(" ", "")] for m in merged]
        if order != sorted(order):
            raise ValueError(f"ids do not follow the merges: {a_path}")
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
            mergeable_ranks={t: i for i, t in enumerate(self.bytes_a) if t and i not in special})

        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"pieces reach over blanks: {b_path}")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.width_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.width_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # Ids as text with the character that may follow them in ``groups``.
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.spelled = [f"{i}{mark}" for mark in ",|;" for i in range(most)]
        self.spelled_size = np.array([len(t) for t in self.spelled], np.int64)
        self.generation = 0
        self.codes: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a = self.n_b = self.n_groups = self.used = np.zeros(0, np.int64)
        self.sound = np.zeros(0, bool)
        self.pairs, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)

    @cached_property
    def a(self):
        """The tokenizer of A's file, loaded with the first text that needs it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.a_path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def pair_bound(self) -> int:
        """Number of id pairs that can be linked: one's bytes end the other's."""
        def ending(longer: list[bytes], shorter: list[bytes], least: int) -> int:
            known: dict[bytes, int] = {}
            for t in shorter:
                known[t] = known.get(t, 0) + 1
            return sum(known.get(t[k:], 0) for t in longer for k in range(least, len(t)))

        return ending(self.bytes_a, self.bytes_b, 0) + ending(self.bytes_b, self.bytes_a, 1)

    def full(self) -> bool:
        return len(self.codes) > REMEMBERED

    def shed(self) -> None:
        """Forgets the stretches met once since the last time, and more if
        that leaves over half of the room taken."""
        least = max(2, int(np.partition(self.used, -(REMEMBERED // 2))[-(REMEMBERED // 2)]) + 1)
        keep = np.flatnonzero(self.used >= least)
        lists = np.repeat(self.used >= least, np.diff(self.first))
        units = list(self.codes)
        self.codes = {units[c]: k for k, c in enumerate(keep.tolist())}
        self.groups = [self.groups[c] for c in keep.tolist()] if self.with_groups else []
        self.pairs, sizes = self.pairs[lists], np.diff(self.first)[keep]
        self.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        self.n_a, self.n_b, self.n_groups = self.n_a[keep], self.n_b[keep], self.n_groups[keep]
        self.sound, self.used = self.sound[keep], self.used[keep] // 2
        self.generation += 1

    def encoded(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Codes of the stretches of each text; None for a null or empty text
        and for one whose tokens of A or B do not spell its bytes. The caller
        lets the aligner ``shed`` between calls when it is ``full``."""
        known = self.codes
        found: list[tuple[list, list[str], list[int]] | None] = []
        missing: dict[str, None] = {}
        for text in texts:
            if not text:
                found.append(None)
                continue
            spaced = " " + text
            units = WORDS.findall(spaced)
            if "".join(units) != spaced:
                units = CUTS.split(spaced)
            codes = list(map(known.get, units))
            gaps = [k for k, c in enumerate(codes) if c is None] if None in codes else []
            for k in gaps:
                missing[units[k]] = None
            found.append((codes, units, gaps))
        if missing:
            self._learn(list(missing))
        out: list[np.ndarray | None] = []
        used: list[np.ndarray] = []
        for each in found:
            if each is None:
                out.append(None)
                continue
            codes, units, gaps = each
            for k in gaps:
                codes[k] = known[units[k]]
            at = np.array(codes, np.int64)
            used.append(at)
            out.append(at if self.sound[at].all() else None)
        if used:
            self.used += np.bincount(np.concatenate(used), minlength=len(self.used))
        return out

    def _learn(self, units: list[str]) -> None:
        """Aligns new stretches: words joined into one text whose tokens are
        cut at the words, anything else by itself."""
        words, others = [], []
        for u in units:
            (words if WORD.fullmatch(u) else others).append(u)
        parts = [self._joined(words)] if words else []
        if parts == [None]:
            parts, others = [], words + others
            words = []
        parts += [self._single(u) for u in others]
        start = len(self.codes)
        self.codes.update({u: start + k for k, u in enumerate(words + others)})
        for name, column in zip(("n_a", "n_b", "n_groups", "sound", "pairs"), range(5), strict=True):
            setattr(self, name, np.concatenate([getattr(self, name), *[p[column] for p in parts]]))
        self.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.n_groups)])
        self.used = np.concatenate([self.used, np.zeros(len(self.n_a) - len(self.used), np.int64)])
        for p in parts:
            self.groups += p[5]

    def _aligned(self, a: np.ndarray, b: np.ndarray, text: bytes) -> tuple | None:
        """Ends in bytes of the groups, the number of tokens of A and of B up
        to there, and the linked pairs. None if the tokens do not spell the text."""
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != text or (
            b"".join(map(self.bytes_b.__getitem__, b.tolist())) != text
        ):
            return None
        ends_a, ends_b = np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        ends, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        return ends, at_a + 1, at_b + 1, pair_key(a[at_a], b[at_b])

    def _texts(self, a, b, to_a, to_b, start, stop) -> list[str]:
        """The groups numbered start[k] to stop[k] - 1 of each stretch k, as
        the ids of A, a bar and the ids of B, between semicolons."""
        if not self.with_groups:
            return []
        # The ids in the order of the text, each with the mark that follows it.
        most = len(self.spelled) // 3
        marked_a, marked_b = a.copy(), b.copy()
        marked_a[to_a - 1] += most
        marked_b[to_b - 1] += 2 * most
        group_a = np.searchsorted(to_a, np.arange(len(a)), side="right")
        group_b = np.searchsorted(to_b, np.arange(len(b)), side="right")
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        tokens = np.concatenate([marked_a, marked_b])[order]
        text = "".join(map(self.spelled.__getitem__, tokens.tolist()))
        ends = np.concatenate([[0], np.cumsum(self.spelled_size[tokens])])
        ends = ends[np.concatenate([[0], to_a + to_b])]  # after each group
        return [text[p : q - 1] if q > p else "" for p, q in zip(ends[start].tolist(), ends[stop].tolist(), strict=True)]

    def _joined(self, words: list[str]) -> tuple | None:
        """Words as one text. Words without a space before them get a line
        feed, which is a group of its own. None if the tokens do not spell it."""
        text = " x" + "".join(w if w[0] == " " else "\n" + w for w in words)
        a = np.array(self.ranks.encode_ordinary(text), np.int64)
        b = np.array(self.b.encode(text[1:]), np.int64)
        found = self._aligned(a, b, text.encode())
        if found is None:
            return None
        ends, to_a, to_b, pairs = found
        size = np.array([len(w.encode()) for w in words], np.int64)
        fed = np.array([w[0] != " " for w in words], np.int64)
        stop = np.cumsum(size + fed) + 2  # after " x"
        last, before = np.searchsorted(ends, stop), np.searchsorted(ends, stop - size)
        if (ends[last] != stop).any() or (ends[before] != stop - size).any():
            raise AssertionError("a token reaches over a blank")
        inside = np.zeros(len(ends) + 1, np.int64)
        np.add.at(inside, before + 1, 1)
        np.add.at(inside, last + 1, -1)
        groups = self._texts(a, b, to_a, to_b, before + 1, last + 1)
        return (to_a[last] - to_a[before], to_b[last] - to_b[before], last - before,
                np.ones(len(words), bool), pairs[np.cumsum(inside)[:-1] > 0], groups)

    def _single(self, unit: str) -> tuple:
        """One stretch; without a space before it B sees it behind a line feed."""
        a = np.array(self.a.encode(unit, add_special_tokens=False).ids, np.int64)
        b = np.array(self.b.encode(unit[1:]) if unit[0] == " " else self.b.encode("\n" + unit)[2:], np.int64)
        found = self._aligned(a, b, unit.encode())
        if found is None:
            none = np.zeros(1, np.int64)
            return none, none, none, np.zeros(1, bool), none[:0], [""] * self.with_groups
        ends, to_a, to_b, pairs = found
        n = np.array([len(ends)], np.int64)
        return (np.array([len(a)]), np.array([len(b)]), n, np.ones(1, bool), pairs,
                self._texts(a, b, to_a, to_b, 0 * n, n))

    def counted(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs and their counts, each code seen so many times."""
        n = np.repeat(seen, np.diff(self.first)[: len(seen)])
        return summed(self.pairs[: len(n)], n)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts, zero sums left out."""
    distinct, at = np.unique(keys, return_inverse=True)
    totals = np.zeros(len(distinct), np.int64)
    np.add.at(totals, at, counts)
    return distinct[totals > 0], totals[totals > 0]


@lru_cache(maxsize=1)
def shared_aligner(a_path: str, b_path: str, with_groups: bool) -> Aligner:
    """One for each Python worker, which serves many tasks."""
    return Aligner(a_path, b_path, with_groups)


class PairCounts:
    """Corpus-wide counts of the linked pairs: a dense vector indexed by the
    perfect hash of the pairs, and the highest count of each id of B."""

    def __init__(self, keys: np.ndarray, b_ids: int):
        self.hash = PerfectHash(keys)
        self.counts = np.zeros(len(keys), np.int64)
        self.highest = np.zeros(b_ids, np.int64)

    def fill(self, counts: np.ndarray) -> None:
        self.counts = counts
        np.maximum.at(self.highest, self.hash.keys.astype(np.int64) & 0xFFFFFFFF, counts)

    def dense(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The counts as a vector over the hash; a foreign key is an error."""
        at = self.hash.verified(keys)
        if (at < 0).any():
            raise KeyError("a pair without an index")
        vector = np.zeros(len(self.hash), np.int64)
        np.add.at(vector, at, counts)
        return vector

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair (0 if never linked), and whether it is the
        highest of its id of B."""
        at = self.hash.verified(keys)
        if not len(self.counts):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        n = np.where(at >= 0, self.counts[at], 0)
        return n, (n > 0) & (n == self.highest[keys & 0xFFFFFFFF])


class LookUp:
    """Sums over the links of each remembered stretch."""

    def __init__(self, aligner: Aligner, counts: PairCounts):
        self.aligner, self.counts, self.generation = aligner, counts, -1
        self.total = self.best = np.zeros(0, np.int64)

    def refresh(self) -> None:
        """Follows the aligner: new stretches are looked up once."""
        al = self.aligner
        if self.generation != al.generation:
            self.generation, self.total, self.best = al.generation, np.zeros(0, np.int64), np.zeros(0, np.int64)
        done = len(self.total)
        if done == len(al.n_a):
            return
        n, best = self.counts.of(al.pairs[al.first[done] :])
        cut = al.first[done:] - al.first[done]
        for name, values in (("total", n), ("best", best)):
            running = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
            setattr(self, name, np.concatenate([getattr(self, name), np.diff(running[cut])]))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def link_counts(documents: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """First pass: key (id of A << 32 | id of B) and n, summed within each
    task, so a key has one row per task that met it."""
    paths = (a_path or tokenizer_path(TOKENIZER_A), b_path or tokenizer_path(TOKENIZER_B))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared_aligner(*paths, False)
        keys = counts = np.zeros(0, np.int64)
        seen = np.zeros(0, np.int64)

        def folded() -> tuple[np.ndarray, np.ndarray]:
            new, n = aligner.counted(seen)
            return summed(np.concatenate([keys, new]), np.concatenate([counts, n]))

        for batch in in_slices(batches, BATCH_ROWS):
            if aligner.full():  # what was seen is counted before it is forgotten
                keys, counts = folded()
                aligner.shed()
                seen = np.zeros(0, np.int64)
            found = [c for c in aligner.encoded(batch.column(1).to_pylist()) if c is not None]
            if found:
                new = np.bincount(np.concatenate(found), minlength=len(aligner.n_a))
                new[: len(seen)] += seen
                seen = new
        keys, counts = folded()
        yield pa.record_batch([pa.array(keys), pa.array(counts)], names=["key", "n"])

    return _texts(documents).mapInArrow(rows, "key bigint, n bigint")


def tree_sum(vectors: DataFrame, fan_in: int = FAN_IN) -> bytes | None:
    """Sum of int64 vectors of equal length, one per row (slot int, vector
    binary), ``fan_in`` slots at a time: no task and not the driver reads more
    than that, however many tasks made vectors. Slots count from 0."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = np.frombuffer(vector.as_buffer(), "<i8")
                sums[slot] = sums[slot] + v if slot in sums else v
        for slot, v in sums.items():
            yield pa.record_batch([pa.array([slot], pa.int32()), pa.array([v.tobytes()], pa.binary())],
                                  names=["slot", "vector"])

    slots = vectors.agg(F.max("slot")).first()[0]
    if slots is None:
        return None
    slots += 1
    while slots > 1:
        slots = -(-slots // fan_in)
        vectors = vectors.withColumn("slot", F.floor(F.col("slot") / fan_in).cast("int"))
        vectors = vectors.repartition(slots, "slot").mapInArrow(added, "slot int, vector binary")
    return vectors.first()["vector"]


def pair_counts(documents: DataFrame, a_path: str | None = None, b_path: str | None = None) -> PairCounts:
    """The first pass as a whole: distinct pairs, their perfect hash, and the
    tree sum of the tasks' dense vectors."""
    paths = (a_path or tokenizer_path(TOKENIZER_A), b_path or tokenizer_path(TOKENIZER_B))
    aligner = Aligner(*paths, False)
    partial = written(link_counts(documents, *paths), "pair-counts")
    distinct = partial.select("key").distinct()
    bound = aligner.pair_bound()
    keys = np.array(sorted(r[0] for r in distinct.limit(bound + 1).collect()), np.int64)
    if len(keys) > bound:
        raise AssertionError(f"more than the {bound} pairs that these vocabularies can link")
    model = PairCounts(keys, len(aligner.bytes_b))
    shared = partial.sparkSession.sparkContext.broadcast(model)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vector = None
        for batch in batches:
            part = shared.value.dense(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            vector = part if vector is None else vector + part
        if vector is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                   pa.array([vector.tobytes()], pa.binary())], names=["slot", "vector"])

    total = tree_sum(written(partial.mapInArrow(dense, "slot int, vector binary"), "pair-vectors"))
    model.fill(np.frombuffer(total, "<i8") if total is not None else model.counts)
    return model


def align_documents(
    documents: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    counts: PairCounts | None = None,
) -> DataFrame:
    """Align the tokens of A and B in every whole text.

    Returns one row per row: doc_id, n_a and n_b (tokens), n_groups, n_links
    (A-B pairs that end together, one per group), n_best (links whose count is
    the highest of their id of B, ties included), count_sum (counts over the
    links) and groups, as ``a1,a2|b1;a3|b2`` with decimal ids.

    ``counts`` come from the documents themselves unless given; a pair never
    counted counts 0 and is never best. Null and empty texts, and texts whose
    tokens do not spell them (U+2581 in the text), have no tokens: zeros and
    an empty ``groups``; they add nothing to the counts. A null id stays null.
    Repeated rows each have their row and each count. A text of any length is
    aligned whole; a task holds ``BATCH_ROWS`` of them. Other columns are
    ignored whatever their names. An empty table gives no rows.
    """
    paths = (a_path or tokenizer_path(TOKENIZER_A), b_path or tokenizer_path(TOKENIZER_B))
    model = counts or pair_counts(documents, *paths)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared_aligner(*paths, True)
        look_up = LookUp(aligner, shared.value)
        for batch in in_slices(batches, BATCH_ROWS):
            if aligner.full():
                aligner.shed()
            found = aligner.encoded(batch.column(1).to_pylist())
            look_up.refresh()
            numbers = np.zeros((5, len(found)), np.int64)
            groups = [""] * len(found)
            for k, codes in enumerate(found):
                if codes is not None:
                    numbers[:, k] = [v[codes].sum() for v in (
                        aligner.n_a, aligner.n_b, aligner.n_groups, look_up.best, look_up.total)]
                    groups[k] = ";".join(map(aligner.groups.__getitem__, codes.tolist()))
            n_a, n_b, n_groups, n_best, total = map(pa.array, numbers)
            yield pa.record_batch(
                [batch.column(0), n_a, n_b, n_groups, n_groups, n_best, total, pa.array(groups, pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    return _texts(documents).mapInArrow(rows, GROUPS)
