"""Hierarchical multi-length packing of token sequences.

Documents are tokenized, routed to context tiers (128, 256, 512, 1024 tokens)
by their length, and packed tier by tier:

* a long document fills windows of 1024; the rest of its last window is a gap,
* gaps are filled from the shorter tiers, longest pieces first, the last piece
  cut to fit exactly,
* what is left of a tier is laid into windows of exactly the tier's length,
  its remainder moves down to the next shorter tier,
* the last remainder of a task is cut into powers of two.

Every window is therefore either full or a power of two long: no padding.
Windows of a length are dealt to step groups of ``STEP_TOKENS`` tokens each, so
the groups cost the same whichever tier they come from. Windows are numbered
over all tasks: at most the last group of a length is not full.

Packing goes along with the scan: a task packs the rows of its own input
split, batch by batch, and carries over less than one window per tier. The
pieces are written; only the numbers of windows, a row per task and length,
are summed over all tasks. There is no shuffle of pieces, no hot group, and a
repeated task gives the same rows.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridwright.llm.common import in_slices, small_or_shuffled, written

CONTEXT = 1024
TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 64 * CONTEXT
END_ID = 0
# The tokenizer, and the same vocabulary as ranks.
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# Words whose ids a worker remembers before it starts over, and documents
# packed at a time.
REMEMBERED_WORDS = 200_000
BATCH_ROWS = 256
# Blanks other than space and line feed.
OTHER_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
# A character that marks word starts; texts that contain it are encoded whole.
MARK = "\x00"

# As a task places them; ``nth`` counts its windows of a length.
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, nth bigint"
)
# Bits of a window's number inside its task.
TASK_BITS = 40
_TYPES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
          ("nth", pa.int64())]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCachedTokenizer:
    """Ids of a byte-level BPE tokenizer, word by word.

    The tokenizer cuts a text before every single space that stands between
    two non-blank characters, whatever else it does, so each such stretch is
    encoded on its own and its ids are remembered. New stretches are encoded
    from the same vocabulary in rank form (``ranks``), which is several times
    faster on short strings. Texts with other blanks next to a space, or with
    a special token's string, go through the tokenizer whole. All give the
    ids of ``Tokenizer.encode(text, add_special_tokens=False)``.
    """

    def __init__(self, path: str, ranks: str):
        import public_tokenizers
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self.whole = ["  ", " \n", "\n ", MARK, *OTHER_BLANKS, *special]
        with open(ranks, "rb") as f:
            by_rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=by_rank, special_tokens={}
        )
        self.widths = np.zeros(max(by_rank.values()) + 1, np.int64)  # bytes of each token
        for token, rank in by_rank.items():
            self.widths[rank] = len(token)
        self.known: dict[str, bytes] = {}

    @cached_property
    def tokenizer(self):
        """Loaded with the first text that has to be encoded whole."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each word with its ids. Words that begin with the space and end in
        no blank can stand behind each other without touching, so they are
        encoded as one text, whose ids are cut where the words end."""
        joined = [w for w in words if w[0] == " " and w[-1] != "\n"]
        if joined:
            text = "".join(joined)
            ids = np.array(self.words.encode_ordinary(text), "<u4")
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, joined)), np.int64, len(joined)))
            cuts = 4 * (np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1)
            data, at = ids.tobytes(), 0
            for w, to in zip(joined, cuts.tolist(), strict=True):
                yield w, data[at:to]
                at = to
        for w in words:
            if w[0] != " " or w[-1] == "\n":
                yield w, np.array(self.words.encode_ordinary(w), "<u4").tobytes()

    def _stretches(self, text: str) -> list[str] | None:
        """The words of a text with their leading space, or None if it has to
        be encoded whole."""
        if any(s in text for s in self.whole):
            return None
        words = text.replace(" ", MARK + " ").split(MARK)
        return words if words[0] else words[1:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        known, out = self.known, [b""] * len(texts)
        cut, whole = [], []
        for i, text in enumerate(texts):
            if text:
                words = self._stretches(text)
                whole.append(i) if words is None else cut.append((i, words))
        found = [list(map(known.get, words)) for _, words in cut]
        new = {w for (_, words), ids in zip(cut, found, strict=True) if None in ids
               for w, x in zip(words, ids, strict=True) if x is None}
        known.update(self._words(list(new)))
        for (i, words), ids in zip(cut, found, strict=True):
            out[i] = b"".join(map(known.__getitem__, words) if None in ids else ids)
        if whole:
            for i, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
                out[i] = ids
        return out


@cache
def tokenizer(path: str, ranks: str) -> WordCachedTokenizer:
    """One tokenizer per worker process and pair of files."""
    return WordCachedTokenizer(path, ranks)


class Piece:
    """A run of one document's ids that is not placed yet."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start: int, ids: memoryview, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // 4

    def split(self, length: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[: 4 * length], self.doc_tokens),
                Piece(self.doc_id, self.start + length, self.ids[4 * length :], self.doc_tokens))


class TierPacker:
    """Packs the documents of one task; ``rows`` collects the placed pieces."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.context = tuple(sorted(tiers)), max(tiers)
        self.base, self.windows = task << TASK_BITS, 0
        self.seen = {}  # number of the last window by length, for the step groups
        self.pools: dict[int, deque[Piece]] = {t: deque() for t in self.tiers}
        self.rows: list[tuple] = []

    def route(self, length: int) -> int:
        """The shortest tier that holds a piece of this length."""
        return next((t for t in self.tiers if length <= t), self.context)

    def _place(self, pieces: list[Piece], length: int) -> None:
        sequence, offset = self.base + self.windows, 0
        self.windows += 1
        nth = self.seen[length] = self.seen.get(length, -1) + 1
        for p in pieces:
            self.rows.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, sequence, offset,
                              length, nth))
            offset += len(p)

    def add(self, doc_id, ids: bytes) -> None:
        """Full windows of a document are placed at once; the rest is routed
        to its tier and waits there."""
        n = len(ids) // 4
        piece = Piece(doc_id, 0, memoryview(ids), n)
        while len(piece) >= self.context:
            window, piece = piece.split(self.context)
            self._place([window], self.context)
        if len(piece):
            self.pools[self.route(len(piece))].append(piece)

    def _take(self, pool: deque[Piece], want: int) -> list[Piece]:
        """Pieces from a pool, ``want`` ids at most, the last one cut to fit."""
        got: list[Piece] = []
        while want and pool:
            p = pool.popleft()
            if len(p) > want:
                p, rest = p.split(want)
                pool.appendleft(rest)
            got.append(p)
            want -= len(p)
        return got

    def pack(self) -> None:
        """Place all that fills windows exactly; keep the remainders."""
        for at in range(len(self.tiers) - 1, -1, -1):
            tier, pool = self.tiers[at], self.pools[self.tiers[at]]
            if tier == self.context:  # gaps of long windows, filled from the shorter tiers
                while pool:
                    window = [pool.popleft()]
                    gap = tier - len(window[0])
                    for shorter in self.tiers[at - 1 :: -1] if at else ():
                        got = self._take(self.pools[shorter], gap)
                        window += got
                        gap -= sum(map(len, got))
                    got = self._take(pool, gap)
                    window += got
                    gap -= sum(map(len, got))
                    if gap:  # not enough left anywhere: wait for the next documents
                        pool.extend(window)
                        break
                    self._place(window, tier)
            else:
                for _ in range(sum(map(len, pool)) // tier):
                    self._place(self._take(pool, tier), tier)
                if at:
                    below = self.pools[self.tiers[at - 1]]
                    while pool:
                        below.append(pool.popleft())

    def finish(self) -> None:
        """Pack, then lay the last remainder into windows of powers of two."""
        self.pack()
        rest: deque[Piece] = deque()
        for tier in reversed(self.tiers):
            rest.extend(self.pools[tier])
            self.pools[tier].clear()
        left = sum(map(len, rest))
        while left:
            size = min(self.context, 1 << (left.bit_length() - 1))
            self._place(self._take(rest, size), size)
            left -= size

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = zip(*rows, strict=True) if rows else [[]] * len(_TYPES)
        return pa.record_batch([pa.array(list(c), t) for c, (_, t) in zip(columns, _TYPES, strict=True)],
                               names=[n for n, _ in _TYPES])


def in_step_groups(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """Written pieces with ``step_group`` for ``nth``: windows of a length, in
    the order of tasks, fill groups of ``step_tokens`` tokens one after the
    other. Groups are numbered from 0, the shortest windows first."""
    task = F.shiftright("sequence_id", TASK_BITS)
    counted = pieces.where("offset = 0").groupBy("tier", task.alias("task")).agg(F.count(F.lit(1)).alias("windows"))
    per = F.greatest(F.lit(1), F.floor(F.lit(step_tokens) / F.col("tier")))
    before = F.sum("windows").over(Window.partitionBy("tier").orderBy("task")) - F.col("windows")
    counted = written(counted, "pack-windows")
    lengths = counted.groupBy("tier").agg(F.ceil(F.sum("windows") / per).alias("groups"))
    # A row per window length (powers of two).
    lengths = lengths.select("tier", (F.sum("groups").over(Window.orderBy("tier")) - F.col("groups")).alias("first"))
    starts = counted.select("tier", "task", before.alias("before")).join(lengths, "tier")
    starts = small_or_shuffled(starts, "pack-starts")
    met = pieces.withColumn("task", task).join(starts, ["tier", "task"])
    group = F.col("first") + F.floor((F.col("before") + F.col("nth")) / per)
    return met.select(*[n for n, _ in _TYPES[:-1]], group.cast("bigint").alias("step_group"))


def pack_documents(
    documents: DataFrame,
    path: str | None = None,
    ranks: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pack every document (``doc_id``, ``text``) into sequences.

    A document is the tokenizer's ids of its whole text, then id 0; a null or
    empty text is the id 0 alone. Returns one row per piece: doc_id, start,
    length, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers),
    doc_tokens, sequence_id, offset, tier (the window's length) and
    step_group. Repeated rows are packed each on its own, null ids stay null,
    a document of any length is cut into windows, extra columns are not read,
    an empty table gives no rows.
    """
    if any(t & (t - 1) for t in tiers) or not tiers:
        raise ValueError("tiers must be powers of two")
    files = path or tokenizer_path(), ranks or tokenizer_path(RANKS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encoder = TierPacker(TaskContext.get().partitionId(), tiers), tokenizer(*files)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in in_slices(batches, BATCH_ROWS):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                packer.add(doc_id, ids + end)
            packer.pack()
            yield packer.batch()
        packer.finish()
        yield packer.batch()

    pieces = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(pack, PIECES)
    return in_step_groups(written(pieces, "pack-pieces"), step_tokens)
