"""Fill-in-the-middle: cut texts at line boundaries and reorder the parts.

A document is cut after two of its lines, drawn by the SHA-256 of its id, into
a prefix, a middle and a suffix, which are written behind marks either as
prefix, suffix, middle (``psm``) or as suffix, prefix, middle (``spm``). The
middle, now last, is what a model learns to fill in.

The text lies in blocks of ``BLOCK`` bytes. A Fenwick tree over the blocks
holds how many lines end and how many code points begin in each. To cut after
the k-th line, a binary-lifting descent of the tree finds the block where that
line ends and the code points before the block; the boundary itself is then
looked for in that block alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.llm.common import in_slices

BLOCK = 1024
BATCH_ROWS = 128
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
# The marks before the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LINE_FEED = 10
OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class BlockTree:
    """Fenwick tree over the blocks of a UTF-8 text: ``tree[k]`` holds the
    line ends and code points of the blocks k - (k & -k) to k - 1."""

    def __init__(self, text: np.ndarray, block: int = BLOCK):
        self.text, self.block = text, block
        starts = np.arange(0, max(1, len(text)), block)
        ends = text == LINE_FEED
        if len(text) and text[-1] != LINE_FEED:
            ends = ends.copy()
            ends[-1] = True  # a last line without a line feed ends with the text
        points = (text & 0xC0) != 0x80  # bytes that begin a code point
        self.tree = np.zeros((len(starts) + 1, 2), np.int64)
        if len(text):
            self.tree[1:, 0] = np.add.reduceat(ends, starts, dtype=np.int64)
            self.tree[1:, 1] = np.add.reduceat(points, starts, dtype=np.int64)
        # Each node is added to the next one that covers it, level by level.
        width = 1
        while width < len(self.tree):
            children = np.arange(width, len(self.tree) - width, 2 * width)
            self.tree[children + width] += self.tree[children]
            width *= 2
        self.ends, self.points = ends, points

    def total(self) -> int:
        """Lines of the text."""
        k, lines = len(self.tree) - 1, 0
        while k:
            lines += int(self.tree[k, 0])
            k -= k & -k
        return lines

    def cut(self, lines: int) -> tuple[int, int]:
        """Byte and code-point offset after the first ``lines`` lines."""
        if not lines:
            return 0, 0
        block, points, left = 0, 0, lines
        step = 1 << ((len(self.tree) - 1).bit_length() - 1)
        while step:
            node = block + step
            if node < len(self.tree) and self.tree[node, 0] < left:
                block = node
                left -= int(self.tree[node, 0])
                points += int(self.tree[node, 1])
            step //= 2
        start = block * self.block
        inside = start + int(np.flatnonzero(self.ends[start : start + self.block])[left - 1]) + 1
        return inside, points + int(np.count_nonzero(self.points[start:inside]))


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document, from the SHA-256 of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4))


def rearranged(doc_id: int | None, text: bytes, seed: int, fim_percent: int, spm_percent: int, block: int) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text."""
    array = np.frombuffer(text, np.uint8)
    tree = BlockTree(array, block)
    n = tree.total()
    first, second, fim, spm = draws(doc_id, seed)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or any(m in text for m in marks) or fim % 100 >= fim_percent:
        return n, "plain", None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    (p, p_chars), (m, m_chars) = tree.cut(low), tree.cut(high)
    prefix, suffix, middle = marks[0] + text[:p], marks[1] + text[m:], marks[2] + text[p:m]
    if spm % 100 < spm_percent:
        return n, "spm", p_chars, m_chars - p_chars, suffix + prefix + middle
    return n, "psm", p_chars, m_chars - p_chars, prefix + suffix + middle


def fill_in_middle(
    documents: DataFrame,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """Rearrange every whole text for filling in its middle.

    Returns one row per row: doc_id, n (lines, each with its line feed), form
    (``plain``, ``psm`` or ``spm``), prefix_chars and middle_chars (code
    points; null if plain) and output. A null text is an empty one, and an
    empty text stays plain, as does one that contains a mark, and the share of
    documents beyond ``fim_percent``. The draws depend on the id alone: rows
    that repeat an id are cut after the same lines if their texts are equal;
    a null id draws as the empty text. Texts of any length are cut whole; a
    task holds ``BATCH_ROWS`` of them. Other columns are ignored whatever
    their names. An empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, BATCH_ROWS):
            made = [
                rearranged(doc_id, text or b"", seed, fim_percent, spm_percent, block)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            n, form, prefix, middle, output = zip(*made, strict=True) if made else ([], [], [], [], [])
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")
    ).mapInArrow(rows, OUTPUT)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. A text with a mark in it stays
    plain, and no mark can arise where two parts meet, so the marks in the
    output of the other forms are the written ones."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(part[1], part[3], part[2])
    spm = F.concat(part[2], part[3], part[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
