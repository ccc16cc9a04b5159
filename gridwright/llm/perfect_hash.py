"""Minimal perfect hashing of a set of integer keys.

Keys are thrown into a bit array about twice their number; those that fall
alone into a bit stay there, the others go on to a smaller array with another
hash, until none is left. A key's index is the number of set bits before its
own, so n keys get the indexes 0 to n - 1 from about four bits each. A key
outside the set gets an arbitrary index or none, which is why the keys are
kept in index order and compared on every look-up.
"""

from __future__ import annotations

import numpy as np

SPACE = 2  # bits of a level for each key thrown into it


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64-bit hashes of uint64 keys, another function for each level."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Index of each of ``keys`` (distinct, 64-bit) in 0 .. len(keys) - 1."""

    def __init__(self, keys: np.ndarray):
        left = np.asarray(keys).astype(np.uint64)
        if len(np.unique(left)) != len(left):
            raise ValueError("keys are repeated")
        self.sizes: list[int] = []
        levels = []
        while len(left):
            size = 64 * -(-SPACE * len(left) // 64)
            at = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, bool)
            bits[at[alone]] = True
            levels.append(bits)
            self.sizes.append(size)
            left = left[~alone]
        packed = np.packbits(np.concatenate(levels), bitorder="little") if levels else np.zeros(0, np.uint8)
        self.words = packed.view("<u8")
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)
        self.keys = np.zeros(len(keys), np.uint64)
        self.keys[self.index(keys)] = np.asarray(keys).astype(np.uint64)

    def __len__(self) -> int:
        return len(self.keys)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 or any index for a key outside the set."""
        keys = np.asarray(keys).astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        rest, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (_mixed(keys[rest], level) % np.uint64(size)).astype(np.int64) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            found = self.words[word]
            hit = (found >> bit) & np.uint64(1) == 1
            lower = found & ((np.uint64(1) << bit) - np.uint64(1))
            out[rest[hit]] = (self.before[word] + np.bitwise_count(lower))[hit]
            rest, start = rest[~hit], start + size
        return out

    def verified(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 for a key outside the set."""
        at = self.index(keys)
        if not len(self.keys):
            return at
        return np.where((at >= 0) & (self.keys[at] == np.asarray(keys).astype(np.uint64)), at, -1)
