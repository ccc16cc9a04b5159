"""A Bloom filter as a small relation.

One row per 64-bit word that has a bit set: a key's hash names its word, a
second hash four of the word's bits. With ``KEYS_PER_WORD`` keys a word, about
one row in a hundred passes without its key being there; no row whose key is
there is lost. The filter is built by one aggregation and applied by a join on
the word, so it takes part in the plan like any small side: its bytes are
measured and it is broadcast only under the cap.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.operators.sizing import broadcast_if_small, materialize_measured

KEYS_PER_WORD = 4
_WORD, _BITS = "__bloom_word", "__bloom_bits"
log = logging.getLogger(__name__)


def _word(keys: list[str], words: int):
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(words).cast("long"))


def _mask(keys: list[str]):
    """Four bits of a word, by six bits each of the keys' second hash."""
    columns = ", ".join(f"`{k}`" for k in keys)
    second = f"xxhash64({columns}, 1)"
    return F.expr(" | ".join(f"shiftleft(1L, cast(shiftright({second}, {6 * k}) & 63 as int))" for k in range(4)))


def bloom_filter(df: DataFrame, keys: list[str], rows: int) -> tuple[DataFrame, int]:
    """The filter of the keys of ``df`` and its number of words, sized for
    ``rows`` keys."""
    words = max(1, -(-rows // KEYS_PER_WORD))
    masks = df.select(_word(keys, words).alias(_WORD), _mask(keys).alias("m"))
    return masks.groupBy(_WORD).agg(F.bit_or("m").alias(_BITS)), words


def possible(df: DataFrame, keys: list[str], filter_rows: DataFrame, words: int) -> DataFrame:
    """Rows of ``df`` whose keys may be in the filter (all of those that are)."""
    met = df.join(filter_rows, _word(keys, words) == F.col(_WORD))
    return met.where(F.col(_BITS).bitwiseAND(_mask(keys)) == _mask(keys)).select(*df.columns)


def prefiltered(
    df: DataFrame, keys: list[str], other: DataFrame, other_keys: list[str], other_rows: int, cap_bytes: int | None = None
) -> DataFrame:
    """``df`` without most rows that an inner join with ``other`` (a stored
    relation) would drop, before any shuffle: by a Bloom filter of the other
    side's keys if that fits under the broadcast cap, else ``df`` as it is."""
    built, words = bloom_filter(other, other_keys, other_rows)
    stored, _, size = materialize_measured(built, "bloom")
    small, fits = broadcast_if_small(stored, cap_bytes, size)
    log.info("bloom filter of %d keys: %d bytes -> %s", other_rows, size, "applied" if fits else "left out")
    return possible(df, keys, small, words) if fits else df
