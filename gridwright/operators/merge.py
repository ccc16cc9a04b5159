"""Null-safe left merge and NULL fills.

The merges of the source job were done by a dataframe library whose join
matches NULL keys to NULL keys, unlike SQL. ``left_merge`` reproduces that
with ``<=>``: Spark plans it as an ordinary hash or sort-merge equi-join on
``(coalesce(key, default), isnull(key))``, not a nested loop. Rows of the
left side fan out once per matching right row; unmatched left rows keep
NULLs on the right columns.

A left outer join lets AQE split a hot key on the left side only. With
``split_skew=True`` the hot keys of the right side are found by a sketch while
that side is written (``operators.skew``), and only they are dealt into slices:
a right row of a hot key goes to one slice, a left row of that key to all of
them. Such a key is known to be on the right, so a left row that meets nothing
in one slice is no unmatched row there and is dropped. All other keys take the
plain left join; both sides are read and shuffled once.

Both sides of a big merge are sorted by their keys. Names that begin alike make
that slow, as a sort tells rows apart by the first bytes of its first column; a
hash of the keys therefore leads them. It is part of the condition, no column,
so it is not shuffled.

A key pair of the same name is kept once (left value); differently named
keys both survive. Non-key columns present on both sides raise instead of
being silently suffixed, and a numeric key against a text key raises
instead of being coerced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridwright.operators.skew import SLICES, Written, hot_keys, write_with_sketch

_NUMERIC = (T.NumericType, T.BooleanType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
# Types whose equal values have equal hashes (not so for floats, 0.0 and -0.0).
_HASHED = (T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType(),
           T.TimestampType(), T.TimestampNTZType())


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, _NUMERIC):
        return "numeric"
    if isinstance(dtype, _TEXT):
        return "text"
    if isinstance(dtype, _TEMPORAL):
        return "temporal"
    return dtype.typeName()


def check_key_types(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str]) -> None:
    """Raise ``TypeError`` when a key pair mixes kinds (e.g. int with text)."""
    lt = {f.name: f.dataType for f in left.schema.fields}
    rt = {f.name: f.dataType for f in right.schema.fields}
    for lk, rk in zip(left_on, right_on):
        if lk not in lt:
            raise KeyError(f"left key {lk!r} not in {list(lt)}")
        if rk not in rt:
            raise KeyError(f"right key {rk!r} not in {list(rt)}")
        lkind, rkind = _kind(lt[lk]), _kind(rt[rk])
        if lkind != rkind and "void" not in (lkind, rkind):
            raise TypeError(
                f"cannot merge on {lk!r} ({lt[lk].simpleString()}) with {rk!r} "
                f"({rt[rk].simpleString()}): key kinds differ ({lkind} vs {rkind})"
            )


def hashed_pairs(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str]) -> list[tuple[str, str]]:
    """The key pairs that a hash may stand for: of one type on both sides, and
    of a type whose equal values hash alike (a text under a collation does not)."""
    return [(lk, rk) for lk, rk in zip(left_on, right_on)
            if left.schema[lk].dataType == right.schema[rk].dataType and left.schema[lk].dataType in _HASHED]


def left_merge(
    left: DataFrame,
    right: DataFrame,
    left_on: list[str] | None = None,
    right_on: list[str] | None = None,
    *,
    on: list[str] | None = None,
    null_safe: bool = True,
    split_skew: bool | Written = False,
) -> DataFrame:
    """Left outer join matching NULL keys to NULL keys (``null_safe=True``).
    ``split_skew`` splits a hot key on either side; the right side is written
    for its sketch, unless the caller has done so (``Written`` of the right
    side and its keys).

    Output columns: all left columns in order, then the right columns in
    order minus right keys that share their name with the paired left key.
    """
    if on is not None:
        if left_on is not None or right_on is not None:
            raise ValueError("give either on= or left_on=/right_on=")
        left_on = right_on = list(on)
    if not left_on or not right_on or len(left_on) != len(right_on):
        raise ValueError("left_on and right_on must be non-empty and of equal length")
    left_on, right_on = list(left_on), list(right_on)
    check_key_types(left, right, left_on, right_on)

    shared_keys = {rk for lk, rk in zip(left_on, right_on) if lk == rk}
    right_kept = [c for c in right.columns if c not in shared_keys]
    clash = sorted(set(left.columns) & set(right_kept))
    if clash:
        raise ValueError(f"columns on both sides that are not paired keys: {clash}")

    right_keys = list(dict.fromkeys(right_on))
    hot = None
    if split_skew:
        sketched = split_skew if isinstance(split_skew, Written) else write_with_sketch(right, right_keys, "merge-right")
        right, hot = sketched.frame, hot_keys(sketched, right_keys, null_safe)

    # Rename the right side so every reference below is unambiguous.
    tag = {c: f"__r_{i}" for i, c in enumerate(right.columns)}
    r = right.select(*[F.col(c).alias(tag[c]) for c in right.columns])

    def eq(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b) if null_safe else a == b

    pairs = [eq(F.col(lk), F.col(tag[rk])) for lk, rk in zip(left_on, right_on)]
    if alike := hashed_pairs(left, right, left_on, right_on):
        l_hash = F.xxhash64(*[F.col(lk) for lk, _ in alike])
        pairs = [l_hash == F.xxhash64(*[F.col(tag[rk]) for _, rk in alike]), *pairs]
    cond = reduce(lambda a, b: a & b, pairs)
    columns = [*[F.col(c) for c in left.columns], *[F.col(tag[c]).alias(c) for c in right_kept]]
    if hot is None:
        return left.join(r, cond, "left").select(*columns)

    of_hot = {c: f"__h_{i}" for i, c in enumerate(right_keys)}
    hot = F.broadcast(hot.withColumnsRenamed(of_hot))  # at most skew.MAX_HOT rows
    on_left = reduce(lambda a, b: a & b, [eq(F.col(lk), F.col(of_hot[rk])) for lk, rk in zip(left_on, right_on)])
    on_right = reduce(lambda a, b: a & b, [eq(F.col(tag[c]), F.col(h)) for c, h in of_hot.items()])
    slices = F.coalesce(F.col(SLICES), F.lit(1))
    dealt = left.join(hot, on_left, "left").select(
        *left.columns, slices.alias("__l_slices"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("__l_slice"))
    # The stored right side is read in the same order by every attempt of a task.
    place = F.pmod(F.monotonically_increasing_id(), slices.cast("long")).cast("int")
    sliced = r.join(hot, on_right, "left").select(*r.columns, place.alias("__r_slice"))
    return (
        dealt.join(sliced, cond & (F.col("__l_slice") == F.col("__r_slice")), "left")
        .where((F.col("__l_slices") == 1) | F.col("__r_slice").isNotNull())
        .select(*columns)
    )


def fill_from(df: DataFrame, target: str, source: str) -> DataFrame:
    """NULLs of ``target`` replaced by the value of ``source`` in the same row."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(source)))


def fill_value(df: DataFrame, target: str, value) -> DataFrame:
    """NULLs of ``target`` replaced by a constant, keeping the column type."""
    dtype = df.schema[target].dataType
    return df.withColumn(target, F.coalesce(F.col(target), F.lit(value).cast(dtype)))
