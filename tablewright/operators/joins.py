"""Joins that keep working when one key holds a large share of either side.

Adaptive execution splits a hot shuffle partition, but only on the side a join
type lets it split: both sides of an inner join, the left side of a left, semi or
anti join. The forms below put the possibly hot side where it can be split, or
shrink it to distinct keys before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import col, cols, free_name, resolve_names


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def semi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``.

    ``right`` is cut to its distinct keys first, so a hot key there is combined on
    the map side and reaches its reducer as one row per map task.
    """
    keys = _keys(on)
    return left.join(right.select(cols(keys)).distinct(), keys, "left_semi").select(cols(left.columns))


#: Bits of a filter for each key: one in so many absent keys passes it.
BITS_PER_KEY = 16
#: A filter is 64 MB at most, which every executor can hold.
MOST_BITS = 1 << 29


def sifted_semi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], *, bits: int | None = None) -> DataFrame:
    """``semi_join`` of two big tables of which few rows of ``left`` meet: most of these are not shuffled.

    The keys of ``right`` set bits in a filter, one each at the key's hash; bits are combined in the tasks and then by
    an aggregation. The filter, at most ``MOST_BITS`` whatever the tables' size, is broadcast and drops rows
    of ``left`` before the shuffle; an exact join follows. Reads ``right`` twice, and counts it to size the filter
    unless ``bits`` is given. All steps are native.
    """
    keys = _keys(on)
    mine, theirs = resolve_names(left, keys), resolve_names(right, keys)
    # hashed alike on both sides: in the type that an equality would compare them in
    types = [_common_type(left, m, right, t) for m, t in zip(mine, theirs, strict=True)]
    wanted = right.select(*[col(t).alias(k) for t, k in zip(theirs, keys, strict=True)]).distinct()
    if bits is None:
        bits = BITS_PER_KEY * max(1, right.count())
    bits = min(MOST_BITS, max(1 << 15, bits))

    def slot(names: Sequence[str]):
        return F.pmod(F.xxhash64(*[col(n).cast(t) for n, t in zip(names, types, strict=True)]), F.lit(bits)) + 1

    bucket, place, held = (free_name(left.columns, n) for n in ("bucket", "place", "held_bits"))
    filters = right.select(slot(theirs).alias("slot")).where("slot IS NOT NULL").groupBy(F.bitmap_bucket_number("slot").alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias(held)
    )
    placed = left.withColumns({bucket: F.bitmap_bucket_number(slot(mine)), place: F.bitmap_bit_position(slot(mine))})
    # of bounded size: MOST_BITS in all
    met = placed.join(F.broadcast(filters), bucket)
    byte = F.conv(F.hex(F.substring(col(held), (col(place) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    passed = F.call_function("shiftright", byte, (col(place) % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    sifted = met.where(passed).select(cols(left.columns))
    # distinct keys make it a semi join; a real one would be moved below the sifting
    exact = reduce(and_, [col(m, of="sifted") == col(k, of="wanted") for m, k in zip(mine, keys, strict=True)])
    return sifted.alias("sifted").join(wanted.alias("wanted"), exact).select([col(c, of="sifted") for c in left.columns])


def _common_type(left: DataFrame, mine: str, right: DataFrame, theirs: str):
    """The type that Spark compares the two columns in."""
    empty = left.sparkSession.createDataFrame([], T.StructType([T.StructField("a", left.schema[mine].dataType), T.StructField("b", right.schema[theirs].dataType)]))
    return empty.select(F.coalesce("a", "b")).schema[0].dataType


def anti_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; NULL keys are kept."""
    keys = _keys(on)
    return left.join(right.select(cols(keys)).distinct(), keys, "left_anti").select(cols(left.columns))


def outer_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str) -> DataFrame:
    """Outer join for keys that may be hot on either side; columns as ``left.join(right, on, how)``.

    A plain left join cannot split a hot right side, and a full join can split
    neither. The matched rows come from an inner join, which can split both; the
    rest come from anti joins against distinct keys. Those read the inner join's shuffles
    again where Spark sees that they are the same, so each side is shuffled once; rows with a
    NULL key would make them differ, and come by a scan of their own that skips all others.
    Otherwise, and where a side is broadcast, the inputs are computed again: write them
    out first if they are costly or may differ between two runs. When the preserved side is the
    big one and the other side has unique keys, a plain left join is cheaper.
    """
    if how not in ("left", "right", "full"):
        raise ValueError(f"how must be left, right or full, not {how!r}")
    left_keys, right_keys = resolve_names(left, _keys(on)), resolve_names(right, _keys(on))
    left_null, right_null = _null_key(left, left_keys), _null_key(right, right_keys)
    keyed_left = left if left_null is None else left.where(~left_null)
    keyed_right = right if right_null is None else right.where(~right_null)
    on_keys = reduce(and_, [col(a, of="l") == col(b, of="r") for a, b in zip(left_keys, right_keys)])

    def shaped(rows: DataFrame, keys_of: str, sides: str) -> DataFrame:
        # By number: any names may be used, also the same ones on both sides. Named above the joins, as names
        # below them would keep Spark from seeing that shuffles are the same.
        picked = [col(k, of=keys_of) for k in (left_keys if keys_of == "l" else right_keys)]
        for side, df, keys in (("l", left, left_keys), ("r", right, right_keys)):
            others = [f for f in df.schema.fields if f.name not in keys]
            picked += [col(f.name, of=side) if side in sides else F.lit(None).cast(f.dataType) for f in others]
        return rows.select(*[c.alias(f"column_{i}") for i, c in enumerate(picked)])

    inner = keyed_left.alias("l").join(keyed_right.alias("r"), on_keys, "inner")
    result = shaped(inner, "r" if how == "right" else "l", "lr")
    if how in ("left", "full"):
        held = keyed_right.select(cols(right_keys)).distinct().alias("r")
        result = result.unionByName(shaped(keyed_left.alias("l").join(held, on_keys, "left_anti"), "l", "l"))
        if left_null is not None:
            result = result.unionByName(shaped(left.where(left_null).alias("l"), "l", "l"))
    if how in ("right", "full"):
        held = keyed_left.select(cols(left_keys)).distinct().alias("l")
        result = result.unionByName(shaped(keyed_right.alias("r").join(held, on_keys, "left_anti"), "r", "r"))
        if right_null is not None:
            result = result.unionByName(shaped(right.where(right_null).alias("r"), "r", "r"))
    named = [*(right_keys if how == "right" else left_keys)]
    named += [c for c in left.columns if c not in left_keys] + [c for c in right.columns if c not in right_keys]
    return result.toDF(*named)


def _null_key(df: DataFrame, keys: list[str]):
    """True for rows with a NULL in the key; None if there can be none."""
    nullable = [col(k).isNull() for k in keys if df.schema[k].nullable]
    return reduce(or_, nullable) if nullable else None
