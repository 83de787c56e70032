"""What a target lacks, holds in an old state or holds too much of, found without joining all of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import col, cols, free_name, resolve_names

#: More unequal ranges than this are joined as they are: a scan's filter should stay small.
MOST_RANGES = 64

Range = tuple[int, int]


def differences(
    source: DataFrame,
    target: DataFrame,
    keys: str | Sequence[str],
    *,
    fan_out: int = 1024,
    leaf_rows: int = 1_000_000,
) -> DataFrame:
    """Rows that differ between ``source`` and ``target``, with a last column ``change``.

    ``missing`` rows are the source's that the target lacks, however old; ``changed`` ones are in both with other
    values, shown as the source has them; ``deleted`` ones are the target's that the source lacks. Keys must be unique on each side; NULL keys
    equal each other. The target's columns count; the source is cast to their types.

    Both sides are summed up by ranges of the first key: rows, and two sums over hashes of whole rows. Only
    ranges whose sums differ are cut again and read again, until they hold ``leaf_rows`` rows or cannot be cut; those are joined.
    Ranges of whole numbers, dates and timestamps are filters that a scan can skip row groups by; other keys are
    cut by their hash, which spares the join but not the reading. Two different ranges are taken as equal with a
    chance of about 2**-64.
    """
    keys = resolve_names(target, [keys] if isinstance(keys, str) else list(keys))
    picked = resolve_names(source, target.columns)
    source = source.select(*[col(s).cast(f.dataType).alias(f.name) for s, f in zip(picked, target.schema, strict=True)])
    number = _number(keys[0], target.schema[keys[0]].dataType)
    ends = source.select(number.alias("n")).union(target.select(number.alias("n"))).agg(F.min("n"), F.max("n")).first()
    ranges: list[Range] = [] if ends[0] is None else [(ends[0], ends[1])]
    null_keys = number.isNull()
    while True:
        parts = max(2, fan_out // max(1, len(ranges)))
        found, rows = _unequal(source, target, number, ranges, parts)
        ends_here = len(found) > MOST_RANGES or rows <= leaf_rows or found == ranges
        ranges = found
        if ends_here or not ranges:
            break
    within = _any_of([_between(keys[0], target.schema[keys[0]].dataType, number, r) for r in ranges])
    return _compare(source.where(null_keys | within), target.where(null_keys | within), keys)


def _number(key: str, dtype: T.DataType) -> Column:
    """The key as a whole number, in its own order where it has one."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col(key).cast("long")
    if isinstance(dtype, T.DateType):
        return F.unix_date(col(key)).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col(key))
    return F.when(col(key).isNotNull(), F.xxhash64(col(key)))


def _between(key: str, dtype: T.DataType, number: Column, ends: Range) -> Column:
    """A filter on the key itself where a scan can use it."""
    lo, hi = (F.lit(e) for e in ends)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col(key).between(lo, hi)
    if isinstance(dtype, T.DateType):
        return col(key).between(F.date_from_unix_date(lo.cast("int")), F.date_from_unix_date(hi.cast("int")))
    if isinstance(dtype, T.TimestampType):
        return col(key).between(F.timestamp_micros(lo), F.timestamp_micros(hi))
    return number.between(lo, hi)


def _any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _unequal(source, target, number, ranges: list[Range], parts: int) -> tuple[list[Range], int]:
    """The parts of the ranges whose digests differ, neighbours joined, and the rows in them."""
    steps = [max(1, -(-(hi - lo + 1) // parts)) for lo, hi in ranges]
    place = F.lit(None).cast("struct<k: int, part: bigint>")
    for k, ((lo, hi), step) in enumerate(zip(ranges, steps, strict=True)):
        # by decimals: a range may be wider than a long
        part = F.floor((number.cast("decimal(20,0)") - lo) / F.lit(step).cast("decimal(20,0)")).cast("long")
        place = F.when(number.between(lo, hi), F.struct(F.lit(k).alias("k"), part.alias("part"))).otherwise(place)
    within = _any_of([number.between(lo, hi) for lo, hi in ranges])

    def digests(df: DataFrame, name: str) -> DataFrame:
        whole = F.xxhash64(F.lit(1), *cols(df.columns))
        return df.where(within).groupBy(place.alias("place")).agg(
            F.count(F.lit(1)).alias(f"n_{name}"), F.sum(whole.cast("decimal(38,0)")).alias(f"sum_{name}"), F.bit_xor(F.xxhash64(F.lit(2), *cols(df.columns))).alias(f"xor_{name}")
        )

    both = digests(source, "a").join(digests(target, "b"), "place", "full")
    same = reduce(and_, [F.col(f"{v}_a").eqNullSafe(F.col(f"{v}_b")) for v in ("n", "sum", "xor")])
    rows = F.coalesce("n_a", F.lit(0)) + F.coalesce("n_b", F.lit(0))
    differing = both.where(~same).select("place.k", "place.part", rows.alias("n")).collect()  # fan_out at most
    found: list[Range] = []
    for k, part in sorted((r["k"], r["part"]) for r in differing):
        lo = ranges[k][0] + part * steps[k]
        hi = min(ranges[k][1], lo + steps[k] - 1)
        if found and found[-1][1] + 1 == lo:
            found[-1] = (found[-1][0], hi)
        else:
            found.append((lo, hi))
    return found, sum(r["n"] for r in differing)


def _compare(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    mark = free_name(target.columns, "held")
    a, b = source.withColumn(mark, F.lit(True)).alias("a"), target.withColumn(mark, F.lit(True)).alias("b")
    on = reduce(and_, [col(k, of="a").eqNullSafe(col(k, of="b")) for k in keys])
    only_a, only_b = col(mark, of="b").isNull(), col(mark, of="a").isNull()
    values = [c for c in target.columns if c not in keys]
    differ = reduce(or_, [~col(c, of="a").eqNullSafe(col(c, of="b")) for c in values], F.lit(False))
    change = F.when(only_b, "deleted").when(only_a, "missing").when(differ, "changed")
    shown = [F.when(only_b, col(c, of="b")).otherwise(col(c, of="a")).alias(c) for c in target.columns]
    return a.join(b, on, "full").select(*shown, change.alias(free_name(target.columns, "change"))).where(F.col(free_name(target.columns, "change")).isNotNull())
