"""Row order under which a filter on any of several columns skips most row groups.

Each column's values are cut into ranges of even size, by quantiles of all rows; the bits of the columns' range numbers
are interleaved into one number (Z-order), by which rows are dealt and sorted. Rows that lie near each other in every
column then lie in the same row groups, whose minima and maxima tell a reader what to skip. For columns that are asked
for by equality, Bloom filters get their size from a distinct-count sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import col, free_name, resolve_names

#: Bytes of a text that its order is taken from; seven fit in a positive 64-bit number.
TEXT_BYTES = 7


def _as_number(value: Column, dtype: T.DataType) -> Column:
    """A number in the order of the values; texts by their first bytes."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        start = F.substring(value.cast("binary"), 1, TEXT_BYTES)
        padded = F.rpad(start, TEXT_BYTES, F.lit(bytes(1)))
        return F.conv(F.hex(padded), 16, 10).cast("long")
    if isinstance(dtype, T.DateType):
        return F.unix_date(value)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(dtype, T.BooleanType):
        return value.cast("int")
    if isinstance(dtype, T.NumericType):
        return value
    raise ValueError(f"{dtype.simpleString()} has no order by which rows could be laid out")


def _range_number(value: Column, bounds: list, low: int = 0) -> Column:
    """How many of the ascending bounds lie at or under the value, by halving."""
    if not bounds:
        return F.lit(low)
    half = len(bounds) // 2
    return F.when(value < F.lit(bounds[half]), _range_number(value, bounds[:half], low)).otherwise(
        _range_number(value, bounds[half + 1 :], low + half + 1)
    )


def _range_bounds(df: DataFrame, numbers: Sequence[Column], bits: int, accuracy: int) -> list[list]:
    """The ascending cuts between the ranges of each column, by one job."""
    steps = 1 << bits
    cuts = F.array(*(F.lit(k / steps) for k in range(1, steps)))
    found = df.agg(*(F.percentile_approx(n, cuts, accuracy).alias(f"b{k}") for k, n in enumerate(numbers))).first()
    return [sorted(set(bounds or ())) for bounds in found]


def _range_code(number: Column, bounds: list) -> Column:
    return F.when(number.isNull(), F.lit(0)).otherwise(_range_number(number, bounds)).cast("long")


def _interleaved(codes: Sequence[Column], bits: int) -> Column:
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for k, code in enumerate(codes):
            one = F.shiftright(code, bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(codes) + len(codes) - 1 - k))
    return key


def _checked(df: DataFrame, names: Sequence[str], bits: int) -> list[str]:
    names = resolve_names(df, list(names))
    if not names or bits * len(names) > 62:
        raise ValueError("between one column and 62 bits in all")
    return names


def z_order_key(df: DataFrame, names: Sequence[str], *, bits: int = 6, accuracy: int = 10_000) -> Column:
    """The interleaved number of each row's ranges. Starts one job, which finds ``2 ** bits - 1`` quantiles per column.

    NULL counts as the first range. Columns with fewer values than ranges get a range per value. With an odd
    spread of values the ranges still hold about the same number of rows each, save for values that fill several.
    """
    names = _checked(df, names, bits)
    numbers = [_as_number(col(n), df.schema[n].dataType) for n in names]
    bounds = _range_bounds(df, numbers, bits, accuracy)
    return _interleaved([_range_code(n, b) for n, b in zip(numbers, bounds, strict=True)], bits)


def z_ordered(df: DataFrame, names: Sequence[str], *, files: int | None = None, bits: int = 6) -> DataFrame:
    """The same rows, dealt to ``files`` partitions by Z-order of the columns and sorted by it inside.

    A key with a large share of the rows is spread by a hash of the whole row. Without ``files`` adaptive execution
    chooses their number. The key is a column while rows are dealt and sorted: as an expression it would be worked
    out again for every comparison.
    """
    names = _checked(df, names, bits)
    numbers = [_as_number(col(n), df.schema[n].dataType) for n in names]
    bounds = _range_bounds(df, numbers, bits, 10_000)
    plain = [
        col(c) for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))
    ]  # what has a hash
    held = [free_name(df.columns, f"number_{k}") for k in range(len(names))]
    codes = [free_name(df.columns, f"code_{k}") for k in range(len(names))]
    key, row = free_name(df.columns, "z_key"), free_name(df.columns, "row_hash")
    # one small projection after another, so that nothing is worked out twice
    keyed = df.withColumns(dict(zip(held, numbers, strict=True)))
    keyed = keyed.withColumns({c: _range_code(col(h), b) for c, h, b in zip(codes, held, bounds, strict=True)})
    keyed = keyed.withColumns({key: _interleaved([col(c) for c in codes], bits), row: F.xxhash64(*plain)}).drop(*held, *codes)
    order = [col(key), col(row)]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(key, *(col(n) for n in names)).drop(key, row)


def bloom_options(df: DataFrame, names: Sequence[str], *, files: int, margin: float = 1.1) -> Mapping[str, str]:
    """Options for ``DataFrameWriter.parquet`` that give the columns Bloom filters of the right size.

    One job counts rows and distinct values, by a sketch with an error of 2 %. A file holds no more distinct values than rows.
    """
    names = resolve_names(df, list(names))
    counts = [F.approx_count_distinct(col(n), 0.02).alias(f"d{k}") for k, n in enumerate(names)]
    n, *distinct = df.agg(F.count(F.lit(1)), *counts).first()
    rows = -(-n // max(1, files))
    options = {}
    for name, d in zip(names, distinct, strict=True):
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(max(1, int(min(d * margin, rows))))
    return options
