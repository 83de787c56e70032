"""Positions in a sorted table without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.names import col, cols, free_name
from tablewright.sources.scratch import scratch_path

#: Fixed value: ``monotonically_increasing_id`` holds the partition above this bit, the row below.
ROW_BITS = 33


def numbered(df: DataFrame, *order: str | Column, name: str = "pos", partitions: int | None = None) -> DataFrame:
    """The rows with their position from 1 on in the given order, as a long in a first column ``name``.

    Rows are dealt out by ranges of the order and sorted within them; a row's position is its place in its range plus the
    rows of all ranges before. Only one number for each range goes to a single task. Rows that the order does not tell apart come in order of a hash of all their columns, so a frequent value in
    the order is spread over ranges unless whole rows are equal. ``partitions`` is the session's number of shuffle
    partitions if not given.
    """
    known = [c for c, t in zip(df.columns, df.schema, strict=True) if "map<" not in t.dataType.simpleString()]
    keys = [*(col(o) if isinstance(o, str) else o for o in order), F.xxhash64(*cols(known))]
    ranges = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_positions(df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys), name=name)


def with_positions(ordered: DataFrame, *, name: str = "pos") -> DataFrame:
    """Sorted rows with their position from 1 on, by the order of their partitions and the rows in them.

    The rows are written to the shared folder first: sorted again, from another sample, their ranges need not be the same.
    """
    spark = ordered.sparkSession
    name = free_name(ordered.columns, name)
    mark = free_name([*ordered.columns, name], "mark")
    path = scratch_path(spark, "positions")
    ordered.withColumn(mark, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    part = F.shiftrightunsigned(col(mark), ROW_BITS)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each range, whatever the table's size: small enough to broadcast
    starts = F.broadcast(sizes.select("part", before.alias("before")))
    place = F.col("before") + col(mark).bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return rows.join(starts, part == starts["part"]).select(place.cast("long").alias(name), *cols(ordered.columns))
