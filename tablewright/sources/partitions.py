"""Upsert into a partitioned table of files, rewriting only the partitions a batch touches."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha1
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import col, cols, free_name, resolve_names
from tablewright.operators.mutate import upsert
from tablewright.sources.swap import NEW, STAGE, commit, finish_swap, folder_uri, place_below

__all__ = ["finish_swap", "upsert_partitions"]


def upsert_partitions(
    path: str,
    batch: DataFrame,
    keys: str | Sequence[str],
    partition_by: str | Sequence[str],
    source_format: str = "parquet",
    **options: Any,
) -> None:
    """``upsert`` a batch into the files at ``path``; ``options`` are those of ``upsert``.

    The partition columns must be among the keys: then a key never moves to another
    partition, and all others keep their files. A partition is known by its value as the table is read,
    and its folder by where its files lie, so ``month=01``, ``month=1`` and a batch's ``'01'`` are one partition
    if the table reads months as numbers. A partition's new files take the place of its folder; of several
    folders with one value the first. An empty text is the partition of NULL, as no folder can tell them apart;
    a batch value that the column's type cannot hold is an error. New partitions get the batch's own text as name.

    The new files are written whole to a folder inside ``path`` that readers skip, then swapped in (see
    ``swap.py``). A run that is cut short in between is finished by the next call, or by ``finish_swap``,
    before anything is read. One writer at a time.
    """
    spark = batch.sparkSession
    finish_swap(spark, path)
    keys = [keys] if isinstance(keys, str) else list(keys)
    partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    target = spark.read.format(source_format).load(path)
    keys, partition_by = resolve_names(target, keys), resolve_names(target, partition_by)
    if not set(partition_by) <= set(keys):
        raise ValueError(f"the partition columns {partition_by} must be among the keys {keys}")
    own = resolve_names(batch, partition_by)
    texts = [F.nullif(col(o).cast("string"), F.lit("")) for o in own]
    named = batch.select("*", F.array(*texts).alias(names := free_name(batch.columns, "names")))
    batch = named.withColumns({o: _value(named, o, target.schema[p].dataType) for o, p in zip(own, partition_by, strict=True)})
    # One row per touched partition: the driver has to move each of these folders anyway.
    touched = batch.groupBy(_tag(cols(own)).alias("tag")).agg(F.min(col(names)).alias("names")).collect()
    batch = batch.drop(names)
    tag = _tag(cols(partition_by))
    current = target.where(tag.isin([t["tag"] for t in touched]))
    held: dict[str, list[str]] = {}
    for row in current.select(tag.alias("tag"), folder_uri().alias("uri")).distinct().collect():
        held.setdefault(row["tag"], []).append(place_below(spark, path, row["uri"]))
    slot = free_name(target.columns, "slot")
    content = upsert(current, batch, keys, **options).withColumn(slot, F.sha1(tag.cast("binary")))
    # Even file sizes, and not a file per task and partition.
    content.drop(*partition_by).hint("rebalance", slot).write.format(source_format).partitionBy(slot).save(f"{path}/{NEW}")
    moves = []
    for t in touched:
        folders, number = sorted(held.get(t["tag"], [])), sha1(t["tag"].encode()).hexdigest()
        moves += [(folder, f"{STAGE}/old/{number}-{k}") for k, folder in enumerate(folders)]
        moves.append((f"{NEW}/{slot}={number}", folders[0] if folders else _folder(spark, partition_by, t["names"])))
    commit(spark, path, moves)


def _value(batch: DataFrame, name: str, wanted: T.DataType) -> Column:
    """The batch's partition value in the table's type; an empty text is NULL, an impossible one an error."""
    given = col(name)
    if not isinstance(batch.schema[name].dataType, T.StringType):
        return given.cast(wanted)
    text = F.nullif(given, F.lit(""))
    value = text.try_cast(wanted)
    wrong = F.concat(F.lit(f"partition column {name} cannot hold "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(wrong)).otherwise(value)


def _tag(columns: list[Column]) -> Column:
    """A text that is each partition's own, also for NULL values; the scan skips partitions by it."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _folder(spark: SparkSession, partition_by: list[str], names: list[str | None]) -> str:
    """The folder of a new partition, escaped as Spark does."""
    spell = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    values = [spell.DEFAULT_PARTITION_NAME() if n is None else spell.escapePathName(n) for n in names]
    return "/".join(f"{spell.escapePathName(p)}={v}" for p, v in zip(partition_by, values, strict=True))
