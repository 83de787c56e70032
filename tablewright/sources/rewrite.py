"""Deleting from and upserting into plain files, rewriting only those that hold a matching row."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha1
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.names import col, cols, free_name, resolve_names
from tablewright.operators.joins import semi_join
from tablewright.operators.mutate import delete_where, upsert
from tablewright.sources.swap import NEW, STAGE, commit, file_uri, finish_swap, folder_uri, place_below, staged_files


def delete_from_files(spark: SparkSession, path: str, condition: str | Column, source_format: str = "parquet") -> int:
    """Delete rows from the table of files at ``path``; returns how many files were rewritten.

    First the files with a matching row are found: the scan skips row groups by the condition. Only these are read
    whole; what is left of them takes their place, in the same folder, and all others keep their names and times. Works
    on partitioned tables too. Changes are swapped in as in ``swap.py``; one writer at a time.
    """
    finish_swap(spark, path)
    table = spark.read.format(source_format).load(path)
    matching = F.expr(condition) if isinstance(condition, str) else condition
    # One name for each file to be rewritten: the driver has to move each anyway.
    found = [r[0] for r in table.where(matching).select(file_uri().alias("uri")).distinct().collect()]
    if not found:
        return 0
    places = [place_below(spark, path, uri) for uri in found]
    folder = free_name(table.columns, "folder")
    held = _read(spark, path, source_format, table, places).withColumn(folder, folder_uri())
    kept = delete_where(held, matching)
    layout = _partition_columns(spark, path, source_format, table)
    slot = free_name(table.columns, "slot")
    rows = kept.withColumn(slot, F.sha1(F.col(folder).cast("binary"))).drop(folder, *layout)
    rows.hint("rebalance", slot).write.format(source_format).partitionBy(slot).save(f"{path}/{NEW}")
    folders = [r[0] for r in held.select(folder).distinct().collect()]
    _swap(spark, path, places, {f"{slot}={sha1(f.encode()).hexdigest()}": place_below(spark, path, f) for f in folders})
    return len(places)


def upsert_files(
    path: str, batch: DataFrame, keys: str | Sequence[str], source_format: str = "parquet", **options: Any
) -> int:
    """``upsert`` a batch into the unpartitioned table of files at ``path``; returns how many files were rewritten.

    Files that hold a key of the batch are found by their keys alone and rewritten with the batch's rows; new
    keys come with them, or in files of their own if no key is held. All other files keep their names and times. ``options`` are those of
    ``upsert``. Partitioned tables are for ``upsert_partitions``.
    """
    spark = batch.sparkSession
    finish_swap(spark, path)
    table = spark.read.format(source_format).load(path)
    if _partition_columns(spark, path, source_format, table):
        raise ValueError(f"{path} is partitioned; use upsert_partitions")
    keys = resolve_names(table, [keys] if isinstance(keys, str) else list(keys))
    own = resolve_names(batch, keys)
    wanted = batch.select(*[col(o).cast(table.schema[k].dataType).alias(k) for o, k in zip(own, keys, strict=True)])
    uri = free_name(table.columns, "uri")
    with_uri = table.select(*cols(keys), file_uri().alias(uri))
    found = [r[0] for r in semi_join(with_uri, wanted, keys).select(uri).distinct().collect()]
    places = [place_below(spark, path, f) for f in found]
    held = _read(spark, path, source_format, table, places) if places else table.limit(0)
    upsert(held, batch, keys, **options).hint("rebalance").write.format(source_format).save(f"{path}/{NEW}")
    _swap(spark, path, places, {"": ""})
    return len(places)


def _read(spark, path, source_format, table, places) -> DataFrame:
    reader = spark.read.format(source_format).schema(table.schema).option("basePath", path)
    return reader.load([f"{path}/{p}" for p in places])


def _partition_columns(spark, path, source_format, table) -> list[str]:
    """Columns that come from folder names: those that a file read by itself does not have."""
    first = next(iter(table.inputFiles()), None)
    if first is None:
        return []
    own = spark.read.format(source_format).option("recursiveFileLookup", "true").load(path).columns
    return [c for c in table.columns if c not in own]


def _swap(spark: SparkSession, path: str, old: list[str], folders: dict[str, str]) -> None:
    """Old files aside, and the files of each staged folder to the folder they are for."""
    moves = [(place, f"{STAGE}/old/{k}") for k, place in enumerate(old)]
    for staged, folder in folders.items():
        below = f"{NEW}/{staged}".rstrip("/")
        moves += [(f"{below}/{name}", f"{folder}/{name}".lstrip("/")) for name in staged_files(spark, path, below)]
    commit(spark, path, moves)

