"""Which files a reader that ignores corrupt files has left out."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def skipped_files(spark: SparkSession, *paths: str, schema: T.StructType | str) -> DataFrame:
    """(path, size, reason) of the Parquet files that give no row when corrupt files are ignored.

    ``reason`` is ``empty`` for a sound file without rows, else ``unreadable``. All files are listed without their content;
    those that rows come from are taken off by their names, without reading a column. Only what is left is opened, a
    file in a task's memory at a time. A file that breaks off behind its first rows is not among them, nor is one of no
    bytes, which Spark's listings leave out.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    listed = reader.format("binaryFile").load(list(paths))
    name = F.regexp_extract("path", "([^/]*)$", 1)
    files = listed.where(~name.rlike("^[_.]")).select("path", F.col("length").alias("size"))
    read = reader.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)
    seen = read.select(F.col("_metadata.file_path").alias("uri")).distinct()
    # a listing shows names as they are, _metadata as a URI
    name_of = F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B")))
    left = files.join(seen.select(_rooted(name_of).alias("held")), _rooted(F.col("path")) == F.col("held"), "left_anti")
    content = listed.select(F.col("path").alias("of"), "content")
    opened = left.join(content, F.col("path") == F.col("of")).select("path", "size", "content")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reasons = [_reason(c) for c in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(reasons, pa.string())], names=["path", "size", "reason"])

    return opened.mapInArrow(judge, "path string, size long, reason string")


def _rooted(path):
    """One slash behind the scheme of a path without a host, where some writers put three."""
    return F.regexp_replace(path, "^([a-z0-9]+):///", "$1:/")


def _reason(content: pa.Scalar) -> str:
    try:
        rows = pq.ParquetFile(io.BytesIO(content.as_py())).metadata.num_rows
    except (pa.ArrowInvalid, OSError):
        return "unreadable"
    return "unreadable" if rows else "empty"
