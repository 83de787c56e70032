"""Places for tables written between two steps, and generated input for trial runs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARED_DIR = "spark.checkpoint.dir"


@cache
def _own_folder() -> str:
    """One folder of this machine for this process, gone with it."""
    folder = tempfile.mkdtemp(prefix="tablewright-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _scratch(spark: SparkSession) -> str:
    base = spark.conf.get(SHARED_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/tablewright/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder that ``spark.checkpoint.dir`` names.

    Every executor must see it. Where the setting is missing, only a local session
    may fall back to a folder of this machine. What is written there stays for the results that
    read it: call ``clear_scratch`` when they are no longer needed, at the end of the application.
    """
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application has written under its scratch paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keyed_data(
    spark: SparkSession, rows: int, value_bytes: int = 1000, partitions: int | None = None, seed: int = 0
) -> DataFrame:
    """``rows`` pairs of a pseudo-random int key and a binary value, the same on every run."""
    words = -(-value_bytes // 32)
    digests = [F.unhex(F.sha2(F.concat_ws("-", F.lit(seed), "id", F.lit(i)), 256)) for i in range(words)]
    ids = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    return ids.select(
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(2**31 - 1)).cast("int").alias("key"),
        F.substring(F.concat(*digests), 1, value_bytes).alias("value"),
    )
