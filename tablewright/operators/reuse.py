"""Keep a DataFrame for several uses, and change a session setting for one use."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` inside the block; run the actions that share it there."""
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session setting inside the block and put the old value back.

    Spark reads most settings when a query runs, so run the action inside too.
    """
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)
