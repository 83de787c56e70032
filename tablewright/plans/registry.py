"""Where the catalogue's queries register themselves, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The given tables as attributes, read when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(self.path(name))
        setattr(self, name, df)
        return df


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(spark, Tables(spark, folder))


CATALOGUE: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function ``(spark, tables) -> DataFrame`` under its own name."""

    def add(run):
        name = run.__name__.rstrip("_")
        if name in CATALOGUE:
            raise ValueError(f"query {name!r} is registered twice")
        CATALOGUE[name] = Query(name, run, sql)
        return run

    return add
