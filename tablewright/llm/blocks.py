"""Sums by key over all blocks of a corpus, each block getting back the sums of its own keys.

A block is one row that holds many documents, in a table bucketed by block: it is written once, and every further
step reads it without moving it. What moves are the block's distinct keys, sorted and packed, to the range of
keys they fall in, and the sums back. A key therefore reaches a range once for each block that has it, however
often it occurs, and no range depends on how the keys' frequencies are spread.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.reuse import session_setting
from tablewright.sources.scratch import scratch_path

REQUESTS = "block long, part int, keys binary, amounts binary"
ANSWERS = "block long, part int, answers binary, ranks binary, notes array<struct<k: long, v: long>>"
#: Spark's setting that deletes the shuffle files of a query when it ends: nothing reads them once its table is written.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Fixed value: Spark refuses tables with more buckets.
MOST_BUCKETS = 100_000


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype: str = "<i8") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(dtype).ravel()


def pack_signed(values: np.ndarray) -> bytes:
    """Numbers of both signs, the sign in the lowest bit: the upper planes of small ones are then all zeros."""
    values = values.astype("<i8", copy=False)
    return pack((values << 1) ^ (values >> 63))


def unpack_signed(blob: bytes) -> np.ndarray:
    values = unpack(blob, "<u8")
    return (values >> np.uint64(1)).astype("<i8") ^ -(values & np.uint64(1)).astype("<i8")


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences, which are shorter."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, "<u8"), dtype=np.uint64)


class Bucketed:
    """A table in the shared folder, bucketed by ``block``; rows can be added to it."""

    def __init__(self, spark: SparkSession, buckets: int, label: str):
        self.spark, self.buckets, self.path = spark, buckets, scratch_path(spark, label)
        self.name = "tablewright_" + self.path.rstrip("/").split("/")[-1].replace("-", "_")

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").bucketBy(self.buckets, "block").option("path", self.path).saveAsTable(self.name)

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def closed(self) -> DataFrame:
        """The rows, without the table's name in the catalog: the files are read by their path."""
        rows = self.rows
        self.spark.sql(f"DROP TABLE {self.name}")
        return rows


class Steps(Bucketed):
    """The sums of all steps so far, by block: they are moved to their block once, and by no later step again."""

    made = 0

    def add(self, *turns: DataFrame) -> None:
        """The sums of the next step. A step of several turns has only one turn's shuffle on disk at a time."""
        for rows in turns:
            with session_setting(self.spark, CLEAN_UP, "true"):
                super().add(rows.withColumn("step", F.lit(self.made)).repartition(self.buckets, "block"))
        self.made += 1


def buckets_for(rows: DataFrame) -> int:
    return min(MOST_BUCKETS, max(1, rows.rdd.getNumPartitions()))


def write_blocks(rows: DataFrame, label: str) -> DataFrame:
    """The rows, one per ``block``, written to the shared folder and read back by bucket."""
    table = Bucketed(rows.sparkSession, buckets_for(rows), label)
    table.add(rows)
    return table.closed()


def requests_of(
    block: int, parts: int, keys: np.ndarray, amounts: np.ndarray, turn: int = 0, turns: int = 1
) -> Iterator[tuple]:
    """One row for each range that has some of the block's ascending distinct keys; every ``turns``-th range in a turn."""
    of = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cuts = np.searchsorted(of, np.arange(parts + 1, dtype=np.uint64))
    for part in np.flatnonzero(np.diff(cuts)).tolist():
        if part % turns != turn:
            continue
        at = slice(cuts[part], cuts[part + 1])
        yield block, part, pack_sorted(keys[at]), pack_signed(amounts[at])


def requests_by_rank(block: int, parts: np.ndarray, ranks: np.ndarray, amounts: np.ndarray) -> Iterator[tuple]:
    """As ``requests_of``, for keys that an earlier step has ranked: the range that ranked them knows them by rank."""
    cuts = np.flatnonzero(np.diff(parts, prepend=-1, append=-1)) if len(parts) else np.zeros(1, dtype=np.int64)
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield block, int(parts[lo]), pack_sorted(ranks[lo:hi].astype(np.uint64)), pack_signed(amounts[lo:hi])


def per_block(blocks: DataFrame, answers: list[DataFrame] | DataFrame, step: Callable, schema: str) -> DataFrame:
    """``step(row, answers)`` gives each block's rows; ``answers`` holds, for each step, the block's sums by key order.

    The steps' sums come as a table for each, or as one with the steps' numbers. Where a step has ranks,
    ``answers["ranks", k]`` is a pair: the ranked keys' ranges and their ranks in these.
    """
    if isinstance(answers, DataFrame):
        answers = [answers]
    else:
        answers = [a.withColumn("step", F.lit(k)) for k, a in enumerate(answers)]
    tables = [a.filter("answers IS NOT NULL").select("block", "step", "part", "answers", "ranks") for a in answers]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(found: dict, rows: pd.DataFrame) -> pd.DataFrame:
        made = [r for row in rows.itertuples(index=False) for r in step(row, found)]
        columns = zip(*made, strict=True) if made else [[] for _ in names]
        return pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(names, columns, strict=True)})

    if not tables:
        return blocks.groupBy("block").applyInPandas(lambda rows: run({}, rows), schema)

    def both(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        got = got.sort_values(["step", "part"])
        found = {}
        for k, g in got.groupby("step"):
            found[k] = np.concatenate([unpack(b) for b in g["answers"]])
            if g["ranks"].notna().all():
                ranks = [unpack_sorted(r) for r in g["ranks"]]
                found["ranks", k] = np.repeat(g["part"].to_numpy(), [len(r) for r in ranks]), np.concatenate(ranks)
        return run(found, rows)

    asked = reduce(DataFrame.unionByName, tables)
    return blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(both, schema)


def sums_of(
    requests: DataFrame, *, answer: Callable | None = None, notes: Callable | None = None, rank_from: int | None = None
) -> DataFrame:
    """Each request's keys with the sums of the amounts in all requests.

    ``answer(sums)`` is what goes back, the sums themselves if not given; ``notes(keys, sums)`` gives pairs of
    numbers about a range's distinct keys, kept in rows without answers. With ``rank_from``, keys of at least that
    sum get their rank among the range's keys, by which later requests can name them in fewer bytes.
    """

    def one_range(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(k) for k in rows["keys"]]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        keys = np.concatenate(keys)
        amounts = np.concatenate([unpack_signed(a) for a in rows["amounts"]])
        order = np.argsort(keys, kind="stable")
        keys, amounts = keys[order], amounts[order]
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sums = np.add.reduceat(amounts, firsts)
        shown = answer(sums).astype("<i8") if answer else sums
        back = np.empty(len(keys), dtype="<i8")
        back[order] = np.repeat(shown, np.diff(firsts, append=len(keys)))
        part = int(rows["part"].iloc[0])
        ranks = [None] * len(rows)
        if rank_from is not None:
            rank, enough = np.empty(len(keys), dtype=np.uint64), np.empty(len(keys), dtype=bool)
            times = np.diff(firsts, append=len(keys))
            rank[order], enough[order] = np.repeat(np.arange(len(firsts), dtype=np.uint64), times), np.repeat(sums >= rank_from, times)
            ranks = [pack_sorted(r[e]) for r, e in zip(np.split(rank, cuts), np.split(enough, cuts), strict=True)]
        made = [(block, part, pack(a), r, []) for block, a, r in zip(rows["block"], np.split(back, cuts), ranks, strict=True)]
        if notes:
            made.append((rows["block"].iloc[0], part, None, None, [{"k": int(k), "v": int(v)} for k, v in notes(keys[firsts], sums)]))
        columns = zip(*made, strict=True)
        return pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(("block", "part", "answers", "ranks", "notes"), columns, strict=True)})

    return requests.groupBy("part").applyInPandas(one_range, ANSWERS)


def totals(requests: DataFrame, label: str, **options) -> DataFrame:
    """``sums_of`` the requests, written to the shared folder."""
    path = scratch_path(requests.sparkSession, label)
    sums_of(requests, **options).write.parquet(path)
    return requests.sparkSession.read.schema(ANSWERS).parquet(path)
