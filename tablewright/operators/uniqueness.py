"""Repeated keys among nearly unique ones, without shuffling every key."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.names import cols, free_name, resolve_names
from tablewright.sources.scratch import scratch_path

#: Slots for each row: one in so many unique keys shares its slot with another and is looked at more closely.
SLOTS_PER_ROW = 32
SLOTS_PER_RANGE = 4_000_000
BATCH_SLOTS = 2_000_000


def repeated_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``n_rows``; a key with a NULL never does. For keys that are nearly all unique.

    Counting by key would shuffle every key, as there is nothing to combine. Here every key is hashed to a slot. A task
    sends the slots it has hit, once each with a bit for "more than once", as packed differences, some two bytes for a key.
    Where they meet, slots hit twice are found; only rows in these are counted by key. The result is exact;
    with many repeated keys ``unique_violations`` takes less. Reads ``df`` three times.
    """
    keys = resolve_names(df, [keys] if isinstance(keys, str) else list(keys))
    n_rows, slot = free_name(keys, "n_rows"), free_name(keys, "slot")
    rows = df.select(cols(keys)).where(reduce(and_, [c.isNotNull() for c in cols(keys)]))
    n = rows.count()
    bits = max(16, math.ceil(math.log2(max(1, n) * SLOTS_PER_ROW)))
    ranges = max(1, -(-n // SLOTS_PER_RANGE))
    hashed = F.shiftrightunsigned(F.xxhash64(*cols(keys)), 64 - bits)
    sent = rows.select(hashed.alias("slot")).mapInArrow(_pack_slots(bits, ranges), "part int, slots binary, twice binary")
    path = scratch_path(df.sparkSession, "hit-twice")
    sent.groupBy("part").applyInPandas(_hit_twice, "slot long").write.parquet(path)
    # written first: Spark then knows that it is small, and need not shuffle the keys to join it
    hot = df.sparkSession.read.schema("slot long").parquet(path)
    # a slot is hit twice by few keys; the join's other side is the keys alone
    suspects = rows.withColumn(slot, hashed).join(hot.withColumnRenamed("slot", slot), slot, "left_semi")
    counts = suspects.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias(n_rows))
    return counts.where(F.col(n_rows) > 1)


def _pack_slots(bits: int, ranges: int):
    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        slots, counts = np.unique(np.concatenate(held), return_counts=True)
        width = -(-(1 << bits) // ranges)
        cuts = np.searchsorted(slots, np.arange(ranges + 1) * width)
        out = []
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[part], cuts[part + 1])
            steps = np.diff(slots[own], prepend=0)
            planes = np.ascontiguousarray(steps.astype("<i8").view(np.uint8).reshape(-1, 8).T)
            out.append((part, zlib.compress(planes.tobytes(), 1), np.packbits(counts[own] > 1).tobytes()))
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["part", "slots", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy())
                size += batch.num_rows
            if size >= BATCH_SLOTS:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return run


def _hit_twice(rows: pd.DataFrame) -> pd.DataFrame:
    slots, twice = [], []
    for blob, marks in zip(rows["slots"], rows["twice"], strict=True):
        planes = np.frombuffer(zlib.decompress(blob), dtype=np.uint8).reshape(8, -1)
        slots.append(np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel()))
        twice.append(np.unpackbits(np.frombuffer(marks, dtype=np.uint8), count=planes.shape[1]))
    slots = np.concatenate(slots)
    order = np.argsort(slots, kind="stable")
    slots, twice = slots[order], np.concatenate(twice)[order]
    again = np.append(slots[1:] == slots[:-1], False) | (twice > 0)
    return pd.DataFrame({"slot": np.unique(slots[again])})
