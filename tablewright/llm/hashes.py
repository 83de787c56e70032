"""Hashes of words and of runs of words as numpy arrays, and their division into ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(31))) * _ODD + b
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words; none if there are fewer words."""
    if len(hashes) < size:
        return hashes[:0]
    n = len(hashes) - size + 1
    h = hashes[:n]
    for k in range(1, size):
        h = mixed(h, hashes[k : k + n])
    return h


def by_range(hashes: np.ndarray, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each range that has hashes, with their indices in order."""
    of = hashes % np.uint64(ranges)
    order = np.argsort(of, kind="stable")
    at = np.flatnonzero(np.diff(of[order], prepend=np.uint64(ranges)))
    for lo, hi in zip(at, [*at[1:], len(order)], strict=True):
        yield int(of[order[lo]]), order[lo:hi]


def ranges_for(rows: DataFrame, chars_per_range: int) -> int:
    """So many ranges that each covers about as many characters of text, whatever the table's size."""
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    return int(max(1, -(-chars // chars_per_range)))


def groups_of(keys: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal values."""
    if not len(keys):
        return []
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True))


def joined(blobs, dtype: str) -> np.ndarray:
    """The arrays packed in a column, one after the other."""
    return np.frombuffer(b"".join(blobs), dtype=dtype)
