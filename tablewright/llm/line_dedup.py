"""Line dedup that can be taken back: exact reference counts per line, with sharded cuckoo filters before them.

Three tables make up the state, all Parquet under the shared folder:

* holders: (key, doc_id) of every insertion and deletion, append only;
* counts: (key, n_docs, top_doc), how many documents hold a line and the largest of them;
* filters: one cuckoo filter per shard with the keys that enough documents hold. A filter gives no false
  negatives and forgets a key when it is deleted, so what it lacks needs no look at the counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.rows import NO_ID, any_ids, documents, free_name, map_batches, shown
from tablewright.sources.scratch import scratch_path

BLANKS = b" \t\n\x0b\x0c\r"
KEYS_PER_SHARD = 250_000
HOLDERS = "key binary, doc_id long"
COUNTS = "key binary, n_docs long, top_doc long"
FILTERS = "shard int, filter binary"
SETTINGS = "min_docs long, min_chars long, shards long"


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may lie in either of two buckets."""

    SLOTS = 4

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized_for(cls, n: int) -> CuckooFilter:
        buckets = 1 << max(2, math.ceil(math.log2(max(1, n) / (cls.SLOTS * 0.8))))
        return cls(np.zeros((buckets, cls.SLOTS), dtype="<u2"))

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        made = cls.sized_for(len(keys))
        while not made.insert(keys):
            made = cls(np.zeros((len(made.table) * 2, cls.SLOTS), dtype="<u2"))
        return made

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, dtype="<u2").reshape(-1, cls.SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first bucket of each key of 16 bytes."""
        halves = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
        prints = (halves[:, 1] & np.uint64(0xFFFF)).astype("<u2")
        prints[prints == 0] = 1
        return prints, (halves[:, 0] & np.uint64(len(self.table) - 1)).astype(np.int64)

    def other(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        spread = prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
        return buckets ^ (spread & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _fill(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Put what fits into free slots; True where it did."""
        order = np.argsort(buckets, kind="stable")
        b = buckets[order]
        nth = np.arange(len(b)) - np.searchsorted(b, b, side="left")
        free = self.table[b] == 0
        fits = nth < free.sum(axis=1)
        slot = np.argsort(~free, axis=1, kind="stable")[np.arange(len(b)), np.minimum(nth, self.SLOTS - 1)]
        self.table[b[fits], slot[fits]] = prints[order][fits]
        done = np.zeros(len(b), dtype=bool)
        done[order[fits]] = True
        return done

    def insert(self, keys: list[bytes], rounds: int = 500) -> bool:
        """False if they don't all fit; the filter is then to be made anew, larger, from the exact table."""
        if not keys:
            return True
        prints, buckets = self.places(keys)
        for k in range(rounds):
            done = self._fill(prints, buckets)
            prints, buckets = prints[~done], buckets[~done]
            if not len(prints):
                return True
            if k:  # put one entry out of each full bucket and take its slot
                _, first = np.unique(buckets, return_index=True)
                slot = (k + first) % self.SLOTS
                out = self.table[buckets[first], slot].copy()
                self.table[buckets[first], slot] = prints[first]
                prints[first] = out
            buckets = self.other(prints, buckets)
        return False

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, dtype=bool)
        prints, buckets = self.places(keys)
        here = (self.table[buckets] == prints[:, None]).any(axis=1)
        return here | (self.table[self.other(prints, buckets)] == prints[:, None]).any(axis=1)

    def delete(self, keys: list[bytes]) -> None:
        """Only for keys that were inserted."""
        if not keys:
            return
        prints, buckets = self.places(keys)
        for p, a, b in zip(prints, buckets, self.other(prints, buckets), strict=True):
            bucket = a if (self.table[a] == p).any() else b
            slot = np.flatnonzero(self.table[bucket] == p)
            if not len(slot):
                raise KeyError("not in the filter")
            self.table[bucket, slot[0]] = 0


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit digest of the stripped line, A-Z already in lower case; None for a short line."""
    line = line.strip(BLANKS)
    if len(line) < min_chars or not line.isascii() and len(line.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line)


class LineIndex:
    """Which lines many documents hold, kept up to date under insertion and deletion of documents.

    A line's key is the line without blanks at both ends and with A-Z in lower case; lines of fewer
    than ``min_chars`` code points have none. A line held by ``min_docs`` documents or more stays
    only in the one with the largest id. Rows of one id are one document; NULL is an id too, the
    smallest. A document that is in the index must be deleted before it is inserted again.
    """

    def __init__(self, spark, *, min_docs: int = 3, min_chars: int = 20):
        self.spark, self.min_docs, self.min_chars = spark, min_docs, min_chars
        self.holders: list[tuple[DataFrame, int]] = []
        self.counts = spark.createDataFrame([], COUNTS)
        self.filters = spark.createDataFrame([], FILTERS)
        self.shards = 0

    def save(self, path: str) -> None:
        """Write the state to a new folder, from which a later session can ``open`` it.

        Holders are written as they now are, without what was deleted. The settings come last: a folder without them is
        a save that was cut short, and can't be opened.
        """
        self.compact()
        for name, df in (("holders", self.holders[0][0]), ("counts", self.counts), ("filters", self.filters)):
            df.write.parquet(f"{path}/{name}")
        settings = [(self.min_docs, self.min_chars, self.shards)]
        self.spark.createDataFrame(settings, SETTINGS).coalesce(1).write.parquet(f"{path}/settings")

    @classmethod
    def open(cls, spark, path: str) -> LineIndex:
        """The index that was saved there. What is inserted and deleted from now on leaves the folder as it is."""

        def read(name: str, schema: str) -> DataFrame:
            return spark.read.schema(schema).parquet(f"{path}/{name}")

        settings = read("settings", SETTINGS).first()
        made = cls(spark, min_docs=settings.min_docs, min_chars=settings.min_chars)
        made.holders, made.shards = [(read("holders", HOLDERS), 1)], settings.shards
        made.counts, made.filters = read("counts", COUNTS), read("filters", FILTERS)
        return made

    def compact(self) -> None:
        """One table of holders in place of one for every batch so far."""
        held = self.current_holders() if self.holders else self.spark.createDataFrame([], HOLDERS)
        self.holders = [(self._written(held, "line-holders"), 1)]

    def _written(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keys_of(self, docs: DataFrame, **columns) -> DataFrame:
        """(key, doc_id) of every document's lines, written once for the steps that read it."""
        min_chars = self.min_chars

        def start():
            def step(ids, texts):
                keys, owners = [], []
                for doc, text in zip(ids, texts, strict=True):
                    found = {line_key(l, min_chars) for l in text.encode().lower().split(b"\n")} if text else set()
                    found.discard(None)
                    keys += found
                    owners += [doc] * len(found)
                return keys, owners

            return step

        return self._written(map_batches(documents(docs, **columns), start, HOLDERS), "line-keys")

    def insert(self, keys: DataFrame) -> None:
        """Add documents by their ``keys_of``. Counting combines on the map side, so hot lines do no harm."""
        new = keys.groupBy("key").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("top_doc"))
        self.holders.append((keys, 1))
        self._replace(
            new
            if not self.shards
            else self.counts.unionByName(new)
            .groupBy("key")
            .agg(F.sum("n_docs").alias("n_docs"), F.max("top_doc").alias("top_doc"))
        )

    def delete(self, keys: DataFrame) -> None:
        """Take documents back by their ``keys_of``; counts and filters are as if they had never come."""
        self.holders.append((keys, -1))
        gone = keys.groupBy("key").agg(F.countDistinct("doc_id").alias("n_gone"))
        left = (
            self.counts.join(gone, "key", "left")
            .withColumn("n_docs", F.col("n_docs") - F.coalesce("n_gone", F.lit(0)))
            .filter("n_docs > 0")
        )
        beheaded = left.join(
            keys.select("key", F.col("doc_id").alias("top_doc")).distinct(), ["key", "top_doc"], "left_semi"
        ).select("key")
        heads = (
            self.current_holders().join(beheaded, "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("head"))
        )
        self._replace(
            left.join(heads, "key", "left").select("key", "n_docs", F.coalesce("head", "top_doc").alias("top_doc"))
        )

    def current_holders(self) -> DataFrame:
        signed = None
        for keys, sign in self.holders:
            part = keys.distinct().withColumn("sign", F.lit(sign))
            signed = part if signed is None else signed.unionByName(part)
        return signed.groupBy("key", "doc_id").agg(F.sum("sign").alias("n")).filter("n > 0").drop("n")

    def shared(self, counts: DataFrame) -> DataFrame:
        return counts.filter(F.col("n_docs") >= self.min_docs)

    def _shard(self, shards: int):
        return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")

    def _replace(self, counts: DataFrame) -> None:
        """Put new counts in place, and bring the filters up to date with what crossed the threshold."""
        before, self.counts = self.counts, self._written(counts.select("key", "n_docs", "top_doc"), "line-counts")
        shards = max(1, math.ceil(self.shared(self.counts).count() / KEYS_PER_SHARD))
        if shards > self.shards:
            self.shards = max(shards, 2 * self.shards)
            self.filters = self._written(self._built(self.shared(self.counts)), "line-filters")
            return
        now, then = self.shared(self.counts).select("key"), self.shared(before).select("key")
        changes = (
            now.join(then, "key", "left_anti")
            .withColumn("sign", F.lit(1))
            .unionByName(then.join(now, "key", "left_anti").withColumn("sign", F.lit(-1)))
        ).select(self._shard(self.shards), "key", "sign")

        def update(changed: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            f = CuckooFilter.from_bytes(held["filter"].iloc[0]) if len(held) else CuckooFilter.sized_for(len(changed))
            f.delete(changed.loc[changed["sign"] < 0, "key"].tolist())
            whole = f.insert(changed.loc[changed["sign"] > 0, "key"].tolist())
            shard = (changed if len(changed) else held)["shard"].iloc[0]
            return pd.DataFrame({"shard": [shard], "filter": [f.to_bytes() if whole else None]})

        updated = self._written(
            changes.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(update, self.filters.schema),
            "line-filters",
        )
        full = updated.filter("filter IS NULL").select("shard")
        anew = self.shared(self.counts).withColumn("shard", self._shard(self.shards)).join(full, "shard", "left_semi")
        self.filters = self._written(updated.filter("filter IS NOT NULL").unionByName(self._built(anew)), "line-filters")

    def _built(self, keys: DataFrame) -> DataFrame:
        def build(rows: pd.DataFrame) -> pd.DataFrame:
            made = CuckooFilter.of(rows["key"].tolist()).to_bytes()
            return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "filter": [made]})

        return keys.select(self._shard(self.shards), "key").groupBy("shard").applyInPandas(build, self.filters.schema)

    def maybe_shared(self, keys: DataFrame) -> DataFrame:
        """The distinct keys that the filters don't rule out. Large shards are dealt to several tasks."""
        salts = max(1, math.ceil(keys.count() / (self.shards * KEYS_PER_SHARD)))
        salt = F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(salts)).cast("int").alias("salt")

        def probe(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(held):
                return asked[["key"]].head(0)
            f = CuckooFilter.from_bytes(held["filter"].iloc[0])
            return asked.loc[f.contains(asked["key"].tolist()), ["key"]]

        asked = keys.select("key").distinct().select(self._shard(self.shards), salt, "key")
        held = self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return (
            asked.groupBy("shard", "salt").cogroup(held.groupBy("shard", "salt")).applyInPandas(probe, "key binary")
        )

    def drops(self, keys: DataFrame) -> DataFrame:
        """(doc_id, keys): the lines that each of these documents loses."""
        shared = self.shared(self.counts).join(self.maybe_shared(keys), "key", "left_semi").select("key", "top_doc")
        return (
            keys.join(shared, "key")
            .filter("doc_id <> top_doc")
            .groupBy("doc_id")
            .agg(F.collect_set("key").alias("dropped_keys"))
        )

    def dedupe(self, docs: DataFrame, keys: DataFrame, **columns) -> DataFrame:
        """(doc_id, text, n_lines, n_dropped) of every row; ``keys`` are the documents' ``keys_of``.

        The text is what stays, joined by line ends; a NULL or empty text is one empty line.
        """
        min_chars = self.min_chars

        def start():
            def step(ids, texts, dropped):
                made = [kept_lines(t, d, min_chars) for t, d in zip(texts, dropped, strict=True)]
                return ids, *([m[k] for m in made] for k in range(3))

            return step

        joined = documents(docs, **columns).join(self.drops(keys), "doc_id", "left")
        return shown(map_batches(joined, start, "doc_id long, text string, n_lines long, n_dropped long"))


def kept_lines(text: str | None, dropped: list[bytes] | None, min_chars: int) -> tuple[str, int, int]:
    """What stays of a text without the lines of some keys, the number of its lines, and of those dropped."""
    lines = (text or "").split("\n")
    if not dropped:
        return text or "", len(lines), 0
    gone = set(dropped)
    stay = [line for line in lines if line_key(line.encode().lower(), min_chars) not in gone]
    return "\n".join(stay), len(lines), len(lines) - len(stay)


@any_ids("doc_id")
def dedupe_lines(docs: DataFrame, *, min_docs: int = 3, min_chars: int = 20, **columns) -> DataFrame:
    """Line dedup of one table against itself: all its documents into a new index, then ``LineIndex.dedupe``."""
    index = LineIndex(docs.sparkSession, min_docs=min_docs, min_chars=min_chars)
    keys = index.keys_of(docs, **columns)
    index.insert(keys)
    return index.dedupe(docs, keys, **columns)


@any_ids()
def clean_lines(docs: DataFrame, *, min_docs: int = 3, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text"):
    """The table with all its columns and rows, where each text is what line dedup leaves of it."""
    index = LineIndex(docs.sparkSession, min_docs=min_docs, min_chars=min_chars)
    keys = index.keys_of(docs, id_col=id_col, text_col=text_col)
    index.insert(keys)
    key, name, owner = docs[id_col].cast("long"), free_name(docs, "dropped_keys"), free_name(docs, "dropped_from")
    drops = index.drops(keys).select(F.col("doc_id").alias(owner), F.col("dropped_keys").alias(name))
    joined = docs.join(drops, F.coalesce(key, F.lit(NO_ID)) == drops[owner], "left").select(
        *(docs["`" + c.replace("`", "``") + "`"] for c in docs.columns), drops[name]
    )
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)
            texts = pa.array([kept_lines(t, d, min_chars)[0] for t, d in rows], pa.string())
            columns = [texts if k == place else c for k, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
