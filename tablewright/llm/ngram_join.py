"""N-gram Jaccard join: groups of texts whose sets of word n-grams are similar, by links and links of links.

Equal sets are one class. Every class asks, by ranges of token hashes, which of its tokens others have
too. A set that others share too little of can't be similar to any and goes at once. The rest put their
tokens in order of rarity; similar sets share one of the first tokens. Sets that do so are candidates and
meet in blocks of bounded size. There the index list of a token stands in order of set size, and the blocks of it
that hold sets of other sizes are skipped; a set's overlaps with all earlier ones are derived from
those of the set before it by the tokens in which the two differ, where they differ little.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.connected import connected_components
from tablewright.llm.decontaminate import LOWER
from tablewright.llm.hashes import by_range, groups_of, joined, ranges_for, run_hashes, word_hashes
from tablewright.llm.rows import any_ids, documents, free_name, map_batches, shown
from tablewright.sources.scratch import scratch_path


#: A task packs its tokens whenever it holds more, which bounds its memory and changes no result.
TOKENS_AT_ONCE = 1_000_000


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of ``size`` words, A-Z in lower case; a shorter text is one run."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(run_hashes(word_hashes(words), min(size, len(words))))


def _asked(rows: DataFrame, size: int, ranges: int) -> DataFrame:
    """Packed rows of two kinds, for whole batches of documents: each document's class and number of tokens,
    and by range of hash the tokens of each class.

    A task asks once for a class, as long as it remembers it, so that copies cost little.
    """

    def start():
        seen: set[bytes] = set()

        def tokens_of(asked: list[tuple[bytes, np.ndarray]]) -> list[tuple]:
            tokens = np.concatenate([t for _, t in asked])
            owner = np.repeat(np.arange(len(asked)), [len(t) for _, t in asked])
            out = []
            for part, at in by_range(tokens, ranges):
                spans = groups_of(owner[at])
                who = owner[at][[lo for lo, _ in spans]].tolist()
                counts = np.array([hi - lo for lo, hi in spans], dtype="<u4")
                sizes = np.array([len(asked[k][1]) for k in who], dtype="<u4")
                names = b"".join([asked[k][0] for k in who])
                out.append((part, None, names, sizes.tobytes(), counts.tobytes(), tokens[at].tobytes()))
            return out

        def step(ids, texts):
            if not ids:
                return None
            sizes, names, asked, held, out = [], [], [], 0, []
            for text in texts:
                tokens = shingles(text, size)
                name = xxhash.xxh3_128_digest(tokens.tobytes())
                sizes.append(len(tokens))
                names.append(name)
                if len(tokens) and name not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen.add(name)
                    asked.append((name, tokens))
                    held += len(tokens)
                    if held > TOKENS_AT_ONCE:
                        out += tokens_of(asked)
                        asked, held = [], 0
            out += tokens_of(asked) if asked else []
            packed = np.array(ids, dtype="<i8").tobytes(), b"".join(names), np.array(sizes, dtype="<u4").tobytes()
            out.append((ids[0] % ranges, *packed, None, None))
            return [list(c) for c in zip(*out, strict=True)]

        return step

    return map_batches(
        rows, start, "part int, ids binary, classes binary, sizes binary, counts binary, tokens binary"
    )


ANSWER = (
    "doc_id long, class string, n int, bucket int, classes binary, sizes binary, counts binary, tokens binary, held binary"
)


def _shared(asked: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """The documents' rows, and packed by class the tokens of one range that other classes have too.

    ``held`` says how many classes have each.
    """
    rows, sets = asked[asked["tokens"].isna()], asked[asked["tokens"].notna()]
    names = joined(rows["classes"], "V16")
    made = [
        (doc, name.tobytes().hex(), n, None, None, None, None, None, None)
        for doc, name, n in zip(joined(rows["ids"], "<i8").tolist(), names, joined(rows["sizes"], "<u4").tolist(), strict=True)
    ]
    classes, sizes = joined(sets["classes"], "<u8").reshape(-1, 2), joined(sets["sizes"], "<u4")
    counts, tokens = joined(sets["counts"], "<u4"), joined(sets["tokens"], "<u8")
    _, first = np.unique(classes, axis=0, return_index=True)  # several tasks may have asked for a class
    once = np.zeros(len(classes), dtype=bool)
    once[first] = True
    tokens, classes, sizes, counts = tokens[np.repeat(once, counts)], classes[once], sizes[once], counts[once]
    _, which, n = np.unique(tokens, return_inverse=True, return_counts=True)
    held = n[which]
    often = held > 1
    owner = np.repeat(np.arange(len(classes)), counts)[often]
    tokens, held = tokens[often], held[often].astype("<u4")
    bucket = (classes[:, 0] % np.uint64(buckets)).astype(np.int64)[owner]
    order = np.argsort(bucket, kind="stable")
    owner, tokens, held, bucket = owner[order], tokens[order], held[order], bucket[order]
    for lo, hi in groups_of(bucket):
        spans = groups_of(owner[lo:hi])
        who = owner[lo:hi][[a for a, _ in spans]]
        lengths = np.array([b - a for a, b in spans], dtype="<u4")
        packed = classes[who], sizes[who], lengths, tokens[lo:hi], held[lo:hi]
        made.append((None, None, None, int(bucket[lo]), *(x.tobytes() for x in packed)))
    columns = zip(*made, strict=True) if made else [[] for _ in ANSWER.split(", ")]
    # built one by one, as a frame of rows would turn ids with gaps into floats
    return pd.DataFrame(
        {
            c.split()[0]: pd.array(list(v), dtype="Int64") if c.split()[1] in ("long", "int") else pd.Series(v, dtype=object)
            for c, v in zip(ANSWER.split(", "), columns, strict=True)
        }
    )


def _in_order(found: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(class, n, tokens, prefix) of the sets that may be similar to another.

    The tokens are those that other sets have too, the rarest first; ``prefix`` says how many are in the set's
    prefix. A set with fewer of them than the threshold asks of any overlap is similar to no other.
    """
    classes, sizes = joined(found["classes"], "<u8").reshape(-1, 2), joined(found["sizes"], "<u4")
    counts, tokens, held = joined(found["counts"], "<u4"), joined(found["tokens"], "<u8"), joined(found["held"], "<u4")
    own, which = np.unique(classes, axis=0, return_inverse=True)
    which = which.reshape(-1)
    n_of = np.zeros(len(own), dtype=np.int64)
    n_of[which] = sizes
    shared = np.bincount(which, weights=counts, minlength=len(own)).astype(np.int64)
    least = -(-percent * n_of // 100)
    owner = np.repeat(which, counts)
    stay = (shared >= least)[owner]
    owner, tokens, held = owner[stay], tokens[stay], held[stay]
    order = np.lexsort((tokens, held, owner))
    owner, tokens = owner[order], tokens[order]
    made = []
    for lo, hi in groups_of(owner):
        k = owner[lo]
        # tokens of no other set come first in the order, but need no index
        prefix = int(n_of[k] - least[k] + 1 - (n_of[k] - shared[k]))
        made.append((own[k].tobytes().hex(), int(n_of[k]), tokens[lo:hi].tobytes(), prefix))
    return pd.DataFrame(made, columns=["class", "n", "tokens", "prefix"])


def _prefixes(sets: DataFrame) -> DataFrame:
    """(token, class) for the tokens of each prefix."""

    def start():
        def step(names, tokens, prefixes):
            own = [np.frombuffer(t, dtype=np.int64)[:p].tolist() for t, p in zip(tokens, prefixes, strict=True)]
            return [t for o in own for t in o], [n for n, o in zip(names, own, strict=True) for _ in o]

        return step

    return map_batches(sets.select("class", "tokens", "prefix"), start, "token long, class string")


class Links:
    """Finds similar sets among those of one block, and keeps such links as join groups not joined yet."""

    def __init__(self, names: list[str], sizes: np.ndarray, tokens: list[np.ndarray], percent: int):
        self.order = np.argsort(sizes, kind="stable")
        self.names = [names[i] for i in self.order]
        self.sizes = sizes[self.order].astype(np.int64)
        self.percent = percent
        own = [tokens[i] for i in self.order]
        flat = np.concatenate(own) if own else np.zeros(0, dtype=np.uint64)
        _, ids = np.unique(flat, return_inverse=True)
        self.own = np.split(ids, np.cumsum([len(o) for o in own])[:-1]) if own else []
        owner = np.repeat(np.arange(len(own)), [len(o) for o in own])
        by_token = np.argsort(ids, kind="stable")  # owners stay in order of size within each list
        self.lists = np.split(owner[by_token], np.flatnonzero(np.diff(ids[by_token])) + 1) if len(flat) else []
        self.parent = list(range(len(own)))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def count(self, tokens, lo: int, hi: int) -> np.ndarray:
        """How many of the tokens each of the sets lo..hi has; lists are entered where those sets begin."""
        parts = []
        for t in tokens:
            held = self.lists[t]
            a, b = (np.searchsorted(held, (lo, hi)) if len(held) > 1 else (0, int(lo <= held[0] < hi)))
            if a < b:
                parts.append(held[a:b])
        if not parts:
            return np.zeros(hi - lo, dtype=np.int64)
        return np.bincount(np.concatenate(parts) - lo, minlength=hi - lo)

    def edges(self, sides: list | None = None) -> list[tuple[str, str]]:
        """Names of linked sets, a forest; with ``sides``, only links from one side to the other are looked for."""
        made = []
        sides = None if sides is None else np.array([sides[i] for i in self.order])
        last, last_lo, overlaps = -1, 0, np.zeros(0, dtype=np.int64)
        for r, tokens in enumerate(self.own):
            # sizes of similar sets differ by the threshold at most
            lo = int(np.searchsorted(self.sizes * 100, self.percent * self.sizes[r]))
            if last >= 0 and lo < last:
                new = np.setdiff1d(tokens, self.own[last], assume_unique=True)
                gone = np.setdiff1d(self.own[last], tokens, assume_unique=True)
            if last >= 0 and lo < last and len(new) + len(gone) < len(tokens):
                kept = overlaps[lo - last_lo :] + self.count(new, lo, last) - self.count(gone, lo, last)
                overlaps = np.concatenate([kept, self.count(tokens, last, r)])
            else:
                overlaps = self.count(tokens, lo, r)
            last, last_lo = r, lo
            both = self.sizes[lo:r] + self.sizes[r] - overlaps
            similar = overlaps * 100 >= self.percent * both
            if sides is not None:
                similar &= sides[lo:r] != sides[r]
            for s in (np.flatnonzero(similar) + lo).tolist():
                a, b = self.find(s), self.find(r)
                if a != b:
                    self.parent[b] = a
                    made.append((self.names[s], self.names[r]))
        return made


def _links_of(block: pd.DataFrame, percent: int) -> pd.DataFrame:
    made = []
    for _, part in block.groupby("unit", sort=False):
        tokens = [np.frombuffer(t, dtype=np.uint64) for t in part["tokens"]]
        sides = part["side"].tolist()
        links = Links(part["class"].tolist(), part["n"].to_numpy(), tokens, percent)
        made += links.edges(sides if len(set(sides)) > 1 else None)
    return pd.DataFrame(made, columns=["a", "b"])


def _blocks(candidates: DataFrame, percent: int, most: int) -> DataFrame:
    """(block, unit, side, class, n, tokens): sets that meet.

    A candidate component of up to ``most`` sets is a unit. A larger one is cut by size, in steps of the
    threshold, and by hash, so that a cell holds about ``most`` sets; units are then the pairs of cells whose sizes can
    be similar. Units are gathered in blocks.
    """
    # a little over the threshold's step, so that rounding never parts similar sizes by two levels
    step = F.floor(F.log("n") / float(-1.001 * np.log(percent / 100)) if percent < 100 else F.col("n").cast("double"))
    cells = candidates.withColumn("level", step.cast("int"))
    totals = candidates.groupBy("component").agg(F.count("*").alias("in_component"))
    sized = cells.join(totals, "component")
    spread = F.pmod(F.xxhash64("component"), F.lit(1 << 30)).cast("string")
    small = sized.filter(F.col("in_component") <= most).select(
        F.pmod(F.xxhash64("component"), F.lit(max(1, candidates.count() // most))).cast("string").alias("block"),
        F.col("component").alias("unit"), F.lit(0).alias("side"), "class", "n", "tokens",
    )
    large = sized.filter(F.col("in_component") > most)
    counts = large.groupBy("component", "level").agg(F.ceil(F.count("*") / most).cast("int").alias("cells"))
    beside = lambda by, name: counts.select("component", (F.col("level") - by).alias("level"), F.col("cells").alias(name))
    placed = large.withColumn("cell", F.xxhash64("class"))
    for by, name in ((0, "cells0"), (-1, "cells1"), (1, "cells2")):  # the cells of its level, the one below, the one above
        placed = placed.join(beside(by, name), ["component", "level"], "left")
    placed = placed.withColumn("cell", F.pmod("cell", F.col("cells0").cast("long")).cast("int"))
    pair = lambda low, a, high, b, side: F.struct(
        F.concat_ws("/", "component", low, a, high, b).alias("unit"), side.alias("side")
    )
    level, cell, each = F.col("level"), F.col("cell"), lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    none = F.array().cast("array<struct<unit: string, side: int>>")
    same = F.transform(
        each("cells0"), lambda c: pair(level, F.least(cell, c), level, F.greatest(cell, c), F.when(cell <= c, 0).otherwise(1))
    )
    up = F.when(F.col("cells2").isNull(), none).otherwise(
        F.transform(each("cells2"), lambda c: pair(level, cell, level + 1, c, F.lit(0)))
    )
    down = F.when(F.col("cells1").isNull(), none).otherwise(
        F.transform(each("cells1"), lambda c: pair(level - 1, c, level, cell, F.lit(1)))
    )
    met = placed.withColumn("met", F.explode(F.concat(same, up, down)))
    return small.unionByName(
        met.select(F.concat(spread, F.lit("/"), "met.unit").alias("block"), "met.unit", "met.side", "class", "n", "tokens")
    )


@any_ids("doc_id", "component_id")
def jaccard_groups(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class, n_shingles, component_id) of every row.

    Two texts link when their sets of ``words``-word shingles have 100 * intersection >= percent * union;
    ``component_id`` is the smallest id reached by links, itself included. A text of fewer words is one
    shingle; a NULL text or one without words has none and links with nothing. A NULL id is the smallest.
    Rows of one id are judged each by its own text. ``class`` names the set; equal sets have equal names.
    """
    return shown(_groups(docs, **options), "doc_id", "component_id")


def _groups(
    docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = 1000
) -> DataFrame:
    """``jaccard_groups`` with ``NO_ID`` for NULL."""
    if not 0 < percent <= 100:
        raise ValueError("percent must lie between 1 and 100")
    spark = docs.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = documents(docs, id_col, text_col)
    ranges = ranges_for(rows, 16 << 20)
    answers = written(
        _asked(rows, words, ranges).groupBy("part").applyInPandas(lambda part: _shared(part, ranges), ANSWER),
        "shingle-answers",
    )
    members = answers.filter("doc_id IS NOT NULL").select("doc_id", "class", "n")
    sets = written(
        answers.filter("bucket IS NOT NULL")
        .select("bucket", "classes", "sizes", "counts", "tokens", "held")
        .groupBy("bucket")
        .applyInPandas(lambda part: _in_order(part, percent), "class string, n int, tokens binary, prefix int"),
        "shingle-sets",
    )
    lists = written(_prefixes(sets), "shingle-lists")
    hubs = lists.groupBy("token").agg(F.min("class").alias("hub"), F.count("*").alias("held")).filter("held > 1")
    meets = lists.join(hubs, "token").filter("class <> hub").select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct()
    candidates = written(
        sets.join(connected_components(meets, "candidates").withColumnRenamed("node", "class"), "class").select(
            "class", "n", "tokens", "component"
        ),
        "shingle-candidates",
    )
    links = (
        _blocks(candidates, percent, block)
        .groupBy("block")
        .applyInPandas(lambda part: _links_of(part, percent), "a string, b string")
    )
    groups = connected_components(links, "similar").withColumnsRenamed({"node": "class", "component": "name"})
    classes = members.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    named = classes.join(groups, "class", "left").withColumn("name", F.coalesce("name", "class"))
    least = named.groupBy("name").agg(F.min("first").alias("component_id"))
    of_class = named.join(least, "name").select("class", "component_id")
    return members.join(of_class, "class", "left").select(
        "doc_id", "class", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


@any_ids()
def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The table, with all its columns, without documents that belong to a group with a smaller id.

    Rows of one id are one document: it goes if one of its rows belongs to such a group.
    """
    groups = _groups(docs, id_col=id_col, text_col=text_col, **options)
    name = free_name(docs, "repeated_id")
    losers = groups.filter("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(losers, docs[id_col].cast("long") == losers[name], "left_anti")
