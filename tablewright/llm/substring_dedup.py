"""Substring dedup: words go that a passage of some length covers which also begins earlier in the corpus.

Every window of ``size`` words names one anchor in it, a run of ``ANCHOR`` words chosen by its hash
alone, so equal windows name equal anchors. Windows around an anchor that occurs only once can't be
repeated. For the others, the words around the anchor make a context; the contexts of one anchor are
a reference shard. Its suffix automaton takes up the contexts in order of place; each is streamed
through it first, and where its matching statistics reach ``size`` words, an earlier place holds the window.
Contexts of an anchor with very many of them meet window by window in native aggregation and not in an automaton.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.hashes import by_range, groups_of, joined, ranges_for, run_hashes, word_hashes
from tablewright.llm.rows import any_ids, documents, map_batches, shown
from tablewright.sources.scratch import scratch_path

ANCHOR = 8
#: An automaton holds the contexts of an anchor with so many occurrences at most.
MOST_CONTEXTS = 2_000


class SuffixAutomaton:
    """Of a growing list of word sequences."""

    def __init__(self):
        self.step: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def statistics(self, words) -> list[int]:
        """For each place, how many words up to it occur in a sequence taken up before."""
        state, matched, out = 0, 0, []
        for w in words:
            while state and w not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if w in self.step[state]:
                state, matched = self.step[state][w], matched + 1
            out.append(matched)
        return out

    def take_up(self, words) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _split(self, state: int, w) -> int:
        """The state for the shortest way to ``w``, parted from longer ones if need be."""
        after = self.step[state][w]
        if self.length[after] == self.length[state] + 1:
            return after
        copy = self._new(self.length[state] + 1, dict(self.step[after]), self.link[after])
        self.link[after] = copy
        while state >= 0 and self.step[state].get(w) == after:
            self.step[state][w] = copy
            state = self.link[state]
        return copy

    def _new(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _extend(self, last: int, w) -> int:
        if w in self.step[last]:
            return self._split(last, w)
        made = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and w not in self.step[state]:
            self.step[state][w] = made
            state = self.link[state]
        if state >= 0:
            self.link[made] = self._split(state, w)
        return made


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than ASCII blanks; None has none."""
    return text.encode().split() if text else []


def anchors_of(words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, of every run of ``ANCHOR`` words, and the place of each window's anchor.

    That is the first least hash among the runs in the window.
    """
    hashes = word_hashes(words)
    runs = run_hashes(hashes, ANCHOR)
    if len(words) < size:
        return hashes, runs, np.zeros(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(runs, size - ANCHOR + 1)
    return hashes, runs, view.argmin(axis=1) + np.arange(len(view))


def around(hashes: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the hash of it with some words before it, and with as many after it; 0 where there are none.

    Every window holds one of the two, so an anchor of which neither is repeated is in no repeated window.
    """
    more = (size - ANCHOR) // 2
    runs = run_hashes(hashes, ANCHOR + more) | np.uint64(1)
    left, right = np.zeros(len(places), dtype=np.uint64), np.zeros(len(places), dtype=np.uint64)
    has_left, has_right = places >= more, places < len(runs)
    left[has_left], right[has_right] = runs[places[has_left] - more], runs[places[has_right]]
    return left, right


def _requests(rows: DataFrame, size: int, ranges: int) -> DataFrame:
    """The documents' anchors by range of hash: a row holds those of a whole batch of documents, packed."""

    def start():
        def step(ids, texts, versions, checks):
            found = []
            for k, text in enumerate(texts):
                hashes, runs, of_window = anchors_of(words_of(text), size)
                places = np.unique(of_window)
                if len(places):
                    found.append((runs[places], *around(hashes, places, size), places, np.full(len(places), k)))
            if not found:
                return None
            base, left, right, places, owner = (np.concatenate(c) for c in zip(*found, strict=True))
            ids, versions, checks = (np.array(x, dtype="<i8") for x in (ids, versions, checks))
            out = []
            for part, at in by_range(base, ranges):
                spans = groups_of(owner[at])
                docs = owner[at][[lo for lo, _ in spans]]
                counts = np.array([hi - lo for lo, hi in spans], dtype="<u4")
                packed = ids[docs], versions[docs], checks[docs], counts, left[at], right[at], places[at].astype("<u4")
                out.append((part, *(x.tobytes() for x in packed)))
            return [list(c) for c in zip(*out, strict=True)]

        return step

    columns = "ids", "versions", "checks", "counts", "left", "right", "places"
    return map_batches(rows, start, "part int" + "".join(f", {c} binary" for c in columns))


def _repeated(asked: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """The places of those anchors that occur twice or more with the same words around them, by document.

    Of equal texts only the first counts and is answered.
    """
    ids, versions, checks = (joined(asked[c], "<i8") for c in ("ids", "versions", "checks"))
    counts, places = joined(asked["counts"], "<u4"), joined(asked["places"], "<u4")
    order = np.lexsort((ids, checks, versions))
    v, c = versions[order], checks[order]
    first = np.zeros(len(ids), dtype=bool)
    first[order] = np.concatenate([[True], (v[1:] != v[:-1]) | (c[1:] != c[:-1])])[: len(ids)]
    own = np.repeat(first, counts)
    ids, versions, counts, places = ids[first], versions[first], counts[first], places[own]
    often = np.zeros(len(places), dtype=bool)
    for side in ("left", "right"):
        runs = joined(asked[side], "<u8")[own]
        _, which, n = np.unique(runs, return_inverse=True, return_counts=True)
        often |= (n[which] > 1) & (runs > 0)
    owner = np.repeat(np.arange(len(ids)), counts)[often]
    places = places[often]
    bucket = ((ids ^ versions) % buckets)[owner]
    order = np.argsort(bucket, kind="stable")
    owner, places, bucket = owner[order], places[order], bucket[order]
    made = [
        (int(bucket[lo]), ids[owner[lo:hi]].tobytes(), versions[owner[lo:hi]].tobytes(), places[lo:hi].tobytes())
        for lo, hi in groups_of(bucket)
    ]
    return pd.DataFrame(made, columns=["bucket", "ids", "versions", "places"])


def _by_document(found: pd.DataFrame) -> pd.DataFrame:
    """One row per document with the places of its repeated anchors, in order."""
    ids, versions, places = joined(found["ids"], "<i8"), joined(found["versions"], "<i8"), joined(found["places"], "<u4")
    order = np.lexsort((places, versions, ids))
    ids, versions, places = ids[order], versions[order], places[order]
    names = np.stack([ids, versions], axis=1)
    spans = [] if not len(ids) else groups_of(np.concatenate([[0], np.cumsum((names[1:] != names[:-1]).any(axis=1))]))
    made = [(int(ids[lo]), int(versions[lo]), places[lo:hi].tobytes()) for lo, hi in spans]
    return pd.DataFrame(made, columns=["doc_id", "version", "places"])


def _contexts(found: DataFrame, size: int) -> DataFrame:
    """The words around each repeated anchor that belong to its windows, and where they begin.

    A context's digest stands for its words and so for its anchor.
    """

    def start():
        def step(ids, versions, texts, places):
            out = [[], [], [], [], [], [], []]
            for doc, version, text, place in zip(ids, versions, texts, places, strict=True):
                words = words_of(text)
                _, runs, of_window = anchors_of(words, size)
                wanted = np.frombuffer(place, dtype="<u4")
                first, last = np.searchsorted(of_window, wanted), np.searchsorted(of_window, wanted, side="right")
                anchors = runs[wanted].view(np.int64).tolist()
                for anchor, a, b in zip(anchors, first.tolist(), last.tolist(), strict=True):
                    context = b" ".join(words[a : b - 1 + size])
                    values = xxhash.xxh3_128_digest(context), anchor, context.decode(), doc, version, a, b - a
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            return out

        return step

    return map_batches(
        found, start, "digest binary, anchor long, context string, doc_id long, version long, at int, windows int"
    )


def _covered_bits(contexts: pd.DataFrame, size: int) -> pd.DataFrame:
    """Of each context of a shard, the windows that an earlier context of its anchor holds, as bits."""
    contexts = contexts.sort_values(["anchor", "doc_id", "at"], kind="stable")
    anchor, automaton, bits = None, None, []
    groups = contexts["anchor"].to_numpy()
    alone = np.ones(len(groups), dtype=bool)
    alone[1:] &= groups[1:] != groups[:-1]
    alone[:-1] &= groups[:-1] != groups[1:]
    for own, single, text in zip(groups, alone, contexts["context"], strict=True):
        if single:
            bits.append(0)
            continue
        if own != anchor:
            anchor, automaton = own, SuffixAutomaton()
        words = text.split(" ")
        matched = automaton.statistics(words)[size - 1 :]
        bits.append(sum(1 << k for k, n in enumerate(matched) if n >= size))
        automaton.take_up(words)
    return pd.DataFrame(
        {"digest": contexts["digest"], "doc_id": contexts["doc_id"], "at": contexts["at"], "bits": bits}
    )


def marked_hot(firsts: DataFrame, occurrences: DataFrame, most: int) -> DataFrame:
    """The contexts with a column ``hot``: true where the anchor has more than ``most`` occurrences, else NULL."""
    often = occurrences.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    return firsts.join(often.select("anchor", F.lit(True).alias("hot")), "anchor", "left")


def _covered_by_window(contexts: DataFrame, size: int) -> DataFrame:
    """What ``_covered_bits`` says, for any number of contexts of one anchor: the first place of every window, natively."""

    def start():
        def step(digests, texts, docs, places):
            out = [[], [], [], [], []]
            for digest, text, doc, at in zip(digests, texts, docs, places, strict=True):
                words = text.encode().split(b" ")
                for k in range(len(words) - size + 1):
                    values = xxhash.xxh3_128_digest(b" ".join(words[k : k + size])), digest, doc, at + k, k
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            return out

        return step

    windows = map_batches(
        contexts.select("digest", "context", "doc_id", "at"),
        start,
        "window binary, digest binary, doc_id long, at int, k int",
        at_once=1_000,
    )
    first = windows.groupBy("window").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n"))
    repeated = first.filter("n > 1").select("window", "first")
    later = F.struct("doc_id", "at") > F.col("first")
    bit = F.when(later, F.call_function("shiftleft", F.lit(1), F.col("k"))).otherwise(0)
    return (
        windows.join(repeated, "window", "left")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.min("at").alias("at"), F.bit_or(bit).alias("bits"))
    )


def versions_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, version, check): two hashes of the text tell rows of one id apart and show equal texts."""
    hashes = {"version": F.xxhash64("text"), "check": F.xxhash64(F.lit(1), "text")}
    return documents(docs, id_col, text_col).withColumns(hashes)


def later_copies(rows: DataFrame) -> DataFrame:
    """(doc_id, version) of the documents with the same text as one of a smaller id; only hashes are shuffled."""
    names = rows.select("doc_id", "version", "check")
    firsts = names.groupBy("version", "check").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = firsts.filter("first < last").select("version", "check", "first")
    return names.join(copied, ["version", "check"]).filter("doc_id > first").select("doc_id", "version").distinct()


def repeated_windows(rows: DataFrame, *, size: int = 20, most: int = MOST_CONTEXTS) -> DataFrame:
    """(doc_id, version, at, bits): window ``at + k`` of the document begins earlier elsewhere if bit k is set.

    ``rows`` are ``versions_of`` documents. Later copies of a text are not in the result: all their windows
    begin earlier, and none of them is the first of its kind. Anchors travel as packed hashes by
    range of hash, so the number of tasks follows the amount of text; an anchor in very many documents
    adds twenty bytes for each to its range. Equal contexts are merged on the map side before they meet, and
    those of an anchor with more than ``most`` occurrences don't meet, but are judged window by window.
    """
    spark = rows.sparkSession
    ranges = ranges_for(rows, 64 << 20)
    answers = (
        _requests(rows, size, ranges)
        .groupBy("part")
        .applyInPandas(lambda part: _repeated(part, ranges), "bucket int, ids binary, versions binary, places binary")
        .groupBy("bucket")
        .applyInPandas(_by_document, "doc_id long, version long, places binary")
    )
    found = rows.join(answers, ["doc_id", "version"]).select("doc_id", "version", "text", "places")
    path = scratch_path(spark, "contexts")
    occurrences = _contexts(found, size)
    occurrences.write.option("compression", "zstd").parquet(path)
    # the same filter for all readers lets Spark shuffle the contexts once
    occurrences = spark.read.schema(occurrences.schema).parquet(path).filter("anchor is not null")
    firsts = (
        occurrences.groupBy("digest", "anchor", "context")
        .agg(F.min(F.struct("doc_id", "at")).alias("first"))
        .select("digest", "anchor", "context", "first.*")
    )
    shards = max(1, occurrences.count() // 20_000)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    marked = marked_hot(firsts, occurrences, most)
    judged = (
        marked.filter("hot is null")
        .groupBy(shard)
        .applyInPandas(lambda part: _covered_bits(part, size), "digest binary, doc_id long, at int, bits int")
        .unionByName(_covered_by_window(marked.filter("hot"), size))
        .select("digest", F.col("doc_id").alias("first_doc"), F.col("at").alias("first_at"), "bits")
    )
    first = (F.col("doc_id") == F.col("first_doc")) & (F.col("at") == F.col("first_at"))
    one = F.lit(1) if size < ANCHOR + 30 else F.lit(1).cast("long")  # all 31 windows fit an int, one bit more does not
    every = (F.call_function("shiftleft", one, F.col("windows")) - 1).cast("int")
    return (
        occurrences.select("digest", "doc_id", "version", "at", "windows")
        .join(judged, "digest")
        .select("doc_id", "version", "at", F.when(first, F.col("bits")).otherwise(every).alias("bits"))
        .filter("bits <> 0")
    )


@any_ids("doc_id")
def remove_repeats(
    docs: DataFrame, *, size: int = 20, most: int = MOST_CONTEXTS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, n_words, n_removed) of every row: the words that stay, joined by one space.

    A word goes if a window of ``size`` words covers it whose words also begin at an earlier place: in a
    document of smaller id, or in the same one before. Windows are judged on the input. A NULL id is the smallest.
    Rows of one id are at the same place: equal ones are judged alike, and neither is earlier than the other.
    A NULL or empty text has no words. ``most`` bounds the contexts of an anchor that one automaton takes up, not the result.
    """
    if not ANCHOR <= size <= ANCHOR + 30:
        raise ValueError(f"size must lie between {ANCHOR} and {ANCHOR + 30}")
    rows = versions_of(docs, id_col, text_col)
    covered = (
        repeated_windows(rows, size=size, most=most)
        .groupBy("doc_id", "version")
        .agg(F.collect_set(F.struct("at", "bits")).alias("covered"))
        .withColumn("copy", F.lit(False))
        .unionByName(later_copies(rows).withColumn("copy", F.lit(True)), allowMissingColumns=True)
    )

    def start():
        def step(ids, texts, spans, copies):
            kept, n_words, n_removed = [], [], []
            for text, found, copy in zip(texts, spans, copies, strict=True):
                words = words_of(text)
                if copy and len(words) >= size:
                    kept.append("")
                    n_words.append(len(words))
                    n_removed.append(len(words))
                    continue
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for span in found or ():
                    for k in range(size):
                        if span["bits"] >> k & 1:
                            gone[span["at"] + k] += 1
                            gone[span["at"] + k + size] -= 1
                stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                kept.append(b" ".join([words[i] for i in stay]).decode() if len(stay) < len(words) else b" ".join(words).decode())
                n_words.append(len(words))
                n_removed.append(len(words) - len(stay))
            return ids, kept, n_words, n_removed

        return step

    joined = rows.join(covered, ["doc_id", "version"], "left").select("doc_id", "text", "covered", "copy")
    return shown(map_batches(joined, start, "doc_id long, text string, n_words long, n_removed long"))


def digest_of(kept: DataFrame) -> DataFrame:
    """Counts and the digest of the text that stays."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
