"""A probabilistic suffix tree over words: variable-length contexts, learnt from and scored over the whole corpus.

A context is a run of up to ``depth`` words. It is a candidate if it occurs ``min_count`` times in the training texts, and
becomes a state if it passes a divergence test: the words that follow it must be told better by its own distribution than
by that of the context one word shorter, by ``min_gain`` (log10) over all its occurrences. Each occurrence is
judged by the counts without itself, so that rare words that happened to follow don't speak for a context.

A state's next-word distribution is smoothed by the one of the next shorter state, which weighs as much as ``smoothing``
occurrences; the root's adds ``ROOT`` to every word's count. A word is scored by the longest state that ends the words before it.

Counts are summed by key over blocks of documents (``blocks.py``), one order after the other; a longer run is asked for only
behind a candidate context. Words and runs are known by 64-bit hashes. No part of the model is broadcast or
collected, only its two numbers: training tokens and distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tablewright.llm.blocks import REQUESTS, Steps, buckets_for, per_block, requests_by_rank, requests_of, sums_of, write_blocks
from tablewright.llm.hashes import mixed, word_hashes

#: Added to the count of every word, and of one word for all unknown ones, in the distribution without context.
ROOT = 0.1
#: Gains are summed as whole numbers of this fraction, so that no sum depends on the order of its parts.
UNIT = 1 << 10
#: Runs of two words, the most by far, are summed in so many turns, each for its share of the ranges.
TURNS = 2
BLOCK_TOKENS = 1_000_000
TOKENS_PER_RANGE = 2_000_000
#: The end of a text: not a word, as words hold no space.
END = b" "


class _Codes(dict):
    """Numbers for words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def words_of(text: str | None) -> list[bytes]:
    """Words of whole text, A-Z in lower case; bytes split at the same six ASCII characters that end words."""
    return (text or "").encode().lower().split()


def _to_blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """One row for up to about ``block_tokens`` tokens; a text is never cut."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, n_tokens long, ids array<{id_type}>, held array<boolean>, sizes array<int>, words binary, codes binary"
    )
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids, held, sizes, codes, parts, n = [], [], [], _Codes({END: 0}), [], 0

        def cut():
            words = word_hashes(list(codes)).astype("<u8").tobytes()
            planes = np.concatenate(parts).astype("<u4").view(np.uint8).reshape(-1, 4).T
            packed = zstandard.ZstdCompressor(level=3).compress(planes.tobytes())
            row = ((task << 32) + made, n, ids, held, sizes, words, packed)
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, out, strict=True)], schema=out)

        for batch in batches:
            for doc_id, is_held, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                words.append(END)
                parts.append(np.fromiter(map(codes.__getitem__, words), dtype=np.uint32, count=len(words)))
                ids.append(doc_id)
                held.append(is_held)
                sizes.append(len(words))
                n += len(words)
                if n >= block_tokens:
                    yield cut()
                    made += 1
                    ids, held, sizes, codes, parts, n = [], [], [], _Codes({END: 0}), [], 0
        if ids:
            yield cut()

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


class _Text:
    """A block's tokens, and what is known of the runs that end at each."""

    def __init__(self, row, found: dict[int, np.ndarray], min_count: int):
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.codes), dtype=np.uint8)
        self.codes = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
        words = np.frombuffer(row.words, dtype="<u8")
        self.sizes = np.asarray(row.sizes, dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.codes)) - np.repeat(self.starts, self.sizes)
        self.train = np.repeat(~np.asarray(row.held, dtype=bool), self.sizes)
        self.first = words[self.codes]
        self.order = np.argsort(words)
        self.words, self.found, self.min_count = words, found, min_count
        self.counts: list[np.ndarray] = []  # by order: count of the run that ends at each token, 0 where it wasn't asked for
        self.runs: list[tuple] = []  # by order from 2 on: asked places, distinct keys, each place's key
        self.hashes = [self.first]
        place_of = np.empty(len(words), dtype=np.int64)
        place_of[self.order] = np.arange(len(words))
        self.keys_at = [place_of[self.codes]]  # by order: the number of each token's run among the block's distinct ones
        if 0 in found:
            back = np.empty(len(words), dtype=np.int64)
            back[self.order] = found[0]
            self.counts.append(back[self.codes])

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words and how often the block's training texts have them."""
        n = np.bincount(self.codes[self.train], minlength=len(self.words))
        return self.words[self.order], n[self.order]

    def longer(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct runs one word longer than known so far, behind candidate contexts, and their counts here."""
        known = len(self.hashes)
        before = self.counts[-1][:-1] >= self.min_count
        places = np.flatnonzero(before & (self.place[1:] >= known)) + 1
        hashes = np.zeros(len(self.codes), dtype=np.uint64)
        hashes[places] = mixed(self.hashes[-1][places - 1], self.first[places])
        keys, of = np.unique(hashes[places], return_inverse=True)
        self.hashes.append(hashes)
        self.keys_at.append(np.zeros(len(self.codes), dtype=np.int64))
        self.keys_at[-1][places] = of
        self.runs.append((places, keys, of))
        return keys, np.bincount(of[self.train[places]], minlength=len(keys))

    def learn(self) -> None:
        """Take in the counts of the runs asked for last."""
        counts = np.zeros(len(self.codes), dtype=np.int64)
        places, keys, of = self.runs[-1]
        if len(keys):
            counts[places] = self.found[len(self.runs)][of]
        self.counts.append(counts)

    def grown(self, orders: int) -> _Text:
        """Known up to runs of so many words."""
        for _ in range(orders - 1):
            self.longer()
            self.learn()
        return self


def _contexts(text: _Text, depth: int) -> list[tuple]:
    """By length of candidate contexts: the places behind them, each place's context as a number, the ranges and ranks
    of the distinct contexts that are used."""
    made = []
    for k in range(1, depth + 1):
        places = text.runs[k - 1][0]
        if not len(places):
            none = np.zeros(0, dtype=np.int64)
            made.append((places, none, none, none))
            continue
        number = np.cumsum(text.found[k - 1] >= text.min_count) - 1
        used, of = np.unique(number[text.keys_at[k - 1][places - 1]], return_inverse=True)
        parts, ranks = text.found["ranks", k - 1]
        made.append((places, of, parts[used], ranks[used]))
    return made


def score_texts(
    docs: DataFrame,
    *,
    depth: int = 3,
    min_count: int = 4,
    min_gain: float = 1.0,
    smoothing: float = 50.0,
    block_tokens: int = BLOCK_TOKENS,
    tokens_per_range: int = TOKENS_PER_RANGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Learns from documents for which crc32 of the id as text is no multiple of ten and scores all. Words are runs of other
    characters than ASCII white space, A-Z in lower case; every text ends with one more token. ``base_score`` is the text's
    log10 probability without any context, ``score`` that by the suffix tree. A NULL or empty text is its end alone. An id
    may have any type; NULL counts as the empty text, so it is held out. Every row gives one row, repeated ones too; copies
    of a training text are seen as often as they occur. An empty table gives none. If every text is held out, all counts
    are zero and each token has probability 1. Other columns are ignored.
    """
    ident = docs[id_col]
    rows = docs.select(
        ident.alias("doc_id"),
        (F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % 10 == 0).alias("held_out"),
        docs[text_col].cast("string").alias("text"),
    )
    made = _to_blocks(rows, block_tokens)
    blocks, known = write_blocks(made, "lm-blocks"), Steps(docs.sparkSession, buckets_for(made), "lm-sums")
    n = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-n // tokens_per_range))
    texts = blocks.select("block", "held", "sizes", "words", "codes")

    def first_words(row, found):
        return requests_of(row.block, parts, *_Text(row, found, min_count).keys())

    def numbers(keys: np.ndarray, sums: np.ndarray):
        return [(0, int((sums > 0).sum())), (1, int(sums.sum()))]

    known.add(sums_of(per_block(texts, [], first_words, REQUESTS), notes=numbers, rank_from=min_count))
    stated = known.rows.selectExpr("inline(notes)").groupBy("k").agg(F.sum("v")).collect()
    vocabulary, tokens = (dict(map(tuple, stated)).get(k, 0) for k in (0, 1))

    for order in range(2, depth + 2):

        turns = TURNS if order == 2 else 1

        def longer_runs(row, found, order=order, turn=0, turns=turns):
            return requests_of(row.block, parts, *_Text(row, found, min_count).grown(order - 1).longer(), turn, turns)

        # runs of depth + 1 words are nobody's context
        rank_from = min_count if order <= depth else None
        asked = (per_block(texts, known.rows, partial(longer_runs, turn=turn), REQUESTS) for turn in range(turns))
        known.add(*(sums_of(a, rank_from=rank_from) for a in asked))

    rest = tokens + ROOT * (vocabulary + 1)

    def gains(row, found):
        text = _Text(row, found, min_count).grown(depth + 1)
        # each occurrence is judged by the counts without itself; only training texts are counted
        told = (np.maximum(text.counts[0] - 1, 0) + ROOT) / (rest - 1)
        for k, (places, of, ranges, ranks) in enumerate(_contexts(text, depth), 1):
            seen = text.train[places]
            places, of = places[seen], of[seen]
            longer = (text.counts[k][places] - 1 + smoothing * told[places]) / (
                text.counts[k - 1][places - 1] - 1 + smoothing
            )
            gain = np.bincount(of, np.rint(np.log10(longer / told[places]) * UNIT), minlength=len(ranks)).astype(np.int64)
            told[places] = longer
            yield from requests_by_rank(row.block, ranges + (k - 1) * parts, ranks, gain)

    known.add(sums_of(per_block(texts, known.rows, gains, REQUESTS), answer=lambda sums: sums >= round(min_gain * UNIT)))

    def score(row, found):
        text = _Text(row, found, min_count).grown(depth + 1)
        chance = (text.counts[0] + ROOT) / rest
        base = np.log10(chance)
        at = 0
        for k, (places, of, _, ranks) in enumerate(_contexts(text, depth), 1):
            if not len(places):
                continue
            state = found[depth + 1][at : at + len(ranks)][of] > 0
            at += len(ranks)
            places = places[state]
            chance[places] = (text.counts[k][places] + smoothing * chance[places]) / (
                text.counts[k - 1][places - 1] + smoothing
            )
        sums = [np.add.reduceat(v, text.starts).tolist() for v in ((text.counts[0] > 0).astype(np.int64), base, np.log10(chance))]
        for doc_id, held, size, *values in zip(row.ids, row.held, text.sizes.tolist(), *sums, strict=True):
            yield doc_id, bool(held), size, values[0], tokens, values[1], values[2]

    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double"
    )
    return per_block(blocks.drop("n_tokens"), known.closed(), score, schema)
