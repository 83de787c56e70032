"""Benchmark decontamination: Wu-Manber search for the benchmark's word windows in every document.

The search jumps: a table gives, for the pair of words at the end of the window, how far the window
may move before a pattern can match. Where it may not move, the pair names the few patterns to compare.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.rows import any_ids, documents, free_name, map_batches, shown
from tablewright.sources.scratch import scratch_path

#: A-Z to lower case.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: ASCII letters to lower case, every other ASCII character that is no digit to a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and everything beyond ASCII, A-Z in lower case; None has none."""
    return text.encode().translate(FOLD).split() if text else []


def windows_of(words: list[bytes], size: int) -> Iterable[tuple[bytes, ...]]:
    """Every window of ``size`` words; a shorter list, if not empty, is one window."""
    if len(words) <= size:
        return [tuple(words)] if words else []
    return (tuple(words[i : i + size]) for i in range(len(words) - size + 1))

#: Windows of a benchmark block, whose tables a task holds at once.
BLOCK_WINDOWS = 200_000


class WuManber:
    """Patterns of one length, each with the items that hold it."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list]):
        self.length, self.patterns = length, patterns
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for pattern in patterns:
            for end in range(self.block, length + 1):
                block = pattern[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            self.buckets[pattern[length - self.block :]].append(pattern)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list]]:
        """Start and items of every occurrence."""
        shift, far, length, block = self.shift.get, self.far, self.length, self.block
        end, n = length, len(words)
        while end <= n:
            key = tuple(words[end - block : end])
            step = shift(key, far)
            if step:
                end += step
                continue
            window = tuple(words[end - length : end])
            for pattern in self.buckets.get(key, ()):
                if pattern == window:
                    yield end - length, self.patterns[pattern]
            end += 1


def matchers(items: Iterable[tuple[object, str | None]], size: int) -> list[WuManber]:
    """One matcher for each pattern length: ``size``, and the lengths of shorter items."""
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(dict))
    for item, text in items:
        for window in windows_of(words_of(text), size):
            by_length[len(window)][window][item] = True
    return [WuManber(n, {w: list(owners) for w, owners in p.items()}) for n, p in sorted(by_length.items())]


def item_blocks(
    benchmark: DataFrame, item_col: str, text_col: str, most_bytes: int, size: int, most_windows: int
) -> Iterator[list]:
    """The benchmark in lists of at most so many bytes of text and windows (or one item); items without id are named ''."""
    rows = benchmark.select(
        F.coalesce(benchmark[item_col].cast("string"), F.lit("")), benchmark[text_col].cast("string")
    )
    block, held, windows = [], 0, 0
    for item, text in rows.toLocalIterator():
        if not text:
            continue
        more = max(1, len(words_of(text)) - size + 1)
        if block and (held + len(text) > most_bytes or windows + more > most_windows):
            yield block
            block, held, windows = [], 0, 0
        block.append((item, text))
        held, windows = held + len(text), windows + more
    if block:
        yield block


def _search(state: DataFrame, block: list, size: int) -> DataFrame:
    """Add one block's hits: a byte per word that is 1 where hit, and the items found so far."""
    shared = state.sparkSession.sparkContext.broadcast(block)

    def start():
        engines = matchers(shared.value, size)

        def step(ids, texts, hits, items):
            new_hits, new_items = [], []
            for text, hit, found in zip(texts, hits, items, strict=True):
                words = words_of(text)
                mask, names = bytearray(hit) if hit else bytearray(len(words)), set(found or ())
                for engine in engines:
                    for at, owners in engine.find(words):
                        mask[at : at + engine.length] = b"\x01" * engine.length
                        names.update(owners)
                new_hits.append(bytes(mask))
                new_items.append(sorted(names))
            return ids, texts, new_hits, new_items

        return step

    return map_batches(state, start, "doc_id long, text string, hits binary, items array<string>")


@any_ids("doc_id")
def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    size: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 8 << 20,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """(doc_id, text, hits, items) of every document: a byte per word, 1 where a benchmark window covers it.

    The benchmark goes to the executors in blocks of bounded size; documents are not shuffled. With
    more than one block, each further one searches what the block before has written. NULL and empty
    texts have no words; an empty benchmark hits nothing; repeated rows and items stay as they are.
    """
    spark = docs.sparkSession
    state = documents(docs, id_col, text_col).withColumns(
        {"hits": F.lit(None).cast("binary"), "items": F.lit(None).cast("array<string>")}
    )
    searched = None
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes, size, block_windows):
        if searched is not None:
            path = scratch_path(spark, "passages")
            searched.write.parquet(path)
            state = spark.read.parquet(path)
        searched = _search(state, block, size)
    return shown(searched if searched is not None else _search(state, [], size))


def report(found: DataFrame) -> DataFrame:
    """Counts per document from ``find_passages``."""

    def start():
        def step(ids, hits, items):
            return (
                ids,
                [len(h) for h in hits],
                [h.count(1) for h in hits],
                [len(i) for i in items],
                [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items],
                [1 in h for h in hits],
            )

        return step

    return map_batches(
        found.select("doc_id", "hits", "items"),
        start,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark.

    No shuffle; with more than one block of the benchmark, each further one searches the rows that the block
    before has kept and written. See ``find_passages`` for the options.
    """
    spark = docs.sparkSession
    name = free_name(docs, "text_of_row")
    rows = docs.withColumn(name, docs[options.get("text_col", "text")].cast("string"))
    size = options.get("size", 10)
    most = options.get("block_bytes", 8 << 20), size, options.get("block_windows", BLOCK_WINDOWS)
    kept = None
    for block in item_blocks(benchmark, options.get("item_col", "item_id"), options.get("item_text_col", "text"), *most):
        if kept is not None:
            path = scratch_path(spark, "kept-rows")
            kept.write.parquet(path)
            rows = spark.read.schema(rows.schema).parquet(path)
        kept = _drop(rows, block, size)
    return (rows if kept is None else kept).drop(name)


def _drop(docs: DataFrame, block: list, size: int) -> DataFrame:
    """Without the rows whose last column holds a window of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        engines = matchers(shared.value, size)
        for batch in batches:
            words = map(words_of, batch.column(batch.num_columns - 1).to_pylist())
            clean = [not any(any(True for _ in e.find(w)) for e in engines) for w in words]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
