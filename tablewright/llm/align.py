"""How the tokens of two tokenizers lie over each other, and how often their ids meet in a corpus.

Both encode the same bytes. Where a token of each ends at the same byte, the text is cut; between two such cuts lies a
group, and all its tokens of one tokenizer are linked with all of the other. An id pair counts once for each document that
links it.

The work inside a task is done on Arrow columns: lists of ids are flattened with the document of each id, byte ends are
cumulative sums within documents, a hash join on (document, end) finds the cuts, another on the group pairs the ids, and
``Table.group_by`` counts. Documents stay in blocks (``blocks.py``); only each block's distinct pairs with their counts
move, and Spark adds them up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tablewright.llm.blocks import REQUESTS, pack, pack_sorted, per_block, requests_of, totals, unpack, unpack_sorted, write_blocks
from tablewright.llm.bpe import pack_ids, read_spec
from tablewright.llm.byte_level import ByteLevel, by_rank, token_bytes

BLOCK_CHARS = 8 << 20
STEP_CHARS = 1 << 20
#: Words whose ids a task holds, and the longest of them.
MOST_WORDS = 300_000
LONGEST_WORD = 100
PAIRS_PER_RANGE = 2_000_000
#: An odd factor deals pairs out evenly over 64-bit numbers and can be taken back.
SPREAD = 0x9E3779B97F4A7C15
SPREAD_BACK = pow(SPREAD, -1, 1 << 64)
#: Fixed value: a sentencepiece model's names for single bytes.
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def token_bytes_of_pieces(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """By id, the bytes of a sentencepiece model's pieces."""
    pieces = [model.id_to_piece(n) for n in range(model.get_piece_size())]
    marks = [BYTE_PIECE.fullmatch(p) for p in pieces]
    return [bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for m, p in zip(marks, pieces, strict=True)]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.zeros(0)]).astype(np.int32)))


class _Side:
    """One tokenizer's tokens of some documents, as flat columns."""

    def __init__(self, lists: pa.ListArray, sizes: pa.Array):
        self.per_doc = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        self.ids, self.doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
        # segmented sum: what all earlier documents hold is taken off
        ends = pc.cumulative_sum(pc.take(sizes, self.ids))
        starts = np.cumsum(self.per_doc) - self.per_doc
        before = np.concatenate([[0], ends.to_numpy()])[starts]
        self.ends = pc.subtract(ends, pc.take(pa.array(before), self.doc))

    def table(self, at: str) -> pa.Table:
        return pa.table({"doc": self.doc, "end": self.ends, at: pa.array(np.arange(len(self.ids)))})

    def grouped(self, cuts: np.ndarray) -> pa.ListArray:
        offsets = np.concatenate([[0], np.sort(cuts) + 1]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), self.ids)


def _group_ids(groups: pa.ListArray, name: str) -> pa.Table:
    """Distinct ids of each group and how often it has them."""
    table = pa.table({"group": pc.list_parent_indices(groups), name: pc.list_flatten(groups)})
    return table.group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"n_{name}"])


def _text_of(groups: pa.ListArray, names: pa.Array) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(groups.offsets, pc.take(names, groups.values)), ",")


class Aligner:
    """Both tokenizers, and their tokens' bytes, sizes and names as Arrow columns."""

    def __init__(self, spec: str, ranked: bool, pieces: bytes):
        self.a = ByteLevel(spec, ranked, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        tokens = (self.a.bytes, token_bytes_of_pieces(self.b))
        self.by_word = all("▁" not in self.b.id_to_piece(n).lstrip("▁") for n in range(self.b.get_piece_size()))
        self.words: dict[str, bytes | None] = {}
        self.bytes = [pa.array(t, type=pa.binary()) for t in tokens]
        self.sizes = [pa.array([len(x) for x in t], type=pa.int64()) for t in tokens]
        self.names = [pa.array([str(n) for n in range(len(t))]) for t in tokens]

    def _learn(self, words: list[list[str]]) -> None:
        """Take in B's ids of new words; None for those whose ids may hang on what stands beside them."""
        new = set().union(*words) - self.words.keys()
        if len(self.words) + len(new) > MOST_WORDS:
            self.words.clear()
            new = set().union(*words)
        plain = [w for w in new if 0 < len(w) <= LONGEST_WORD and "▁" not in w]
        self.words.update(dict.fromkeys(new))
        self.words.update((w, pack_ids(i)) for w, i in zip(plain, self.b.encode(plain, num_threads=1), strict=True))

    def encode(self, texts: list[str]) -> list[list[np.ndarray]]:
        """Both sides' ids of each text; B's word by word where it can be done.

        No piece has a space behind another character, so a single space between two words always begins a piece.
        """
        words = [t.split(" ") for t in texts]
        if self.by_word:
            self._learn(words)
        b = []
        for text, parts in zip(texts, words, strict=True):
            try:
                b.append(np.frombuffer(b"".join(map(self.words.__getitem__, parts)), dtype="<u4"))
            except (TypeError, KeyError):
                b.append(np.array(self.b.encode(text), dtype="<u4"))
        return [[self.a.ids(" " + t) for t in texts], b]

    def align(self, texts: list[str | None]) -> tuple[pa.Table, list[str], pa.Table]:
        """For documents by their place: numbers and digests of all, and the (doc, pair, times) they link."""
        wanted = [k for k, t in enumerate(texts) if t]
        encoded = list(map(_lists, self.encode([texts[k] for k in wanted])))
        bytes_of = pa.array([(" " + texts[k]).encode() for k in wanted], type=pa.binary())
        same = np.ones(len(wanted), dtype=bool)
        for lists, tokens in zip(encoded, self.bytes, strict=True):
            joined = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, pc.take(tokens, lists.values)), b"")
            same &= pc.equal(joined, bytes_of).to_numpy(zero_copy_only=False).astype(bool)
        kept = np.array(wanted, dtype=np.int64)[same]
        if not same.all():
            encoded = [lists.filter(pa.array(same)) for lists in encoded]
        numbers = np.zeros((4, len(texts)), dtype=np.int64)
        digests = [""] * len(texts)
        if not len(kept):
            return numbers, digests, pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.uint64()), "times": pa.array([], pa.int64())})
        a, b = (_Side(lists, sizes) for lists, sizes in zip(encoded, self.sizes, strict=True))
        cuts = a.table("at_a").join(b.table("at_b"), ["doc", "end"], join_type="inner", use_threads=False)
        in_a, in_b = a.grouped(cuts["at_a"].to_numpy()), b.grouped(cuts["at_b"].to_numpy())
        per_doc = np.bincount(cuts["doc"].to_numpy(), minlength=len(kept))
        firsts = np.cumsum(per_doc) - per_doc
        links = pc.multiply(pc.cast(pc.list_value_length(in_a), pa.int64()), pc.list_value_length(in_b)).to_numpy()
        numbers[:, kept] = a.per_doc, b.per_doc, per_doc, np.add.reduceat(links, firsts)
        names = pc.binary_join_element_wise(*(_text_of(g, n) for g, n in zip((in_a, in_b), self.names, strict=True)), "|")
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(firsts, len(names)).astype(np.int32)), names), ";")
        for k, text in zip(kept.tolist(), whole, strict=True):
            digests[k] = sha256(text.as_buffer()).hexdigest()
        met = _group_ids(in_a, "a").join(_group_ids(in_b, "b"), "group", join_type="inner", use_threads=False)
        doc_of = np.repeat(kept, per_doc)
        ids = met["a"].to_numpy().astype(np.uint64) << np.uint64(32) | met["b"].to_numpy().astype(np.uint64)
        pairs = pa.table({
            "doc": pa.array(doc_of[met["group"].to_numpy()]),
            "pair": pa.array(ids * np.uint64(SPREAD)),
            "times": pc.multiply(met["n_a"], met["n_b"]),
        })
        linked = pairs.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
        return numbers, digests, linked.rename_columns(["doc", "pair", "times"])


def _to_blocks(docs: DataFrame, start, block_chars: int) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, ids array<{id_type}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
        "groups array<string>, n_pairs long, pairs binary, counts binary, per_doc array<int>, linked binary, times binary"
    )
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task, made = start(), TaskContext.get().partitionId(), 0
        ids, numbers, digests, tables, chars = [], [], [], [], 0

        def cut():
            pairs = pa.concat_tables(tables)
            counted = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            keys = counted["pair"].to_numpy()
            order = np.argsort(keys)
            keys = keys[order]
            of = np.searchsorted(keys, pairs["pair"].to_numpy())
            doc, times = pairs["doc"].to_numpy(), pairs["times"].to_numpy()
            by_doc = np.lexsort((of, doc))
            row = [
                (task << 32) + made, ids, *np.concatenate(numbers, axis=1).tolist(), digests, len(keys), pack_sorted(keys),
                pack(counted["count_all"].to_numpy()[order]), np.bincount(doc, minlength=len(ids)).tolist(), pack(of[by_doc]), pack(times[by_doc]),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, out, strict=True)], schema=out)

        def steps():
            """Documents of about STEP_CHARS at a time."""
            some, size = [], 0
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    some.append(row)
                    size += len(row[1] or "")
                    if size >= STEP_CHARS or len(some) >= STEP_CHARS >> 6:
                        yield some, size
                        some, size = [], 0
            if some:
                yield some, size

        for some, size in steps():
            some_ids, texts = map(list, zip(*some, strict=True))
            found, named, linked = aligner.align(texts)
            tables.append(linked.set_column(0, "doc", pc.add(linked["doc"], len(ids))))
            ids += some_ids
            numbers.append(found)
            digests += named
            chars += size
            if chars >= block_chars:
                yield cut()
                made += 1
                ids, numbers, digests, tables, chars = [], [], [], [], 0
        if ids:
            yield cut()

    return docs.mapInArrow(run, schema)


def align_tokens(
    docs: DataFrame, byte_level: str, pieces: str, *, block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    ``byte_level`` is the JSON of a byte-level BPE (A), which encodes a space and the text; ``pieces`` a sentencepiece model
    (B) that puts a space in front itself. A document's links are all A-B pairs of tokens in one group; ``n_best`` are those whose pair's
    count is the highest of all pairs with its A id, ties included, and ``count_sum`` adds up the pairs' counts.
    Groups are written ``a1,a2|b1;a3|b2``. Texts that are NULL, empty or not given back by both tokenizers' tokens have zeros and an
    empty text. Ids may have any type; every row gives one row, and repeated rows count as documents of their own.
    """
    spark = docs.sparkSession
    spec = read_spec(byte_level)
    with open(pieces, "rb") as f:
        proto = f.read((64 << 20) + 1)
    if len(proto) > 64 << 20:
        raise ValueError(f"{pieces} has more than 64 MB")
    shared = spark.sparkContext.broadcast((spec, by_rank(spec), proto))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    blocks = write_blocks(_to_blocks(rows, lambda: Aligner(*shared.value), block_chars), "aligned")
    n = blocks.agg(F.sum("n_pairs")).first()[0] or 0
    parts = max(1, -(-n // PAIRS_PER_RANGE))

    def ask(row, found):
        return requests_of(row.block, parts, unpack_sorted(row.pairs), unpack(row.counts))

    def best(keys: np.ndarray, sums: np.ndarray):
        """The highest count of each A id in a range."""
        a = (keys * np.uint64(SPREAD_BACK)) >> np.uint64(32)
        order = np.lexsort((sums, a))
        last = np.flatnonzero(np.append(a[order][1:] != a[order][:-1], True))
        return zip(a[order][last], sums[order][last], strict=True)

    counts = totals(per_block(blocks.select("block", "pairs", "counts"), [], ask, REQUESTS), "pair-counts", notes=best)
    highest = counts.selectExpr("inline(notes)").groupBy("k").agg(F.max("v").alias("v")).collect()
    table = np.zeros(len(token_bytes(spec)), dtype=np.int64)  # a number for each id of A, whatever the corpus
    for k, v in highest:
        table[k] = v
    of_a = spark.sparkContext.broadcast(table)

    def judge(row, found):
        sizes = np.asarray(row.per_doc, dtype=np.int64)
        pairs, linked, times = unpack_sorted(row.pairs), unpack(row.linked), unpack(row.times)
        count = found.get(0, np.zeros(0, dtype=np.int64))
        is_best = count == of_a.value[((pairs * np.uint64(SPREAD_BACK)) >> np.uint64(32)).astype(np.int64)]
        sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * is_best[linked], times * count[linked])]
        ends = np.cumsum(sizes)
        n_best, count_sum = (s[ends] - s[ends - sizes] for s in sums)
        return zip(row.ids, row.n_a, row.n_b, row.n_groups, row.n_links, n_best.tolist(), count_sum.tolist(), row.groups, strict=True)

    kept = blocks.drop("n_pairs", "counts")
    return per_block(kept, [counts], judge, f"doc_id {id_type}, {RESULT}")
