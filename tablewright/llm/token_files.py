"""Token ids in files: byte planes of fixed-size id blocks, each compressed, with an index of chunks.

A shard is one Parquet file with one row group and holds a contiguous range of documents in order of
their ids. Each row is a chunk: a block of ids cut into four byte planes (all lowest bytes, all
second bytes, ...), every plane compressed by itself, with its place in the shard, a checksum and
the documents that begin in it. Documents may run over several chunks, never over shards.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm.bpe import SIMPLE_CHUNK, byte_level, read_spec
from tablewright.llm.rows import Recent, documents, has_whole_ids, map_batches, shown

BLOCK = 1 << 16
CHUNK_SCHEMA = (
    "shard int, chunk int, first long, n_ids int, crc32 long, planes array<binary>, "
    "docs array<struct<doc_id: {}, start: long, n_tokens: long>>"
)


#: Fixed value: how a byte-level pre-tokenizer cuts a text.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Latin letters whose class is the same everywhere, and signs after them, which are always cut off as one piece.
LETTERS_AND_SIGNS = re.compile("([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f]+)([!-&(-/:-@[-`{-~]*)").fullmatch


class Words(Recent):
    """A cache of words' ids, each word after a fixed text."""

    def __init__(self, encoder: SpacedEncoder, before: str, size: int):
        super().__init__(encoder.piece, size)
        self.before, self.start, self.tokenize = before, byte_level(before), encoder.model.tokenize
        self.packed, self.signs = encoder.packed, encoder.signs

    def __missing__(self, word: str):
        if "\n" in word:
            before, *lines = word.split("\n")
            return self.line_end.join([self[before], *[self.first[w] for w in lines]])
        value = self.last.get(word)
        if value is None:
            parts = LETTERS_AND_SIGNS(word)
            if parts is None:
                value = self.make()(word, self.before + word)
            elif parts[2]:
                value = self[parts[1]] + self.signs[parts[2]]
            else:
                # For one word the library's model is called directly, which saves most of the time.
                letters = self.start + (word if word.isascii() else byte_level(word))
                value = b"".join([self.packed[t.id] for t in self.tokenize(letters)])
        if len(self) >= self.size:
            self.last = dict(self)
            self.clear()
        self[word] = value
        return value


class SpacedEncoder:
    """The library's byte-level encoding, word by word with a cache.

    Its pre-tokenizer always cuts before a space that follows something else, so the ids of a line
    are those of its first word and of each further one with its space; a single line end between words is
    a token too. Where white space meets white space, also where a line or word begins with white space
    other than a space, or a special token's string stands in the text, the whole text goes to the library.
    """

    def __init__(self, spec: str):
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.cut = self.library.model, regex.compile(BYTE_LEVEL_WORDS).findall
        told = json.loads(spec)
        cutter = told["pre_tokenizer"]
        if cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"]:
            raise ValueError("only plain byte-level tokenizers are handled")
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.packed = [n.to_bytes(4, "little") for n in range(max(told["model"]["vocab"].values()) + 1)]
        self.signs = Recent(self.whole)
        self.first, self.rest = Words(self, "", 50_000), Words(self, " ", 400_000)
        self.line_end = self.whole("\n")
        self.rest.line_end, self.rest.first = self.line_end, self.first

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def piece(self, word: str, text: str):
        """What is not letters, or letters and signs; a tuple marks a word that can't be encoded by itself."""
        if not word or word[0].isspace() or word[-1].isspace():
            return ()
        if not SIMPLE_CHUNK.fullmatch(word):
            return self.whole(text)
        return b"".join([self.packed[t.id] for w in self.cut(text) for t in self.model.tokenize(byte_level(w))])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        words = text.split(" ")
        start = words[0].split("\n")
        try:
            made = self.line_end.join([self.first[w] for w in start])
            return made + b"".join(map(self.rest.__getitem__, words[1:]))
        except TypeError:
            return self.whole(text)


def encoder(spec: str) -> SpacedEncoder:
    """One for the task, given back with it."""
    return SpacedEncoder(spec)


def to_planes(ids: bytes, compressor: zstandard.ZstdCompressor) -> list[bytes]:
    """Four compressed byte planes of little-endian 32-bit ids."""
    table = np.frombuffer(ids, dtype=np.uint8).reshape(-1, 4)
    return [compressor.compress(np.ascontiguousarray(table[:, k]).tobytes()) for k in range(4)]


def from_planes(planes: list[bytes], decompressor: zstandard.ZstdDecompressor) -> bytes:
    rows = [np.frombuffer(decompressor.decompress(p), dtype=np.uint8) for p in planes]
    return np.stack(rows, axis=1).tobytes()


class ShardWriter:
    """Cuts the ids of documents, given in order, into chunk rows."""

    def __init__(self, shard: int, block: int):
        self.shard, self.size = shard, block * 4
        self.held, self.docs = bytearray(), []
        self.chunk = self.first = self.total = 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, doc_id: int, ids: bytes) -> list[tuple]:
        made = []
        self.docs.append({"doc_id": doc_id, "start": self.total, "n_tokens": len(ids) // 4})
        self.total += len(ids) // 4
        self.held += ids
        while len(self.held) >= self.size:
            made.append(self.cut(self.size))
        return made

    def cut(self, size: int) -> tuple:
        ids = bytes(self.held[:size])
        del self.held[:size]
        row = (self.shard, self.chunk, self.first, len(ids) // 4, zlib.crc32(ids), to_planes(ids, self.compressor), self.docs)
        self.chunk, self.first, self.docs = self.chunk + 1, self.first + len(ids) // 4, []
        return row


def _rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """(doc_id, text), and the type of the ids: long for whole numbers, otherwise their own."""
    if has_whole_ids(docs, id_col):
        return documents(docs, id_col, text_col), "bigint"
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")), docs.schema[id_col].dataType.simpleString()


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int, block: int = BLOCK, shards: int | None = None, **columns
) -> None:
    """Encode every whole text, add ``end_id``, and write the ids in ascending order of doc_id.

    ``shards`` is as many as the input has partitions if not given. NULL ids come first, rows of one
    id stand next to each other in order of their texts; a NULL or empty text has the end id alone.
    An empty table gives no chunk.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer))
    end = np.array([end_id], dtype="<u4").tobytes()
    rows, id_type = _rows(docs, **columns)
    shards = shards or max(1, docs.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def start():
        e, w = encoder(spec.value), ShardWriter(TaskContext.get().partitionId(), block)

        def turned(made):
            return [list(c) for c in zip(*made, strict=True)] if made else None

        def step(ids, texts):
            return turned([row for i, t in zip(ids, texts, strict=True) for row in w.add(i, e.encode(t) + end)])

        return step, lambda: turned([w.cut(len(w.held))] if w.held else [])

    # one row group for each file, so that a file is never dealt out to two tasks
    map_batches(ordered, start, CHUNK_SCHEMA.format(id_type)).write.option("parquet.block.size", 1 << 30).option(
        "compression", "uncompressed"
    ).parquet(path)


def _walk(chunks: DataFrame, digest: bool, schema: str) -> DataFrame:
    def start():
        unpack = zstandard.ZstdDecompressor()
        state = {"shard": None, "next": 0, "open": []}  # open: documents not read to their end, in order

        def step(shards, numbers, firsts, counts, sums, planes, docs):
            out = []
            for shard, number, first, n, crc, packed, begun in zip(
                shards, numbers, firsts, counts, sums, planes, docs, strict=True
            ):
                if number != (state["next"] if shard == state["shard"] else 0) or number == 0 and state["open"]:
                    raise ValueError(f"chunk {number} of shard {shard} is out of order")
                state["shard"], state["next"] = shard, number + 1
                ids = from_planes(packed, unpack)
                if len(ids) != 4 * n or zlib.crc32(ids) != crc:
                    raise ValueError(f"chunk {number} of shard {shard} is damaged")
                state["open"] += [[d["doc_id"], d["start"], d["n_tokens"], d["n_tokens"] * 4, 0, []] for d in begun]
                at, left = 0, []
                for doc in state["open"]:
                    part = ids[at : at + doc[3]]
                    at += len(part)
                    doc[3] -= len(part)
                    if digest:
                        doc[4] = zlib.crc32(part, doc[4])
                    else:
                        doc[5].append(part)
                    if doc[3]:
                        left.append(doc)
                    else:
                        out.append((doc[0], shard, doc[1], doc[2], doc[4] if digest else b"".join(doc[5])))
                state["open"] = left
            return [list(c) for c in zip(*out, strict=True)] if out else None

        def finish():
            if state["open"]:
                raise ValueError(f"shard {state['shard']} ends within a document")

        return step, finish

    return map_batches(chunks.select("shard", "chunk", "first", "n_ids", "crc32", "planes", "docs"), start, schema)


def shard_offsets(chunks: DataFrame) -> DataFrame:
    """(shard, before): ids in all shards before; one row for each shard, from the index columns alone."""
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("shard", F.coalesce(before, F.lit(0)).cast("long").alias("before"))


def read_tokens(spark: SparkSession, path: str, *, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; with ``digest`` its crc32 in place of the ids.

    ``start`` counts the ids of all documents before. Chunks are checked against their checksums.
    """
    chunks = spark.read.parquet(path)
    id_type = chunks.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    last = "ids_crc32 long" if digest else "ids binary"
    read = _walk(chunks, digest, f"doc_id {id_type}, shard int, start_in_shard long, n_tokens long, {last}")
    found = read.join(shard_offsets(chunks), "shard").select(
        "doc_id", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens", last.split(" ")[0]
    )
    return shown(found) if id_type == "bigint" else found
