"""Token counts that follow edits: a segment tree per document over its pre-token pieces.

A text is cut before every run of white space that follows something else; the pieces are the leaves.
Such cuts are also cuts of the byte-level pre-tokenizer, so the token counts of the pieces add up. An edit
changes the pieces it touches and their neighbours at most; only these are encoded again. The tree's leaves hold some
neighbouring pieces each, and nodes the sums over their children, so pieces can be put in or taken out by making
anew the leaves they lie in and the nodes above those.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.bpe import read_spec
from tablewright.llm.byte_level import ByteLevel, by_rank
from tablewright.llm.rows import Recent, map_batches

#: Fixed value: Unicode's white space.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
SPACE = re.compile(f"[{SPACES}]")
#: A node has at most twice so many children; a leaf so many pieces.
WIDTH = 64
#: States are larger than texts, so a task makes them for so many documents at a time.
ROWS_AT_ONCE = 1000
#: Pieces whose counts a task holds, twice.
MOST_PIECES = 150_000


class Leaf:
    """Neighbouring pieces: their lengths and token counts, and the sums of both."""

    def __init__(self, values: np.ndarray):
        self.values = values  # two rows
        self.n = values.shape[1]
        self.chars, self.tokens = (int(s) for s in values.sum(axis=1))


class Node:
    """Neighbouring leaves or nodes, and the sums over them."""

    def __init__(self, children: list):
        self.children = children
        self.n, self.chars, self.tokens = (sum(c.n for c in children), sum(c.chars for c in children), sum(c.tokens for c in children))


def _even(n: int) -> list[int]:
    """Cuts of ``n`` things into as few parts as may be, all about as large, none over twice ``WIDTH``."""
    parts = -(-n // (2 * WIDTH))
    return [n * k // parts for k in range(parts + 1)] if parts else [0]


class PieceTree:
    """A balanced tree over a text's pieces; putting pieces in the place of others changes the nodes above them only."""

    def __init__(self, values: np.ndarray):
        cuts = _even(values.shape[1])
        self._grow([Leaf(values[:, lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)])
        self.touched = 0

    @classmethod
    def of(cls, lengths: list[int], tokens: list[int]) -> PieceTree:
        return cls(np.array([lengths, tokens], dtype="<u4").reshape(2, -1))

    def _grow(self, nodes: list) -> None:
        while len(nodes) > 1:
            cuts = _even(len(nodes))
            nodes = [Node(nodes[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        root = nodes[0] if nodes else Leaf(np.zeros((2, 0), dtype="<u4"))
        while isinstance(root, Node) and len(root.children) == 1:
            root = root.children[0]
        self.root = root

    def find(self, offset: int) -> tuple[int, int, int]:
        """The piece that covers a place of the text: its number, where it begins and how long it is."""
        node, number, start = self.root, 0, 0
        while isinstance(node, Node):
            for child in node.children:
                if offset < start + child.chars:
                    break
                number, start = number + child.n, start + child.chars
            node = child
        ends = np.cumsum(node.values[0])
        k = int(np.searchsorted(ends, offset - start, side="right"))
        size = int(node.values[0][k])
        return number + k, start + int(ends[k]) - size, size

    def splice(self, first: int, last: int, values: np.ndarray) -> None:
        """Put pieces in the place of those from ``first`` to before ``last``."""
        self._grow(self._spliced(self.root, first, last, values))

    def _spliced(self, node, first: int, last: int, values: np.ndarray) -> list:
        """What stands for the node after the change: nothing, itself made anew, or several beside each other."""
        if isinstance(node, Leaf):
            changed = np.concatenate([node.values[:, :first], values, node.values[:, last:]], axis=1)
            cuts = _even(changed.shape[1])
            made = [Leaf(changed[:, lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        else:
            ends = np.cumsum([c.n for c in node.children])
            i = min(int(np.searchsorted(ends, first, side="right")), len(ends) - 1)
            j = max(i, int(np.searchsorted(ends, last, side="left")))
            begin = int(ends[i]) - node.children[i].n
            inner = self._spliced(node.children[i], first - begin, min(last, int(ends[i])) - begin, values)
            if j > i:
                inner += self._spliced(node.children[j], 0, last - (int(ends[j]) - node.children[j].n), values[:, :0])
            children = node.children[:i] + inner + node.children[j + 1 :]
            cuts = _even(len(children))
            made = [Node(children[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        self.touched += len(made)
        return made

    def values(self) -> np.ndarray:
        """Lengths and token counts of all pieces."""
        found, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            if isinstance(node, Leaf):
                found.append(node.values)
            else:
                waiting += reversed(node.children)
        return np.concatenate(found, axis=1)


class Counter:
    """Token counts of pieces, cached."""

    def __init__(self, spec: str, ranked: bool):
        self.encoder = ByteLevel(spec, ranked, plain=False)
        self.cache = Recent(self.encoder.count, MOST_PIECES)


class CountedText:
    """A text with the tree over its pieces; ``encoded`` counts the pieces encoded so far."""

    def __init__(self, text: str, tree: PieceTree):
        self.text, self.tree, self.encoded = text, tree, 0

    @classmethod
    def of(cls, text: str, counts: Counter) -> CountedText:
        pieces = PIECE.findall(text)
        made = cls(text, PieceTree.of(list(map(len, pieces)), list(map(counts.cache.__getitem__, pieces))))
        made.encoded = len(pieces)
        return made

    @property
    def n(self) -> int:
        return self.tree.root.n

    @property
    def n_tokens(self) -> int:
        return self.tree.root.tokens

    def edit(self, start: int, end: int, new: str, counts: Counter) -> None:
        """Put ``new`` in the place of text[start:end]."""
        size = len(self.text)
        start = min(max(start, 0), size)
        end = min(max(end, start), size)
        first, lo, _ = self.tree.find(start - 1) if start else (0, 0, 0)
        last, hi = self.n, size  # the first piece behind the region, and where it begins
        if end < size:
            last, at, length = self.tree.find(end)
            last, hi = last + 1, at + length
        self.text = self.text[:start] + new + self.text[end:]
        hi += len(new) - (end - start)
        while hi < len(self.text) and (hi == lo or SPACE.match(self.text[hi - 1])):
            # the region ends in white space, which belongs to the next piece
            hi += self.tree.find(hi - len(new) + (end - start))[2]
            last += 1
        pieces = PIECE.findall(self.text[lo:hi])
        values = [list(map(len, pieces)), [counts.cache[p] for p in pieces]]
        self.tree.splice(first, last, np.array(values, dtype="<u4").reshape(2, -1))
        self.encoded += len(pieces)

    def apply(self, edits, counts: Counter) -> None:
        for e in edits or ():
            self.edit(e["start"] or 0, e["stop"] or 0, e["new"] or "", counts)


STATE = "doc_id {}, text string, n_pieces long, pieces binary, n_tokens long, n_encoded long"


def _columns(ids: list, texts: list[CountedText]) -> tuple:
    rows = [(t.text, t.n, t.tree.values().tobytes(), t.n_tokens, t.encoded) for t in texts]
    return ids, *(list(c) for c in zip(*rows, strict=True))


def _edits(edits: Column) -> Column:
    return F.transform(
        edits, lambda e: F.struct(e.start.cast("long").alias("start"), e.stop.cast("long").alias("stop"), e.new.alias("new"))
    ).alias("edits")


def _shared(spark, tokenizer: str):
    spec = read_spec(tokenizer)
    return spark.sparkContext.broadcast((spec, by_rank(spec)))


def count_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The state of every document: text, number of pieces, the lengths and token counts of its pieces, n_tokens, pieces encoded.

    The tokenizer must be byte-level without added prefix space. A NULL text counts as empty, with no token.
    Ids may have any type. Every row gives one row; nothing is shuffled.
    """
    shared = _shared(docs.sparkSession, tokenizer)

    def start():
        c = Counter(*shared.value)
        return lambda ids, texts: _columns(ids, [CountedText.of(t or "", c) for t in texts]) if ids else None

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return map_batches(rows, start, STATE.format(docs.schema[id_col].dataType.simpleString()), at_once=ROWS_AT_ONCE)


def count_edited(docs: DataFrame, tokenizer: str, edits: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_pieces, n_tokens_after, n_encoded): counts of each text, and after its edits, in one pass.

    ``edits`` is as for ``apply_edits``; ``n_encoded`` is the number of pieces that they encode again.
    """
    shared = _shared(docs.sparkSession, tokenizer)

    def start():
        c = Counter(*shared.value)

        def step(ids, texts, edits):
            out = []
            for text, changes in zip(texts, edits, strict=True):
                t = CountedText.of(text or "", c)
                before, t.encoded = (t.n_tokens, t.n), 0
                t.apply(changes, c)
                out.append((*before, t.n_tokens, t.encoded))
            return (ids, *(list(x) for x in zip(*out, strict=True))) if ids else None

        return step

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), _edits(edits))
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, n_pieces long, n_tokens_after long, n_encoded long"
    return map_batches(rows, start, schema)


def with_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """The state with a column ``edits`` from rows (doc_id, seq, start, stop, new), in order of ``seq``.

    Documents without edits have NULL. An edit of a document that isn't there is ignored. Edits of a row's id
    apply to each row of that id.
    """
    lists = edits.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "new"))).alias("edits")
    )
    keyed = lists.withColumnRenamed("doc_id", "edited_id")
    return state.join(keyed, state["doc_id"].eqNullSafe(keyed["edited_id"]), "left").drop("edited_id")


def apply_edits(state: DataFrame, tokenizer: str, *, carry: tuple[str, ...] = ()) -> DataFrame:
    """The state after each row's ``edits`` (array of structs with start, stop, new; places in code points).

    Each edit refers to the text as the edits before left it; places beyond the text's end mean its end, a
    NULL place means 0 and a NULL ``new`` is empty. ``n_encoded`` is the number of pieces encoded again. The columns named
    in ``carry`` go along.
    """
    shared = _shared(state.sparkSession, tokenizer)

    def start():
        c = Counter(*shared.value)

        def step(ids, texts, pieces, edits, *carried):
            done = []
            for text, values, changes in zip(texts, pieces, edits, strict=True):
                t = CountedText(text, PieceTree(np.frombuffer(values, dtype="<u4").reshape(2, -1)))
                t.apply(changes, c)
                done.append(t)
            return (*_columns(ids, done), *carried) if ids else None

        return step

    asked = state.select("doc_id", "text", "pieces", _edits(F.col("edits")), *carry)
    more = "".join(f", `{c}` {state.schema[c].dataType.simpleString()}" for c in carry)
    return map_batches(asked, start, STATE.format(state.schema["doc_id"].dataType.simpleString()) + more, at_once=ROWS_AT_ONCE)
