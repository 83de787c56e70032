import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tablewright.llm.bpe import read_spec
from tablewright.llm.token_counts import PIECE, CountedText, Counter, PieceTree, apply_edits, count_tokens, with_edits

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
BITS = [" ", "  ", "\n", "\t\n ", "a", "word", " two", ",", "'s", "é", "\x1c", "\x85", "日本", "<|endoftext|>", "12", "🙂", ""]


def full(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_edits_equal_counting_anew():
    rng = random.Random(2)
    counts = Counter(read_spec(PATH), True)
    say = lambda n: "".join(rng.choices(BITS, k=rng.randint(0, n)))
    for _ in range(300):
        t = CountedText.of(say(30), counts)
        assert t.n_tokens == full(t.text)
        for _ in range(6):
            a = rng.randint(0, len(t.text))
            b = rng.choice([a, rng.randint(a, len(t.text)), len(t.text) + 3])
            new, old = say(4), t.text
            t.edit(a, b, new, counts)
            assert t.text == old[:a] + new + old[b:]
            assert t.n_tokens == full(t.text), (old, a, b, new)
            assert t.tree.root.chars == len(t.text)


def test_only_the_neighbourhood_is_encoded():
    counts = Counter(read_spec(PATH), True)
    t = CountedText.of("some words here " * 2000, counts)
    for _ in range(5):
        t.encoded = 0
        t.edit(9000, 9004, "other", counts)
        assert t.encoded <= 6
    assert t.n_tokens == full(t.text)


def depth(node):
    return 1 + max(map(depth, node.children)) if hasattr(node, "children") else 1


def test_tree():
    rng = random.Random(3)
    for n in (0, 1, 5, 127, 128, 129, 300, 40_000):
        pieces = [(rng.randint(1, 5), rng.randint(0, 3)) for _ in range(n)]
        t = PieceTree.of([p[0] for p in pieces], [p[1] for p in pieces])
        for _ in range(40):
            first = rng.randint(0, len(pieces))
            last = rng.choice([first, min(len(pieces), first + rng.randint(0, 400)), len(pieces) if n < 1000 else first])
            new = [(rng.randint(1, 5), rng.randint(0, 3)) for _ in range(rng.choice([0, 1, 2, 300]))]
            pieces[first:last] = new
            t.splice(first, last, np.array(new, dtype="<u4").reshape(-1, 2).T)
            assert t.values().T.tolist() == [list(p) for p in pieces]
            root = t.root
            assert (root.n, root.chars, root.tokens) == (len(pieces), sum(p[0] for p in pieces), sum(p[1] for p in pieces))
        starts = np.cumsum([0, *(p[0] for p in pieces)]).tolist()
        for k in rng.sample(range(len(pieces)), min(30, len(pieces))):
            assert t.find(starts[k]) == t.find(starts[k + 1] - 1) == (k, starts[k], pieces[k][0])
        assert depth(t.root) <= 4


def test_an_insertion_makes_one_path_anew():
    t = PieceTree.of([4] * 1_000_000, [1] * 1_000_000)
    for _ in range(50):
        t.touched = 0
        t.splice(500_000, 500_000, np.array([[3, 3], [1, 1]], dtype="<u4"))
        assert t.touched <= 8
    assert (t.root.n, t.root.chars, t.root.tokens) == (1_000_100, 4_000_300, 1_000_100)


def test_query_equals_the_library(spark):
    """The query's three edits, done to each text by hand, and its counts by encoding the whole text."""
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries()["op3_token_counts"](spark, folder).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        n = len(text)
        after, pieces = text, 0
        for start, stop, new in ((n // 3, int(n / 3 + 20), ""), (n // 2, n // 2, " a few new words"), (n - 5, n, ". The end")):
            start, stop = min(max(start, 0), len(after)), min(max(stop, start, 0), len(after))
            before, after = after, after[:start] + new + after[stop:]
            old, now = PIECE.findall(before), PIECE.findall(after)
            same = 0  # pieces that differ, between equal ones at both ends
            while same < min(len(old), len(now)) and old[same] == now[same]:
                same += 1
            tail = 0
            while tail < min(len(old), len(now)) - same and old[-1 - tail] == now[-1 - tail]:
                tail += 1
            pieces += len(now) - same - tail
        assert (got[i].n_tokens, got[i].n_pieces, got[i].n_tokens_after) == (full(text), len(PIECE.findall(text)), full(after))
        # what changed and at most the neighbours of each edit
        assert pieces <= got[i].n_pieces_encoded <= pieces + 12


def test_operator(spark):
    texts = [(1, "one two three"), (2, None), (3, ""), (None, "no id here"), (4, "again"), (4, "again"), (5, "long " * 20000)]
    docs = spark.createDataFrame([(*r, "clash") for r in texts], "doc_id long, text string, n_tokens string")
    edits = [(1, 2, 0, 3, "uno"), (1, 1, 0, 0, "x "), (2, 1, 0, 5, "new"), (None, 1, 2, 3, None), (9, 1, 0, 0, "gone"), (4, 1, None, None, "so ")]
    frame = spark.createDataFrame(edits, "doc_id long, seq int, start long, stop long, new string")
    state = count_tokens(docs, PATH)
    assert {(r.doc_id, r.n_tokens) for r in state.collect()} == {(i, full(t or "")) for i, t in texts}
    after = {(r.doc_id, r.text): (r.n_tokens, r.n_encoded) for r in apply_edits(with_edits(state, frame), PATH).collect()}
    expected = {(1, "unone two three"), (2, "new"), (3, ""), (None, "noid here"), (4, "so again"), (5, "long " * 20000)}
    assert set(after) == expected
    assert all(n == full(t) for (_, t), (n, _) in after.items())
    assert after[(5, "long " * 20000)][1] == 0
    assert apply_edits(with_edits(state.limit(0), frame), PATH).count() == 0
