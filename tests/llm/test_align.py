import random
from collections import Counter, defaultdict
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablewright.llm import align
from tablewright.llm.align import Aligner, align_tokens
from tablewright.llm.bpe import BYTE_CHARACTERS, read_spec
from tablewright.llm.byte_level import ByteLevel, by_rank
from tablewright.plans.registry import Tables

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"
TEXTS = [
    None, "", "a", " ", "two words", "  spaced   out ", "line\nend\n\n\ttab", "<|endoftext|> and <s> </s> <unk>", "日本語 テスト 🙂👍🏽", "naïve Größe",
    "x" * 500, "12345 678", "▁ lower block", "<0x41> byte name", "é combining", "\x00\x1c\x85 ", "a b", "''s don't", "word " * 5000,
    "ﬁ ligature Ａ", "​ zero width", "same text", "same text",
]


def brute_force(rows):
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: b for b, c in enumerate(BYTE_CHARACTERS)}
    found, count = [], Counter()
    for i, text in rows:
        tokens = []
        if text:
            a = [(n, bytes(back[c] for c in library.id_to_token(n))) for n in library.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for n in model.encode(text):
                piece = model.id_to_piece(n)
                is_byte = len(piece) == 6 and piece[:3] == "<0x" and piece[5] == ">"
                b.append((n, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
            if all(b"".join(x[1] for x in side) == (" " + text).encode() for side in (a, b)):
                tokens = [a, b]
        groups = []
        if tokens:
            ends = [list(_sums(side)) for side in tokens]
            groups = list(_cut(tokens, ends, sorted(set(ends[0]) & set(ends[1]))))
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        count.update(links.keys())
        found.append((i, [len(s) for s in tokens] or [0, 0], groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for i, (n_a, n_b), groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n_best = sum(t for (x, y), t in links.items() if count[x, y] == best[x])
        total = sum(t * count[p] for p, t in links.items())
        yield i, n_a, n_b, len(groups), sum(links.values()), n_best, total, sha256(text.encode()).hexdigest() if groups else ""


def _sums(side):
    at = 0
    for _, b in side:
        at += len(b)
        yield at


def _cut(tokens, ends, cuts):
    """The ids of each tokenizer between two cuts, from left to right."""
    at = [0, 0]
    for hi in cuts:
        group = []
        for k in (0, 1):
            start = at[k]
            while at[k] < len(ends[k]) and ends[k][at[k]] <= hi:
                at[k] += 1
            group.append([x[0] for x in tokens[k][start : at[k]]])
        yield tuple(group)


def assert_same(frame, rows, **options):
    got = align_tokens(frame, A, B, **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_force(rows), key=repr)


def test_given_documents(spark):
    docs = Tables(spark, "/root/testdata/sf0.001").documents
    assert_same(docs, [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("step,block,per_range", [(30, 50, 7), (1000, 10_000, 100)])
def test_small_blocks(spark, monkeypatch, step, block, per_range):
    monkeypatch.setattr(align, "STEP_CHARS", step)
    monkeypatch.setattr(align, "PAIRS_PER_RANGE", per_range)
    rows = [(k * 3, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again"), (3, "again"), (3, None)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", n_a int").repartition(4)
    assert_same(frame, rows, block_chars=block)


def test_ids_of_other_types_and_empty(spark):
    rows = [(f"u/{k}", t) for k, t in enumerate(TEXTS)] + [("", "x"), (None, "y")]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    for ansi in ("false", "true"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert_same(frame, rows)
    assert align_tokens(spark.createDataFrame([], SCHEMA), A, B).count() == 0
    rows = [(1, None), (2, "")]
    assert_same(spark.createDataFrame(rows, SCHEMA), rows)


def test_fast_encoder_gives_the_library_s_ids():
    spec = read_spec(A)
    assert by_rank(spec)
    sides = [(ByteLevel(spec, True, plain=plain), Tokenizer.from_file(A)) for plain in (True, False)]
    sides[0][1].encode_special_tokens = True
    rng = random.Random(4)
    letters = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(160, 592), 0x85, 0x1C, 0x3000, 0x4E00, 0x1F600]] + [" ", "\n", "the", " of", "'s", "<|endoftext|>"] * 20
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 25)))
        for encoder, library in sides:
            ids = library.encode(text, add_special_tokens=False).ids
            assert encoder.ids(text).tolist() == ids and encoder.count(text) == len(ids), repr(text)


def test_word_by_word_gives_the_whole_text_s_ids(monkeypatch):
    monkeypatch.setattr(align, "MOST_WORDS", 40)
    spec = read_spec(A)
    with open(B, "rb") as f:
        aligner = Aligner(spec, True, f.read())
    assert aligner.by_word
    library, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    rng = random.Random(6)
    bits = [" ", " ", " ", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "▁", "word", "Größe", "日本", "🙂", "a", "'s", ",", "\x85", "\u0301", "<s>", "x" * 120, "1"]
    for _ in range(300):
        texts = ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(8)]
        a, b = aligner.encode(texts)
        assert [i.tolist() for i in a] == [library.encode(" " + t, add_special_tokens=False).ids for t in texts]
        assert [i.tolist() for i in b] == model.encode(texts), texts
