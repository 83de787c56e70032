import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablewright.llm.bpe import MergeTable, PrefixBpe, decode, encode, read_spec, round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "a", "AbC's don't we'LL", "x<|endoftext|>y <|startoftext|>", "日本語 テスト", "İstanbul ΣΑΣ Σ",
    "éä ﬁ", "a b c\x1cd\x85e", "\t\r\n\x0b", "!!!!????...", "1234567890", "𝒳𝒴 🙂🙂👍🏽", "</w> a</w>b", "ab" * 3000,
    "é ë́", "\x00\x01\x7f", "ǅ ß ẞ K", "ｶﾞ ①②½", "¡½²­\xa0ñ", "the" * 400, "naïve café " * 500,
]


def library():
    return Tokenizer.from_file(PATH)


def test_same_ids_and_text_as_the_library():
    ours, theirs = PrefixBpe(read_spec(PATH)), library()
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzeeeaaaiiotnséüñ"
    made = ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(4000)]
    for text in [t or "" for t in TEXTS] + made:
        ids = theirs.encode(text, add_special_tokens=False).ids
        got = ours.encode(text)
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == ids, text[:50]
        assert ours.decode(got) == theirs.decode(ids, skip_special_tokens=False)


def merged(symbols, ranks):
    symbols = list(symbols)
    while True:
        pairs = [(ranks.get((a, b), 1e9), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
        if not pairs or min(pairs)[0] == 1e9:
            return symbols
        i = min(pairs)[1]
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def test_small_models_against_merging_by_rank():
    rng = random.Random(1)
    for _ in range(150):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 12:
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens:
                tokens.append(a + b)
                merges.append((a, b))
        table = MergeTable({t: i for i, t in enumerate(tokens)}, merges)
        ranks = {m: i for i, m in enumerate(merges)}
        for x in tokens:
            assert table.is_sound(tokens.index(x)) == (merged(x, ranks) == [x])
            for y in tokens:
                if merged(x, ranks) == [x] and merged(y, ranks) == [y]:
                    expected = merged(x + y, ranks) == [x, y]
                    assert table.compatible(tokens.index(x), tokens.index(y)) == expected, (x, y, merges)


def test_operator(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "y"), (3, "a", "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    theirs = library()
    expected = []
    for i, text, _ in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        back = theirs.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256(back.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, round_trip(docs, PATH).collect()), key=key) == sorted(expected, key=key)
    texts = {r.doc_id: r.text for r in decode(encode(docs.filter("ids = 'x'"), PATH), PATH).collect()}
    assert texts[4] == theirs.decode(theirs.encode(TEXTS[4], add_special_tokens=False).ids, skip_special_tokens=False)
    assert round_trip(docs.limit(0), PATH).count() == 0


def test_refuses_what_it_cannot_do(tmp_path):
    with pytest.raises(ValueError):
        PrefixBpe('{"model": {"type": "WordPiece"}}')
    with pytest.raises(ValueError):
        read_spec(PATH, most_bytes=10)


def test_trie_finds_every_token_that_ends_at_a_place():
    from tablewright.llm.bpe import SuffixLinkTrie

    vocabulary = {t: n for n, t in enumerate(["a", "b", "ab", "ba", "bab", "abba", "aabb"])}
    text = "abbabaabbabbb"
    want = [
        [(k, vocabulary[text[end - k : end]]) for k in range(end, 0, -1) if text[end - k : end] in vocabulary]
        for end in range(len(text) + 1)
    ]
    assert [list(x) for x in SuffixLinkTrie(vocabulary).ends(text)] == want
