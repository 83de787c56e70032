import struct
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm.bpe import read_spec
from tablewright.llm.token_files import SpacedEncoder, read_tokens, write_tokens
from tablewright.sources.scratch import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "one two", None, "", "a  b", " a b ", "a \nb", "a\n b", "a\t\n b", "<|endoftext|> x", "don 't", "a\n\n b\n", "  ",
    "a\x1c b", "a\x85 b", "日本語 テスト 🙂", "naïve Größe, çà", "word " * 3000, "x" * 5000, "1 22 333, (a) [b]",
]


def expected(rows):
    library = Tokenizer.from_file(PATH)
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("block,shards", [(7, 3), (64, 1), (1 << 16, 4)])
def test_round_trip(spark, block, shards):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    path = scratch_path(spark, "test-tokens")
    write_tokens(docs, path, PATH, end_id=2, block=block, shards=shards)
    key = lambda r: r[1]
    want = expected(rows)
    assert [tuple(r) for r in sorted(read_tokens(spark, path, digest=True).collect(), key=key)] == [w[:4] for w in want]
    got = sorted(read_tokens(spark, path).collect(), key=key)
    assert [list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) for r in got] == [w[4] for w in want]


def test_damage_is_seen(spark):
    path = scratch_path(spark, "test-tokens")
    write_tokens(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), path, PATH, end_id=2)
    bad = path + "-bad"
    spark.read.parquet(path).withColumn("crc32", F.col("crc32") + 1).write.parquet(bad)
    with pytest.raises(Exception, match="damaged"):
        read_tokens(spark, bad).collect()


def test_empty_table(spark):
    path = scratch_path(spark, "test-tokens")
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, PATH, end_id=2)
    assert read_tokens(spark, path).count() == 0


@pytest.mark.parametrize("blank", ["\u00a0", "\u3000", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\u2003", "\u2028", "\u200b", "\ufeff"])
def test_words_that_begin_with_white_space(blank):
    library = Tokenizer.from_file(PATH)
    cut = SpacedEncoder(read_spec(PATH))
    for n in range(4):
        for text in ("x\n{}foo bar", "x {}foo bar", "{}foo", "x\n{}", "x\n{} y", "x\n {}y", "x{}\ny", "x\n{}1, (a)", "{}\nfoo", "x{}y z"):
            text = text.format(blank * n)
            ids = library.encode(text, add_special_tokens=False).ids
            assert cut.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_signs_after_a_word_cost_no_encoding_of_the_word():
    library = Tokenizer.from_file(PATH)
    cut = SpacedEncoder(read_spec(PATH))
    asked, tokenize = [], cut.model.tokenize
    cut.rest.tokenize = lambda word: asked.append(word) or tokenize(word)
    text = "x naming naming$$$ naming,%%% naming\nnaming... naming\n\"naming! größer größer&& naming'' naming's (naming) a.b 3rd ª!"
    ids = library.encode(text, add_special_tokens=False).ids
    assert cut.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert [w for w in asked if w.endswith("naming")] == ["\u0120naming"]


@pytest.mark.parametrize("sign", [*"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'", "'s", "'s,", "'ll!", "1", "_a"])
def test_words_and_signs(sign):
    library = Tokenizer.from_file(PATH)
    cut = SpacedEncoder(read_spec(PATH))
    for text in ("x foo{}", "foo{} foo{}", "x\nfoo{0}{0} y\nfoo{0}.{0}", "é{}\né{} É{}x", "{0} {0}{0}\n{0}\nx {0}"):
        text = text.format(sign, sign, sign)
        ids = library.encode(text, add_special_tokens=False).ids
        assert cut.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)
