import hashlib
import struct
from fractions import Fraction

import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
from tablewright.llm.quality_rules import RULES
from tests.llm import test_decontaminate, test_line_dedup, test_ngram_join, test_quality_rules

FOLDER = "/root/testdata/sf0.001"


def good(text):
    m = test_quality_rules.brute(text)
    if m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]:
        return False
    return all(
        (r.low is None or m[r.measure] >= Fraction(r.low) * m[r.per])
        and (r.high is None or m[r.measure] <= Fraction(r.high) * m[r.per])
        for r in RULES
    )


def expected(rows, items):
    rows = [r for r in rows if good(r[1])]
    rows = [r[:2] for r in test_line_dedup.brute(rows)]
    groups = test_ngram_join.brute(rows, 5, 80)
    rows = [r for r, (i, _, least) in zip(rows, groups, strict=True) if i == least]
    rows = [r for r in rows if not test_decontaminate.brute(r[1], items)[-1]]
    library, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        out.append((i, len(ids), digest, hashlib.sha256(back.encode()).hexdigest()))
    return out


def test_against_brute_force(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    got = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    want = sorted(expected([(d["doc_id"], d["text"]) for d in docs], items))
    assert got == want and 0 < len(got) < len(docs)


def test_stages_keep_the_columns(spark):
    rows = [(i, f"The text of document {i} is here and it is long enough to be kept by all of the rules that there are. {i}", "en", "s", 5) for i in range(3)]
    rows += [(3, None, None, None, None), (None, rows[0][1] + " more", "en", None, 1), (1, rows[1][1], "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for part in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, part, FOLDER)
            assert made.schema == docs.schema
            assert made.count() == 0 or part is docs
