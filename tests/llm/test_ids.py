"""Every operator with ids that are no whole numbers: the same results, in the ids' own order and type."""

import datetime

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tablewright.llm import bpe, decontaminate, license_scan, line_dedup, ngram_join, rows, substring_dedup, token_files
from tablewright.sources.scratch import scratch_path

FOLDER = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def token_files_of(docs, spark):
    path = scratch_path(spark, "test-ids")
    token_files.write_tokens(docs, path, BYTES, end_id=2)
    return token_files.read_tokens(spark, path, digest=True)


OPERATORS = {
    "lines": lambda d, b: line_dedup.dedupe_lines(d),
    "clean_lines": lambda d, b: line_dedup.clean_lines(d),
    "passages": lambda d, b: substring_dedup.remove_repeats(d),
    "groups": lambda d, b: ngram_join.jaccard_groups(d).drop("class"),
    "one_of_each": lambda d, b: ngram_join.one_of_each_group(d),
    "licenses": lambda d, b: license_scan.license_scan(d),
    "bpe": lambda d, b: bpe.round_trip(d, WORDS),
    "encode": lambda d, b: bpe.encode(d, WORDS),
    "benchmark": lambda d, b: decontaminate.find_passages(d, b),
    "files": lambda d, b: token_files_of(d, d.sparkSession),
}
TYPES = {
    "string": lambda c: F.concat(F.lit("http://x/"), F.lpad(c.cast("string"), 6, "0")),
    "date": lambda c: F.date_add(F.lit(datetime.date(2000, 1, 1)), c.cast("int")),
    "fraction": lambda c: c.cast("decimal(12,1)") + F.lit("0.5").cast("decimal(2,1)"),
}


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 60")
    extra = spark.createDataFrame(
        [(7, "again", None, None, 1), (7, "again", None, None, 1), (None, "no id " * 20, "en", "s", 3), (61, None, "en", "s", None), (62, "", "en", "s", 0)],
        given.schema,
    )
    path = scratch_path(spark, "test-ids-docs")
    given.unionByName(extra).write.parquet(path)
    return spark.read.parquet(path)


def shown(df, ids=None):
    known = ids or {}
    return sorted((tuple(known.get(v, v) if c in ("doc_id", "component_id") else v for c, v in zip(df.columns, r, strict=True)) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("name", "kind"), [(n, "string") for n in OPERATORS] + [("groups", "date"), ("lines", "fraction"), ("files", "date")])
def test_same_results(spark, docs, name, kind):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    turn = TYPES[kind]
    ids = {r[0]: r[1] for r in docs.select("doc_id", turn(F.col("doc_id"))).distinct().collect()}
    want = shown(OPERATORS[name](docs, benchmark), ids)
    other = docs.withColumn("doc_id", turn(F.col("doc_id"))).withColumn("id_number", F.lit("clash"))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        got = OPERATORS[name](other, benchmark)
        assert shown(got.drop("id_number")) == want
        assert got.schema["doc_id"].dataType == other.schema["doc_id"].dataType
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_null_ids_come_back_as_null(spark):
    frame = spark.createDataFrame([(None, "a b c d e f g"), (1, "a b c d e f g"), (2, "x")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in ngram_join.jaccard_groups(frame).collect()}
    assert got == {(None, None), (1, None), (2, 2)}
    assert {r.doc_id for r in ngram_join.one_of_each_group(frame).collect()} == {None, 2}


def test_an_index_of_lines_refuses_other_ids(spark):
    frame = spark.createDataFrame([("u", "a line")], "doc_id string, text string")
    with pytest.raises(ValueError, match="whole number"):
        line_dedup.LineIndex(spark).keys_of(frame)
    assert not rows.has_whole_ids(frame)
