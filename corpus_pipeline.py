"""A corpus clean-up in stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.bpe import round_trip
from tablewright.llm.decontaminate import without_benchmark
from tablewright.llm.line_dedup import clean_lines
from tablewright.llm.ngram_join import one_of_each_group
from tablewright.llm.quality_rules import keep_good
from tablewright.plans.registry import Query, Tables
from tablewright.sources.scratch import scratch_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in the last of them; ``n_chars``, if there is one, follows the text."""
    cleaned = clean_lines(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return one_of_each_group(docs, words=5, percent=80)


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item."""
    return without_benchmark(docs, Tables(spark, sf_dir).benchmark)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and the digest of what they decode to."""
    return round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", own_lines),
    ("n-gram Jaccard join", no_near_copies),
    ("benchmark decontamination", no_benchmark_passages),
    ("BPE encoding and decoding", encoded),
]

#: Groups of similar texts and token ids are beyond SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


PIPELINE = Query("pipeline", lambda spark, tables: run(spark, tables.folder), ORACLE_SQL)
