"""Operators that keep most rows or keys out of the shuffle: the same results, and how much is shuffled."""

import os

import pytest
from pyspark.sql import functions as F

from tablewright import repeated_keys, semi_join, sifted_semi_join, skipped_files, unique_violations
from tablewright.operators import uniqueness
from tablewright.operators.reuse import session_setting


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shuffled(df, metric):
    """The sum of a metric over the exchanges of the plan that ran."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    total, waiting = 0, [execution.executedPlan()]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            waiting.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply(metric).value()
        children = node.children()
        waiting += [children.apply(k) for k in range(children.size())]
    return total


@pytest.mark.parametrize("per_range,batch", [(100, 1000), (10**6, 10**6)])
def test_repeated_keys(spark, monkeypatch, per_range, batch):
    monkeypatch.setattr(uniqueness, "SLOTS_PER_RANGE", per_range)
    monkeypatch.setattr(uniqueness, "BATCH_SLOTS", batch)
    once = spark.range(0, 20_000, 1, 6).selectExpr("id AS a", "CAST(id AS string) AS b", "id AS other")
    more = spark.range(0, 20_000, 1, 3).where("id % 997 = 1").selectExpr("id AS a", "CAST(id AS string) AS b", "-id")
    hot = spark.range(3000).selectExpr("7 AS a", "'7' AS b", "id")
    nulls = spark.range(5).selectExpr("CAST(NULL AS bigint) AS a", "'x' AS b", "id")
    df = once.union(more).union(hot).union(nulls)
    assert rows(repeated_keys(df, ["A", "b"])) == rows(unique_violations(df, ["a", "b"]))
    assert rows(repeated_keys(df.limit(0), ["a", "b"])) == []
    floats = spark.createDataFrame([(float("nan"),), (float("nan"),), (0.0,), (-0.0,), (1.0,)], "x double")
    assert len(rows(repeated_keys(floats, "x"))) == len(rows(unique_violations(floats, "x"))) == 2


def test_repeated_keys_shuffle_little(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(0, 1_000_000, 1, 8).select(F.sha1(F.col("id").cast("string")).alias("k")).write.parquet(path)
    keys = spark.read.parquet(path)
    sparse, plain = repeated_keys(keys, "k"), unique_violations(keys, "k")
    assert rows(sparse) == []
    few = shuffled(sparse, "dataSize")
    assert few < shuffled(plain, "dataSize") / 5


def test_sifted_semi_join(spark):
    left = spark.range(0, 100_000, 1, 8).selectExpr("IF(id % 11 = 0, NULL, id) AS k", "id AS v")
    for right in (
        spark.range(50).selectExpr("CAST(id * 977 AS int) AS k"),
        spark.range(50).selectExpr("id * 977 AS k").union(spark.range(9).selectExpr("CAST(NULL AS bigint)")),
        spark.range(0).selectExpr("id AS k"),
        spark.range(200_000).selectExpr("id AS k"),
    ):
        for bits in (None, 1 << 15):
            assert rows(sifted_semi_join(left, right, "k", bits=bits)) == rows(semi_join(left, right, "k"))


def test_sifted_rows_are_not_shuffled(spark, tmp_path):
    spark.range(0, 200_000, 1, 8).selectExpr("id * 3 AS k", "id AS v").write.parquet(str(tmp_path / "a"))
    spark.range(0, 5_000, 1, 4).selectExpr("id * 30 AS k").write.parquet(str(tmp_path / "b"))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), session_setting(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"):
        sifted = sifted_semi_join(left, right, "k")
        records = shuffled(sifted, "shuffleRecordsWritten")
        assert shuffled(semi_join(left, right, "k"), "shuffleRecordsWritten") > 200_000
    # those that meet, one in sixteen of the others, and the right side's own
    assert records < 5_000 + 200_000 / 12 + 20_000
    assert rows(sifted) == rows(semi_join(left, right, "k"))


def test_skipped_files(spark, tmp_path):
    top = tmp_path / "odd names+%41"
    spark.range(10).write.parquet(str(top / "good"))
    spark.range(0).write.parquet(str(top / "none"))
    (top / "bad").mkdir()
    (top / "bad" / "x.parquet").write_bytes(b"no such format")
    (top / "bad" / "y z.parquet").write_bytes(b"")  # no file at all to Spark
    (top / "bad" / "_hidden").write_bytes(b"mark")
    found = rows(skipped_files(spark, str(top), schema="id bigint"))
    assert sorted((os.path.basename(os.path.dirname(p)), n if r == "unreadable" else None, r) for p, n, r in found) == [
        ("bad", 14, "unreadable"), ("none", None, "empty"),
    ]
