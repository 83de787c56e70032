import os
import time

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from tablewright import cached
from tablewright.operators.reuse import session_setting
from tablewright.sources.scratch import clear_scratch, keyed_data, scratch_path


def test_scratch_is_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base) and first != second


def test_modified_before_and_after(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = spark.range(5)
    rows.coalesce(1).write.parquet(path)
    (part,) = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    old = time.mktime((2010, 1, 1, 0, 0, 0, 0, 0, 0))
    os.utime(part, (old, old))
    for option, found in (("modifiedBefore", 5), ("modifiedAfter", 0)):
        reader = spark.read.schema(rows.schema).option(option, "2020-06-01T05:30:00")
        assert reader.parquet(path).count() == found


def test_session_setting_is_put_back(spark):
    key = "spark.sql.files.ignoreCorruptFiles"
    before = spark.conf.get(key)
    with pytest.raises(KeyError), session_setting(spark, key, "true"):
        assert spark.conf.get(key) == "true"
        raise KeyError
    assert spark.conf.get(key) == before
    with session_setting(spark, "spark.tablewright.some", "1"):
        assert spark.conf.get("spark.tablewright.some") == "1"
    assert spark.conf.get("spark.tablewright.some", None) is None


@pytest.mark.parametrize("level", [StorageLevel.MEMORY_ONLY, StorageLevel.MEMORY_AND_DISK,
                                   StorageLevel.DISK_ONLY, StorageLevel.MEMORY_ONLY_2])
def test_cached(spark, level):
    df = spark.range(10).selectExpr("id * 2 AS x")
    with cached(df, level) as held:
        assert held.count() == 10 and held.storageLevel.useMemory == level.useMemory
        assert "InMemory" in held._jdf.queryExecution().executedPlan().toString()
    assert not df.is_cached
    with pytest.raises(RuntimeError), cached(df):
        raise RuntimeError
    assert not df.is_cached


def test_keyed_data(spark):
    df = keyed_data(spark, 200, value_bytes=100, partitions=4, seed=1)
    again = keyed_data(spark, 200, value_bytes=100, partitions=2, seed=1)
    assert df.dtypes == [("key", "int"), ("value", "binary")]
    assert df.count() == 200 and df.selectExpr("min(length(value))", "max(length(value))").first()[:] == (100, 100)
    assert sorted(df.collect()) == sorted(again.collect())
    assert sorted(keyed_data(spark, 200, 100, seed=2).collect()) != sorted(df.collect())
    assert df.select("key").distinct().count() > 190


def test_rows_and_layout(spark):
    from_rows = spark.createDataFrame([(1, "a")], "k int, v string")
    renamed = spark.createDataFrame([(1, "a")]).toDF("k", "v")
    assert from_rows.collect() == renamed.collect()
    df = spark.range(100, numPartitions=8)
    assert df.coalesce(3).rdd.getNumPartitions() == 3
    sorted_parts = df.repartitionByRange(4, "id").sortWithinPartitions("id")
    assert [r[0] for r in sorted_parts.collect()] == list(range(100))


def test_write_layouts(spark, tmp_path):
    rows = spark.range(100).selectExpr("id AS k", "id % 3 AS p", "CAST(id AS string) AS s")
    path = str(tmp_path / "parts")
    rows.write.partitionBy("p").parquet(path)
    assert {d for d in os.listdir(path) if d.startswith("p=")} == {"p=0", "p=1", "p=2"}
    text = str(tmp_path / "text")
    rows.select("s").write.option("compression", "gzip").text(text)
    assert all(f.endswith(".gz") for f in os.listdir(text) if f.startswith("part"))


def test_buckets_spare_the_shuffle(spark):
    names = ["bucketed_left", "bucketed_right"]
    try:
        for i, name in enumerate(names):
            df = spark.range(1000).selectExpr("id AS k", f"id * {i + 1} AS v{i}")
            df.write.mode("overwrite").bucketBy(4, "k").sortBy("k").option(
                "path", scratch_path(spark, name)
            ).saveAsTable(name)
        assert spark.catalog.tableExists(names[0])
        with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            joined = spark.table(names[0]).join(spark.table(names[1]), "k")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and joined.count() == 1000
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not spark.catalog.tableExists(names[0])


def test_actions(spark, capsys):
    df = spark.range(5).selectExpr("id", "id * 2 AS x")
    assert (df.count(), df.first().x, len(df.take(2)), len(df.collect())) == (5, 0, 2, 5)
    df.orderBy("id").show(2)
    df.printSchema()
    out = capsys.readouterr().out
    assert "|  1|  2|" in out and "|-- x: long" in out


def test_declared_types(spark):
    ddl = "a array<string>, m map<string,struct<city:string,n:int>>, b binary, d date"
    df = spark.createDataFrame([(["x", None], {"k": ("Rome", 1)}, bytearray(b"z"), None)], ddl)
    assert df.selectExpr("a[0]", "m['k'].city", "length(b)", "d").first()[:] == ("x", "Rome", 1, None)


def test_partition_numbers(spark):
    def count(batches):
        for rows in batches:
            yield rows.groupby("part", as_index=False).size()

    df = spark.range(0, 40, 1, 4).select(F.spark_partition_id().alias("part"))
    got = df.mapInPandas(count, "part int, size long").collect()
    assert sorted(tuple(r) for r in got) == [(i, 10) for i in range(4)]


def test_clear_scratch(spark, tmp_path, monkeypatch):
    from tablewright.sources import scratch

    own = str(tmp_path / "application")
    monkeypatch.setattr(scratch, "_scratch", lambda s: own)
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.exists(path)
    clear_scratch(spark)
    assert not os.path.exists(own) and os.path.exists(tmp_path)


def test_partitions_and_buckets_are_few_files(spark, tmp_path):
    from tablewright.plans.files import bucketed

    rows = spark.range(0, 20000, 1, 16).selectExpr("id AS k", "id % 3 AS p")
    path = str(tmp_path / "parts")
    rows.hint("rebalance", "p").write.partitionBy("p").parquet(path)
    assert sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs) == 3
    pruned = spark.read.parquet(path).where("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p#" in pruned
    names = ["few_left", "few_right"]
    try:
        for name in names:
            place = str(tmp_path / name)
            bucketed(rows, "k", 6).write.bucketBy(6, "k").sortBy("p").option("path", place).saveAsTable(name)
            assert sum(f.endswith(".parquet") for f in os.listdir(place)) <= 2 * 6
        with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            joined = spark.table(names[0]).join(spark.table(names[1]), "k")
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            assert joined.count() == 20000
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_written_options_are_in_the_files(spark, tmp_path, monkeypatch):
    import pyarrow.orc as orc
    import pyarrow.parquet as pq

    from tablewright.plans import files
    from tablewright.plans.registry import Tables

    for query, suffix in ((files.sink_parquet_opts, ".parquet"), (files.sink_orc, ".orc")):
        monkeypatch.setattr(files, "scratch_path", lambda s, label: str(tmp_path / label))
        query(spark, Tables(spark, "/root/testdata/sf0.001"))
    part = next(tmp_path.glob("parquet-options/*.parquet"))
    types = pq.read_metadata(part).row_group(0).column(1)
    assert types.path_in_schema == "event_type" and not any("DICTIONARY" in e for e in types.encodings)
    plain = str(tmp_path / "plain")
    rows = spark.read.parquet(str(tmp_path / "parquet-options")).coalesce(1)
    rows.write.option("parquet.enable.dictionary", "false").parquet(plain)
    # the bloom filter, asked for a thousand values, is over a kilobyte that a plain file has not
    assert part.stat().st_size > next((tmp_path / "plain").glob("*.parquet")).stat().st_size + 1000
    written = orc.ORCFile(next(tmp_path.glob("orc/*.orc")))
    assert written.nrows > 0
