import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tablewright import delete_from_files, delete_where, upsert, upsert_files
from tablewright.sources import swap


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(path):
    """Each data file below the folder with its time of change."""
    return {
        os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
        for d, _, names in os.walk(path)
        for n in names
        if n.endswith(".parquet")
    }


@pytest.fixture
def flat(spark, tmp_path):
    path = str(tmp_path / "flat table")
    spark.range(0, 1000, 1, 10).selectExpr("id", "CAST(id AS string) AS v").write.parquet(path)
    return path


@pytest.mark.parametrize("condition", ["id BETWEEN 120 AND 130", "id = 999", "id < 100", "v IS NULL", "id > 0"])
def test_delete(spark, flat, condition):
    want = rows(delete_where(spark.read.parquet(flat), condition))
    hit = {r[0] for r in spark.read.parquet(flat).where(condition).select(F.input_file_name()).distinct().collect()}
    before = files(flat)
    assert delete_from_files(spark, flat, condition) == len(hit)
    assert rows(spark.read.parquet(flat)) == want
    after = files(flat)
    assert len([f for f in before if after.get(f) == before[f]]) == 10 - len(hit)
    assert delete_from_files(spark, flat, condition) == 0
    assert files(flat) == after


def test_delete_everything_leaves_an_empty_table(spark, flat):
    delete_from_files(spark, flat, "id >= 0")
    assert not files(flat) or spark.read.parquet(flat).count() == 0


def test_delete_from_partitions(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(400).selectExpr("id", "CASE id % 4 WHEN 0 THEN '01' WHEN 1 THEN 'a/b' WHEN 2 THEN NULL ELSE 'x' END AS p").write.partitionBy("p").parquet(path)
    want = rows(spark.read.parquet(path).where("NOT id IN (0, 1, 2, 6)"))
    before = files(path)
    delete_from_files(spark, path, "id IN (0, 1, 2, 6)")
    assert rows(spark.read.parquet(path)) == want
    after = files(path)
    assert {f for f in before if "p=x" in f} <= set(after)


@pytest.mark.parametrize("options", [{}, {"action": "nothing"}, {"condition": "source.v > target.v"}], ids=str)
def test_upsert(spark, flat, options):
    batch = spark.createDataFrame([(5, "new"), (7, ""), (5000, "added"), (None, "no key")], "id bigint, v string")
    want = rows(upsert(spark.read.parquet(flat), batch, "id", **options))
    before = files(flat)
    assert upsert_files(flat, batch, "id", **options) == 1
    assert rows(spark.read.parquet(flat)) == want
    after = files(flat)
    assert len([f for f in before if after.get(f) == before[f]]) == 9


def test_upsert_of_new_keys_only_rewrites_nothing(spark, flat):
    before = files(flat)
    assert upsert_files(flat, spark.createDataFrame([(-1, "a")], "id bigint, v string"), "id") == 0
    assert before.items() <= files(flat).items()
    assert spark.read.parquet(flat).count() == 1001


def test_upsert_refuses_partitions(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(4).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(path)
    with pytest.raises(ValueError, match="upsert_partitions"):
        upsert_files(path, spark.createDataFrame([(1, 1)], "id bigint, p bigint"), "id")


def test_query_keeps_order_and_customer_of_key_zero(spark, tmp_path):
    spark.createDataFrame([(0, 5.0, "O"), (1007, 6.0, "F"), (2, 7.0, "F")], "o_orderkey bigint, o_totalprice double, o_orderstatus string").write.parquet(
        str(tmp_path / "orders.parquet")
    )
    spark.createDataFrame([(0, 8.0, "BUILDING"), (3, 9.0, "BUILDING"), (4, 1.0, "MACHINERY")], "c_custkey bigint, c_acctbal double, c_mktsegment string").write.parquet(
        str(tmp_path / "customer.parquet")
    )
    got = queries()["upsert_files"](spark, str(tmp_path))
    assert got.columns == ["o_orderkey", "o_totalprice"]
    assert sorted(rows(got)) == [(-3, 9.0), (0, 5.0), (0, 8.0), (2, 7.0), (1007, 0.0)]


@pytest.mark.parametrize("after", range(5))
def test_cut_short(spark, flat, monkeypatch, after):
    want = rows(spark.read.parquet(flat).where("id > 250"))
    done, move = [], swap.move

    def stopping(*a):
        if len(done) == after + 1:
            raise OSError("cut short")
        done.append(a)
        move(*a)

    monkeypatch.setattr(swap, "move", stopping)
    try:
        delete_from_files(spark, flat, "id <= 250")
    except OSError:
        pass
    monkeypatch.setattr(swap, "move", move)
    swap.finish_swap(spark, flat)
    assert rows(spark.read.parquet(flat)) == want
