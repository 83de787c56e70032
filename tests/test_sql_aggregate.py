import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright import drop_aggregate, register_aggregate

STEPS = dict(
    reduce=lambda rows: pd.DataFrame({"total": rows["cents"].sum(), "n": rows["cents"].count()}),
    merge=lambda buffers: buffers.sum(),
    finish=lambda b: pd.DataFrame({"mean": (b["total"] / b["n"]).where(b["n"] > 0)}),
    buffer_schema="total bigint, n bigint",
    output_schema="mean double",
)
CALL = """SELECT * FROM mean_of(TABLE(
    SELECT * FROM mean_of_part(TABLE(SELECT {columns} FROM {rows}))
) PARTITION BY shop)"""


@pytest.fixture
def mean_of(spark):
    register_aggregate(spark, "mean_of", keys="shop string", **STEPS)
    yield
    drop_aggregate(spark, "mean_of")


def test_means(spark, mean_of):
    rows = spark.createDataFrame(
        [("a", 1), ("a", 4), ("b", 7), (None, 5), (None, 6), ("c", None)], "shop string, cents long"
    ).repartition(4)
    got = spark.sql(CALL.replace("{columns}", "cents, shop AS SHOP, 'x' AS other"), rows=rows)
    assert got.columns == ["shop", "mean"]
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 2.5), ("b", 7.0), ("c", None), (None, 5.5)]


def test_no_rows(spark, mean_of):
    rows = spark.createDataFrame([], "shop string, cents long")
    assert spark.sql(CALL.replace("{columns}", "*"), rows=rows).collect() == []


@pytest.mark.parametrize("max_buffers", [1, 50, 100_000])
def test_many_keys_and_a_hot_one(spark, max_buffers):
    register_aggregate(spark, "mean_hot", keys="shop long", max_buffers=max_buffers, **STEPS)
    rows = spark.range(0, 20_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("shop"), F.col("id").alias("cents")
    )
    got = spark.sql(CALL.replace("mean_of", "mean_hot").replace("{columns}", "*"), rows=rows)
    drop_aggregate(spark, "mean_hot")
    assert {r.shop: r.mean for r in got.collect()} == {r[0]: r[1] for r in rows.groupBy("shop").avg("cents").collect()}


def test_without_keys(spark):
    register_aggregate(spark, "mean_all", keys="", **STEPS)
    sql = """SELECT mean FROM mean_all(TABLE(
        SELECT * FROM mean_all_part(TABLE(SELECT id AS cents FROM {rows}))) WITH SINGLE PARTITION)"""
    assert [tuple(r) for r in spark.sql(sql, rows=spark.range(11)).collect()] == [(5.0,)]
    drop_aggregate(spark, "mean_all")


def test_zeros_are_one_key(spark):
    register_aggregate(spark, "mean_zero", keys="shop double", **STEPS)
    rows = spark.createDataFrame([(0.0, 1), (-0.0, 3)], "shop double, cents long")
    got = spark.sql(CALL.replace("mean_of", "mean_zero").replace("{columns}", "*"), rows=rows).collect()
    drop_aggregate(spark, "mean_zero")
    assert [tuple(r) for r in got] == [(0.0, 2.0)]


def test_buffers_and_not_rows_are_shuffled(spark, mean_of):
    rows = spark.range(0, 100_000, 1, 4).select(F.lit("a").alias("shop"), F.col("id").alias("cents"))
    got = spark.sql(CALL.replace("{columns}", "*"), rows=rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "mean_of(" in above and "mean_of_part(" in below
    assert got.count() == 1


def test_refusals(spark):
    with pytest.raises(ValueError, match="at once"):
        register_aggregate(spark, "bad", keys="mean double", **STEPS)
    with pytest.raises(ValueError, match="nested"):
        register_aggregate(spark, "bad", keys="k array<int>", **STEPS)
