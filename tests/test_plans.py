"""What the plans look like: pruning, pushdown, no cross joins, hot keys split or combined."""

from contextlib import ExitStack

import pytest
from pyspark.sql import functions as F

from tablewright import (
    anti_join,
    apply_parent_delete,
    apply_parent_update,
    foreign_key_orphans,
    outer_join,
    semi_join,
    upsert,
)
from tablewright.operators.reuse import session_setting
from tablewright.plans.catalogue import CATALOGUE
from tablewright.plans.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan adaptive execution ended with."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


@pytest.fixture
def hot_settings(spark):
    """Joins shuffle, and a partition counts as skewed at a size that a test can make."""
    with ExitStack() as stack:
        for key, value in {
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        }.items():
            stack.enter_context(session_setting(spark, key, value))
        yield


@pytest.fixture
def big(spark):
    """A third of the rows hold key 7, another sixth have none."""
    k = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 != 1, F.col("id")).cast("bigint")
    return spark.range(0, 300_000, 1, 8).select(
        k.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("text")
    )


@pytest.fixture
def small(spark):
    return spark.range(0, 100_000).selectExpr("id AS k", "id * 2 AS n")


def test_hot_key_is_split(hot_settings, big, small):
    assert "skew=true" in final_plan(outer_join(big, small, "k", "left"))
    assert "skew=true" in final_plan(outer_join(small, big, "k", "left"))
    assert "skew=true" in final_plan(outer_join(small, big, "k", "full"))
    assert "skew=true" in final_plan(semi_join(big, small, "k"))
    assert "skew=true" in final_plan(anti_join(big, small, "k"))


def test_outer_join_shuffles_each_side_once(hot_settings, spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    orders = tables.orders.select("o_orderkey", "o_custkey")
    final = final_plan(outer_join(orders, orders.alias("b").select("o_custkey"), "o_custkey", "full"))
    assert final.split("== Initial Plan ==")[0].count("ReusedExchange") >= 2


def test_hot_foreign_key_is_split(hot_settings, big, small):
    for action in ("cascade", "set_null"):
        assert "skew=true" in final_plan(apply_parent_delete(big, "k", small, "k", action))
    changes = small.selectExpr("k AS old", "n AS new")
    assert "skew=true" in final_plan(apply_parent_update(big, "k", changes))


def test_hot_side_of_a_check_is_combined_first(hot_settings, big, small):
    text = plan(foreign_key_orphans(big, "k", small, "k"))
    assert text.index("partial_count") > 0 and "text" not in text


def test_many_null_keys_in_the_target_are_split(hot_settings, spark, small):
    k = F.when(F.col("id") % 3 != 0, F.col("id"))
    target = spark.range(0, 300_000, 1, 8).select(
        k.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("n")
    )
    batch = small.select("k", F.col("n").cast("string").alias("n"))
    assert "skew=true" in final_plan(upsert(target, batch, "k"))
    assert "skew=true" in final_plan(upsert(target, batch, "k", condition="source.n > target.n"))


def test_small_batch_leaves_the_target_unshuffled(spark):
    target = Tables(spark, "/root/testdata/sf0.1").lineitem.select("l_orderkey", "l_quantity")
    batch = spark.createDataFrame([(1, 2.0)], "l_orderkey bigint, l_quantity double")
    for options in ({}, {"condition": "source.l_quantity > target.l_quantity"}, {"action": "nothing"}):
        df = upsert(target, batch, "l_orderkey", **options)
        text = final_plan(df)
        final = text.split("== Initial Plan ==")[0]
        assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final


def test_scans_are_pruned_and_filters_pushed(spark):
    tables = Tables(spark, FOLDER)
    text = plan(CATALOGUE["filter_eq"].run(spark, tables))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
    text = plan(CATALOGUE["segment_priority_report"].run(spark, tables))
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderpriority:string>" in text


# The others write when called, and what they return is a plain scan.
LAZY = [n for n in sorted(CATALOGUE) if not n.startswith(("jdbc", "src_", "sink_", "cache"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_rows(spark, name):
    text = plan(CATALOGUE[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "RDDScan"):
        assert operator not in text


@pytest.mark.parametrize(
    "name",
    ["proj_arith", "proj_cast", "join_mixed_keys", "fn_to_date", "fn_to_timestamp", "struct_to_map",
     "split_columns", "evolve_schema", "upsert_update", "fk_set_default"],
)
def test_same_result_without_ansi(spark, name):
    def run():
        return sorted((tuple(r) for r in CATALOGUE[name](spark, FOLDER).collect()), key=repr)

    with_ansi = run()
    with session_setting(spark, "spark.sql.ansi.enabled", "false"):
        assert run() == with_ansi


@pytest.mark.parametrize(
    ("name", "key"),
    [
        ("sort_cols", lambda r: (r.o_orderpriority, r.o_orderstatus, r.o_orderkey)),
        ("sort_mixed", lambda r: (r.c_mktsegment, -r.c_acctbal, r.c_custkey)),
        ("sort_sql", lambda r: (r.c_mktsegment, -r.c_acctbal, r.c_custkey)),
        ("filter_sort_project", lambda r: (r.l_extendedprice, r.l_orderkey, r.l_linenumber)),
        ("top_k", lambda r: r.pos),
        ("sort_groups", lambda r: r.pos),
        ("segment_priority_report", lambda r: (r.c_mktsegment, r.o_orderpriority)),
    ],
)
def test_row_order(spark, name, key):
    rows = CATALOGUE[name](spark, FOLDER).collect()
    if "pos" in rows[0]:
        rows.sort(key=lambda r: r.pos)
        assert [r.pos for r in rows] == list(range(1, len(rows) + 1))
    assert rows == sorted(rows, key=key)
