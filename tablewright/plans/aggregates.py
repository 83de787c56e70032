"""Aggregation, pivot, sorting, user aggregates and reuse.

Sums of prices are sums of whole cents in a decimal: exact, without overflow, and so
the same however the rows are spread over tasks.
"""

from __future__ import annotations

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright import cached, drop_aggregate, numbered, register_aggregate, two_phase_aggregate, with_positions
from tablewright.plans.registry import query
from tablewright.sources.scratch import scratch_path


def _cents(column: str):
    # Rounded to whole cents as a number first: a direct cast from double to decimal is much slower.
    return F.rint(F.col(column) * 100).cast("bigint").cast("decimal(19,0)")


def _total(column: str):
    return F.sum(_cents(column)).cast("double") / 100


def _mean(column: str):
    return _total(column) / F.count(column)


# -- grouping --------------------------------------------------------------------


@query(
    """SELECT c_mktsegment, o_orderpriority, count(*) AS n_orders,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_price,
    max(o_totalprice) AS max_price
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_mktsegment, o_orderpriority
    HAVING max(o_totalprice) >= 400000 ORDER BY 1, 2"""
)
def segment_priority_report(spark, t):
    """Flagship: join, group, several aggregates, a filter on one, and a sort."""
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", "o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            _total("o_totalprice").alias("total_price"),
            _mean("o_totalprice").alias("avg_price"),
            F.max("o_totalprice").alias("max_price"),
        )
        .where("max_price >= 400000")
        .orderBy("c_mktsegment", "o_orderpriority")
    )


@query(
    """SELECT o_orderpriority, 'sum' AS measure, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
    AS value FROM orders GROUP BY 1
    UNION ALL SELECT o_orderpriority, 'count', count(*) FROM orders GROUP BY 1
    UNION ALL SELECT o_orderpriority, 'min', min(o_totalprice) FROM orders GROUP BY 1
    UNION ALL SELECT o_orderpriority, 'max', max(o_totalprice) FROM orders GROUP BY 1
    UNION ALL SELECT o_orderpriority, 'avg',
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) FROM orders GROUP BY 1"""
)
def agg_single(spark, t):
    # The single aggregates of the list share one pass; the names come from an unpivot.
    measures = t.orders.groupBy("o_orderpriority").agg(
        _total("o_totalprice").alias("sum"),
        F.count(F.lit(1)).cast("double").alias("count"),
        F.min("o_totalprice").alias("min"),
        F.max("o_totalprice").alias("max"),
        _mean("o_totalprice").alias("avg"),
    )
    return measures.unpivot(
        "o_orderpriority", ["sum", "count", "min", "max", "avg"], "measure", "value"
    )


@query(
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
    FROM lineitem GROUP BY ALL"""
)
def agg_multi_key(spark, t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("quantity"), _total("l_extendedprice").alias("price")
    )


@query(
    """SELECT l_suppkey, sum(l_quantity) AS quantity, sum(l_quantity) / count(l_quantity) AS avg_quantity,
    max(l_extendedprice) AS max_price, min(l_extendedprice) AS min_price, count(*) AS n
    FROM lineitem GROUP BY l_suppkey"""
)
def agg_multi(spark, t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("quantity"),
        F.avg("l_quantity").alias("avg_quantity"),
        F.max("l_extendedprice").alias("max_price"),
        F.min("l_extendedprice").alias("min_price"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
    FROM orders GROUP BY o_custkey HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) >= 3000000"""
)
def agg_having(spark, t):
    totals = t.orders.groupBy("o_custkey").agg(
        _total("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n")
    )
    return totals.where(F.col("total") >= 3000000)


@query(
    """SELECT count(*) AS n, max(l_extendedprice) AS max_price, min(l_quantity) AS min_quantity,
    count(DISTINCT l_orderkey) AS n_orders FROM lineitem"""
)
def agg_global(spark, t):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("l_extendedprice").alias("max_price"),
        F.min("l_quantity").alias("min_quantity"),
        F.countDistinct("l_orderkey").alias("n_orders"),
    )


@query("SELECT count(DISTINCT l_partkey) AS n_keys FROM lineitem")
def distinct_keys(spark, t):
    return t.lineitem.select("l_partkey").distinct().agg(F.count(F.lit(1)).alias("n_keys"))


@query(
    """SELECT o_orderstatus, o_orderkey // 1000 AS block, count(*) AS n,
    string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS order_keys
    FROM orders GROUP BY 1, 2"""
)
def group_collect(spark, t):
    # All values of a key, in blocks: order keys are unique, so a block holds at most a thousand
    # and no task ever gathers a whole hot key.
    blocks = t.orders.groupBy("o_orderstatus", F.expr("o_orderkey div 1000").alias("block"))
    return blocks.agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.sort_array(F.collect_list("o_orderkey")).cast("array<string>"), ",").alias(
            "order_keys"
        ),
    )


# -- pivot -----------------------------------------------------------------------


_PIVOT = """SELECT o_orderpriority,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS F,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS O,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS P
    FROM orders GROUP BY o_orderpriority"""


@query(_PIVOT)
def pivot(spark, t):
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(_total("o_totalprice"))


@query(_PIVOT)
def pivot_auto(spark, t):
    # One more pass finds the values; Spark refuses more than spark.sql.pivotMaxValues of them.
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus").agg(_total("o_totalprice"))


def _orders_by_customer(t):
    # Many a customer has no order of some status.
    return t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))


_UNPIVOT = """SELECT o_custkey, o_orderstatus AS status, count(*) AS total
    FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY ALL"""


@query(_UNPIVOT)
def unpivot(spark, t):
    wide = _orders_by_customer(t).select("o_custkey", "O", "P")
    return wide.unpivot("o_custkey", ["O", "P"], "status", "total").where("total IS NOT NULL")


@query(_UNPIVOT)
def unpivot_stack(spark, t):
    stacked = F.expr("stack(2, 'O', O, 'P', P) AS (status, total)")
    return _orders_by_customer(t).select("o_custkey", stacked).where("total IS NOT NULL")


# -- sorting ---------------------------------------------------------------------
# Each row tells its position. Each order ends in a unique key, so the range partitions of
# the sort stay even when one of the leading values is very frequent.


@query(
    """SELECT row_number() OVER (ORDER BY o_orderpriority, o_orderstatus, o_orderkey) AS pos,
    o_orderpriority, o_orderstatus, o_orderkey FROM orders"""
)
def sort_cols(spark, t):
    rows = t.orders.select("o_orderpriority", "o_orderstatus", "o_orderkey")
    return numbered(rows, F.col("o_orderpriority").asc(), F.asc("o_orderstatus"), "o_orderkey")


@query(
    """SELECT row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS pos,
    c_mktsegment, c_acctbal, c_custkey FROM customer"""
)
def sort_mixed(spark, t):
    rows = t.customer.select("c_mktsegment", "c_acctbal", "c_custkey")
    return numbered(rows, F.asc("c_mktsegment"), F.desc("c_acctbal"), F.asc("c_custkey"))


@query(
    """SELECT row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS pos,
    c_mktsegment, c_acctbal, c_custkey FROM customer"""
)
def sort_sql(spark, t):
    # The sort is SQL's; positions follow from the ranges it was sorted in.
    ordered = spark.sql(
        """SELECT c_mktsegment, c_acctbal, c_custkey FROM {customer}
        ORDER BY c_mktsegment ASC, c_acctbal DESC, c_custkey ASC""",
        customer=t.customer,
    )
    return with_positions(ordered)


@query(
    """SELECT row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pos,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_returnflag = 'R'"""
)
def filter_sort_project(spark, t):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return numbered(returned, "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    """SELECT row_number() OVER (ORDER BY total DESC, o_orderpriority, o_orderstatus) AS pos, * FROM
    (SELECT o_orderpriority, o_orderstatus, count(*) AS total FROM orders GROUP BY ALL)"""
)
def sort_groups(spark, t):
    # Positions are numbered after the aggregation, on one row per priority and status.
    counts = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("total"))
    order = Window.orderBy(F.desc("total"), F.asc("o_orderpriority"), F.asc("o_orderstatus"))
    return counts.select(F.row_number().over(order).cast("bigint").alias("pos"), "*")


@query(
    """SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos, o_orderkey, o_totalprice
    FROM orders ORDER BY pos LIMIT 10"""
)
def top_k(spark, t):
    best = t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
    # The window sees the ten rows only.
    order = Window.orderBy(F.desc("o_totalprice"), "o_orderkey")
    return best.select(F.row_number().over(order).cast("bigint").alias("pos"), "o_orderkey", "o_totalprice")


# -- sampling --------------------------------------------------------------------


@query(
    """SELECT event_id, event_type FROM events
    WHERE ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::UBIGINT < 429496729"""
)
def sample(spark, t):
    # A tenth of the rows, by a hash of the key: unlike a random sample, the same rows come
    # back however the input is partitioned and whichever tasks are repeated.
    part = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10).cast("bigint")
    return t.events.where(part < 429496729).select("event_id", "event_type")


@query("SELECT event_id, event_type FROM events ORDER BY md5('7-' || event_id), event_id LIMIT 50")
def take_sample(spark, t):
    # A sample of fixed size: the first rows by a hash of the key, kept per partition before they meet.
    digest = F.md5(F.concat(F.lit("7-"), F.col("event_id").cast("string")))
    return t.events.select("event_id", "event_type").orderBy(digest, "event_id").limit(50)


# -- user aggregates -------------------------------------------------------------


@query(
    """SELECT o_orderkey % 3 AS key, CAST(sum(o_custkey) AS BIGINT) AS total, count(o_custkey) AS n,
    CAST(sum(o_custkey) AS DOUBLE) / count(o_custkey) AS mean, CAST(min(o_custkey) AS DOUBLE) AS least,
    max(o_custkey) AS greatest FROM orders GROUP BY 1"""
)
def agg_typed(spark, t):
    return t.orders.groupBy((F.col("o_orderkey") % 3).alias("key")).agg(
        F.sum("o_custkey").alias("total"),
        F.count("o_custkey").alias("n"),
        F.avg("o_custkey").alias("mean"),
        F.min(F.col("o_custkey").cast("double")).alias("least"),
        F.max(F.col("o_custkey").cast("long")).alias("greatest"),
    )


@query("SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean FROM customer")
def uda_mean(spark, t):
    return two_phase_aggregate(
        t.customer.select(F.rint(F.col("c_acctbal") * 100).cast("bigint").alias("cents")),
        [],
        zero={"total": 0, "n": 0},
        reduce=lambda rows: pd.DataFrame({"total": rows["cents"].sum(), "n": rows["cents"].count()}),
        merge=lambda buffers: buffers.sum(),
        finish=lambda b: pd.DataFrame({"mean": (b["total"] / 100 / b["n"]).where(b["n"] > 0)}),
        buffer_schema="total bigint, n bigint",
        output_schema="mean double",
    )


@query(
    """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean,
    count(*) AS n, max(o_totalprice) AS greatest FROM orders GROUP BY o_custkey"""
)
def uda_two_phase(spark, t):
    # The whole contract: a three-part buffer, folded per task and merged per key.
    cents = F.rint(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    orders = t.orders.select("o_custkey", "o_totalprice", cents)
    return two_phase_aggregate(
        orders,
        "o_custkey",
        zero={"total": 0, "n": 0, "greatest": float("-inf")},
        reduce=lambda rows: pd.DataFrame(
            {"total": rows["cents"].sum(), "n": rows.size(), "greatest": rows["o_totalprice"].max()}
        ),
        merge=lambda buffers: buffers.agg({"total": "sum", "n": "sum", "greatest": "max"}),
        finish=lambda b: b.assign(mean=b["total"] / 100 / b["n"]),
        buffer_schema="total bigint, n bigint, greatest double",
        output_schema="mean double, n bigint, greatest double",
    )


@query(
    """SELECT c_mktsegment, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean
    FROM customer GROUP BY c_mktsegment"""
)
def uda_mean_sql(spark, t):
    # SQL would hand a Python aggregate whole groups. The two-phase form folds them per task, and SQL
    # reads its result like a table.
    means = two_phase_aggregate(
        t.customer.select("c_mktsegment", F.rint(F.col("c_acctbal") * 100).cast("bigint").alias("cents")),
        "c_mktsegment",
        zero={"total": 0, "n": 0},
        reduce=lambda rows: pd.DataFrame({"total": rows["cents"].sum(), "n": rows["cents"].count()}),
        merge=lambda buffers: buffers.sum(),
        finish=lambda b: pd.DataFrame({"mean": (b["total"] / 100 / b["n"]).where(b["n"] > 0)}),
        buffer_schema="total bigint, n bigint",
        output_schema="mean double",
    )
    return spark.sql("SELECT c_mktsegment, mean FROM {means}", means=means)


@query(
    """SELECT c_mktsegment, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean
    FROM customer GROUP BY c_mktsegment"""
)
def uda_called_in_sql(spark, t):
    # SQL text calls the aggregate itself: once to fold each task's rows, once to merge what was shuffled.
    register_aggregate(
        spark,
        "mean_cents",
        keys="c_mktsegment string",
        reduce=lambda rows: pd.DataFrame({"total": rows["cents"].sum(), "n": rows["cents"].count()}),
        merge=lambda buffers: buffers.sum(),
        finish=lambda b: pd.DataFrame({"mean": (b["total"] / 100 / b["n"]).where(b["n"] > 0)}),
        buffer_schema="total bigint, n bigint",
        output_schema="mean double",
    )
    means = spark.sql(
        """SELECT c_mktsegment, mean FROM mean_cents(TABLE(
            SELECT * FROM mean_cents_part(TABLE(
                SELECT c_mktsegment, CAST(rint(c_acctbal * 100) AS BIGINT) AS cents FROM {customer}))
        ) PARTITION BY c_mktsegment)""",
        customer=t.customer,
    )
    drop_aggregate(spark, "mean_cents")
    return means


# -- reuse -----------------------------------------------------------------------


@query(
    """SELECT 'listed' AS part, event_id, user_id, value FROM events WHERE event_type IN ('click', 'view')
    UNION ALL SELECT 'large', event_id, user_id, value FROM events WHERE value >= 30"""
)
def cache_reuse(spark, t):
    events = t.events.select("event_id", "user_id", "event_type", "value")
    path = scratch_path(spark, "cache-reuse")
    columns = ["event_id", "user_id", "value"]
    with cached(events, StorageLevel.MEMORY_AND_DISK) as shared:
        listed = shared.where(F.col("event_type").isin("click", "view")).select(*columns)
        listed.write.parquet(f"{path}/part=listed")
        shared.where(F.col("value") >= 30).select(*columns).write.parquet(f"{path}/part=large")
    return spark.read.parquet(path)
