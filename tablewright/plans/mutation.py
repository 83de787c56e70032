"""Table mutation, constraint checks and schema changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright import (
    AddColumn,
    CastColumn,
    DropColumn,
    NumberedSchema,
    RenameColumn,
    apply_parent_delete,
    apply_parent_update,
    delete_from_files,
    delete_where,
    differences,
    evolve_schema,
    foreign_key_orphans,
    incremental_append,
    incremental_rows,
    latest_snapshot,
    primary_key_violations,
    read_by_id,
    repeated_keys,
    save_by_id,
    unique_violations,
    upsert,
    upsert_files,
    upsert_partitions,
    watermark,
)
from tablewright.plans.registry import query
from tablewright.sources.scratch import scratch_path

# -- upsert ----------------------------------------------------------------------


def _accounts(t):
    return t.customer.select("c_custkey", "c_name", "c_acctbal")


def _batch(t):
    """Changed balances for one segment, and the suppliers as new accounts."""
    changed = t.customer.where("c_mktsegment = 'BUILDING'").select(
        "c_custkey", F.upper("c_name").alias("c_name"), (1000 - F.col("c_acctbal")).alias("c_acctbal")
    )
    new = t.supplier.select(
        (F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return changed.unionByName(new)


_BATCH = """batch AS (SELECT c_custkey, upper(c_name) AS c_name, 1000 - c_acctbal AS c_acctbal
    FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT s_suppkey + 1000000000, s_name, s_acctbal FROM supplier)"""


@query(
    f"""WITH {_BATCH} SELECT c_custkey, c_name, c_acctbal FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM batch) UNION ALL SELECT * FROM batch"""
)
def upsert_update(spark, t):
    return upsert(_accounts(t), _batch(t), "c_custkey")


@query(
    f"""WITH {_BATCH} SELECT c_custkey, c_name, c_acctbal FROM customer
    UNION ALL SELECT * FROM batch WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)"""
)
def upsert_nothing(spark, t):
    return upsert(_accounts(t), _batch(t), "c_custkey", action="nothing")


@query(
    f"""WITH {_BATCH} SELECT c.c_custkey,
    CASE WHEN b.c_acctbal > c.c_acctbal THEN b.c_name ELSE c.c_name END AS c_name,
    CASE WHEN b.c_acctbal > c.c_acctbal THEN b.c_acctbal ELSE c.c_acctbal END AS c_acctbal
    FROM customer c LEFT JOIN batch b ON c.c_custkey = b.c_custkey
    UNION ALL SELECT * FROM batch WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)"""
)
def upsert_conditional(spark, t):
    return upsert(
        _accounts(t), _batch(t), "c_custkey", condition="source.c_acctbal > target.c_acctbal"
    )


@query(
    f"""WITH {_BATCH} SELECT c.c_custkey, c.c_name, coalesce(b.c_acctbal, c.c_acctbal) AS c_acctbal
    FROM customer c LEFT JOIN batch b ON c.c_custkey = b.c_custkey
    UNION ALL SELECT c_custkey, NULL, c_acctbal FROM batch
    WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)"""
)
def upsert_partial(spark, t):
    return upsert(_accounts(t), _batch(t).drop("c_name"), "c_custkey")


@query(
    """WITH newest AS (SELECT o_custkey, max_by(o_totalprice, o_orderkey) AS price FROM orders
    GROUP BY o_custkey)
    SELECT c_custkey, c_name, coalesce(price, c_acctbal) AS c_acctbal
    FROM customer LEFT JOIN newest ON c_custkey = o_custkey"""
)
def upsert_latest_wins(spark, t):
    # Many orders per customer in one batch: the greatest order key wins.
    batch = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderkey"
    )
    return upsert(_accounts(t), batch, "c_custkey", order_by="o_orderkey")


@query(
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 2001 AND o_orderstatus = 'F' THEN 0 ELSE o_totalprice
    END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders"""
)
def upsert_partitions_(spark, t):
    # The batch holds orders of one year: the files of the other years stay.
    year = F.year("o_orderdate").alias("order_year")
    path = scratch_path(spark, "by-year")
    orders = t.orders.select("o_orderkey", "o_totalprice", year)
    orders.hint("rebalance", "order_year").write.partitionBy("order_year").parquet(path)
    recent = "o_orderdate >= DATE '2001-01-01' AND o_orderdate < DATE '2002-01-01'"
    finished = t.orders.where(f"o_orderstatus = 'F' AND {recent}")
    batch = finished.select("o_orderkey", F.lit(0.0).alias("o_totalprice"), year)
    upsert_partitions(path, batch, ["order_year", "o_orderkey"], "order_year")
    return spark.read.parquet(path)


@query(
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) = 3 AND o_orderstatus = 'F' THEN 0 ELSE o_totalprice
    END AS o_totalprice, CAST(month(o_orderdate) AS INTEGER) AS order_month FROM orders"""
)
def upsert_partitions_padded(spark, t):
    # Folders order_month=01 to order_month=12, which Spark reads as whole numbers.
    month = F.date_format("o_orderdate", "MM").alias("order_month")
    path = scratch_path(spark, "by-month")
    orders = t.orders.select("o_orderkey", "o_totalprice", month)
    orders.hint("rebalance", "order_month").write.partitionBy("order_month").parquet(path)
    finished = t.orders.where("o_orderstatus = 'F' AND month(o_orderdate) = 3")
    batch = finished.select("o_orderkey", F.lit(0.0).alias("o_totalprice"), month)
    upsert_partitions(path, batch, ["order_month", "o_orderkey"], "order_month")
    return spark.read.parquet(path)


@query(
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
    WHERE o_orderpriority <> '1-URGENT'"""
)
def delete_where_(spark, t):
    rows = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return delete_where(rows, "priority = '1-URGENT'")


@query(
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE NOT (o_orderdate >= DATE '2001-01-01' AND o_orderdate < DATE '2001-03-01' AND o_totalprice < 100000)"""
)
def delete_from_files_(spark, t):
    # Files hold ranges of dates, so those of other months keep their names.
    path = scratch_path(spark, "orders")
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    orders.repartitionByRange(16, "o_orderdate").write.parquet(path)
    early = "o_orderdate >= DATE '2001-01-01' AND o_orderdate < DATE '2001-03-01'"
    delete_from_files(spark, path, f"{early} AND o_totalprice < 100000")
    return spark.read.parquet(path)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 7 AND o_orderstatus = 'F' THEN 0 ELSE o_totalprice
    END AS o_totalprice FROM orders UNION ALL SELECT -c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def upsert_files_(spark, t):
    # Both kinds of rows have a key 0, as -0 is 0, so the kind is part of the key.
    path, kind = scratch_path(spark, "orders"), lambda name: F.lit(name).alias("kind")
    orders = t.orders.select(kind("order"), "o_orderkey", "o_totalprice")
    orders.repartitionByRange(16, "o_orderkey").write.parquet(path)
    changed = t.orders.where("o_orderkey % 1000 = 7 AND o_orderstatus = 'F'").select(kind("order"), "o_orderkey", F.lit(0.0).alias("o_totalprice"))
    added = t.customer.where("c_mktsegment = 'BUILDING'").select(kind("customer"), -F.col("c_custkey"), "c_acctbal")
    upsert_files(path, changed.union(added), ["kind", "o_orderkey"])
    return spark.read.parquet(path).drop("kind")


# -- incremental load ------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 500 = 3 THEN 'missing' ELSE 'changed' END AS change
    FROM orders WHERE o_orderkey % 500 = 3 OR o_orderkey % 700 = 11 AND o_totalprice <> 1
    UNION ALL SELECT c_custkey + 1000000000, c_mktsegment, c_acctbal, 'deleted' FROM customer WHERE c_custkey % 100 = 1"""
)
def late_rows(spark, t):
    # The target lacks some old orders, holds others with an old price, and some that the source has deleted.
    source = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    old_price = F.when(F.col("o_orderkey") % 700 == 11, 1.0).otherwise(F.col("o_totalprice"))
    held = source.where("o_orderkey % 500 <> 3").withColumn("o_totalprice", old_price)
    gone = t.customer.where("c_custkey % 100 = 1").select(F.col("c_custkey") + 1000000000, "c_mktsegment", "c_acctbal")
    path = scratch_path(spark, "held-orders")
    held.union(gone).write.parquet(path)
    return differences(source, spark.read.parquet(path), "o_orderkey")


def _orders(t):
    # The column as stored: a comparison with it can skip row groups, one with a cast cannot.
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")


def _loaded(t):
    return _orders(t).where("o_orderdate < DATE '2000-01-01'")


def _text(df):
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    return df.select("o_orderkey", day, "o_totalprice")


_DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day"


@query(
    f"""SELECT o_orderkey, {_DAY}, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) >
    (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderdate < DATE '2000-01-01')"""
)
def incremental_rows_(spark, t):
    return _text(incremental_rows(_orders(t), _loaded(t), "o_orderdate"))


@query(f"SELECT o_orderkey, {_DAY}, o_totalprice FROM orders")
def incremental_append_(spark, t):
    # Late rows on the last loaded day are taken too, by key.
    late = _loaded(t).where("o_totalprice < 300000 OR o_orderdate < DATE '1999-12-31'")
    return _text(incremental_append(_orders(t), late, "o_orderdate", inclusive=True, keys="o_orderkey"))


@query(
    """SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS update_from FROM orders
    WHERE o_orderdate < DATE '2000-01-01'"""
)
def incremental_watermark(spark, t):
    mark = watermark(_orders(t), _loaded(t), "o_orderdate")
    return mark.select(F.date_format("update_from", "yyyy-MM-dd").alias("update_from"))


@query(
    f"""SELECT o_orderkey, {_DAY}, o_totalprice FROM orders
    WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)"""
)
def latest_snapshot_(spark, t):
    return _text(latest_snapshot(_orders(t), "o_orderdate"))


# -- constraint checks -----------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1"""
)
def check_unique(spark, t):
    return unique_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM (SELECT l_orderkey, l_linenumber FROM lineitem
    UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 50 = 0) GROUP BY ALL HAVING count(*) > 1"""
)
def check_unique_sparse(spark, t):
    # Nearly all keys are there once: only their hashes are shuffled.
    again = t.orders.where("o_orderkey % 50 = 0").selectExpr("o_orderkey", "1")
    return repeated_keys(t.lineitem.select("l_orderkey", "l_linenumber").union(again), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT nullif(user_id, 0) AS user_id, event_type, count(*) AS n_rows,
    CASE WHEN nullif(user_id, 0) IS NULL THEN 'null' ELSE 'duplicate' END AS reason
    FROM events GROUP BY 1, 2 HAVING count(*) > 1 OR nullif(user_id, 0) IS NULL"""
)
def check_primary_key(spark, t):
    rows = t.events.select(F.nullif("user_id", F.lit(0)).alias("user_id"), "event_type")
    return primary_key_violations(rows, ["user_id", "event_type"])


@query(
    """SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey NOT IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') GROUP BY o_custkey"""
)
def check_foreign_key(spark, t):
    kept = t.customer.where("c_mktsegment <> 'MACHINERY'")
    return foreign_key_orphans(t.orders, "o_custkey", kept, "c_custkey")


def _children(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


def _closed(t):
    return t.customer.where("c_mktsegment = 'MACHINERY'").select("c_custkey")


_CLOSED = "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')"


@query(f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN {_CLOSED}")
def fk_cascade(spark, t):
    return apply_parent_delete(_children(t), "o_custkey", _closed(t), "c_custkey", "cascade")


@query(
    f"""SELECT o_orderkey, CASE WHEN o_custkey NOT IN {_CLOSED} THEN o_custkey END AS o_custkey,
    o_totalprice FROM orders"""
)
def fk_set_null(spark, t):
    return apply_parent_delete(_children(t), "o_custkey", _closed(t), "c_custkey", "set_null")


@query(
    f"""SELECT o_orderkey, CASE WHEN o_custkey IN {_CLOSED} THEN -1 ELSE o_custkey END AS o_custkey,
    o_totalprice FROM orders"""
)
def fk_set_default(spark, t):
    return apply_parent_delete(
        _children(t), "o_custkey", _closed(t), "c_custkey", "set_default", {"o_custkey": -1}
    )


@query(
    f"""SELECT o_orderkey, CASE WHEN o_custkey IN {_CLOSED} THEN o_custkey + 1000000000 ELSE o_custkey END
    AS o_custkey, o_totalprice FROM orders"""
)
def fk_update_cascade(spark, t):
    changes = _closed(t).select(
        F.col("c_custkey").alias("old"), (F.col("c_custkey") + 1_000_000_000).alias("new")
    )
    return apply_parent_update(_children(t), "o_custkey", changes, "cascade")


@query(
    """SELECT p_partkey, p_name AS title, CAST(trunc(p_retailprice) AS INTEGER) AS p_retailprice,
    CAST(NULL AS INTEGER) AS p_type, 'EUR' AS currency FROM part"""
)
def evolve_schema_(spark, t):
    return evolve_schema(
        t.part,
        [
            RenameColumn("p_name", "title"),
            DropColumn("p_brand"),
            DropColumn("p_size"),
            CastColumn("p_retailprice", "int"),
            CastColumn("p_type", "int"),
            AddColumn("currency", "string", "EUR"),
        ],
    )


@query(
    """SELECT o_orderkey, o_totalprice AS price, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority
    FROM orders"""
)
def evolve_by_id(spark, t):
    # Odd orders are written before the changes, even ones after; no file is written twice.
    path = scratch_path(spark, "orders-by-id")
    old = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    schema = NumberedSchema.of(old.schema)
    save_by_id(old.where("o_orderkey % 2 <> 0"), schema, path)
    changes = [RenameColumn("o_totalprice", "price"), DropColumn("o_orderstatus"), AddColumn("priority", "string")]
    schema = schema.changed(spark, changes)
    new = t.orders.where("o_orderkey % 2 = 0")
    save_by_id(
        new.select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")),
        schema,
        path,
    )
    return read_by_id(spark, schema, path)
