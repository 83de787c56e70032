"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright import anti_join, outer_join, semi_join, sifted_semi_join
from tablewright.plans.registry import query


def _richest(t):
    """Customers with a high balance: one side of the outer joins, so both sides keep unmatched rows."""
    return t.customer.where("c_acctbal > 5000").select("c_custkey", "c_name")


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey")


_RICHEST = "(SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000)"


@query(
    """SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey"""
)
def join_inner(spark, t):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select("o_orderkey", "c_name", "n_name")
    )


@query(f"SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN {_RICHEST} ON o_custkey = c_custkey")
def join_left(spark, t):
    # Many orders to one customer: a plain left join, whose left side may be split.
    joined = _orders(t).join(_richest(t), F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select("o_orderkey", "o_custkey", "c_name")


@query(f"SELECT o_orderkey, c_custkey, c_name FROM orders RIGHT JOIN {_RICHEST} ON o_custkey = c_custkey")
def join_right(spark, t):
    orders = _orders(t).withColumnRenamed("o_custkey", "c_custkey")
    return outer_join(orders, _richest(t), "c_custkey", "right").select("o_orderkey", "c_custkey", "c_name")


@query(
    f"""SELECT coalesce(o_custkey, c_custkey) AS custkey, o_orderkey, c_name
    FROM orders FULL JOIN {_RICHEST} ON o_custkey = c_custkey"""
)
def join_full(spark, t):
    orders = _orders(t).withColumnRenamed("o_custkey", "custkey")
    customers = _richest(t).withColumnRenamed("c_custkey", "custkey")
    return outer_join(orders, customers, "custkey", "full").select("custkey", "o_orderkey", "c_name")


@query(
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
    (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"""
)
def join_semi(spark, t):
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return semi_join(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN
    (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'F')"""
)
def join_semi_sifted(spark, t):
    few = t.orders.where("o_totalprice > 400000 AND o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return sifted_semi_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), few, "l_orderkey")


@query(
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_totalprice > 400000 AND o_custkey = c_custkey)"""
)
def join_anti(spark, t):
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return anti_join(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@query(
    """SELECT a.o_orderkey, a.o_orderkey // 10 AS superior_key, b.o_orderpriority AS superior_priority
    FROM orders a JOIN orders b ON a.o_orderkey // 10 = b.o_orderkey"""
)
def join_self(spark, t):
    orders = t.orders.withColumn("superior_key", F.expr("o_orderkey div 10"))
    return (
        orders.alias("a")
        .join(orders.alias("b"), F.col("a.superior_key") == F.col("b.o_orderkey"), "inner")
        .select("a.o_orderkey", "a.superior_key", F.col("b.o_orderpriority").alias("superior_priority"))
    )


@query("SELECT c_custkey, n_name FROM customer c, nation n WHERE c.c_nationkey = n.n_nationkey")
def join_sql_comma(spark, t):
    return spark.sql(
        "SELECT c_custkey, n_name FROM {c} c, {n} n WHERE c.c_nationkey = n.n_nationkey",
        c=t.customer,
        n=t.nation,
    )


@query("SELECT s_suppkey, n_name FROM supplier s INNER JOIN nation n ON s.s_nationkey = n.n_nationkey")
def join_sql_inner(spark, t):
    t.supplier.createOrReplaceTempView("tablewright_supplier")
    t.nation.createOrReplaceTempView("tablewright_nation")
    return spark.sql(
        """SELECT s_suppkey, n_name FROM tablewright_supplier s
        INNER JOIN tablewright_nation n ON s.s_nationkey = n.n_nationkey"""
    )


@query(
    """SELECT l_orderkey AS orderkey, l_linenumber, l_partkey, o_orderstatus
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def join_using(spark, t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey")
    return lines.join(t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus"), "orderkey")


@query(
    """SELECT c_custkey, status, coalesce(n_orders, 0) AS n_orders
    FROM (SELECT c_custkey, status FROM customer CROSS JOIN (VALUES ('F'), ('O'), ('P')) s(status))
    FULL JOIN (SELECT o_custkey AS c_custkey, o_orderstatus AS status, count(o_orderkey) AS n_orders
    FROM orders GROUP BY 1, 2) USING (c_custkey, status)"""
)
def join_cross(spark, t):
    # Every customer with every status of a fixed list: the product is an explode, three rows
    # per customer, and counts of the pairs that occur fill it. Pairs beyond the list stay too.
    statuses = F.array(*[F.lit(s) for s in ("F", "O", "P")])
    pairs = t.customer.select("c_custkey", F.explode(statuses).alias("status"))
    counts = t.orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status")
    ).agg(F.count("o_orderkey").alias("n_orders"))
    return pairs.join(counts, ["c_custkey", "status"], "full").fillna(0, ["n_orders"])


@query(
    """SELECT s_suppkey, n_name FROM (SELECT s_suppkey, CASE WHEN s_nationkey < 3 THEN 'none'
    ELSE CAST(s_nationkey AS VARCHAR) END AS nation_text FROM supplier)
    JOIN nation ON TRY_CAST(nation_text AS INTEGER) = n_nationkey"""
)
def join_mixed_keys(spark, t):
    text = F.when(F.col("s_nationkey") < 3, "none").otherwise(F.col("s_nationkey").cast("string"))
    suppliers = t.supplier.select("s_suppkey", text.alias("nation_text"))
    on = F.col("nation_text").try_cast("int") == F.col("n_nationkey")
    return suppliers.join(t.nation, on).select("s_suppkey", "n_name")


@query(
    """SELECT coalesce(a.k, b.k) AS nationkey, customers, balance, suppliers FROM
    (SELECT c_nationkey AS k, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE)
    AS balance FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1) a
    FULL JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1) b ON a.k = b.k"""
)
def cogroup(spark, t):
    # Both groups are folded before they meet: only one row per key and side is joined.
    customers = (
        t.customer.where("c_mktsegment = 'BUILDING'")
        .groupBy(F.col("c_nationkey").alias("nationkey"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            (F.sum(F.rint(F.col("c_acctbal") * 100).cast("bigint")).cast("double") / 100).alias("balance"),
        )
    )
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    return customers.join(suppliers, "nationkey", "full")


# -- set operations --------------------------------------------------------------


@query(
    """SELECT c_nationkey AS nationkey, c_name AS name FROM customer
    UNION ALL SELECT s_nationkey, s_name FROM supplier
    UNION ALL SELECT s_nationkey, s_name FROM supplier"""
)
def union_all(spark, t):
    customers = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"))
    suppliers = t.supplier.select("s_nationkey", "s_name")
    return customers.union(suppliers).unionAll(suppliers)


@query(
    """SELECT o_custkey AS custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '2-HIGH'"""
)
def union_distinct(spark, t):
    rows = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderstatus")
    urgent = rows.where(F.col("o_orderpriority") == "1-URGENT")
    high = rows.where(F.col("o_orderpriority") == "2-HIGH")
    return urgent.union(high).distinct()


@query(
    """SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
    INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"""
)
def intersect(spark, t):
    # Distinct on both sides first: otherwise every row of a hot key is shuffled.
    finished = t.orders.where("o_orderstatus = 'F'").select("o_custkey").distinct()
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    return finished.intersect(urgent)
