"""Projections, filters, conditionals and scalar functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tablewright import capitalize_words, split_columns, struct_to_map
from tablewright.plans.registry import query

# -- projections -----------------------------------------------------------------


@query("SELECT c_custkey, c_name AS customer, c_mktsegment AS segment FROM customer")
def proj_select(spark, t):
    return t.customer.select(
        "c_custkey", F.col("c_name").alias("customer"), F.col("c_mktsegment").alias("segment")
    )


@query("SELECT *, p_retailprice * 2 AS doubled FROM part")
def proj_star_expr(spark, t):
    return t.part.select("*", (F.col("p_retailprice") * 2).alias("doubled"))


@query("SELECT n_nationkey, n_name, 'USA' AS country, 1 AS version FROM nation")
def proj_lit(spark, t):
    return t.nation.select("n_nationkey", "n_name").withColumns(
        {"country": F.lit("USA"), "version": F.lit(1)}
    )


@query(
    """SELECT p_partkey, CAST(CAST(p_size AS VARCHAR) AS DOUBLE) * 100 AS size_x100,
    p_partkey % 3 AS remainder FROM part"""
)
def proj_arith(spark, t):
    # The text is cast before the product: bare text * 100 has another type under ANSI rules.
    sizes = t.part.select("p_partkey", F.col("p_size").cast("string").alias("size_text"))
    return sizes.select(
        "p_partkey",
        (F.col("size_text").try_cast("double") * 100).alias("size_x100"),
        (F.col("p_partkey") % 3).alias("remainder"),
    )


@query("SELECT c_custkey, c_acctbal, c_acctbal * -1 AS copied FROM customer")
def proj_derive(spark, t):
    return t.customer.select("c_custkey", "c_acctbal").withColumn("copied", F.col("c_acctbal") * -1)


@query(
    """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_no,
    TRY_CAST(o_orderstatus AS INTEGER) AS status_no FROM orders"""
)
def proj_cast(spark, t):
    return t.orders.select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority_no"),
        F.col("o_orderstatus").try_cast("int").alias("status_no"),
    )


@query(
    """SELECT c_acctbal * 100 AS acctbal, c_acctbal * -1 AS copied, 'USA' AS country,
    c_custkey FROM customer"""
)
def proj_sql(spark, t):
    return spark.sql(
        """SELECT c_acctbal * 100 AS acctbal, c_acctbal * -1 AS copied, 'USA' AS country, c_custkey
        FROM {customer}""",
        customer=t.customer,
    )


@query("SELECT s_suppkey AS supplier_id, s_name FROM supplier")
def proj_rename(spark, t):
    return t.supplier.select("s_suppkey", "s_name").withColumnRenamed("s_suppkey", "supplier_id")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def proj_drop(spark, t):
    return t.supplier.drop("s_nationkey", "no_such_column")


@query("SELECT n_nationkey AS id, n_name AS label, n_regionkey AS parent FROM nation")
def proj_todf(spark, t):
    return t.nation.toDF("id", "label", "parent")


@query(
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS adjective, split_part(p_name, ' ', 2) AS noun,
    CAST(NULL AS VARCHAR) AS rest, split_part(p_brand, '#', 2) AS brand_no FROM part"""
)
def split_columns_(spark, t):
    return split_columns(
        t.part.withColumn("brand", F.col("p_brand")).select("p_partkey", "p_name", "brand"),
        {"p_name": (" ", ["adjective", "noun", "rest"]), "brand": ("#", ["_prefix", "brand_no"])},
    ).drop("_prefix")


@query("SELECT p_partkey, concat_ws(',', p_name, p_brand, p_type) AS full_name, p_size FROM part")
def map_rows(spark, t):
    return t.part.select(
        "p_partkey", F.concat_ws(",", "p_name", "p_brand", "p_type").alias("full_name"), "p_size"
    )


@query("SELECT p_partkey, concat_ws(',', p_name, p_brand, p_type) AS full_name, p_size FROM part")
def map_partitions(spark, t):
    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        separator = ","  # set up once per partition: where a costly client or model would be made
        for rows in batches:
            full_name, begun = pd.Series("", rows.index), pd.Series(False, rows.index)
            for part in ("p_name", "p_brand", "p_type"):  # missing parts are left out
                there = rows[part].notna()
                full_name += (begun & there).map({True: separator, False: ""}) + rows[part].fillna("")
                begun |= there
            yield rows[["p_partkey"]].assign(full_name=full_name, p_size=rows["p_size"])

    parts = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return parts.mapInPandas(combine, "p_partkey bigint, full_name string, p_size int")


@query("SELECT 'Name: ' || c_name AS label FROM customer WHERE c_acctbal BETWEEN 1000 AND 2000")
def map_format(spark, t):
    names = t.customer.where(F.col("c_acctbal").between(1000, 2000))
    return names.select(F.concat(F.lit("Name: "), "c_name").alias("label"))


# -- filters ---------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, t):
    return t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_sql(spark, t):
    return t.orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey")


@query(
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'"
)
def filter_and(spark, t):
    both = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.where(both).select("o_orderkey")


@query("SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'red')")
def filter_array(spark, t):
    words = t.part.select("p_partkey", "p_name", F.split("p_name", " ").alias("words"))
    return words.where(F.array_contains("words", "red")).drop("words")


@query("SELECT p_partkey, p_brand, p_type FROM part WHERE p_type = 'PROMO'")
def filter_nested(spark, t):
    nested = t.part.select("p_partkey", F.struct("p_brand", "p_type").alias("kind"))
    return nested.where(F.col("kind.p_type") == "PROMO").select("p_partkey", "kind.*")


@query("SELECT event_id, user_id FROM events WHERE event_type IN ('click', 'purchase')")
def filter_in(spark, t):
    return t.events.where(F.col("event_type").isin("click", "purchase")).select("event_id", "user_id")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 40 AND l_discount < 0.03")
def filter_cmp(spark, t):
    wanted = (F.col("l_quantity") >= 40) & (F.col("l_discount") < 0.03)
    return t.lineitem.where(wanted).select("l_orderkey", "l_linenumber")


@query("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 13 AND 19")
def filter_between(spark, t):
    return t.part.where(F.col("p_size").between(13, 19)).select("p_partkey", "p_size")


@query("SELECT event_id, event_type FROM events WHERE value > 10 AND length(event_type) = 5")
def filter_udf(spark, t):
    def short_type(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows[rows["event_type"].str.len() == 5]

    # Only the opaque test goes to Python; the scan takes the other.
    wanted = t.events.where("value > 10").select("event_id", "event_type")
    return wanted.mapInPandas(short_type, wanted.schema)


# -- conditionals ----------------------------------------------------------------


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Finished' WHEN o_orderstatus = 'O'
    THEN 'Open' ELSE 'Unknown' END AS status FROM orders"""
)
def when_otherwise(spark, t):
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "Finished").when(status == "O", "Open").otherwise("Unknown").alias("status"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low'
    ELSE 'high' END AS balance FROM customer"""
)
def case_when(spark, t):
    band = "CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END"
    return t.customer.select("c_custkey", F.expr(band).alias("balance"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' OR l_returnflag = 'R'
    THEN 'A' WHEN (l_returnflag = 'N' AND l_linestatus = 'O') OR l_quantity > 45 THEN 'B' ELSE 'C' END
    AS code FROM lineitem"""
)
def when_logic(spark, t):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when((flag == "A") | (flag == "R"), "A")
        .when(((flag == "N") & (status == "O")) | (F.col("l_quantity") > 45), "B")
        .otherwise("C")
        .alias("code"),
    )


# -- scalar functions ------------------------------------------------------------


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') || '-01' AS month_start FROM orders")
def fn_to_date(spark, t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    day = F.try_to_date("day", "yyyy-MM-dd")
    return text.select("o_orderkey", F.trunc(day, "month").cast("string").alias("month_start"))


@query(
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS stamp,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events"""
)
def fn_to_timestamp(spark, t):
    stamps = t.events.select(
        "event_id", F.date_format("ts", "yyyyMMddHHmmss").cast("bigint").alias("stamp")
    )
    parsed = F.try_to_timestamp(F.col("stamp").cast("string"), F.lit("yyyyMMddHHmmss"))
    return stamps.select(
        "event_id", "stamp", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("at")
    )


@query(
    """SELECT doc_id, len(string_split(text, ' ')) AS n_words,
    array_to_string(string_split(text, ' '), '|') AS words FROM documents"""
)
def fn_split(spark, t):
    words = F.split("text", " ")
    return t.documents.select(
        "doc_id", F.size(words).cast("bigint").alias("n_words"), F.array_join(words, "|").alias("words")
    )


@query("SELECT c_custkey, c_name || '/' || c_mktsegment AS states FROM customer")
def fn_array(spark, t):
    pair = t.customer.select("c_custkey", F.array("c_name", "c_mktsegment").alias("states"))
    return pair.select("c_custkey", F.array_join("states", "/").alias("states"))


@query("SELECT p_partkey, list_contains(string_split(p_name, ' '), 'bolt') AS is_bolt FROM part")
def fn_array_contains(spark, t):
    return t.part.select("p_partkey", F.array_contains(F.split("p_name", " "), "bolt").alias("is_bolt"))


@query(
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY word"""
)
def fn_explode(spark, t):
    words = t.documents.select(F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _properties(t):
    """Each part with a map like {p_brand: ..., p_type: ...}."""
    return t.part.select(
        "p_partkey",
        F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type").alias("properties"),
        F.create_map(F.lit("name"), F.col("p_name"), F.lit("size"), F.col("p_size").cast("string")).alias(
            "more"
        ),
    )


@query("SELECT p_partkey, 'brand,type' AS names FROM part")
def fn_map_keys(spark, t):
    keys = F.sort_array(F.map_keys("properties"))
    return _properties(t).select("p_partkey", F.array_join(keys, ",").alias("names"))


@query("SELECT p_partkey, p_brand || ',' || p_type AS contents FROM part")
def fn_map_values(spark, t):
    return _properties(t).select("p_partkey", F.array_join(F.map_values("properties"), ",").alias("contents"))


@query(
    """SELECT p_partkey, 'brand' AS key, p_brand AS value FROM part
    UNION ALL SELECT p_partkey, 'type', p_type FROM part
    UNION ALL SELECT p_partkey, 'name', p_name FROM part
    UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part"""
)
def fn_map_concat(spark, t):
    return _properties(t).select("p_partkey", F.explode(F.map_concat("properties", "more")))


@query(
    """SELECT p_partkey, 'p_size' AS field, CAST(p_size AS VARCHAR) AS value FROM part
    UNION ALL SELECT p_partkey, 'p_type', p_type FROM part"""
)
def struct_to_map_(spark, t):
    nested = t.part.select("p_partkey", F.struct("p_size", "p_type").alias("properties"))
    mapped = struct_to_map(nested, "properties", "properties_map")
    return mapped.select("p_partkey", F.explode("properties_map").alias("field", "value"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, t):
    return t.events.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


# -- scalar user functions -------------------------------------------------------

# The upper case of a leading sharp s is two letters here and one in the checking engine.
_CAPITALIZED = """array_to_string(list_transform(string_split({0}, ' '), lambda w:
    CASE WHEN w[1:1] = 'ß' THEN 'SS' ELSE upper(w[1:1]) END || w[2:]), ' ')"""


@query(f"SELECT doc_id, {_CAPITALIZED.format('text')} AS text FROM documents")
def udf_capitalize(spark, t):
    return t.documents.select("doc_id", capitalize_words("text").alias("text"))


@query(f"SELECT c_custkey, {_CAPITALIZED.format('lower(c_mktsegment)')} AS segment FROM customer")
def udf_sql(spark, t):
    # A function of SQL expressions is inlined, and no row leaves the JVM.
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION tablewright_capitalize(s STRING) RETURNS STRING
        RETURN array_join(transform(split(s, ' '), w -> concat(upper(left(w, 1)), substring(w, 2))), ' ')"""
    )
    return spark.sql(
        "SELECT c_custkey, tablewright_capitalize(lower(c_mktsegment)) AS segment FROM {customer}",
        customer=t.customer,
    )
