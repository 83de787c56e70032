"""File sources and sinks: each query writes a given table and reads it back.

Everything is written under the shared scratch folder, to a fresh path per call.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewright import bloom_options, skipped_files, z_ordered
from tablewright.operators.reuse import session_setting
from tablewright.plans.registry import query
from tablewright.sources.scratch import scratch_path

# -- Parquet ---------------------------------------------------------------------


@query(
    """SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier"""
)
def src_parquet(spark, t):
    customers, suppliers = scratch_path(spark, "customers"), scratch_path(spark, "suppliers")
    spark.read.load(t.path("customer")).select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    ).write.save(customers)
    spark.read.format("parquet").load(t.path("supplier")).select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    ).write.parquet(suppliers)
    return spark.read.parquet(customers, suppliers)


@query(
    """SELECT via, s_suppkey, s_name FROM supplier
    CROSS JOIN (VALUES ('option'), ('session')) v(via)"""
)
def src_ignore_corrupt(spark, t):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    t.supplier.select("s_suppkey", "s_name").write.parquet(good)
    t.supplier.select("s_name").write.text(bad)  # no Parquet file: unreadable to the Parquet reader
    # With a schema given, no file needs to be opened before the query runs.
    reader = spark.read.schema("s_suppkey bigint, s_name string")
    by_option = reader.option("ignoreCorruptFiles", "true").parquet(good, bad)
    kept = scratch_path(spark, "kept")
    by_option.write.parquet(f"{kept}/via=option")
    with session_setting(spark, "spark.sql.files.ignoreCorruptFiles", "true"):
        plain = spark.read.schema("s_suppkey bigint, s_name string").parquet(good, bad)
        plain.write.parquet(f"{kept}/via=session")
    return spark.read.parquet(kept)


@query(
    """SELECT 'text' AS folder, CAST(sum(strlen(s_name) + 1) AS BIGINT) AS size, 'unreadable' AS reason FROM supplier
    UNION ALL SELECT 'none', NULL, 'empty'"""
)
def src_skipped_files(spark, t):
    path = scratch_path(spark, "mixed files")
    names = t.supplier.select("s_suppkey", "s_name")
    names.write.parquet(f"{path}/good")
    names.limit(0).write.parquet(f"{path}/none")
    names.select("s_name").coalesce(1).write.text(f"{path}/text")
    found = skipped_files(spark, path, schema="s_suppkey bigint, s_name string")
    folder = F.element_at(F.split("path", "/"), -2)
    # the size of an empty Parquet file is the writer's affair
    return found.select(folder.alias("folder"), F.when(F.col("reason") == "unreadable", F.col("size")).alias("size"), "reason")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def src_recursive(spark, t):
    path = scratch_path(spark, "nested")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.hint("rebalance", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(f"{path}/deeper")
    # Recursion switches partition discovery off: no o_orderstatus column.
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


@query("SELECT n_nationkey, n_name FROM nation")
def src_glob(spark, t):
    path = scratch_path(spark, "mixed")
    t.nation.select("n_nationkey", "n_name").write.parquet(path)
    t.nation.select("n_name").write.mode("append").text(path)
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(path)


@query("SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 3 = 1")
def src_modified(spark, t):
    # Files of three dates; the two limits leave those in the middle.
    path = scratch_path(spark, "dated")
    rows = t.supplier.select("s_suppkey", "s_acctbal")
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for part, day in enumerate(("2015-03-01", "2021-03-01", "2031-03-01")):
        place = f"{path}/part={part}"
        rows.where(F.col("s_suppkey") % 3 == part).write.parquet(place)
        millis = int(datetime.fromisoformat(f"{day}T00:00:00+00:00").timestamp() * 1000)
        for entry in files.listStatus(folder(place)):
            files.setTimes(entry.getPath(), millis, -1)
    reader = spark.read.schema(rows.schema)  # an empty match could not be inferred
    after = reader.option("modifiedAfter", "2018-02-03T04:05:06")
    return after.option("modifiedBefore", "2025-02-03T04:05:06").parquet(path).select("s_suppkey", "s_acctbal")


@query(
    """SELECT p_partkey, p_size, CASE WHEN p_size < 25 THEN p_retailprice END AS small_price,
    CASE WHEN p_size >= 25 THEN p_retailprice END AS large_price,
    CASE WHEN p_size < 25 THEN 1 ELSE 2 END AS key FROM part"""
)
def src_merge_schema(spark, t):
    path = scratch_path(spark, "merged")
    small = t.part.where("p_size < 25")
    large = t.part.where("p_size >= 25")
    small.select("p_partkey", "p_size", F.col("p_retailprice").alias("small_price")).write.parquet(
        f"{path}/key=1"
    )
    large.select("p_partkey", "p_size", F.col("p_retailprice").alias("large_price")).write.parquet(
        f"{path}/key=2"
    )
    return spark.read.option("mergeSchema", "true").parquet(path)


@query("SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS max_price FROM orders GROUP BY o_orderstatus")
def src_sql_on_file(spark, t):
    return spark.sql(
        f"""SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS max_price
        FROM parquet.`{t.path("orders")}` GROUP BY o_orderstatus"""
    )


# -- JSON, CSV, text -------------------------------------------------------------


@query("SELECT event_id, user_id, event_type, value FROM events")
def src_json(spark, t):
    path = scratch_path(spark, "json")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    rows.write.json(path)
    return spark.read.schema(rows.schema).json(path)


@query("SELECT event_id, user_id, event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_inferred(spark, t):
    # Nested JSON held in a text column: Spark finds the schema in one pass over the strings.
    path = scratch_path(spark, "json-strings")
    detail = F.struct(F.col("event_type").alias("kind"), F.from_json("props", "k bigint").alias("props"))
    t.events.select(F.to_json(F.struct("event_id", "user_id", detail.alias("detail")))).write.text(path)
    return spark.read.json(path).select("event_id", "user_id", "detail.kind", "detail.props.k")


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def src_csv(spark, t):
    path = scratch_path(spark, "csv")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    rows.write.options(sep=";", header=True).csv(path)
    typed = spark.read.options(sep=";", header=True, inferSchema=True).csv(path)
    # Inference picks int where the values are small.
    return typed.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS _c0, p_name AS _c1, CAST(p_size AS VARCHAR) AS _c2 FROM part")
def src_csv_default(spark, t):
    path = scratch_path(spark, "csv-default")
    t.part.select("p_partkey", "p_name", "p_size").write.csv(path)
    return spark.read.csv(path)


@query("SELECT n_nationkey, n_name FROM nation")
def src_csv_folder(spark, t):
    # A folder that holds other files too: glob and schema keep them out.
    path = scratch_path(spark, "csv-folder")
    rows = t.nation.select("n_nationkey", "n_name")
    rows.write.csv(path)
    rows.write.mode("append").json(path)
    return spark.read.schema(rows.schema).option("pathGlobFilter", "*.csv").csv(path)


@query("SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def src_text(spark, t):
    path = scratch_path(spark, "text")
    t.documents.select("text").write.text(path)
    return spark.read.text(path, lineSep="\n")  # by default a carriage return ends a line too


@query("SELECT unnest(string_split(p_name || ' ' || p_brand, ' ')) AS value FROM part")
def src_text_linesep(spark, t):
    path = scratch_path(spark, "text-sep")
    t.part.select(F.concat_ws(" ", "p_name", "p_brand")).write.option("lineSep", " ").text(path)
    return spark.read.text(path, lineSep=" ")


@query("SELECT lang, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY lang")
def src_text_whole(spark, t):
    # One row per file: the writer bounds the files, so no row grows with the table.
    path = scratch_path(spark, "text-whole")
    documents = t.documents.select("lang", "text")
    dealt = documents.hint("rebalance", "lang")
    dealt.write.partitionBy("lang").options(maxRecordsPerFile=500, lineSep="\x1e").text(path)
    files = spark.read.text(path, wholetext=True)
    # Each text came with one separator, whatever signs it holds itself.
    ends = documents.groupBy("lang").agg(F.count("text").alias("ends"))
    chars = files.groupBy("lang").agg(F.sum(F.length("value")).alias("chars"))
    return chars.join(ends, "lang").select("lang", (F.col("chars") - F.col("ends")).alias("n_chars"))


@query("SELECT unnest(string_split(text, chr(10))) AS value FROM conversations")
def sink_text_gzip(spark, t):
    path = scratch_path(spark, "text-gzip")
    t.conversations.select("text").write.option("compression", "gzip").text(path)
    return spark.read.text(path, lineSep="\n")


# -- rows from memory and from a range -------------------------------------------


@query(
    """SELECT o_orderkey, label FROM orders
    LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open')) v(code, label) ON code = o_orderstatus"""
)
def src_inline(spark, t):
    labels = spark.createDataFrame([("F", "finished"), ("O", "open")], "code string, label string")
    # Two literal rows, but Spark does not know the size of rows from Python: without the hint it
    # would shuffle the orders by a column of three values.
    matching = F.col("o_orderstatus") == F.col("code")
    return t.orders.join(F.broadcast(labels), matching, "left").select("o_orderkey", "label")


@query(
    """SELECT coalesce(i, q) AS l_quantity, coalesce(n, 0) AS n FROM range(61) r(i)
    FULL JOIN (SELECT CAST(l_quantity AS BIGINT) AS q, count(l_orderkey) AS n FROM lineitem GROUP BY 1) ON i = q"""
)
def src_range(spark, t):
    # Every quantity from 0 to 60 with its number of lines, zero where there is none; others too.
    counts = t.lineitem.groupBy(F.col("l_quantity").cast("bigint").alias("l_quantity")).agg(
        F.count("l_orderkey").alias("n")
    )
    steps = spark.range(0, 61).withColumnRenamed("id", "l_quantity")
    return steps.join(counts, "l_quantity", "full").fillna(0, ["n"])


# -- sinks -----------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def sink_parquet(spark, t):
    path = scratch_path(spark, "parquet")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    rows.write.format("parquet").save(path)
    return spark.read.parquet(path)


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def sink_modes(spark, t):
    path = scratch_path(spark, "modes")
    rows = t.supplier.select("s_suppkey", "s_name")
    rows.write.mode("error").parquet(path)
    rows.write.mode("overwrite").parquet(path)
    rows.write.mode("append").parquet(path)
    rows.write.mode("ignore").parquet(path)  # the path exists: nothing is written
    try:
        rows.write.parquet(path)  # the default mode refuses
    except AnalysisException:
        return spark.read.parquet(path)
    raise RuntimeError("the default save mode wrote over an existing path")


@query("SELECT event_id, event_type FROM events")
def sink_parquet_opts(spark, t):
    path = scratch_path(spark, "parquet-options")
    options = {
        "parquet.bloom.filter.enabled#event_type": "true",
        "parquet.bloom.filter.expected.ndv#event_type": "1000",
        "parquet.enable.dictionary": "true",
        # no bloom filter is written for a column that its dictionary describes already
        "parquet.enable.dictionary#event_type": "false",
        "parquet.page.write-checksum.enabled": "false",
    }
    t.events.select("event_id", "event_type").write.options(**options).parquet(path)
    return spark.read.parquet(path)


@query("SELECT event_id, event_type FROM events")
def sink_orc(spark, t):
    path = scratch_path(spark, "orc")
    options = {
        "orc.bloom.filter.columns": "event_type",
        "orc.dictionary.key.threshold": "1.0",
        "orc.column.encoding.direct": "event_type",
    }
    t.events.select("event_id", "event_type").write.format("orc").options(**options).save(path)
    return spark.read.orc(path)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def sink_partitioned(spark, t):
    path = scratch_path(spark, "partitioned")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    # Rebalanced by the partition column, each value's rows come in few files, also of a frequent one.
    rows.hint("rebalance", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders")
def sink_z_ordered(spark, t):
    # A filter on the customer or on the date skips most row groups, one on the order asks Bloom filters.
    path = scratch_path(spark, "z-ordered")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    options = bloom_options(orders, ["o_orderkey"], files=16)
    z_ordered(orders, ["o_custkey", "o_orderdate"], files=16).write.options(**options).parquet(path)
    return spark.read.parquet(path)


def bucketed(rows, key, buckets):
    """The rows dealt by the bucket they will be written to: few files for each, also for a hot key."""
    dealt = rows.withColumn("bucket_no", F.pmod(F.hash(key), F.lit(buckets)))
    return dealt.hint("rebalance", "bucket_no").drop("bucket_no")


def _read_back(spark, writer, label):
    """Save as a catalog table, read that table, and drop it; what was read comes back as a copy."""
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writer.option("path", path).saveAsTable(name)
    try:
        spark.table(name).write.parquet(f"{path}-copy")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(f"{path}-copy")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_bucketed(spark, t):
    rows = bucketed(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c_custkey", 24)
    return _read_back(spark, rows.write.bucketBy(24, "c_custkey").sortBy("c_acctbal"), "bucketed")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_part_bucketed(spark, t):
    rows = bucketed(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey", 8)
    writer = rows.write.partitionBy("c_mktsegment").bucketBy(8, "c_custkey")
    return _read_back(spark, writer, "part-bucketed")
