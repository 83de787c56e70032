"""Queries through a JDBC database.

``spark.tablewright.jdbc.url``, ``.driver``, ``.user`` and ``.password`` name a
database that all executors reach. Without them a local session uses Derby in the
memory of its own process, which no other process can see. Every query copies what
it read from the database to the scratch folder and drops its tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablewright.plans.registry import query
from tablewright.sources.jdbc import JdbcDatabase, JdbcTarget
from tablewright.sources.scratch import scratch_path

SETTINGS = "spark.tablewright.jdbc."


def database(spark) -> JdbcDatabase:
    url = spark.conf.get(SETTINGS + "url", None)
    if url is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTINGS}url to a database that all executors reach")
        target = JdbcTarget(
            db="derby",
            driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
            jdbc_url="jdbc:derby:memory:tablewright;create=true",
        )
    else:
        target = JdbcTarget(
            db=url.split(":")[1],
            driver=spark.conf.get(SETTINGS + "driver"),
            user=spark.conf.get(SETTINGS + "user", ""),
            password=spark.conf.get(SETTINGS + "password", ""),
            jdbc_url=url,
        )
    return JdbcDatabase(spark, target)


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}".upper()


def _copied(db, rows, *tables):
    """The rows read from the database, as a Parquet copy; the tables are dropped."""
    path = scratch_path(db.spark, "jdbc")
    try:
        rows.write.parquet(path)
    finally:
        for table in tables:
            db.drop(table)
    return db.spark.read.parquet(path)


def _unique_id(db, table):
    """The unique key an upsert needs; it also spares the database a search per row."""
    db.execute([f'CREATE UNIQUE INDEX {table}_KEY ON {table} ("ID")'])


def _accounts(t):
    # Upper-case names are what most databases make of unquoted ones.
    return t.customer.select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("NAME"), F.col("c_acctbal").alias("BALANCE")
    )


_TYPES = "NAME VARCHAR(64)"


@query("SELECT c_custkey AS ID, c_name AS NAME, c_acctbal AS BALANCE FROM customer")
def jdbc_roundtrip(spark, t):
    db, name = database(spark), _name("accounts")
    db.save(_accounts(t), name, mode="error", column_types=_TYPES, num_partitions=8)
    return _copied(db, db.table(name, partition_column="ID"), name)


@query("SELECT c_custkey AS ID, c_acctbal AS BALANCE FROM customer WHERE c_acctbal > 5000")
def jdbc_query(spark, t):
    db, name = database(spark), _name("accounts")
    db.save(_accounts(t), name, mode="error", column_types=_TYPES)
    large = f'SELECT "ID", "BALANCE" FROM {name} WHERE "BALANCE" > 5000'
    return _copied(db, db.read(large, partition_column="ID", num_partitions=4), name)


@query(
    """SELECT c_custkey AS ID, c_name AS NAME, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 500
    THEN 1000 - c_acctbal ELSE c_acctbal END AS BALANCE FROM customer WHERE c_acctbal > -500
    UNION ALL SELECT s_suppkey + 1000000000, s_name, s_acctbal FROM supplier"""
)
def jdbc_upsert(spark, t):
    db, name = database(spark), _name("accounts")
    db.save(_accounts(t), name, mode="error", column_types=_TYPES)
    _unique_id(db, name)
    changed = t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("NAME"), (1000 - F.col("c_acctbal")).alias("BALANCE")
    )
    new = t.supplier.select(
        (F.col("s_suppkey") + 1_000_000_000).alias("ID"),
        F.col("s_name").alias("NAME"),
        F.col("s_acctbal").alias("BALANCE"),
    )
    db.delete_where(name, '"BALANCE" <= -500')
    held = changed.where("BALANCE < 1500")  # those whose old balance is above -500
    db.upsert(
        held.unionByName(new), name, "ID", condition='source."BALANCE" > target."BALANCE"'
    )
    return _copied(db, db.table(name, partition_column="ID"), name)


@query("SELECT o_orderkey AS ID, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS DAY FROM orders")
def jdbc_incremental(spark, t):
    db, source, target = database(spark), _name("source"), _name("target")
    orders = t.orders.select(F.col("o_orderkey").alias("ID"), F.to_date("o_orderdate").alias("DAY"))
    db.save(orders, source, mode="error")
    db.save(orders.where("DAY < DATE '2000-01-01'"), target, mode="error")
    _unique_id(db, target)
    db.copy_newer(
        db,
        source,
        "DAY",
        target,
        "DAY",
        lambda day: f"""SELECT * FROM {source} WHERE "DAY" > DATE('{day}')""",
        keys="ID",
    )
    days = db.table(target, partition_column="ID").select("ID", F.col("DAY").cast("string").alias("DAY"))
    return _copied(db, days, source, target)
