"""Every registered query against the same question in SQL, on the given tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in sorted(os.listdir(FOLDER)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(df, connection, sql):
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert got[1], "a query that finds nothing shows nothing"
    if sql is None:
        return
    result = connection.execute(sql)
    want = _rows([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, tables, name):
    compare(queries()[name](spark, FOLDER), tables, oracle_sql().get(name))


def test_entry(spark):
    assert entry(spark).count() > 0
