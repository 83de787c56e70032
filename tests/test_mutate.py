"""Upsert, delete and incremental load: values, edge cases, and invariants on random tables."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewright import (
    delete_where,
    incremental_append,
    incremental_rows,
    latest_snapshot,
    upsert,
    watermark,
)

USE = "date date, language string, users_count int"
D1, D2 = dt.date(2010, 1, 23), dt.date(2015, 8, 15)
HELD = [
    (D1, "Java", 20000), (D1, "Python", 100000), (D1, "Scala", 3000),
    (D2, "Java", 25000), (D2, "Python", 150000), (D2, "Scala", 2000),
]
BATCH = [
    (D1, "Java", 21000), (D1, "Python", 100000), (D1, "Scala", 15000),
    (D2, "Java", 24000), (D2, "Python", 135000), (D2, "Scala", 2200), (D2, "Rust", 1000),
]
KEYS = ["date", "language"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def held(spark):
    return spark.createDataFrame(HELD, USE)


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(BATCH, USE)


def test_update_replaces_and_inserts(held, batch):
    assert rows(upsert(held, batch, KEYS)) == sorted(BATCH, key=repr)


def test_nothing_inserts_only(held, batch):
    want = HELD + [(D2, "Rust", 1000)]
    assert rows(upsert(held, batch, KEYS, action="nothing")) == sorted(want, key=repr)


def test_twice_is_once(held, batch):
    once = upsert(held, batch, KEYS)
    assert rows(upsert(once, batch, KEYS)) == rows(once)


def test_condition_keeps_old_rows(held, batch):
    got = rows(upsert(held, batch, KEYS, condition="source.users_count > target.users_count"))
    best = {(d, l): n for d, l, n in HELD}
    for d, l, n in BATCH:
        best[d, l] = max(n, best.get((d, l), n))
    assert got == sorted(((d, l, n) for (d, l), n in best.items()), key=repr)


def test_null_condition_keeps_old_row(spark):
    target = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    source = spark.createDataFrame([(1, 9), (2, 9)], "k int, v int")
    got = upsert(target, source, "k", condition="source.v > target.v")
    assert rows(got) == [(1, None), (2, 9)]


def test_condition_as_column(spark):
    target = spark.createDataFrame([(1, 1), (2, 5)], "k int, v int")
    source = spark.createDataFrame([(1, 3), (2, 3)], "k int, v int")
    got = upsert(target, source, "k", condition=F.col("source.v") > F.col("target.v"))
    assert rows(got) == [(1, 3), (2, 5)]


def test_batch_without_some_columns(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, v int")
    source = spark.createDataFrame([(2, 21), (3, 30)], "k int, v int")
    assert rows(upsert(target, source, "k")) == [(1, "a", 10), (2, "b", 21), (3, None, 30)]


def test_null_keys_match_nothing(spark):
    target = spark.createDataFrame([(None, 1), (1, 1)], "k int, v int")
    source = spark.createDataFrame([(None, 2), (None, 2), (1, 2)], "k int, v int")
    assert rows(upsert(target, source, "k")) == [(1, 2), (None, 1), (None, 2), (None, 2)]
    assert rows(upsert(target, source, "k", "nothing")) == [(1, 1), (None, 1), (None, 2), (None, 2)]
    got = upsert(target, source, "k", condition="source.v > target.v")
    assert rows(got) == [(1, 2), (None, 1), (None, 2), (None, 2)]


def test_two_part_key_with_null_part(spark):
    target = spark.createDataFrame([(1, None, 1), (1, 2, 1)], "a int, b int, v int")
    source = spark.createDataFrame([(1, None, 9), (1, 2, 9)], "a int, b int, v int")
    assert rows(upsert(target, source, ["a", "b"])) == [(1, 2, 9), (1, None, 1), (1, None, 9)]


def test_duplicate_keys_need_an_order(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (1, "z", 1)], "k int, v string, seq int")
    with pytest.raises(PySparkException, match="duplicate keys"):
        upsert(target, source.drop("seq"), "k").collect()
    assert rows(upsert(target, source, "k", order_by="seq")) == [(1, "z"), (2, "y")]
    assert rows(upsert(target, source, "k", "nothing", order_by="seq")) == [(1, "a"), (2, "y")]
    assert rows(upsert(target, source.drop("seq"), "k", order_by=F.length("v"))) == [(1, "z"), (2, "y")]


def test_all_columns_are_keys(spark):
    target = spark.createDataFrame([(1, 1)], "a int, b int")
    source = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    assert rows(upsert(target, source, ["a", "b"])) == [(1, 1), (1, 2)]


def test_nested_and_map_columns(spark):
    schema = "k int, m map<string,int>, s struct<a:int,b:array<string>>"
    target = spark.createDataFrame([(1, {"x": 1}, (1, ["p"])), (2, {"x": 2}, (2, None))], schema)
    source = spark.createDataFrame([(2, {"y": 3}, (3, ["q"])), (3, None, None)], schema)
    got = {r.k: (r.m, r.s) for r in upsert(target, source, "k").collect()}
    assert got[2] == ({"y": 3}, (3, ["q"])) and got[3] == (None, None) and len(got) == 3


def test_batch_takes_the_targets_types_and_spelling(spark):
    target = spark.createDataFrame([(1, 2.5)], "Key bigint, Value double")
    source = spark.createDataFrame([(1, 3), (2, 4)], "key int, VALUE int")
    got = upsert(target, source, "KEY")
    assert got.schema == target.schema
    assert rows(got) == [(1, 3.0), (2, 4.0)]


@pytest.mark.parametrize("condition", [None, "true"])
def test_columns_stay_in_place(spark, condition):
    target = spark.createDataFrame([(1.5, 1, "a")], "v double, k int, s string")
    source = spark.createDataFrame([("b", 2.5, 1), ("c", 3.5, 2)], "s string, v double, k int")
    got = upsert(target, source, "k", condition=condition)
    assert got.columns == target.columns
    assert rows(got) == [(2.5, 1, "b"), (3.5, 2, "c")]


def test_case_sensitive_names(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        target = spark.createDataFrame([(1, 2)], "K int, v int")
        with pytest.raises(ValueError, match="no such column"):
            upsert(target, spark.createDataFrame([(1, 2)], "k int, v int"), "K")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_bad_arguments(held, batch):
    with pytest.raises(ValueError, match="action"):
        upsert(held, batch, KEYS, action="doWhatever")
    with pytest.raises(ValueError, match="condition"):
        upsert(held, batch, KEYS, action="nothing", condition="true")
    with pytest.raises(ValueError, match="no such column"):
        upsert(held, batch, ["nope"])
    with pytest.raises(ValueError, match="no such column"):
        upsert(held, batch.withColumn("extra", F.lit(1)), KEYS)
    with pytest.raises(ValueError, match="lacks key"):
        upsert(held, batch.drop("date"), KEYS)


maybe = st.one_of(st.none(), st.integers(0, 6))
table = st.lists(st.tuples(st.integers(0, 12), maybe), max_size=10, unique_by=lambda r: r[0])
loose = st.lists(st.tuples(maybe, maybe), max_size=10)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=table, source=table, nulls=loose)
def test_against_brute_force(spark, target, source, nulls):
    free = [(None, v) for _, v in nulls]
    t = spark.createDataFrame(target + free[:2], "k int, v int")
    s = spark.createDataFrame(source + free, "k int, v int")
    held = dict(target)
    merged = {**held, **dict(source)}
    kept = {**dict(source), **held}
    cond = dict(held)
    for k, v in source:
        if k not in held or (v is not None and held[k] is not None and v > held[k]):
            cond[k] = v
    loose_rows = free[:2] + free
    for got, want in [
        (upsert(t, s, "k"), merged),
        (upsert(t, s, "k", "nothing"), kept),
        (upsert(t, s, "k", condition="source.v > target.v"), cond),
    ]:
        assert rows(got) == sorted([*want.items(), *loose_rows], key=repr)


def test_delete(held, spark):
    left = delete_where(held, "date = '2010-01-23' and language = 'Scala'")
    assert left.count() == 5
    loose = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert rows(delete_where(loose, F.col("v") == 1)) == [(2,), (None,)]


# -- incremental -----------------------------------------------------------------

DAYS = [dt.date(2020, 1, 1), dt.date(2020, 1, 3), dt.date(2020, 1, 12), dt.date(2020, 2, 2),
        dt.date(2020, 5, 18), dt.date(2020, 8, 21)]
PRICES = [10, 231, 11, 201, 15, 191, 21, 149, 18, 131, 19, 154]
SOURCE = [(DAYS[i // 2], ("000001", "000300")[i % 2], p) for i, p in enumerate(PRICES)]
PRICE = "date date, symbol string, price int"


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame(SOURCE, PRICE)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(SOURCE[:4], PRICE)


def test_incremental(source, target):
    assert watermark(source, target, "date").first()[0] == dt.date(2020, 1, 3)
    assert rows(incremental_rows(source, target, "date")) == sorted(SOURCE[4:], key=repr)
    loaded = incremental_append(source, target, "date")
    assert rows(loaded) == sorted(SOURCE, key=repr)
    assert incremental_rows(source, loaded, "date").count() == 0
    assert watermark(source, loaded, "date").first()[0] is None


def test_incremental_on_empty_target(spark, source):
    empty = spark.createDataFrame([], PRICE)
    assert incremental_rows(source, empty, "date").count() == 0
    assert incremental_rows(source, empty, "date", on_empty="full").count() == 12
    assert watermark(source, empty, "date").first()[0] is None
    with pytest.raises(ValueError):
        incremental_rows(source, empty, "date", on_empty="all")


def test_late_rows_at_the_maximum(spark, source):
    late = spark.createDataFrame(SOURCE[:3], PRICE)
    assert incremental_rows(source, late, "date").count() == 8
    got = incremental_append(source, late, "date", inclusive=True, keys=["date", "symbol"])
    assert rows(got) == sorted(SOURCE, key=repr)
    with pytest.raises(ValueError, match="keys"):
        incremental_rows(source, late, "date", inclusive=True)


def test_latest_snapshot(source):
    assert rows(latest_snapshot(source, "date")) == sorted(SOURCE[-2:], key=repr)
