import datetime as dt

import pandas as pd
import pytest

from tablewright import two_phase_aggregate


def mean(df, keys, **options):
    return two_phase_aggregate(
        df,
        keys,
        zero={"total": 0, "n": 0},
        reduce=lambda rows: pd.DataFrame({"total": rows["v"].sum(), "n": rows["v"].count()}),
        merge=lambda buffers: buffers.sum(),
        finish=lambda b: b.assign(mean=(b["total"] / b["n"]).where(b["n"] > 0)),
        buffer_schema="total bigint, n bigint",
        output_schema="mean double, n bigint",
        **options,
    )


def test_salaries(spark):
    df = spark.createDataFrame([("Michael", 3000), ("Andy", 4500), ("Justin", 3500), ("Berta", 4000)], "name string, v long")
    assert [tuple(r) for r in mean(df.select("v"), []).collect()] == [(3750.0, 4)]


def test_no_input(spark):
    empty = spark.createDataFrame([], "k int, v long")
    assert [tuple(r) for r in mean(empty.select("v"), []).collect()] == [(None, 0)]
    assert mean(empty, "k").collect() == []


@pytest.mark.parametrize("max_buffers", [1, 100_000])
def test_many_partitions_and_flushes(spark, max_buffers):
    df = spark.range(0, 5000, 1, 16).selectExpr("id % 7 AS k", "id AS v")
    got = {r.k: (r["mean"], r.n) for r in mean(df, "k", max_buffers=max_buffers).collect()}
    want = {k: list(range(k, 5000, 7)) for k in range(7)}
    assert got == {k: (sum(v) / len(v), len(v)) for k, v in want.items()}


def test_keys_keep_type_and_null(spark):
    big = 2**60 + 1
    day = dt.date(2020, 1, 3)
    rows = [(big, day, 1), (big, day, 3), (None, day, 5), (None, None, 7)]
    df = spark.createDataFrame(rows, "k long, d date, v long").repartition(3)
    got = {(r.k, r.d): r["mean"] for r in mean(df, ["k", "d"]).collect()}
    assert got == {(big, day): 2.0, (None, day): 5.0, (None, None): 7.0}


def test_missing_values_and_zeros(spark):
    df = spark.createDataFrame([(0.0, 2), (-0.0, 4), (float("nan"), 1), (float("nan"), None), (None, 9)], "k double, v long")
    got = {str(r.k): (r["mean"], r.n) for r in mean(df.repartition(4), "k").collect()}
    assert got == {"0.0": (3.0, 2), "nan": (1.0, 1), "None": (9.0, 1)}


def test_buffers_of_any_type(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "z"), ("a", "x")], "k string, v string")
    got = two_phase_aggregate(
        df.repartition(3),
        "k",
        zero={"seen": []},
        reduce=lambda rows: rows["v"].agg(lambda v: sorted(set(v))).to_frame("seen"),
        merge=lambda buffers: buffers["seen"].agg(lambda s: sorted({x for part in s for x in part})).to_frame(),
        finish=lambda b: pd.DataFrame({"n": b["seen"].map(len)}),
        buffer_schema="seen array<string>",
        output_schema="n int",
    )
    assert dict(tuple(r) for r in got.collect()) == {"a": 2, "b": 1}


def test_hot_key_reaches_the_shuffle_as_buffers(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr("CASE WHEN id % 3 > 0 THEN 0 ELSE id % 5 END AS k", "id AS v")
    got = mean(df, "k")
    assert got.agg({"n": "sum"}).first()[0] == 200_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    final, below = plan.split("Exchange", 1)
    assert "MapInArrow" in final and "MapInArrow" in below


def test_same_name_for_key_and_buffer(spark):
    df = spark.range(10).selectExpr("id % 2 AS n", "id AS v")
    got = two_phase_aggregate(
        df,
        "n",
        zero={"n": 0},
        reduce=lambda rows: pd.DataFrame({"n": rows.size()}),
        merge=lambda buffers: buffers.sum(),
        finish=lambda b: pd.DataFrame({"rows": b["n"]}),
        buffer_schema="n bigint",
        output_schema="rows bigint",
    )
    assert sorted(tuple(r) for r in got.collect()) == [(0, 5), (1, 5)]


def test_nested_keys_are_refused(spark):
    df = spark.createDataFrame([((1, 2), [1], 3)], "s struct<a:int,b:int>, l array<int>, v int")
    for key in ("s", "L"):
        with pytest.raises(ValueError, match="nested"):
            two_phase_aggregate(
                df, key, zero={"n": 0}, reduce=lambda r: pd.DataFrame({"n": r.size()}), merge=lambda b: b.sum(),
                finish=lambda b: b, buffer_schema="n bigint", output_schema="n bigint",
            )
