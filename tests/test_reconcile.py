import datetime

import pytest
from pyspark.sql import functions as F

from tablewright import differences
from tablewright.operators import reconcile


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(source, target, n_keys=1):
    a, b = {r[:n_keys]: r for r in source}, {r[:n_keys]: r for r in target}
    out = [(*r, "missing") for k, r in a.items() if k not in b] + [(*r, "deleted") for k, r in b.items() if k not in a]
    return sorted(out + [(*r, "changed") for k, r in a.items() if k in b and b[k] != r], key=repr)


KEYS = {
    "bigint": lambda k: k * 1_000_003 - 2**40,
    "int": lambda k: k,
    "date": lambda k: datetime.date(2000, 1, 1) + datetime.timedelta(days=k),
    "timestamp": lambda k: datetime.datetime(2000, 1, 1) + datetime.timedelta(hours=k),
    "string": lambda k: f"k{k}",
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("leaf_rows", [0, 50, 10**6])
def test_all_kinds_of_change(spark, kind, leaf_rows):
    key = KEYS[kind]
    source = [(key(k), f"v{k}", k * 1.5) for k in range(2000) if k % 97 != 5] + [(None, "no key", 1.0)]
    target = [(key(k), f"v{k}" if k % 211 else None, k * 1.5) for k in range(2000) if not 700 < k < 710] + [(None, "no key", 2.0)]
    schema = f"k {kind}, v string, x double"
    got = differences(spark.createDataFrame(source, schema), spark.createDataFrame(target, schema), "k", fan_out=16, leaf_rows=leaf_rows)
    assert rows(got) == expected(source, target)


def test_extreme_keys_and_empty_sides(spark):
    schema = "k bigint, v string"
    some = [(-(2**63), "a"), (2**63 - 1, "b"), (0, "c")]
    a, none = spark.createDataFrame(some, schema), spark.createDataFrame([], schema)
    assert rows(differences(a, none, "k", leaf_rows=0)) == expected(some, [])
    assert rows(differences(none, a, "k", leaf_rows=0)) == expected([], some)
    assert rows(differences(a, a, "k", leaf_rows=0)) == [] == rows(differences(none, none, "k"))


def test_two_keys_and_other_column_order(spark):
    a = spark.createDataFrame([("x", 1, 1), ("x", 2, 1), ("y", 2, 1)], "v string, k int, j bigint")
    b = spark.createDataFrame([(1, 1, "x"), (2, 1, "z"), (3, 2, "gone")], "k bigint, j int, v string")
    a = a.withColumn("j", F.when(F.col("v") == "y", 2).otherwise(F.col("j")))
    assert rows(differences(a, b, ["k", "j"])) == sorted([(2, 1, "x", "changed"), (2, 2, "y", "missing"), (3, 2, "gone", "deleted")], key=repr)


def test_only_unequal_ranges_are_read_again(spark, tmp_path, monkeypatch):
    spark.range(0, 100_000, 1, 4).selectExpr("id AS k", "id * 2 AS v").write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    b = a.where("k <> 41007").withColumn("v", F.when(F.col("k") == 90000, 0).otherwise(F.col("v")))
    seen, unequal = [], reconcile._unequal
    monkeypatch.setattr(reconcile, "_unequal", lambda s, t, n, ranges, parts: seen.append(list(ranges)) or unequal(s, t, n, ranges, parts))
    found = differences(a, b, "k", fan_out=64, leaf_rows=10)
    assert rows(found) == [(41007, 82014, "missing"), (90000, 180000, "changed")]
    widths = [sum(hi - lo + 1 for lo, hi in ranges) for ranges in seen]
    assert widths[0] == 100_000 and widths[1] < 4_000 and len(widths) >= 3 and widths[2] < 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k," in plan and "LessThanOrEqual(k," in plan
