"""Column names with dots, blanks and backticks."""

import pandas as pd
import pytest

from tablewright import (
    AddColumn,
    DropColumn,
    RenameColumn,
    anti_join,
    apply_parent_delete,
    apply_parent_update,
    evolve_schema,
    foreign_key_orphans,
    incremental_append,
    latest_snapshot,
    outer_join,
    primary_key_violations,
    semi_join,
    two_phase_aggregate,
    unique_violations,
    upsert,
    watermark,
)

K, V = "a.key", "the `value`"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (None, 0)], "k int, v int").toDF(K, V)
    source = spark.createDataFrame([(2, 25), (3, 30)], "k int, v int").toDF(K, V)
    return target, source


def test_mutation(tables):
    target, source = tables
    want = [(1, 10), (2, 25), (3, 30), (None, 0)]
    assert rows(upsert(target, source, K)) == want
    assert rows(upsert(target, source, K, order_by=V)) == want
    assert rows(upsert(target, source, K, condition="source.`a.key` > 0")) == want
    assert rows(upsert(target, source, K, "nothing")) == [(1, 10), (2, 20), (3, 30), (None, 0)]
    assert rows(incremental_append(source, target, V)) == rows(target.union(source))
    assert watermark(source, target, V).first()[0] == 20
    assert rows(latest_snapshot(target, V)) == [(2, 20)]


def test_joins(tables):
    target, source = tables
    assert rows(semi_join(target, source, K)) == [(2, 20)]
    assert rows(anti_join(target, source, K)) == [(1, 10), (None, 0)]
    right = source.toDF(K, "r.v")
    assert rows(outer_join(target, right, K, "full")) == rows(target.join(right, [K], "full"))


def test_constraints(tables):
    target, source = tables
    twice = target.union(target)
    assert rows(unique_violations(twice, K)) == [(1, 2), (2, 2)]
    assert len(rows(primary_key_violations(twice, [K]))) == 3
    assert rows(foreign_key_orphans(target, K, source, K)) == [(1, 1)]
    assert rows(apply_parent_delete(target, K, source, K, "cascade")) == [(1, 10), (None, 0)]
    assert rows(apply_parent_delete(target, K, source, K, "set_null")) == [(1, 10), (None, 0), (None, 20)]
    changes = source.toDF("old.k", "new.k")
    assert rows(apply_parent_update(target, K, changes, old="old.k", new="new.k"))[1] == (25, 20)
    assert evolve_schema(target, [AddColumn("x.y", "int")]).columns == [K, V, "x.y"]


def test_aggregate(tables):
    got = two_phase_aggregate(
        tables[0], K, zero={"n": 0},
        reduce=lambda r: pd.DataFrame({"n": r.size()}), merge=lambda b: b.sum(), finish=lambda b: b,
        buffer_schema="n bigint", output_schema="n bigint",
    )
    assert rows(got) == [(1, 1), (2, 1), (None, 1)]


@pytest.fixture
def case_sensitive(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    yield
    spark.conf.unset("spark.sql.caseSensitive")


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_by_spelling(spark, how):
    left = spark.createDataFrame([(1, "x", "p"), (2, "y", "q"), (None, "n", "r")], "k int, v string, w string")
    right = spark.createDataFrame([(2, "Y"), (3, "z"), (None, "m")], "K int, v string")
    for on in ("k", "K"):
        plain, got = left.join(right, on, how), outer_join(left, right, on, how)
        assert rows(got) == rows(plain)
        assert [c.lower() for c in got.columns] == [c.lower() for c in plain.columns] == ["k", "v", "w", "v"]


def test_outer_join_case_sensitive(spark, case_sensitive):
    left = spark.createDataFrame([(1, 2)], "k int, K int")
    right = spark.createDataFrame([(2, 5)], "K int, k int")
    assert rows(outer_join(left, right, "K", "full")) == rows(left.join(right, "K", "full")) == [(2, 1, 5)]
    with pytest.raises(ValueError):
        outer_join(left.select("k"), right, "K", "full")


def test_helper_names_may_be_columns(spark):
    names = ["_matched", "_row", "_n", "_order_0", "n_rows", "_gone", "_to"]
    frame = lambda data: spark.createDataFrame(data, ", ".join(f"{n} int" for n in ["id", *names]))
    target = frame([(1, *[0] * 7), (2, *[0] * 7)])
    batch = frame([(1, *[5] * 7), (3, *[7] * 7)])
    want = [(1, *[5] * 7), (2, *[0] * 7), (3, *[7] * 7)]
    assert rows(upsert(target, batch, "id")) == want
    assert rows(upsert(target, batch, "ID", condition="source.id > 0")) == want
    assert rows(upsert(target, batch, "id", order_by="_order_0")) == want
    assert rows(upsert(target, batch.drop("_gone"), "id")) == [(1, *[5] * 5, 0, 5), want[1], (3, *[7] * 5, None, 7)]
    for name in names:
        assert rows(upsert(target, batch, [name], order_by="id")) == sorted([*rows(target), *rows(batch)], key=repr)
        key = target.select(name)
        assert rows(unique_violations(key, name)) == [(0, 2)]
        assert rows(primary_key_violations(key, name)) == [(0, 2, "duplicate")]
        assert rows(foreign_key_orphans(key, name, batch, name)) == [(0, 2)]
        gone = apply_parent_delete(target.withColumn(name, target["id"]), name, batch.select("id"), "id", "set_null")
        assert sorted(r[name] or 0 for r in gone.collect()) == [0, 2]
        moved = spark.createDataFrame([(0, 9)], "old int, new int")
        assert {r[name] for r in apply_parent_update(target, name, moved).collect()} == {9}


def test_constraints_by_spelling(spark):
    child = spark.createDataFrame([(1, 1), (2, 2)], "id int, fk int")
    gone = spark.createDataFrame([(1,)], "PK int")
    assert rows(apply_parent_delete(child, "FK", gone, "pk", "set_null")) == [(1, None), (2, 2)]
    assert rows(apply_parent_delete(child, "FK", gone, "pk", "set_default", {"Fk": 7})) == [(1, 7), (2, 2)]
    assert rows(evolve_schema(child, [DropColumn("FK")])) == [(1,), (2,)]
    assert evolve_schema(child, [RenameColumn("FK", "Fk")]).columns == ["id", "Fk"]
    with pytest.raises(ValueError, match="exists"):
        evolve_schema(child, [AddColumn("FK", "int")])


def test_key_changes_to_null(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, fk int")
    changes = lambda data: spark.createDataFrame(data, "old int, new int")
    assert rows(apply_parent_update(child, "fk", changes([(5, None), (5, None)]))) == [(1, None), (2, 6), (3, None)]
    with pytest.raises(Exception, match="ambiguous"):
        apply_parent_update(child, "fk", changes([(5, 7), (5, None)])).collect()
