import pytest
from pyspark.errors import PySparkException

from tablewright import (
    AddColumn,
    CastColumn,
    DropColumn,
    RenameColumn,
    apply_parent_delete,
    apply_parent_update,
    evolve_schema,
    foreign_key_orphans,
    primary_key_violations,
    unique_violations,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, None), (5, 99)], "id int, fk int")


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([(10,), (20,), (30,)], "pk int")


@pytest.fixture(scope="module")
def gone(spark):
    return spark.createDataFrame([(10,), (10,), (30,)], "pk int")


def test_unique_ignores_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (1, None), (2, 1)], "a int, b int")
    assert rows(unique_violations(df, ["a", "b"])) == [(1, 1, 2)]


def test_primary_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 1)], "a int, b int")
    got = rows(primary_key_violations(df, ["a", "b"]))
    assert got == [(1, 1, 2, "duplicate"), (1, None, 1, "null")]


def test_orphans(child, parent):
    assert rows(foreign_key_orphans(child, "fk", parent, "pk")) == [(99, 1)]


def test_delete_actions(child, gone):
    assert [r[0] for r in rows(apply_parent_delete(child, "fk", gone, "pk", "cascade"))] == [3, 4, 5]
    assert rows(apply_parent_delete(child, "fk", gone, "pk", "set_null"))[:2] == [(1, None), (2, None)]
    got = rows(apply_parent_delete(child, "fk", gone, "pk", "set_default", {"fk": 0}))
    assert got == [(1, 0), (2, 0), (3, 20), (4, None), (5, 99)]
    for action in ("restrict", "no_action"):
        with pytest.raises(ValueError, match="still refer"):
            apply_parent_delete(child, "fk", gone, "pk", action)
        unused = gone.where("pk = 30")
        assert apply_parent_delete(child, "fk", unused, "pk", action).count() == 5
    with pytest.raises(ValueError, match="action"):
        apply_parent_delete(child, "fk", gone, "pk", "explode")
    with pytest.raises(ValueError, match="default"):
        apply_parent_delete(child, "fk", gone, "pk", "set_default")


def test_update_actions(spark, child):
    changes = spark.createDataFrame([(10, 11), (10, 11), (20, 20)], "old int, new int")
    assert rows(apply_parent_update(child, "fk", changes))[:3] == [(1, 11), (2, 11), (3, 20)]
    got = rows(apply_parent_update(child, "fk", changes, "set_null"))
    assert got[:3] == [(1, None), (2, None), (3, 20)]
    got = rows(apply_parent_update(child, "fk", changes, "set_default", default=0))
    assert got[:3] == [(1, 0), (2, 0), (3, 20)]
    with pytest.raises(ValueError, match="still refer"):
        apply_parent_update(child, "fk", changes, "restrict")
    two = spark.createDataFrame([(10, 11), (10, 12)], "old int, new int")
    with pytest.raises(PySparkException, match="ambiguous"):
        apply_parent_update(child, "fk", two).collect()
    with pytest.raises(ValueError, match="action"):
        apply_parent_update(child, "fk", two, "explode")


def test_evolve(spark):
    df = spark.createDataFrame([("1", 2), ("x", 3)], "a string, b int")
    got = evolve_schema(
        df,
        [RenameColumn("a", "n"), CastColumn("n", "int"), AddColumn("c", "double", 1), DropColumn("b"),
         AddColumn("b", "string")],
    )
    assert got.dtypes == [("n", "int"), ("c", "double"), ("b", "string")]
    assert rows(got) == [(1, 1.0, None), (None, 1.0, None)]
    for bad in (AddColumn("a", "int"), DropColumn("z"), RenameColumn("a", "b"), CastColumn("z", "int")):
        with pytest.raises(ValueError):
            evolve_schema(df, [bad])
