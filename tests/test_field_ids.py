import pytest

from tablewright import AddColumn, CastColumn, DropColumn, NumberedSchema, RenameColumn, read_by_id, save_by_id


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rename_drop_add(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "x", 10), (2, "y", 20)], "k int, name string, size int")
    schema = NumberedSchema.of(first.schema)
    save_by_id(first, schema, path)
    files = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("*.parquet")}

    second = schema.changed(spark, [RenameColumn("name", "title"), DropColumn("size"), AddColumn("lang", "string")])
    save_by_id(spark.createDataFrame([("en", 3, "z")], "lang string, k int, title string"), second, path)
    got = read_by_id(spark, second, path)
    assert got.columns == ["k", "title", "lang"]
    assert rows(got) == [(1, "x", None), (2, "y", None), (3, "z", "en")]
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("*.parquet") if p.name in files} == files

    # filters are pushed to columns of another name
    assert rows(got.filter("title = 'x'")) == [(1, "x", None)]
    assert rows(got.filter("title IS NOT NULL AND lang IS NULL").select("k")) == [(1,), (2,)]
    # the old schema still reads what it knows
    assert rows(read_by_id(spark, schema, path)) == [(1, "x", 10), (2, "y", 20), (3, "z", None)]


def test_a_name_used_again_brings_no_old_values_back(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 10)], "k int, size int")
    schema = NumberedSchema.of(first.schema)
    save_by_id(first, schema, path)
    again = schema.changed(spark, [DropColumn("size"), AddColumn("size", "int")])
    assert rows(read_by_id(spark, again, path)) == [(1, None)]
    swapped = schema.changed(spark, [RenameColumn("k", "k_"), RenameColumn("size", "k"), RenameColumn("k_", "size")])
    got = read_by_id(spark, swapped, path)
    assert got.columns == ["size", "k"] and rows(got) == [(1, 10)]


def test_wider_types(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 1.5, 7)], "k int, f float, n int")
    schema = NumberedSchema.of(first.schema)
    save_by_id(first, schema, path)
    wide = schema.changed(spark, [CastColumn("k", "bigint"), CastColumn("f", "double"), CastColumn("n", "double")])
    save_by_id(spark.createDataFrame([(2**40, 2.5, 0.5)], "k long, f double, n double"), wide, path)
    assert rows(read_by_id(spark, wide, path)) == [(1, 1.5, 7.0), (2**40, 2.5, 0.5)]
    with pytest.raises(ValueError, match="can't be read"):
        schema.changed(spark, [CastColumn("k", "string")])


def test_schema_outlives_the_session(spark, tmp_path):
    first = spark.createDataFrame([(1, "x")], "k int, name string")
    schema = NumberedSchema.of(first.schema).changed(spark, [DropColumn("name")])
    again = NumberedSchema.from_json(schema.json())
    assert again == schema
    assert again.changed(spark, [AddColumn("c", "int")]).columns["c"].metadata == {"parquet.field.id": 3}


def test_missing_and_unknown_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = NumberedSchema.of(spark.createDataFrame([], "k int, name string").schema)
    save_by_id(spark.createDataFrame([(1,)], "K int"), schema, path)
    assert rows(read_by_id(spark, schema, path)) == [(1, None)]
    with pytest.raises(ValueError, match="no columns"):
        save_by_id(spark.createDataFrame([(1, 2)], "k int, z int"), schema, path)


@pytest.mark.parametrize(
    "change", [AddColumn("K", "int"), DropColumn("z"), RenameColumn("k", "name"), AddColumn("d", "int", 5)]
)
def test_refusals(spark, change):
    schema = NumberedSchema.of(spark.createDataFrame([], "k int, name string").schema)
    with pytest.raises(ValueError):
        schema.changed(spark, [change])
