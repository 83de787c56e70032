"""Small literal inputs with results that can be checked by hand."""

import pytest
from pyspark.sql import functions as F

from tablewright import (
    anti_join,
    capitalize_words,
    outer_join,
    semi_join,
    split_columns,
    struct_to_map,
)
from tablewright.functions.columns import capitalize_words_udf


def rows(df):
    return [tuple(r) for r in df.collect()]


def ordered(df):
    return sorted(rows(df), key=repr)


@pytest.fixture(scope="module")
def loans(spark):
    return spark.createDataFrame(
        [
            ("atlas", "maps", "north", 12, 3, 40),
            ("globe", "maps", "south", 20, 5, 10),
            ("chart", "maps", "south", 7, 1, 5),
            ("violin", "music", "north", 30, 2, 25),
            ("organ", "music", "south", 14, 8, 15),
            ("herbs", "plants", "north", 9, 4, 60),
        ],
        "title string, shelf string, branch string, days int, readers int, fine int",
    )


def test_group_by(loans):
    by = loans.groupBy("shelf")
    assert dict(rows(by.sum("days"))) == {"maps": 39, "music": 44, "plants": 9}
    assert dict(rows(by.count())) == {"maps": 3, "music": 2, "plants": 1}
    assert dict(rows(by.min("days"))) == {"maps": 7, "music": 14, "plants": 9}
    assert dict(rows(by.max("days"))) == {"maps": 20, "music": 30, "plants": 9}
    assert dict(rows(by.mean("days"))) == {"maps": 13.0, "music": 22.0, "plants": 9.0}
    many = by.agg(F.avg("readers").alias("a"), F.sum("fine").alias("s"), F.max("fine").alias("m"))
    assert {r[0]: r[1:] for r in rows(many)} == {
        "maps": (3.0, 55, 40), "music": (5.0, 40, 25), "plants": (4.0, 60, 60)
    }
    assert {r[0] for r in rows(many.where("s > 50"))} == {"maps", "plants"}
    two = loans.groupBy("shelf", "branch").sum("days", "fine")
    assert ("maps", "south", 27, 15) in rows(two) and two.count() == 5


def test_sort(loans):
    pairs = loans.select("shelf", "branch")
    up = rows(pairs.sort("shelf", "branch"))
    assert up == sorted(up) == rows(pairs.orderBy(F.col("shelf").asc(), F.asc("branch")))
    mixed = rows(pairs.sort(F.asc("shelf"), F.desc("branch")))
    assert mixed[:3] == [("maps", "south"), ("maps", "south"), ("maps", "north")]


def test_union(loans):
    short, popular = loans.where("days < 13"), loans.where("readers >= 3")
    assert (short.count(), popular.count()) == (3, 4)
    assert short.union(popular).count() == short.unionAll(popular).count() == 7
    assert short.union(popular).distinct().count() == 5
    assert {r[0] for r in rows(short.intersect(popular))} == {"atlas", "herbs"}


@pytest.fixture(scope="module")
def trees(spark):
    return spark.createDataFrame(
        [(1, "root", None, "3"), (2, "left", 1, "4"), (3, "right", 1, "3"), (4, "leaf", 3, "none"), (5, "bud", 3, "9")],
        "node int, label string, parent int, bed string",
    )


@pytest.fixture(scope="module")
def beds(spark):
    return spark.createDataFrame([("sunny", 3), ("shady", 4), ("wet", 5)], "place string, bed_no int")


def test_joins(trees, beds):
    on = F.col("bed").try_cast("int") == F.col("bed_no")
    keyed = trees.withColumn("bed_no", F.col("bed").try_cast("int"))
    assert trees.join(beds, on).count() == 3
    spellings = {
        "full": ("outer", "full", "fullouter", 6),
        "left": ("left", "leftouter", 5),
        "right": ("right", "rightouter", 4),
    }
    for how, (*names, n) in spellings.items():
        want = ordered(keyed.join(beds, "bed_no", how))
        assert len(want) == n and {trees.join(beds, on, s).count() for s in names} == {n}
        got = outer_join(keyed, beds, "bed_no", how)
        assert got.columns == keyed.join(beds, "bed_no", how).columns
        assert ordered(got) == want
    assert sorted(r.node for r in semi_join(keyed, beds, "bed_no").collect()) == [1, 2, 3]
    assert sorted(r.node for r in anti_join(keyed, beds, "bed_no").collect()) == [4, 5]
    above = trees.alias("a").join(trees.alias("b"), F.col("a.parent") == F.col("b.node"))
    assert dict(rows(above.select("a.node", "b.label"))) == {2: "root", 3: "root", 4: "right", 5: "right"}


def test_outer_join_with_nulls_and_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (4, "w")], "k int, r string")
    for how in ("left", "right", "full"):
        assert ordered(outer_join(left, right, "k", how)) == ordered(left.join(right, "k", how))
    with pytest.raises(ValueError):
        outer_join(left, right, "k", "cross")


def test_pivot_and_unpivot(spark):
    catch = spark.createDataFrame(
        [("cod", 3, "mon"), ("cod", 4, "mon"), ("cod", 1, "wed"), ("eel", 2, "tue"), ("eel", 6, "wed")],
        "fish string, boxes int, day string",
    )
    wide = catch.groupBy("fish").pivot("day", ["wed", "mon", "tue"]).sum("boxes")
    assert wide.columns == ["fish", "wed", "mon", "tue"]
    assert {r[0]: r[1:] for r in rows(wide)} == {"cod": (1, 7, None), "eel": (6, None, 2)}
    long = wide.unpivot("fish", ["mon", "tue"], "day", "total").where("total IS NOT NULL")
    assert ordered(long) == [("cod", "mon", 7), ("eel", "tue", 2)]
    stacked = F.expr("stack(2, 'mon', mon, 'tue', tue) AS (day, total)")
    assert ordered(wide.select("fish", stacked).where("total IS NOT NULL")) == ordered(long)


def test_arrays(spark):
    df = spark.createDataFrame(
        [("red;;blue", ["oak", "ash"], "a", "b"), (";", ["elm"], "c", "c"), ("green", [], "d", None)],
        "colours string, woods array<string>, one string, two string",
    )
    assert sorted(r[0] for r in rows(df.select(F.explode("woods")))) == ["ash", "elm", "oak"]
    assert rows(df.select(F.split("colours", ";"))) == [(["red", "", "blue"],), (["", ""],), (["green"],)]
    assert rows(df.select(F.array("one", "two"))) == [(["a", "b"],), (["c", "c"],), (["d", None],)]
    assert [r[0] for r in rows(df.select(F.array_contains("woods", "elm")))] == [False, True, False]


def test_struct_to_map(spark):
    df = spark.createDataFrame([("x", (7, "dry")), ("y", None)], "id string, soil struct<depth:int,kind:string>")
    got = struct_to_map(df, "soil", "soil_map")
    assert got.columns == ["id", "soil_map"]
    assert rows(got)[0] == ("x", {"depth": "7", "kind": "dry"})
    with pytest.raises(ValueError):
        struct_to_map(df, "id", "m")


def test_split_columns(spark):
    df = spark.createDataFrame([("12-b", "oak | tall | old"), ("9", "fir"), ("1-c-d", None)], "plot string, note string")
    splits = {"plot": ("-", ["no", "part"]), "note": (" | ", ["tree", "size", "age"])}
    assert rows(split_columns(df, splits)) == [
        ("12", "b", "oak", "tall", "old"), ("9", None, "fir", None, None), ("1", "c", None, None, None)
    ]
    rest = rows(split_columns(df, splits, further="keep"))
    assert rest[2][:2] == ("1", "c-d") and rest[:2] == rows(split_columns(df, splits))[:2]
    with pytest.raises(Exception, match="more than 2 parts"):
        split_columns(df, splits, further="error").collect()
    with pytest.raises(ValueError):
        split_columns(df, splits, further="some")
    dotted = spark.createDataFrame([("a.b", 1)], "x string, y int")
    assert rows(split_columns(dotted, {"x": (".", ["p", "q"])})) == [("a", "b", 1)]


def test_capitalize(spark):
    df = spark.createDataFrame([("two words",), ("eBook  z ",), ("",), (None,), ("ßa über",)], "q string")
    want = ["Two Words", "EBook  Z ", "", None, "SSa Über"]
    assert [r[0] for r in rows(df.select(capitalize_words("q")))] == want
    assert [r[0] for r in rows(df.select(capitalize_words_udf("q")))] == want
    spark.udf.register("tablewright_test_capitalize", capitalize_words_udf)
    sql = "SELECT tablewright_test_capitalize(q) FROM {df}"
    assert [r[0] for r in spark.sql(sql, df=df).collect()] == want


def test_conditions(spark):
    df = spark.createDataFrame([(5, "w"), (15, "w"), (15, "s"), (None, "s"), (40, None)], "degrees int, season string")
    plain = F.when(F.col("degrees") < 10, "cold").when(F.col("degrees") < 20, "mild").otherwise("?")
    assert [r[0] for r in rows(df.select(plain))] == ["cold", "mild", "mild", "?", "?"]
    both = (
        F.when((F.col("season") == "w") & (F.col("degrees") > 10), "thaw")
        .when((F.col("season") == "s") | (F.col("degrees") >= 40), "summer")
        .otherwise("none")
    )
    assert [r[0] for r in rows(df.select(both))] == ["none", "thaw", "summer", "summer", "summer"]


def test_timestamp_numbers(spark):
    df = spark.createDataFrame([(20190405060708,), (20240229235959,)], "n long")
    parsed = F.try_to_timestamp(F.col("n").cast("string"), F.lit("yyyyMMddHHmmss"))
    assert [str(r[0]) for r in rows(df.select(parsed))] == ["2019-04-05 06:07:08", "2024-02-29 23:59:59"]


def test_merged_schema(spark, tmp_path):
    base = str(tmp_path / "table")
    spark.range(4).selectExpr("id AS n", "id + 1 AS next").write.parquet(f"{base}/key=1")
    spark.range(4, 6).selectExpr("id AS n", "id - 1 AS last").write.parquet(f"{base}/key=2")
    merged = spark.read.option("mergeSchema", "true").parquet(base)
    assert sorted(merged.columns) == ["key", "last", "n", "next"]
    assert merged.count() == 6 and merged.where("last IS NULL").count() == 4


def test_range_aggregates(spark):
    df = spark.range(10).selectExpr("id % 2 AS key", "id")
    got = df.groupBy("key").agg(F.sum("id"), F.count("id"), F.avg("id"), F.min("id"), F.max("id"))
    assert ordered(got) == [(0, 20, 5, 4.0, 0, 8), (1, 25, 5, 5.0, 1, 9)]


@pytest.fixture(scope="module")
def boats(spark):
    return spark.createDataFrame(
        [(("Tern", 1981), ["sail", "oar"], "lake", 4), (("Gull", 1990), ["motor"], "sea", 12),
         (("Tern", 2004), ["oar"], "sea", 2), (("Heron", 1990), ["motor", "sail"], "lake", 6)],
        "built struct<name:string,year:int>, drive array<string>, water string, seats int",
    )


def test_filters(boats):
    spellings = [boats["water"] == "sea", boats.water == "sea", F.col("water") == "sea", F.expr("water = 'sea'")]
    assert {boats.filter(c).count() for c in spellings} == {boats.where("water == 'sea'").count()} == {2}
    assert boats.where("seats > 3").count() == 3
    assert boats.where((F.col("water") == "lake") & (F.col("seats") > 4)).count() == 1
    assert boats.where(F.array_contains("drive", "sail")).count() == 2
    assert boats.where(F.col("built.name") == "Tern").count() == 2
    assert boats.where(F.col("seats").isin(2, 6)).count() == boats.where(F.col("seats").between(2, 4)).count() == 2


def test_maps(spark):
    df = spark.createDataFrame(
        [("p", [("a", 1), ("b", 2)], {"hue": "red", "tone": "dark"}, {"age": "3"}),
         ("q", None, {"hue": "tan", "tone": "tan"}, {"age": "8"}), ("r", [("c", 3)], {}, {})],
        "id string, spots array<struct<place:string,n:int>>, looks map<string,string>, more map<string,string>",
    )
    assert dict(rows(df.select("id", F.sort_array(F.map_keys("looks"))))) == {"p": ["hue", "tone"], "q": ["hue", "tone"], "r": []}
    assert dict(rows(df.select("id", F.sort_array(F.map_values("looks"))))) == {"p": ["dark", "red"], "q": ["tan", "tan"], "r": []}
    both = dict(rows(df.select("id", F.map_concat("looks", "more"))))
    assert both["q"] == {"hue": "tan", "tone": "tan", "age": "8"} and both["r"] == {}
    assert df.select("id", F.explode("spots")).count() == 3


def test_column_changes(spark):
    df = spark.createDataFrame([("s1", "12", "x"), ("s2", "-3", "y"), ("s3", "no", "z")], "stone string, weight string, kind string")
    weight = F.col("weight").try_cast("int")
    got = df.withColumns({"place": F.lit("hall"), "turned": weight * -1}).withColumn("weight", weight * 10)
    assert rows(got.select("weight", "place", "turned")) == [(120, "hall", -12), (-30, "hall", 3), (None, "hall", None)]
    assert df.withColumnRenamed("kind", "sort").drop("weight", "nothing").columns == ["stone", "sort"]


def test_row_map(spark):
    df = spark.createDataFrame([("n", "", "e", 3), ("s", "w", None, 4)], "a string, b string, c string, steps int")
    path = F.concat_ws("-", "a", "b", "c").alias("path")
    assert rows(df.select(path, "steps")) == [("n--e", 3), ("s-w", 4)]


def test_records_in_sql(spark):
    records = spark.range(1, 31).selectExpr("CAST(id AS int) AS no", "'row ' || id AS text")
    assert spark.sql("SELECT count(*) FROM {r}", r=records).first()[0] == 30
    assert spark.sql("SELECT no, text FROM {r} WHERE no <= 4", r=records).count() == 4
    assert rows(records.where("no = 7").select("text")) == [("row 7",)]
    assert records.agg(F.avg("no")).first()[0] == 15.5


def test_json_strings(spark):
    text = '{"river":"Aare","mouth":{"into":"Rhine","km":288}}'
    strings = spark.createDataFrame([(text,)], "value string")
    parsed = strings.select(F.from_json("value", F.schema_of_json(F.lit(text))).alias("p")).select("p.*")
    assert rows(parsed.select("river", "mouth.into", "mouth.km")) == [("Aare", "Rhine", 288)]
