"""Connected components of a graph given by its edges, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.sources.scratch import scratch_path


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) from edges (a, b); the component is its smallest node.

    Nodes without an edge to another are left out, as are edges with a NULL end. Alternates two steps until
    nothing changes: every node hands its larger neighbours, then its smaller ones, to its smallest
    neighbour. The number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder; minima combine on the map side and hot nodes stand on the left of
    the joins, where adaptive execution can split them.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def state(df: DataFrame) -> tuple:
        # a sum of hashes that cannot overflow: equal edges give equal sums in any order
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), "a", "b")
    now = written(ends.filter("a IS NOT NULL AND b IS NOT NULL AND u <> v").select("u", "v").distinct())
    before = None
    while before != (seen := state(now)):
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        now = written(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
