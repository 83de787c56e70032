"""A Merkle tree over a dataset, and proofs for many leaves at once (octopus multiproofs).

Every row is a leaf. The leaves of a group make a tree, the groups' roots make one more tree, whose root stands
for the dataset. A node is the digest of its children's digests as hex text, joined; a last child without a neighbour
makes a node by itself.

Trees are built and proofs are made in chunks: ``2**CHUNK`` neighbouring leaves, then as many neighbouring chunks, and
so on. A leaf partition is a chunk of leaves. For all of its wanted leaves together it works out which nodes are needed
and don't follow from the leaves it has, fetches each of these once, derives the rest, and reads every leaf's
own proof off them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.ranking import numbered
from tablewright.sources.scratch import scratch_path

#: Levels that one task derives: a chunk has ``2**CHUNK`` leaves at most.
CHUNK = 12
#: The number of the tree over the groups' roots; groups' trees count from 0.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rounds of levels, enough for any 64-bit number of leaves.
MOST_ROUNDS = 6
NODE = "tree long, level int, place long, digest string, is_root boolean"
ASKED = "tree long, chunk long, of long, round int, level int, at long"


def digest_of(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def encoded_field(value: Column) -> Column:
    """``-`` for NULL, otherwise the number of its bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded_field, fields)).cast("binary"), 256)


def parents(level: list[str]) -> list[str]:
    return [digest_of(level[k : k + 2]) for k in range(0, len(level), 2)]


def missing(places: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(level, place) of the nodes that the leaves at ``places`` lack for their proofs: the least that will do.

    ``sizes`` has the number of nodes on each level, the leaves' first.
    """
    for level, size in enumerate(sizes[:-1]):
        beside = places ^ 1
        lacking = beside[(beside < size) & ~np.isin(beside, places)]
        yield from ((level, place) for place in lacking.tolist())
        places = np.unique(places >> 1)


def level_sizes(leaves: int) -> list[int]:
    sizes = [leaves]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // 2))
    return sizes


def derive(known: dict[tuple[int, int], str], places: np.ndarray, sizes: list[int]) -> str:
    """Put all nodes above the leaves at ``places`` into ``known``; returns the root."""
    for level, size in enumerate(sizes[:-1]):
        places = np.unique(places >> 1)
        for p in places.tolist():
            pair = [known[level, 2 * p]]
            if 2 * p + 1 < size:
                pair.append(known[level, 2 * p + 1])
            known[level + 1, p] = digest_of(pair)
    return known[len(sizes) - 1, 0]


def proof_of(known: dict[tuple[int, int], str], place: int, sizes: list[int]) -> tuple[str, str]:
    """A leaf's proof in its tree, from below: a sign for each level, and the digests beside its path, joined.

    ``r`` and ``l`` say that the digest stands on the right or the left, ``-`` that there is none.
    """
    sides, digests = [], []
    for level, size in enumerate(sizes[:-1]):
        beside = place ^ 1
        if beside < size:
            sides.append("r" if beside & 1 else "l")
            digests.append(known[level, beside])
        else:
            sides.append("-")
        place >>= 1
    return "".join(sides), "".join(digests)


def fold(leaf: str, sides: str, digests: str) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    for side in sides:
        if side == "-":
            leaf = digest_of([leaf])
            continue
        beside, at = digests[at : at + 64], at + 64
        leaf = digest_of([leaf, beside] if side == "r" else [beside, leaf])
    return leaf


@dataclass(frozen=True)
class Manifest:
    """``leaves``: (tree, place, size, leaf, and what was carried along). ``nodes``: by round of ``CHUNK`` levels, (tree,
    level, place, digest, is_root); those of round -1 are the leaves of all trees. The number of ``groups`` and the ``root``."""

    leaves: DataFrame
    nodes: dict[int, DataFrame]
    groups: int
    root: str | None


def _as_nodes(leaves: DataFrame) -> DataFrame:
    return leaves.selectExpr("tree", "0 AS level", "place", "leaf AS digest", "size = 1 AS is_root")


def _chunk_above(base: int):
    """A function from a chunk's nodes on level ``base`` to those on the next ``CHUNK`` levels."""

    def chunk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        tree, size, place = (int(rows[c].iloc[0]) for c in ("tree", "size", "place"))
        nodes, out, top = rows["digest"].tolist(), [], len(level_sizes(size)) - 1
        for up in range(base + 1, min(top, base + CHUNK) + 1):
            nodes, place = parents(nodes), place >> 1
            out += [(tree, up, place + k, d, up == top) for k, d in enumerate(nodes)]
        return pd.DataFrame(out, columns=["tree", "level", "place", "digest", "is_root"])

    return chunk


def _grow(leaves: DataFrame, path: str) -> dict[int, DataFrame]:
    """The nodes over (tree, place, size, leaf) by round; a chunk of neighbours of one tree is one group."""
    spark = leaves.sparkSession
    most = leaves.agg(F.max("size")).first()[0] or 0
    rounds = {-1: _as_nodes(leaves)}
    level = leaves.withColumnRenamed("leaf", "digest")
    for made in range(MOST_ROUNDS):
        base = made * CHUNK
        if most <= 1 << base:
            break

        # a tree with a single node by now is done
        unfinished = level.filter(F.col("size") > 1 << base).withColumn("chunk", F.shiftright("place", CHUNK))
        grouped = unfinished.select("tree", "chunk", "place", "size", "digest").groupBy("tree", "chunk")
        grouped.applyInPandas(_chunk_above(base), NODE).write.parquet(f"{path}-{made}")
        rounds[made] = spark.read.schema(NODE).parquet(f"{path}-{made}")
        tops = rounds[made].filter(F.col("level") == base + CHUNK)
        level = tops.join(leaves.filter("place = 0").select("tree", "size"), "tree")
    return rounds


def write_manifest(
    rows: DataFrame, leaf: Column, *, group: Column, order: Column, carry: dict[str, Column] | None = None
) -> Manifest:
    """The tree over all rows: leaves in order of ``order`` within each ``group``, groups in order of their text.

    NULL comes first in both orders; rows of one group and order follow their digests, so that equal rows are leaves
    of their own. ``carry`` names columns that stay with the leaves. Everything is written to the shared folder.
    An empty table has no root.
    """
    spark, carry = rows.sparkSession, carry or {}
    path = scratch_path(spark, "merkle")
    kept = [c.alias(f"carried_{n}") for n, c in carry.items()]
    leaves = rows.select(group.cast("string").alias("group"), order.alias("rank"), leaf.alias("leaf"), *kept)
    placed = numbered(leaves, F.asc_nulls_first("group"), F.asc_nulls_first("rank"), "leaf", name="at")
    sizes = placed.groupBy("group").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    groups = numbered(sizes.withColumnRenamed("group", "of"), F.asc_nulls_first("of"), name="number")
    placed.join(groups, F.col("group").eqNullSafe(F.col("of"))).select(
        (F.col("number") - 1).alias("tree"), (F.col("at") - F.col("first")).alias("place"), "size", "leaf",
        *(F.col(f"carried_{n}").alias(n) for n in carry),
    ).write.parquet(f"{path}/leaves")
    leaves = spark.read.parquet(f"{path}/leaves")
    nodes = _grow(leaves.select("tree", "place", "size", "leaf"), f"{path}/nodes")
    found = reduce(DataFrame.unionByName, nodes.values()).filter("is_root")
    n = leaves.filter("place = 0").count()
    roots = found.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n).cast("long").alias("size"), F.col("digest").alias("leaf")
    )
    roots.write.parquet(f"{path}/roots")
    top = _grow(spark.read.parquet(f"{path}/roots"), f"{path}/top")
    last = reduce(DataFrame.unionByName, top.values()).filter("is_root").first()
    for k, more in top.items():
        nodes[k] = nodes[k].unionByName(more) if k in nodes else more
    return Manifest(leaves, nodes, n, last["digest"] if last else None)


def fetch(manifest: Manifest, asked: DataFrame) -> DataFrame:
    """The digests of the nodes asked for; only rounds that are asked for are read."""
    rounds = [r["round"] for r in asked.select("round").distinct().collect()]  # a few, by the trees' height
    nodes = reduce(DataFrame.unionByName, [manifest.nodes[k] for k in sorted(rounds)] or [manifest.nodes[-1].limit(0)])
    nodes = nodes.select(F.col("tree").alias("of"), "level", F.col("place").alias("at"), "digest")
    return asked.join(nodes, ["of", "level", "at"]).select("tree", "chunk", "of", "level", "at", "digest")


def prove(manifest: Manifest, wanted: DataFrame, *, carry: tuple[str, ...] = ()) -> DataFrame:
    """(what is carried, leaf, subroot, root, sides, proof, folded_root) for the wanted leaves.

    ``wanted`` has rows of ``manifest.leaves`` and, in a column ``claimed``, the digest that is said to be the leaf.
    ``sides`` and ``proof`` lead from the leaf over its group's root to ``root`` (see ``proof_of``); ``folded_root``
    is where they lead from the claimed digest. Carried columns are texts.
    """
    spark, groups, root = wanted.sparkSession, manifest.groups, manifest.root
    wanted = wanted.withColumn("chunk", F.shiftright("place", CHUNK))
    over = level_sizes(groups)

    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        tree, chunk = int(rows["tree"].iloc[0]), int(rows["chunk"].iloc[0])
        places = np.unique(rows["place"].to_numpy(dtype=np.int64))
        lacking = [(tree, *node) for node in missing(places, level_sizes(int(rows["size"].iloc[0])))]
        lacking += [(TOP, *node) for node in missing(np.array([tree]), over)]
        out = [(tree, chunk, of, (level - 1) // CHUNK, level, at) for of, level, at in lacking]
        return pd.DataFrame(out, columns=["tree", "chunk", "of", "round", "level", "at"])

    path = scratch_path(spark, "merkle-asked")
    places = wanted.select("tree", "chunk", "place", "size").groupBy("tree", "chunk")
    places.applyInPandas(ask, ASKED).write.parquet(path)
    fetched = fetch(manifest, spark.read.schema(ASKED).parquet(path))

    def expand(rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        tree, sizes = int(rows["tree"].iloc[0]), level_sizes(int(rows["size"].iloc[0]))
        own, top = {}, {}
        for of, level, at, digest in nodes[["of", "level", "at", "digest"]].itertuples(index=False):
            (top if of == TOP else own)[level, at] = digest
        places = rows["place"].tolist()
        own |= {(0, p): leaf for p, leaf in zip(places, rows["leaf"], strict=True)}
        subroot = derive(own, np.unique(np.array(places, dtype=np.int64)), sizes)
        top[0, tree] = subroot
        reached = derive(top, np.array([tree]), over)
        above = proof_of(top, tree, over)
        out = []
        for place, leaf, claimed, *carried in rows[["place", "leaf", "claimed", *carry]].itertuples(index=False):
            sides, digests = map(str.__add__, proof_of(own, place, sizes), above)
            folded = reached if claimed == leaf else fold(claimed, sides, digests)
            out.append((*carried, leaf, subroot, root, sides, digests, folded))
        return pd.DataFrame(out, columns=[*carry, "leaf", "subroot", "root", "sides", "proof", "folded_root"])

    schema = ", ".join(f"`{c}` string" for c in (*carry, "leaf", "subroot", "root", "sides", "proof", "folded_root"))
    rows = wanted.select("tree", "chunk", "place", "size", "leaf", "claimed", *carry)
    return rows.groupBy("tree", "chunk").cogroup(fetched.groupBy("tree", "chunk")).applyInPandas(expand, schema)


def audit(docs: DataFrame, tampered: Column, *, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", id_col: str = "doc_id", number_col: str = "n_chars") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Rows where ``tampered`` is true claim a leaf in which ``number_col`` is one more (NULL stays NULL); their proofs must not lead to the
    root. Fields of any type count as their text; ids of any type order by that type, NULL ids first. Repeated rows are
    leaves of their own, beside each other. Other columns are ignored, an empty table gives no row.
    """
    one_more = (docs[number_col].cast("decimal(38,0)") + 1).cast("string")
    original = [docs[f] for f in fields]
    changed = [one_more if f == number_col else docs[f] for f in fields]
    carry = {"doc_id": docs[id_col].cast("string"), "claimed": F.when(tampered, leaf_of(changed))}
    manifest = write_manifest(docs, leaf_of(original), group=docs[group_col], order=docs[id_col], carry=carry)
    wanted = manifest.leaves.withColumn("claimed", F.coalesce("claimed", "leaf"))
    return prove(manifest, wanted, carry=("doc_id",)).select(
        F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
