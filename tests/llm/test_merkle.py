import random
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import merkle
from tablewright.llm.queries import CORPUS

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def first_null(v):
    return (v is not None, v if v is not None else 0)


def climb(level):
    """All levels of a tree."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def path_of(levels, place):
    out = []
    for level in levels[:-1]:
        out.append((place ^ 1) % 2 if place ^ 1 < len(level) else None)
        out[-1] = (out[-1], level[place ^ 1] if out[-1] is not None else "")
        place >>= 1
    return out


def brute_force(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        members = sorted(groups[name], key=lambda r: (first_null(r[0]), leaf_of(r)))
        trees.append((members, climb([leaf_of(r) for r in members])))
    top = climb([levels[-1][0] for _, levels in trees])
    root, out = top[-1][0], []
    for number, (members, levels) in enumerate(trees):
        for place, row in enumerate(members):
            path = path_of(levels, place) + path_of(top, number)
            changed = (*row[:3], row[3] if row[3] is None else row[3] + 1, row[4])
            at = leaf_of(changed if tampered(row[0]) else row)
            for side, digest in path:
                at = h(at) if side is None else h(at, digest) if side else h(digest, at)
            out.append((row[0], leaf_of(row), levels[-1][0], root, h(*(d for _, d in path)), at, at == root))
    return out


def assert_same(spark, rows, schema, tampered=lambda i: i is not None and i % 3 == 0, condition="coalesce(doc_id % 3 = 0, false)"):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], schema + ", leaf string").repartition(3)
    got = merkle.audit(docs, F.expr(condition)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_force(rows, tampered), key=repr)


@pytest.mark.parametrize("chunk", [1, 2, 12])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(merkle, "CHUNK", chunk)
    monkeypatch.setattr(merkle, "MOST_ROUNDS", 64)
    rng = random.Random(chunk)
    rows = [(i, rng.choice(["s", "", None]), lang, rng.choice([None, i]), "é" * (i % 4)) for lang, n in (("en", 41), ("fr", 8), (None, 1), ("", 3), ("é", 2)) for i in rng.sample(range(500), n)]
    rows += [(None, None, None, None, None), (None, "s", "en", 1, "x"), (7, "s", "fr", 1, "y"), (7, "s", "fr", 1, "y"), (7, "s", "fr", 2, "z")]
    rows.append((3, "s", "long", 2**63 - 1, "word " * 50_000))
    assert_same(spark, rows, SCHEMA)


def test_one_leaf_and_none(spark):
    assert_same(spark, [(4, "s", "en", 3, "abc")], SCHEMA)
    assert merkle.audit(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0


def test_text_ids(spark):
    rows = [(f"u{k}", "s", "en" if k % 3 else None, k, "t") for k in range(20)] + [(None, "s", "en", 1, "t"), ("", "s", "en", 1, "t")]
    schema = SCHEMA.replace("doc_id long", "doc_id string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        docs = spark.createDataFrame(rows, schema)
        got = merkle.audit(docs, F.lit(False)).collect()
        ordered = [((r[0] or "") if r[0] is not None else None, *r[1:]) for r in rows]
        groups = {}
        for r in ordered:
            groups.setdefault(r[2], []).append(r)
        levels = [climb([leaf_of(r) for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or ""))]) for g in (None, "en")]
        assert {r.root for r in got} == {climb([x[-1][0] for x in levels])[-1][0]}
        assert all(r.verified for r in got) and {r.doc_id for r in got} == {r[0] for r in rows}
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_proofs_for_some_leaves_fetch_what_is_missing(spark, monkeypatch):
    monkeypatch.setattr(merkle, "CHUNK", 4)
    docs = spark.createDataFrame([(k, "s", "en" if k < 90 else "fr", k, "t") for k in range(100)], SCHEMA)
    manifest = merkle.write_manifest(
        docs, merkle.leaf_of([docs[f] for f in FIELDS]), group=docs.lang, order=docs.doc_id, carry={"doc_id": docs.doc_id.cast("string")}
    )
    asked = []
    fetch = merkle.fetch
    monkeypatch.setattr(merkle, "fetch", lambda m, a: asked.append(a) or fetch(m, a))
    chosen = [0, 1, 5, 33, 89, 92]
    wanted = manifest.leaves.filter(F.col("doc_id").isin([str(c) for c in chosen])).withColumn("claimed", F.col("leaf"))
    proofs = merkle.prove(manifest, wanted, carry=("doc_id",)).collect()
    assert sorted(int(p.doc_id) for p in proofs) == chosen
    for p in proofs:
        assert p.folded_root == p.root == manifest.root == merkle.fold(p.leaf, p.sides, p.proof)
        assert merkle.fold(h("other"), p.sides, p.proof) != p.root
    nodes = [(r.tree, r.chunk, r.of, r.level, r["at"]) for r in asked[0].collect()]
    assert len(nodes) == len(set(nodes))
    # leaves 0, 1 and 5 are in one chunk: only what joins none of them is asked for
    assert sorted(n[3:] for n in nodes if n[:3] == (0, 0, 0)) == [(0, 4), (1, 1), (1, 3), (3, 1), (4, 1), (5, 1), (6, 1)]


def test_missing_is_the_least():
    rng = random.Random(1)
    for _ in range(200):
        size = rng.randint(1, 40)
        places = sorted(rng.sample(range(size), rng.randint(1, size)))
        sizes = merkle.level_sizes(size)
        found = set(merkle.missing(np.array(places), sizes))
        have = {(0, p) for p in places}
        needed = set()
        for level, n in enumerate(sizes[:-1]):
            mine = {p >> level for p in places}
            have |= {(level, p) for p in mine}
            needed |= {(level, p ^ 1) for p in mine if p ^ 1 < n and p ^ 1 not in mine}
        assert found == needed


def test_query_on_larger_table(spark):
    folder = "/root/testdata/sf0.01"
    query = CORPUS["op13_merkle_manifest"]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = query(spark, folder)
    names = sorted(got.columns)
    result = connection.execute(query.sql)
    at = [[c[0] for c in result.description].index(n) for n in names]
    assert sorted(tuple(r[i] for i in at) for r in result.fetchall()) == sorted(map(tuple, got.select(names).collect()))
