import random
import re
from fractions import Fraction

import numpy as np
import pytest

from tablewright.llm.connected import connected_components
from tablewright.llm.ngram_join import Links, jaccard_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def groups(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute(rows, size, percent):
    low = lambda i: -(2**63) if i is None else i
    sets = [shingles(t, size) for _, t in rows]
    edges = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and Fraction(len(sets[i] & sets[j]), len(sets[i] | sets[j])) >= Fraction(percent, 100)
    ]
    of = groups(range(len(rows)), edges)
    least = {}
    for i, g in of.items():
        least[g] = min(least.get(g, low(rows[i][0])), low(rows[i][0]))
    shown = lambda i: None if i == low(None) else i
    return [(r[0], len(s), shown(least[of[i]])) for i, (r, s) in enumerate(zip(rows, sets))]


def made(seed, copies=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(6):
        base = rng.choices(vocabulary, k=rng.randint(30, 120))
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 8])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            words = words[: len(words) - rng.choice([0, 0, 1, 5])]
            rows.append((len(rows), " ".join(words)))
    hot = " ".join(rng.choices(vocabulary, k=15))
    rows += [(1000 + i, hot + " " + " ".join(rng.choices(vocabulary, k=40))) for i in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one Two"), (2004, "ONE two"), (2005, "one"), (None, rows[3][1])]
    rows += [(5, rows[5][1]), (5, "another text under the same id"), (2**62 + 1, "long " + " ".join(rng.choices(vocabulary, k=20000)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,percent,block", [(4, 85, 1000), (5, 80, 7), (1, 50, 10), (2, 100, 3)])
def test_against_brute_force(spark, words, percent, block):
    rows = made(words * percent)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, class string")
    got = jaccard_groups(docs, words=words, percent=percent, block=block).collect()
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in got]
    assert sorted(found, key=repr) == sorted(brute(rows, words, percent), key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_groups(docs).count() == 0
    assert jaccard_groups(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 1


def test_links_join_what_is_similar():
    rng = np.random.default_rng(3)
    for trial in range(40):
        base = rng.choice(500, 60, replace=False)
        sets = []
        for _ in range(30):
            keep = base[rng.random(60) > rng.choice([0.02, 0.1, 0.4])]
            sets.append(np.unique(np.concatenate([keep, rng.integers(500, 900, rng.integers(0, 6))])).astype(np.uint64))
        names = [str(i) for i in range(30)]
        sides = [int(i % 2) for i in range(30)] if trial % 2 else None
        found = Links(names, np.array([len(s) for s in sets]), sets, 75).edges(sides)
        plain = [
            (names[i], names[j])
            for i in range(30)
            for j in range(i)
            if (sides is None or sides[i] != sides[j])
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
        ]
        partition = lambda e: {frozenset(k for k, v in groups(names, e).items() if v == g) for g in groups(names, e).values()}
        assert partition(found) == partition(plain)


def test_components(spark):
    rng = random.Random(9)
    edges = [(f"{i:05d}", f"{i + 1:05d}") for i in range(0, 300)]
    edges += [(f"{rng.randint(1000, 1600):05d}", f"{rng.randint(1000, 1600):05d}") for _ in range(400)]
    edges += [("hub", f"{i:05d}") for i in range(2000, 2500)]
    edges += [(None, "x"), ("alone", "alone")]
    frame = spark.createDataFrame(edges, "a string, b string")
    real = [(a, b) for a, b in edges if a and b and a != b]
    want = groups({n for e in real for n in e}, real)
    assert {r.node: r.component for r in connected_components(frame).collect()} == want
    assert connected_components(frame.limit(0)).count() == 0
