import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tablewright.llm.line_dedup import CuckooFilter, LineIndex, dedupe_lines


def key(line):
    k = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    return k if len(k) >= 20 else None


def brute(rows, index_rows=None):
    held = defaultdict(set)
    low = lambda i: -(2**63) if i is None else i
    for i, text in index_rows if index_rows is not None else rows:
        for line in (text or "").split("\n"):
            if key(line):
                held[key(line)].add(low(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [l for l in lines if not (key(l) and len(held[key(l)]) >= 3 and max(held[key(l)]) != low(i))]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def order(r):
    return (r[0] is not None, r[0] or 0, r[1:])


def made(seed, n=60):
    rng = random.Random(seed)
    lines = [f"A common LINE number {i} that several documents hold" for i in range(12)]
    lines += ["short", "", "  \t", "éééééééééééééééééééé", "exactly twenty chars", "nineteen characters"]
    rows = []
    for i in range(n):
        own = [rng.choice([" ", "", "\t"]) + rng.choice(lines) + rng.choice(["", " ", "\r"]) for _ in range(rng.randint(0, 8))]
        rows.append((i, "\n".join([*own, f"line of document {i} and no other one"])))
    hot = "This line stands in a third of all the documents, at least"
    rows += [(100 + i, hot + "\n" + hot.upper()) for i in range(40)]
    return rows + [(500, None), (501, ""), (502, "\n\n"), (7, lines[3]), (None, lines[4]), (None, lines[5]), (503, "x " * 50000)]


def test_against_brute_force(spark):
    for seed in range(2):
        rows = made(seed)
        docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, key string")
        got = sorted(map(tuple, dedupe_lines(docs).collect()), key=order)
        assert got == sorted(brute(rows), key=order)
    assert dedupe_lines(docs.limit(0)).count() == 0


def test_deletion_takes_everything_back(spark, monkeypatch):
    monkeypatch.setattr("tablewright.llm.line_dedup.KEYS_PER_SHARD", 5)
    rows = [r for r in made(3) if r[0] not in (7, None)]
    frame = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    first, second, third = rows[::3], rows[1::3], rows[2::3]
    index = LineIndex(spark)
    keys = [index.keys_of(frame(p)) for p in (first, second, third)]
    for k in keys:
        index.insert(k)
    check = lambda left: sorted(map(tuple, index.dedupe(frame(first), keys[0]).collect()), key=order) == sorted(
        brute(first, left), key=order
    )
    assert check(rows)
    index.delete(keys[2])
    assert check(first + second)
    index.delete(keys[1])
    assert check(first)
    alone = LineIndex(spark)
    alone.insert(keys[0])
    assert sorted(map(tuple, index.counts.collect())) == sorted(map(tuple, alone.counts.collect()))
    index.insert(keys[1])
    assert check(first + second)


def test_filter():
    keys = [xxhash.xxh3_128_digest(str(i)) for i in range(20000)]
    f = CuckooFilter.of(keys[:10000])
    assert f.contains(keys[:10000]).all()
    assert f.contains(keys[10000:]).mean() < 0.01
    f = CuckooFilter.from_bytes(f.to_bytes())
    f.delete(keys[:9000])
    assert f.contains(keys[9000:10000]).all() and f.contains(keys[:9000]).mean() < 0.01
    assert (f.table > 0).sum() == 1000
    small = CuckooFilter(np.zeros((4, 4), dtype="<u2"))
    assert not small.insert(keys[:100])
    with pytest.raises(KeyError):
        CuckooFilter.sized_for(4).delete(keys[:1])


def test_saved_in_one_session_and_opened_in_another(spark, tmp_path):
    shared = "a line that is long enough"
    docs = spark.createDataFrame(
        [(k, f"{shared}\nonly document {k} has this one") for k in range(5)], "doc_id long, text string"
    )
    index = LineIndex(spark)
    for k in (0, 1, 2, 3):
        index.insert(index.keys_of(docs.filter(f"doc_id = {k}")))
    index.delete(index.keys_of(docs.filter("doc_id = 3")))
    index.save(str(tmp_path / "index"))

    again = LineIndex.open(spark.newSession(), str(tmp_path / "index"))
    assert len(again.holders) == 1 and again.shards == index.shards
    state = lambda i: sorted((bytes(r.key), r.n_docs, r.top_doc) for r in i.counts.collect())
    assert state(again) == state(index)

    def dropped(*ids):
        left = docs.filter(docs.doc_id.isin(*ids))
        return {r.doc_id: r.n_dropped for r in again.dedupe(left, again.keys_of(left)).collect()}

    assert dropped(0, 1, 2) == {0: 1, 1: 1, 2: 0}
    again.delete(again.keys_of(docs.filter("doc_id = 2")))  # its largest holder, known from before
    assert dropped(0, 1) == {0: 0, 1: 0}
    again.insert(again.keys_of(docs.filter("doc_id = 4")))
    assert dropped(0, 1, 4) == {0: 1, 1: 1, 4: 0}
    assert LineIndex.open(spark, str(tmp_path / "index")).counts.count() == 4  # the folder is as it was


def test_empty_index_saved(spark, tmp_path):
    LineIndex(spark, min_docs=2, min_chars=5).save(str(tmp_path / "index"))
    index = LineIndex.open(spark, str(tmp_path / "index"))
    assert (index.min_docs, index.min_chars, index.shards) == (2, 5, 0)
    docs = spark.createDataFrame([(1, "a line"), (2, "a line")], "doc_id long, text string")
    index.insert(index.keys_of(docs))
    assert {r.doc_id: r.n_dropped for r in index.dedupe(docs, index.keys_of(docs)).collect()} == {1: 1, 2: 0}
