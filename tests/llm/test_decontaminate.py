import hashlib
import random
import re

from tablewright.llm.decontaminate import WuManber, find_passages, item_blocks, report, without_benchmark

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, size=10):
    words, hit, found = words_of(text), set(), set()
    for item, item_text in items:
        own = words_of(item_text)
        n = min(size, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "Élan", "x9", "naïve", "it"]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.choice([0, 1, 3, 9, 10, 11, 25]) if i > 1 else 12)) for i in range(8)]
    items = [x for x in items if len(words_of(x[1])) not in (1, 3)] + [(90, None), (91, "..."), (5, "the the x9 it")]
    docs = [(i, say(rng.randint(0, 80))) for i in range(60)]
    docs += [(100 + i, say(5) + ", " + t.upper() + "! " + say(5)) for i, t in items if t]
    docs += [(200, None), (201, ""), (202, "--"), (None, items[0][1]), (100, "twice"), (203, "the " * 30000)]
    return docs, items


def test_against_brute_force(spark):
    for seed in range(3):
        rows, items = made(seed)
        docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, hits string")
        bench = spark.createDataFrame(items, "item_id long, text string")
        for block_bytes in (8 << 20, 60):
            got = report(find_passages(docs, bench, block_bytes=block_bytes)).collect()
            key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
            want = [(i, *brute(t, items)) for i, t in rows]
            assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
        kept = without_benchmark(docs, bench)
        assert kept.columns == docs.columns
        clean = [r[0] for r in rows if not brute(r[1], items)[-1]]
        assert sorted(r.doc_id for r in kept.collect()) == sorted(clean)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in report(find_passages(docs, none)).collect()] == [(3, 0)]
    assert report(find_passages(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id"))).count() == 0
    assert without_benchmark(docs, none).count() == 1


def test_search_skips():
    words = [f"w{i}".encode() for i in range(10)]
    looked = 0

    class Counting(dict):
        def get(self, *a):
            nonlocal looked
            looked += 1
            return super().get(*a)

    search = WuManber(10, {tuple(words): ["x"]})
    search.shift = Counting(search.shift)
    text = [b"z"] * 900 + words
    assert [at for at, _ in search.find(text)] == [900]
    assert looked < 120


def test_each_block_is_searched_by_itself(spark):
    rows, items = made(1)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, hits string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = sorted(r[0] or 0 for r in rows if not brute(r[1], items)[-1])
    for options in ({"block_bytes": 60}, {"block_windows": 8}):
        kept = without_benchmark(docs, bench, **options)
        assert kept.columns == docs.columns
        assert kept._jdf.queryExecution().toString().count("MapInArrow") <= 4  # one for each of the four plans shown
        assert sorted(r.doc_id or 0 for r in kept.collect()) == clean


def test_blocks_by_windows(spark):
    bench = spark.createDataFrame([(i, "a b c d e f g h i j k l") for i in range(5)], "item_id long, text string").coalesce(1)
    assert [len(b) for b in item_blocks(bench, "item_id", "text", 8 << 20, 10, 7)] == [2, 2, 1]
