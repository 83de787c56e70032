import math
import random
import zlib
from collections import Counter

import pytest

from tablewright.llm.suffix_tree_lm import score_texts
from tablewright.plans.registry import Tables

SCHEMA = "doc_id long, text string"


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w] + [None]  # None: the end


def brute_force(rows, depth=3, min_count=4, min_gain=1.0, smoothing=50.0):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    count = Counter()
    train = [tokens_of(t) for i, t in rows if not held(i)]
    for words in train:
        for k in range(1, depth + 2):
            count.update(tuple(words[at : at + k]) for at in range(len(words) - k + 1))
    n = sum(v for run, v in count.items() if len(run) == 1)
    rest = n + 0.1 * (sum(len(run) == 1 for run in count) + 1)

    def chances(before, word, contexts, less=0):
        """By number of words of context: the chance of the word, as long as ``contexts`` has the context."""
        told = [(count[(word,)] - less + 0.1) / (rest - less)]
        for k in range(1, min(depth, len(before)) + 1):
            context = tuple(before[-k:])
            if count[context] < min_count:
                break
            if contexts is None or context in contexts:
                told.append((count[(*context, word)] - less + smoothing * told[-1]) / (count[context] - less + smoothing))
            else:
                told.append(told[-1])
        return told

    gains = Counter()
    for words in train:
        for at, word in enumerate(words):
            told = chances(words[max(0, at - depth) : at], word, None, less=1)
            for k in range(1, len(told)):
                gains[tuple(words[at - k : at])] += round(math.log10(told[k] / told[k - 1]) * 2**10)
    states = {context for context, gain in gains.items() if gain >= round(min_gain * 2**10)}
    out = []
    for i, text in rows:
        words = tokens_of(text)
        base = [math.log10((count[(w,)] + 0.1) / rest) for w in words]
        score = [math.log10(chances(words[max(0, at - depth) : at], w, states)[-1]) for at, w in enumerate(words)]
        out.append((i, held(i), len(words), sum(count[(w,)] > 0 for w in words), n, sum(base), sum(score)))
    return out, states


def assert_same(frame, rows, **options):
    got = sorted((tuple(r) for r in score_texts(frame, **options).collect()), key=repr)
    known = {k: v for k, v in options.items() if k in ("depth", "min_count", "min_gain", "smoothing")}
    want, states = brute_force(rows, **known)
    want.sort(key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], abs=1e-6)
    return states


def test_given_documents(spark):
    docs = Tables(spark, "/root/testdata/sf0.001").documents
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    states = assert_same(docs, rows)
    assert {len(s) for s in states} == {1, 2, 3}


@pytest.mark.parametrize("depth,min_count,min_gain,smoothing", [(1, 1, 0.0, 1.0), (2, 2, 0.5, 3.0), (4, 2, -100.0, 5.0)])
def test_small_blocks(spark, depth, min_count, min_gain, smoothing):
    rng = random.Random(depth)
    say = lambda: " ".join(rng.choices(["a", "b", "A", "c,", "dd", "é", "\n", "a b a", "x y"], k=rng.randint(0, 30)))
    rows = [(i, say()) for i in range(150)]
    rows += [(None, "no id"), (3, None), (3, ""), (7, "a b a b a b"), (7, "a b a b a b"), (200, "a b a " * 4000), (201, "unheard of")]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA + ", score string").repartition(5)
    options = {"depth": depth, "min_count": min_count, "min_gain": min_gain, "smoothing": smoothing}
    assert assert_same(frame, rows, block_tokens=100, tokens_per_range=40, **options)


def test_context_tells_more_than_words_alone(spark):
    rng = random.Random(5)
    follows = {w: rng.sample("abcdefghij", 2) for w in "abcdefghij"}

    def walk():
        at, said = rng.choice("abcdefghij"), []
        for _ in range(40):
            said.append(at)
            at = rng.choice(follows[at])
        return " ".join(said)

    frame = spark.createDataFrame([(i, walk()) for i in range(400)], SCHEMA)
    held = [r for r in score_texts(frame).collect() if r.held_out]
    assert held and all(r.score > r.base_score for r in held)
    # two equally likely followers: about log10(2) a word, where words alone take log10(10)
    assert 0.3 < -sum(r.score for r in held) / sum(r.n_tokens for r in held) < 0.5


def test_ids_of_other_types(spark):
    rows = [(f"http://x/{i}", "a b c d " * 5) for i in range(30)] + [(None, "a b"), ("", "b c")]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    assert_same(frame, rows)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert_same(frame, rows)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_empty_and_all_held_out(spark):
    assert score_texts(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "all of it is held out"), (None, None)]
    assert_same(spark.createDataFrame(rows, SCHEMA), rows)


def test_neither_blocks_nor_their_sums_are_moved(spark):
    frame = spark.createDataFrame([(i, "a b c " * 9) for i in range(40)], SCHEMA).repartition(4)
    plan = score_texts(frame, block_tokens=60)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2 and "Exchange" not in plan
