import re
from collections import Counter

import pytest

from tablewright.llm.quality_rules import STOP_WORDS, keep_good, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [l for l in text.split("\n") if WORD.search(l)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_shouts": sum(c in "!?" for c in text),
        "n_stop_words": sum(w in STOP_WORDS for w in words),
        "n_text_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }


GOOD = "The house by the river was built from old stones and it is still in use as a school for the valley.\n"
TEXTS = [
    None, "", " \t\n", "one", "a b c d e f g h", GOOD, GOOD * 3, GOOD + "x\n" * 4, "é " * 30, "𝒳 the 𝒳 y " * 9,
    "\x0b\x0cthe  and\r\nof\r\nof\r\n", "##| $ " * 20 + GOOD, "SHOUT!! " * 40, " ".join(f"w{i}" for i in range(30000)),
    " ".join("abcdefghij"[i % 10] for i in range(5000)), "a b c d e f g h i a b c d e f g h i j k l m n o p q r",
]


def test_counts_equal_brute_force(spark):
    rows = [(i, t, "x", "clash") for i, t in enumerate(TEXTS)] + [(None, GOOD, None, None), (5, GOOD, "y", "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, n_words string")
    got = quality_rules(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r.asDict())
    assert len(by_id[5]) == 2 and len(by_id[None]) == 1
    for i, text in enumerate(TEXTS):
        expected = brute(text)
        failed = expected["n_words"] < 20 or 100 * expected["n_repeat_words"] > 30 * expected["n_words"]
        for r in by_id[i]:
            assert {k: r[k] for k in expected} == expected, i
            assert r["base_failed"] == failed and not (failed and r["kept"])


def test_keeps_columns_and_clean_documents(spark):
    docs = spark.createDataFrame(
        [(1, GOOD, "a"), (2, GOOD.replace(" ", " # ", 5), "b"), (3, "short", "c"), (4, None, "d")],
        "doc_id long, text string, kept string",
    )
    assert [tuple(r) for r in keep_good(docs).collect()] == [(1, GOOD, "a")]
    assert keep_good(docs).columns == docs.columns
    assert quality_rules(docs.limit(0)).count() == 0


def test_no_python_and_no_shuffle(spark):
    plan = quality_rules(spark.createDataFrame([(1, GOOD)], "doc_id long, text string"))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", text)


@pytest.mark.parametrize("name", ["op6_quality_rules"])
def test_query_is_whole(spark, name):
    from tablewright.llm.queries import CORPUS

    folder = "/root/testdata/sf0.001"
    assert CORPUS[name](spark, folder).count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_languages_without_stop_words_are_left_to_the_other_rules(spark):
    russian = "Старый дом у реки стоит много лет и теперь служит школой для всей долины где дети учатся читать и писать каждый день зимой"
    docs = [(1, russian, "ru"), (2, russian, "en"), (3, russian, None), (4, "# " * 9 + russian, "ru"), (5, russian, "EN-gb"), (6, GOOD, "el")]
    kept = keep_good(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 6]
