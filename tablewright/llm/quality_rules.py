"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Languages whose frequent words are listed.
LISTED = ("en", "es", "fr", "de")
#: Frequent words of these four. Only words in lower case count, so that a text in capitals has none.
STOP_WORDS = (
    "the and of to in is that for with was on are as by be at from it this "
    "de la que el en y los del se las por un para con una su al lo "
    "le les et des est dans pour qui sur au une par ne pas plus "
    "der die und das den von zu mit ist ein eine auf dem nicht im"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep documents with ``low <= measure / per <= high``; a bound of None is open.

    Where the language of a document is known, a rule with ``langs`` is for documents of these languages only.
    """

    measure: str
    per: str
    low: str | None = None
    high: str | None = None
    langs: tuple[str, ...] | None = None


#: A rejected document breaks at least one rule. Bounds are decimals given as text, compared exactly.
RULES = (
    Rule("word_chars", "n_words", low="2", high="15"),
    Rule("n_symbols", "n_words", high="0.1"),
    Rule("n_shouts", "n_words", high="0.3"),
    Rule("n_stop_words", "n_words", low="0.01", langs=LISTED),
    Rule("n_dup_lines", "n_text_lines", high="0.5"),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where ``use`` names it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _without(text: Column, characters: str) -> Column:
    """The text without some ASCII characters; a search per character is faster than ``translate``."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _spaced(text: Column) -> Column:
    for c in BLANKS[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _repeat_words(words: Column) -> Column:
    """Words covered by windows of eight words that stand in the text twice or more."""
    size = 8

    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            _let(
                F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
                lambda s: _let(
                    F.array_sort(
                        F.transform(
                            F.filter(
                                s,
                                lambda e, k: F.coalesce(e.w == F.get(s, k - 1).w, F.lit(False))
                                | F.coalesce(e.w == F.get(s, k + 1).w, F.lit(False)),
                            ),
                            lambda e: e.i,
                        )
                    ),
                    lambda at: F.aggregate(
                        F.transform(
                            at, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size)))
                        ),
                        F.lit(0),
                        lambda total, step: total + step,
                    ),
                ),
            )
        )

    def with_next(hashes: Column, *steps: int) -> Column:
        """Each hash together with those ``steps`` further on; short at the end."""
        return F.transform(hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in steps)))

    n = F.size(words)
    return F.when(n <= size, F.lit(0)).otherwise(
        _let(
            F.transform(words, lambda w: F.xxhash64(w)),
            lambda one: _let(
                with_next(one, 1, 2, 3),
                # a repeated window of eight holds a repeated window of four, which most texts have not
                lambda four: F.when(F.size(F.array_distinct(four)) == F.size(four), F.lit(0)).otherwise(
                    _let(F.slice(with_next(four, 4), 1, F.size(four) - 7), of_windows)
                ),
            ),
        )
    )


def _ratio(rule: Rule) -> Column:
    """The rule over whole numbers, so that no rounding decides."""
    value, per = F.col(rule.measure).cast("decimal(20,0)"), F.col(rule.per).cast("decimal(20,0)")
    ok = F.lit(True)
    if rule.low is not None:
        low = Fraction(rule.low)
        ok = ok & (value * low.denominator >= per * low.numerator)
    if rule.high is not None:
        high = Fraction(rule.high)
        ok = ok & (value * high.denominator <= per * high.numerator)
    return ok


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, carry: bool = False
) -> DataFrame:
    """One row per document with its counts; ``carry`` keeps the input in one struct column ``source_row``.

    Words are runs of characters other than blanks. A NULL or empty text has no words and no lines.
    Windows of words are compared by 64-bit hashes within one document. Repeated rows stay repeated;
    other columns are not read.
    """
    base = docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        *([F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("source_row")] if carry else []),
    )
    text = F.col("text")
    split = base.withColumns(
        {
            "words": F.array_remove(F.split(_spaced(text), " "), ""),
            "lines": F.filter(F.split(text, "\n"), lambda l: F.length(_without(l, BLANKS)) > 0),
        }
    )
    count = lambda chars: (F.length(text) - F.length(_without(text, chars))).cast("long")
    return split.select(
        "doc_id",
        *(["source_row"] if carry else []),
        F.size("words").cast("long").alias("n_words"),
        F.length(_without(text, BLANKS)).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count("!?").alias("n_shouts"),
        F.size(F.filter("words", lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_text_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def judge(
    measured: DataFrame,
    rules: Sequence[Rule] = RULES,
    *,
    min_words: int = 20,
    repeat_percent: int = 30,
    lang: Column | None = None,
):
    """Add ``base_failed`` and ``kept``; a document that fails the base is never kept.

    ``lang`` is the language of each document, as 'en' or 'en-GB'; where it is NULL, empty or not given, every rule holds.
    """
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent)
    verdict = F.lit(True)
    for rule in rules:
        ok = _ratio(rule)
        if lang is not None and rule.langs is not None:
            own = F.nullif(F.lower(F.regexp_extract(lang.cast("string"), "^[A-Za-z]*", 0)), F.lit(""))
            ok = ok | F.coalesce(~own.isin(*rule.langs), F.lit(False))
        verdict = verdict & ok
    return measured.withColumns({"base_failed": failed, "kept": ~failed & verdict})


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, **options) -> DataFrame:
    """Counts and verdict of every document: one scan, one projection, no shuffle."""
    return judge(measure(docs, **options), rules)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, *, lang_col: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their columns as they came; ``lang_col`` is used if there is one."""
    own = next((c for c in docs.columns if c.lower() == lang_col.lower()), None)
    lang = None if own is None else F.col("source_row.`" + own.replace("`", "``") + "`")
    return judge(measure(docs, carry=True), rules, lang=lang).filter("kept").select("source_row.*")


def rules_sql(rules: Sequence[Rule] = RULES) -> str:
    """The verdict in SQL over the same counts."""
    parts = []
    for r in rules:
        for bound, sign in ((r.low, ">="), (r.high, "<=")):
            if bound is not None:
                f = Fraction(bound)
                parts.append(f"{r.measure} * {f.denominator} {sign} {r.per} * {f.numerator}")
    return " AND ".join(parts)
