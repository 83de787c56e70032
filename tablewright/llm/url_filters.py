"""URL filters with dates: list entries become validity intervals, joined with captures as of their fetch time.

Only DataFrame functions; no step runs Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and a final dot; NULL where the URL has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def domains_of(host: Column) -> Column:
    """The host and every parent domain: a.b.c, b.c, c."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )


def validity(entries: DataFrame) -> DataFrame:
    """(list, domain, valid_from, valid_to) from dated entries (list, domain, listed_on, action).

    An entry with action ``add`` holds until the list's next entry for the domain, which may renew it
    or ``remove`` it; the last one holds on (``valid_to`` NULL). Entries of one list, domain and date are
    one: any removal wins. Entries without domain, date or a known action are ignored; a list
    of NULL is a list. Domains compare in lower case.
    """
    one = (
        entries.select("list", F.lower("domain").alias("domain"), "listed_on", "action")
        .filter("domain IS NOT NULL AND listed_on IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy("list", "domain", "listed_on")
        .agg(F.max("action").alias("action"))
    )
    after = F.lead("listed_on").over(Window.partitionBy("list", "domain").orderBy("listed_on"))
    return (
        one.withColumn("valid_to", after)
        .filter("action = 'add'")
        .select("list", "domain", F.col("listed_on").alias("valid_from"), "valid_to")
    )


def judge_captures(captures: DataFrame, entries: DataFrame, *, url_col: str = "url", time_col: str = "fetched_on"):
    """The captures, every row with all its columns, plus host, lists and blocked, which replace columns so named.

    ``lists`` names the lists with an entry for the host or one of its parent domains in force when the
    capture was fetched, sorted; ``blocked`` says whether there is any. Captures without host or time are
    not blocked. Each pair of host and time is judged once, so repeated captures and hot hosts cost little;
    a host with many times can be split by adaptive execution, as it stands on the left of both joins.
    """
    host, at = F.col("capture_host"), F.col("capture_time")
    seen = captures.select(F.struct(*(captures[f"`{c}`"] for c in captures.columns)).alias("capture")).select(
        "capture", host_of(F.col(f"capture.`{url_col}`")).alias("capture_host"),
        F.col(f"capture.`{time_col}`").alias("capture_time"),
    )
    asked = seen.select(host, at).filter("capture_host IS NOT NULL AND capture_time IS NOT NULL").distinct()
    spans = validity(entries)
    matched = asked.select(host, at, F.explode(domains_of(host)).alias("domain")).join(
        spans, "domain"
    ).filter((at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))
    verdicts = matched.groupBy(host, at).agg(
        F.array_sort(F.collect_set(F.coalesce("list", F.lit("")))).alias("verdict_lists")
    )
    return seen.join(verdicts, ["capture_host", "capture_time"], "left").select(
        *(F.col(f"capture.`{c}`") for c in captures.columns if c not in ("host", "lists", "blocked")),
        host.alias("host"),
        F.coalesce("verdict_lists", F.array().cast("array<string>")).alias("lists"),
        F.col("verdict_lists").isNotNull().alias("blocked"),
    )


def entries_from_pages(pages: DataFrame) -> DataFrame:
    """Dated entries that the pages' own hosts determine, for trial runs: by digits of each domain's digest.

    About half of the domains are listed, on one or both of two lists; some are taken off again and some put
    back. The domain is the host without its first label if it has four or more.
    """
    host = host_of(F.col("url"))
    domain = F.regexp_replace(host, r"^[^.]+\.((?:[^.]+\.){2,}[^.]+)$", "$1")
    digest = F.md5(F.col("domain"))
    digits = lambda at: F.conv(F.substring(digest, at, 2), 16, 10).cast("int")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    hosts = pages.select(domain.alias("domain")).filter("domain IS NOT NULL").distinct()
    step = lambda name, on_day, action, on: F.struct(
        F.lit(name).alias("list"), day(on_day).alias("listed_on"), F.lit(action).alias("action"), on.alias("on")
    )
    steps = F.array(
        step("spam", digits(1), "add", digits(9) < 128),
        step("spam", digits(1) + digits(3), "remove", digits(9) < 64),
        step("spam", digits(1) + digits(3) + digits(5), "add", digits(9) < 32),
        step("adult", digits(7), "add", digits(11) < 64),
    )
    return hosts.select("domain", F.explode(steps).alias("e")).filter("e.on").select(
        "e.list", "domain", "e.listed_on", "e.action"
    )
