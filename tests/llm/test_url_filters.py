import datetime as dt
import random
import re

from pyspark.sql import functions as F

from tablewright.llm.url_filters import host_of, judge_captures, validity

DAY = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)


def brute(captures, entries):
    out = []
    for page, url, day in captures:
        m = re.match(r"[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", (url or "").lower())
        host = (m[1].rstrip(".") or None) if m else None
        lists = set()
        if host and day:
            for l in {e[0] for e in entries}:
                for d in {e[1].lower() for e in entries if e[1]}:
                    if host == d or host.endswith("." + d):
                        past = [(e[2], e[3]) for e in entries if e[0] == l and e[1] and e[1].lower() == d and e[2] and e[2] <= day and e[3] in ("add", "remove")]
                        if past and max(past)[1] == "add":
                            lists.add(l or "")
        out.append((page, host, sorted(lists), bool(lists)))
    return out


def test_against_brute_force(spark):
    rng = random.Random(4)
    hosts = ["a.example.com", "b.a.example.com", "example.com", "x.org", "EXAMPLE.com", "com"]
    entries = [(rng.choice(["spam", "adult", None]), rng.choice(hosts), DAY(rng.randint(0, 20)), rng.choice(["add", "remove", "add"])) for _ in range(40)]
    entries += [("spam", None, DAY(1), "add"), ("spam", "x.org", None, "add"), ("spam", "x.org", DAY(0), "maybe"), entries[0], entries[0]]
    urls = [f"https://{h}/p?q=http://x.org/" for h in hosts] + ["http://u:p@A.Example.com:80/", "ftp://x.org.", "no url", "", None, "https:///x", "https://notexample.com/"]
    captures = [(i, rng.choice(urls), rng.choice([DAY(rng.randint(-1, 22)), None] + [DAY(5)] * 5)) for i in range(300)]
    captures += [(None, urls[0], DAY(9)), captures[0], captures[0], (999, "https://x.org/" + "y" * 200000, DAY(9))]
    c = spark.createDataFrame([(*r, "clash") for r in captures], "page_id long, url string, fetched_on date, list string")
    e = spark.createDataFrame(entries, "list string, domain string, listed_on date, action string")
    got = [(r.page_id, r.host, list(r.lists), r.blocked) for r in judge_captures(c, e).collect()]
    assert sorted(got, key=str) == sorted(brute(captures, entries), key=str)
    assert judge_captures(c, e).columns == [*c.columns, "host", "lists", "blocked"]
    assert judge_captures(c.limit(0), e).count() == 0
    assert judge_captures(c, e.limit(0)).filter("blocked").count() == 0


def test_intervals_and_plan(spark):
    e = spark.createDataFrame(
        [("l", "a.b", DAY(1), "add"), ("l", "a.b", DAY(3), "remove"), ("l", "a.b", DAY(5), "add"), ("l", "a.b", DAY(5), "add")],
        "list string, domain string, listed_on date, action string",
    )
    assert sorted((r.valid_from, r.valid_to) for r in validity(e).collect() if r.valid_to) == [(DAY(1), DAY(3))]
    c = spark.createDataFrame([(1, "http://a.b/", DAY(2))], "page_id long, url string, fetched_on date")
    plan = judge_captures(c, e)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
    assert c.select(host_of(F.col("url")).alias("h")).first().h == "a.b"
