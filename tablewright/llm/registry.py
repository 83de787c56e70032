"""The corpus queries by name."""

from __future__ import annotations

from tablewright.plans.registry import Query

CORPUS: dict[str, Query] = {}


def corpus_query(name: str, sql: str | None = None):
    """Register a function ``(spark, tables) -> DataFrame``; ``sql`` is what checks it, if SQL can."""

    def add(run):
        CORPUS[name] = Query(name, run, sql)
        return run

    return add
