"""Columns by name, also where a name holds dots or backticks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str, of: str | None = None) -> Column:
    """The column ``name``, of the DataFrame with the alias ``of`` if given."""
    return F.col(quoted(name) if of is None else f"{of}.{quoted(name)}")


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def same_name(df: DataFrame):
    """A function that maps spellings which ``spark.sql.caseSensitive`` takes for one name to one text."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return (lambda name: name) if sensitive else str.lower


def resolve_names(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The spelling ``df`` uses for ``names``, matched by ``spark.sql.caseSensitive``."""
    norm = same_name(df)
    known = {norm(c): c for c in df.columns}
    missing = [n for n in names if norm(n) not in known]
    if missing:
        raise ValueError(f"no such column: {missing}; have {df.columns}")
    return [known[norm(n)] for n in names]


def free_name(taken: Iterable[str], name: str) -> str:
    """The name, lengthened by underscores until it meets none of those taken, in any spelling."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name
