"""Schema changes of a table, as an ordered list of small descriptions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.names import col, same_name


@dataclass(frozen=True)
class AddColumn:
    name: str
    dtype: str
    default: Any = None


@dataclass(frozen=True)
class DropColumn:
    name: str


@dataclass(frozen=True)
class RenameColumn:
    name: str
    to: str


@dataclass(frozen=True)
class CastColumn:
    """Change a column's type; a value that does not convert becomes NULL."""

    name: str
    dtype: str


Change = AddColumn | DropColumn | RenameColumn | CastColumn


def evolve_schema(df: DataFrame, changes: Iterable[Change]) -> DataFrame:
    """Apply the changes in order, as one projection over ``df``.

    Names match by ``spark.sql.caseSensitive``, as everywhere in Spark.
    """
    norm = same_name(df)
    columns = {norm(c): (c, col(c)) for c in df.columns}
    for change in changes:
        known = norm(change.name)
        if isinstance(change, AddColumn):
            if known in columns:
                raise ValueError(f"column {change.name!r} exists already")
            columns[known] = (change.name, F.lit(change.default).cast(change.dtype))
            continue
        if known not in columns:
            raise ValueError(f"no column {change.name!r}; have {[n for n, _ in columns.values()]}")
        name, value = columns[known]
        if isinstance(change, DropColumn):
            del columns[known]
        elif isinstance(change, CastColumn):
            columns[known] = (name, value.try_cast(change.dtype))
        elif norm(change.to) in columns and norm(change.to) != known:
            raise ValueError(f"column {change.to!r} exists already")
        else:
            columns = {
                (norm(change.to) if k == known else k): ((change.to, c) if k == known else (n, c))
                for k, (n, c) in columns.items()
            }
    return df.select(*[c.alias(n) for n, c in columns.values()])
