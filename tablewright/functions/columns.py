"""Column helpers that Spark has no single function for."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import col


def split_columns(
    df: DataFrame, splits: Mapping[str, tuple[str, Sequence[str]]], further: str = "drop"
) -> DataFrame:
    """Replace text columns by the parts between a separator.

    ``splits`` maps a column to (separator, names). Parts are not trimmed; a row
    with too few parts gets NULL for the missing ones. ``further`` says what happens to
    parts beyond the names: ``"drop"`` leaves them out, ``"keep"`` leaves them in the last
    column with their separators, ``"error"`` fails the query.
    """
    if further not in ("drop", "keep", "error"):
        raise ValueError(f"further must be drop, keep or error, not {further!r}")
    out: list[Column] = []
    for name in df.columns:
        if name not in splits:
            out.append(col(name))
            continue
        separator, parts = splits[name]
        pieces = F.split(col(name), re.escape(separator), len(parts) if further == "keep" else -1)
        if further == "error":
            message = F.lit(f"{name!r} has more than {len(parts)} parts")
            # NULL texts have size -1 or NULL and pass
            pieces = F.when(F.coalesce(F.size(pieces) > len(parts), F.lit(False)), F.raise_error(message)).otherwise(pieces)
        out += [F.get(pieces, F.lit(i)).alias(part) for i, part in enumerate(parts)]
    return df.select(*out)


def struct_to_map(df: DataFrame, column: str, into: str) -> DataFrame:
    """Replace a struct column by a map from field name to value, as text."""
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.StructType):
        raise ValueError(f"{column!r} is not a struct")
    entries = [
        part
        for f in dtype.fields
        for part in (F.lit(f.name), col(column).getField(f.name).cast("string"))
    ]
    return df.withColumn(into, F.create_map(*entries)).drop(column)


def capitalize_words(text: Column | str) -> Column:
    """Upper-case the first letter of each space-separated word; leave the rest as it is."""
    words = F.split(F.col(text) if isinstance(text, str) else text, " ")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))),
        " ",
    )


@F.pandas_udf(T.StringType())
def capitalize_words_udf(text: pd.Series) -> pd.Series:
    """``capitalize_words`` as a function to register for SQL."""
    return text.map(
        lambda s: s if s is None else " ".join(w[:1].upper() + w[1:] for w in s.split(" ")),
    )
