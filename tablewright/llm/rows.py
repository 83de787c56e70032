"""Shared small parts: documents as (id, text) rows, functions over Arrow batches, a bounded cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps
from inspect import ismethod
from weakref import WeakMethod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

from tablewright.operators.ranking import numbered

#: Stands for an id of NULL inside the operators: before every other id, and equal to itself.
NO_ID = -(2**63)


def has_whole_ids(docs: DataFrame, id_col: str = "doc_id") -> bool:
    return isinstance(docs.schema[id_col].dataType, (ByteType, ShortType, IntegerType, LongType))


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly (doc_id long, text string), whatever other columns there are; NULL ids become ``NO_ID``.

    Ids of other types than whole numbers are refused; operators marked ``any_ids`` number them first.
    """
    if not has_whole_ids(docs, id_col):
        raise ValueError(f"{id_col} must be a whole number, not {docs.schema[id_col].dataType.simpleString()}")
    return docs.select(
        F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("doc_id"),
        docs[text_col].cast("string").alias("text"),
    )


def shown(df: DataFrame, *names: str) -> DataFrame:
    """``NO_ID`` in the column ``doc_id``, or those named, back to NULL."""
    return df.withColumns({n: F.nullif(n, F.lit(NO_ID)) for n in names or ("doc_id",)})


def any_ids(*names: str):
    """Makes an operator on whole-number ids take ids of any type, in their own order.

    Other ids are numbered by rank for the operator; ``names`` are the result's columns where ids stand again in
    their own type. Without names the operator gives back its input's columns. NULL stays NULL.
    """

    def wrap(operator):
        @wraps(operator)
        def run(docs: DataFrame, *args, id_col: str = "doc_id", **options) -> DataFrame:
            if has_whole_ids(docs, id_col):
                return operator(docs, *args, id_col=id_col, **options)
            own = docs[id_col]
            known = numbered(docs.filter(own.isNotNull()).select(own.alias("id")).distinct(), "id", name="number")
            number = free_name(docs, "id_number")
            rows = docs.join(known, own == known["id"], "left").select(
                *(docs["`" + c.replace("`", "``") + "`"] for c in docs.columns), known["number"].alias(number)
            )
            out = operator(rows, *args, id_col=number, **options)
            for name in names:
                back = known.select(F.col("id").alias("id_"), F.col("number").alias("number_"))
                joined = out.join(back, out[name] == back["number_"], "left")
                out = joined.select(*(back["id_"].alias(c) if c == name else out[c] for c in out.columns))
            return out if names else out.drop(number)

        return run

    return wrap


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column has it in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, start: Callable[[], Callable], schema: str, *, at_once: int | None = None) -> DataFrame:
    """Run over Arrow batches: ``start()`` once per task gives a function of the columns as lists.

    That function returns the output columns as lists, or None for no rows. ``start`` may also
    return a pair; its second function, without arguments, gives the rows that are left at the end.
    ``at_once`` bounds the rows of one call where the results are much larger than the input.
    """
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(made):
            arrays = [pa.array(c, type=f.type) for c, f in zip(made, out, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=out)

        started = start()
        step, finish = started if isinstance(started, tuple) else (started, None)
        for batch in batches:
            size = at_once or max(1, batch.num_rows)
            for part in (batch.slice(k, size) for k in range(0, batch.num_rows, size)):
                made = step(*(c.to_pylist() for c in part.columns))
                if made is not None:
                    yield batch_of(made)
        if finish and (made := finish()) is not None:
            yield batch_of(made)

    return df.mapInArrow(run, schema)


class Recent(dict):
    """A cache that makes what it lacks and holds about ``2 * size`` entries: this and the last generation.

    An object may cache the results of its own method: the cache doesn't keep it, so both go when its task ends.
    """

    def __init__(self, make: Callable, size: int = 250_000):
        super().__init__()
        self.make = WeakMethod(make) if ismethod(make) else lambda: make
        self.size, self.last = size, {}

    def __missing__(self, key):
        value = self.last.get(key)
        if value is None:
            value = self.make()(key)
        if len(self) >= self.size:
            self.last = dict(self)
            self.clear()
        self[key] = value
        return value
