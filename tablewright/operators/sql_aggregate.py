"""User aggregates that SQL text can call.

``register_aggregate(spark, "mean_cents", ...)`` makes two table functions. The inner one folds the rows of each task
into a buffer per key; the outer one merges a key's buffers as they arrive:

    SELECT shop, mean FROM mean_cents(TABLE(
        SELECT * FROM mean_cents_part(TABLE(SELECT shop, cents FROM payments))
    ) PARTITION BY shop)

Only buffers are shuffled, and neither function holds the rows of a group.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.operators.aggregate import _NULLABLE, _joined, _per_key, _struct


def register_aggregate(
    spark: SparkSession,
    name: str,
    *,
    keys: str | T.StructType,
    reduce: Callable[[Any], pd.DataFrame],
    merge: Callable[[Any], pd.DataFrame],
    finish: Callable[[pd.DataFrame], pd.DataFrame],
    buffer_schema: str | T.StructType,
    output_schema: str | T.StructType,
    max_buffers: int = 100_000,
) -> None:
    """Register ``name`` and ``name_part`` as table functions of this session.

    ``reduce``, ``merge`` and ``finish`` are those of ``two_phase_aggregate``. The inner function takes a table with the
    columns of ``keys``, found by name in any spelling, and hands the others to ``reduce``. The outer one must be
    called with ``PARTITION BY`` over all keys, or ``WITH SINGLE PARTITION`` where there are none; it then returns
    one row per key, NULL among them. A table without rows gives none, also without keys. A task passes its buffers
    on whenever it holds more than ``max_buffers`` keys, which changes no result.
    """
    keys, buffers, output = _struct(keys), _struct(buffer_schema), _struct(output_schema)
    for schema in (buffers, output):
        twice = {n.lower() for n in keys.names} & {n.lower() for n in schema.names}
        if twice:
            raise ValueError(f"{sorted(twice)} are keys and results at once; SQL could not tell them apart")
    nested = [f.name for f in keys if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    if nested:
        raise ValueError(f"the keys {nested} are nested; group by their fields or by their text")
    names = keys.names
    key_arrow, buffer_arrow, output_arrow = (to_arrow_schema(s) for s in (keys, buffers, output))
    partial_arrow = pa.schema([*key_arrow, *buffer_arrow])

    def keyed(batch: pa.RecordBatch) -> pa.Table:
        """The batch with its key columns in the names and types of ``keys``."""
        rows = pa.Table.from_batches([batch])
        at = {c.lower(): i for i, c in enumerate(rows.column_names)}
        for field in key_arrow:
            i = at.get(field.name.lower())
            if i is None:
                raise ValueError(f"the table has no column {field.name!r}; it has {rows.column_names}")
            column = rows.column(i).cast(field.type)
            if pa.types.is_floating(field.type):
                column = pc.add(column, pa.scalar(0, field.type))  # one zero, not two
            rows = rows.set_column(i, field, column)
        return rows

    class Part:
        def __init__(self):
            self.held: list[pa.Table] = []

        def eval(self, batch: pa.RecordBatch):
            if batch.num_rows:
                self.held.append(_per_key(keyed(batch), names, reduce, buffer_arrow))
            if sum(part.num_rows for part in self.held) > max_buffers:
                merged = _per_key(pa.concat_tables(self.held), names, merge, buffer_arrow)
                self.held = [merged]
                if merged.num_rows > max_buffers // 2:
                    self.held = []
                    yield merged

        def terminate(self):
            if self.held:
                yield _per_key(pa.concat_tables(self.held), names, merge, buffer_arrow)

    class Whole:
        def __init__(self):
            self.held: pa.Table | None = None

        def eval(self, batch: pa.RecordBatch):
            if batch.num_rows:
                rows = keyed(batch).select(partial_arrow.names).cast(partial_arrow)
                rows = rows if self.held is None else pa.concat_tables([self.held, rows])
                self.held = _per_key(rows, names, merge, buffer_arrow)
            yield from ()

        def terminate(self):
            if self.held is not None:
                frame = finish(self.held.drop_columns(names).to_pandas(types_mapper=_NULLABLE.get))
                yield _joined(self.held.select(names), frame, output_arrow)

    spark.udtf.register(f"{name}_part", F.arrow_udtf(Part, returnType=T.StructType(keys.fields + buffers.fields)))
    spark.udtf.register(name, F.arrow_udtf(Whole, returnType=T.StructType(keys.fields + output.fields)))


def drop_aggregate(spark: SparkSession, name: str) -> None:
    """Take both functions out of the session; DataFrames made with them go on working."""
    for function in (f"{name}_part", name):
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {function}")
