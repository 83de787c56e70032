"""User-defined aggregates in two phases.

Spark combines its own aggregates on the map side, but gives a Python aggregate
function all rows of a group at once. ``two_phase_aggregate`` folds rows into one
buffer per key inside each task and shuffles the buffers only, so a hot key costs a
buffer per task, and no task ever holds the rows of a group. For anything the
built-in aggregates can say, use those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import cols, resolve_names

# Integers stay integers when some are missing.
_NULLABLE = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
}


def two_phase_aggregate(
    df: DataFrame,
    keys: str | Sequence[str],
    *,
    zero: Mapping[str, Any],
    reduce: Callable[[Any], pd.DataFrame],
    merge: Callable[[Any], pd.DataFrame],
    finish: Callable[[pd.DataFrame], pd.DataFrame],
    buffer_schema: str | T.StructType,
    output_schema: str | T.StructType,
    max_buffers: int = 100_000,
) -> DataFrame:
    """One row per key: the key columns and ``output_schema``.

    All steps work on many keys at once. ``reduce`` gets rows as a pandas group-by
    over the keys and returns a frame with one row per group and the columns of
    ``buffer_schema``. ``merge`` gets buffers as such a group-by and returns one
    buffer per group; it must not depend on order. ``finish`` turns a frame of
    buffers into a frame of results. ``zero`` is the buffer of no rows: without keys
    there is one result row, also for empty input.

    A task passes its buffers on whenever it holds more than ``max_buffers`` keys,
    which bounds its memory and changes no result.
    """
    keys = resolve_names(df, [keys] if isinstance(keys, str) else keys)
    nested = [k for k in keys if isinstance(df.schema[k].dataType, (T.StructType, T.ArrayType, T.MapType))]
    if nested:
        raise ValueError(f"the keys {nested} are nested; group by their fields or by their text")
    values = [c for c in df.columns if c not in keys]
    spark = df.sparkSession
    buffer_schema, output_schema = _struct(buffer_schema), _struct(output_schema)
    # LIMIT 0 is answered without a task.
    buffer_arrow = spark.createDataFrame([], buffer_schema).limit(0).toArrow().schema
    output_arrow = spark.createDataFrame([], output_schema).limit(0).toArrow().schema
    buffers, results = buffer_schema.names, output_schema.names

    # Between the steps columns go by number: any names may be used, also the same ones twice.
    key_ids = [f"key_{i}" for i in range(len(keys))]
    value_ids = [f"value_{i}" for i in range(len(values))]
    buffer_ids = [f"buffer_{i}" for i in range(len(buffers))]
    result_ids = [f"result_{i}" for i in range(len(results))]
    key_fields = [T.StructField(i, df.schema[k].dataType) for i, k in zip(key_ids, keys)]
    partial_schema = _schema(key_fields, buffer_ids, buffer_schema)
    result_schema = _schema(key_fields, result_ids, output_schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch]).rename_columns(key_ids + values)
                held.append(_per_key(rows, key_ids, reduce, buffer_arrow))
            if sum(part.num_rows for part in held) > max_buffers:
                held = [_per_key(pa.concat_tables(held), key_ids, merge, buffer_arrow)]
                if held[0].num_rows > max_buffers // 2:
                    yield from held[0].rename_columns(key_ids + buffer_ids).to_batches()
                    held = []
        if held:
            part = _per_key(pa.concat_tables(held), key_ids, merge, buffer_arrow)
            yield from part.rename_columns(key_ids + buffer_ids).to_batches()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Buffers come sorted by key: all but a batch's last key are complete.
        last: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch]).rename_columns(key_ids + buffers)
            part = part if last is None else pa.concat_tables([last, part])
            merged = _per_key(part, key_ids, merge, buffer_arrow)
            last = merged.slice(merged.num_rows - 1)
            yield from result(merged.slice(0, merged.num_rows - 1))
        if last is not None:
            yield from result(last)

    def result(merged: pa.Table) -> Iterator[pa.RecordBatch]:
        if merged.num_rows:
            frame = finish(merged.drop_columns(key_ids).to_pandas(types_mapper=_NULLABLE.get))
            rows = _joined(merged.select(key_ids), frame, output_arrow)
            yield from rows.rename_columns(key_ids + result_ids).to_batches()

    numbered = df.select(cols(keys + values)).toDF(*key_ids, *value_ids)
    # One zero, not two: Spark groups -0.0 with 0.0.
    floats = [f for f in key_fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    numbered = numbered.withColumns({f.name: F.col(f.name) + F.lit(0).cast(f.dataType) for f in floats})
    partials = numbered.mapInArrow(fold, partial_schema)
    if keys:
        partials = partials.repartition(*key_ids).sortWithinPartitions(*key_ids)
    else:
        nothing = tuple(zero[name] for name in buffers)
        no_rows = spark.createDataFrame([nothing], partial_schema).coalesce(1)
        partials = partials.unionByName(no_rows).repartition(1)
    return partials.mapInArrow(combine, result_schema).toDF(*keys, *results)


def _schema(key_fields: list[T.StructField], ids: list[str], schema: T.StructType) -> T.StructType:
    return T.StructType(key_fields + [T.StructField(i, f.dataType) for i, f in zip(ids, schema.fields)])


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _per_key(table: pa.Table, keys: list[str], step, buffer_arrow: pa.Schema) -> pa.Table:
    """Apply ``reduce`` or ``merge`` once per distinct key, in order of first appearance."""
    first, codes = _group(table, keys)
    values = table.drop_columns(keys).to_pandas(types_mapper=_NULLABLE.get)
    buffers = step(values.groupby(codes, sort=True))
    kept = table.select(keys).take(first) if keys else table.select([])
    return _joined(kept, buffers.reindex(range(len(first))), buffer_arrow)


def _group(table: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Position of each distinct key's first row, and for each row the number of its key."""
    codes = np.zeros(table.num_rows, dtype=np.int64)
    for key in keys:
        column = table.column(key).combine_chunks()
        encoded = column.dictionary_encode(null_encoding="encode")
        codes = codes * max(len(encoded.dictionary), 1) + encoded.indices.to_numpy()
        codes = np.unique(codes, return_inverse=True)[1]
    first = np.unique(codes, return_index=True)[1]
    order = np.argsort(first)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return first[order], rank[codes]


def _joined(keys: pa.Table, values: pd.DataFrame, schema: pa.Schema) -> pa.Table:
    """Key columns as they came, then the frame's columns in the types of ``schema``."""
    arrays = [_array(values[field.name], field.type) for field in schema]
    return pa.Table.from_arrays(
        [*keys.columns, *arrays], schema=pa.schema([*keys.schema, *schema])
    )


def _array(values: pd.Series, dtype: pa.DataType) -> pa.Array:
    if values.dtype.kind == "f" and isinstance(values.dtype, np.dtype):
        return pa.array(values.to_numpy(), type=dtype, from_pandas=not pa.types.is_floating(dtype))
    return pa.Array.from_pandas(values, type=dtype)
