"""Upsert, delete and incremental load, each as a lazy DataFrame.

Nothing here writes. The result is the table's new content (or, for
``incremental_rows``, the rows to append); write it to a new location and switch,
never over the files being read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import col, cols, free_name, quoted, resolve_names
from tablewright.operators.joins import anti_join

ACTIONS = ("update", "nothing")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    action: str = "update",
    condition: str | Column | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
) -> DataFrame:
    """Content of ``target`` after inserting the batch ``source``.

    New keys are inserted. For a key that ``target`` holds already, ``"update"``
    takes the batch's values and ``"nothing"`` keeps the old row. A batch may lack
    non-key columns: an update then keeps their old values, an insert leaves them
    NULL. ``condition`` (update only) names the two rows ``target`` and ``source``;
    where it is not true the old row stays.

    A key that occurs more than once in the batch is an error unless ``order_by``
    says which row wins: the one with the greatest value. NULL keys match nothing,
    as under a SQL unique constraint, so such rows are always inserted.

    The plan reads ``source`` several times: write it out first if it is costly or
    may differ between two runs.
    """
    if action not in ACTIONS:
        raise ValueError(f"action must be one of {ACTIONS}, not {action!r}")
    if condition is not None and action != "update":
        raise ValueError("a condition needs action='update'")
    keys = resolve_names(target, [keys] if isinstance(keys, str) else keys)
    keyed, unkeyed = split_batch(target, source, keys, order_by)

    values = [c for c in keyed.columns if c not in keys]
    replaces = action == "update" and bool(values)

    def with_unkeyed(rows: DataFrame) -> DataFrame:
        return rows if unkeyed is None else rows.unionByName(unkeyed)

    if replaces and condition is None and set(keyed.columns) == set(target.columns):
        kept = target.join(keyed.select(cols(keys)), keys, "left_anti").select(cols(target.columns))
        return kept.unionByName(with_unkeyed(keyed))
    held = _update_matches(target, keyed, keys, values, condition) if replaces else target
    return held.unionByName(with_unkeyed(_absent(target, keyed, keys)), allowMissingColumns=True)


def split_batch(target, source, keys, order_by):
    """The batch as (one row per key, rows with a NULL key or None), in target types."""
    names = resolve_names(target, [c for c in source.columns if not _only_orders(c, target, order_by)])
    picked = resolve_names(source, names)
    missing = [k for k in keys if k not in names]
    if missing:
        raise ValueError(f"the batch lacks key columns {missing}")
    order = _order_columns(source, order_by)
    types = {f.name: f.dataType for f in target.schema.fields}
    batch = source.select(
        *[col(s).cast(types[n]).alias(n) for s, n in zip(picked, names)],
        *[o.alias(free_name(names, f"_order_{i}")) for i, o in enumerate(order)],
    )
    ordering = [c for c in batch.columns if c not in names]

    nullable = any(batch.schema[k].nullable for k in keys)
    has_key = reduce(and_, [col(k).isNotNull() for k in keys])
    keyed = batch.where(has_key) if nullable else batch
    unkeyed = batch.where(~has_key).drop(*ordering) if nullable else None
    return _one_row_per_key(keyed, keys, names, ordering), unkeyed


def _only_orders(column, target, order_by) -> bool:
    """True for a batch column that the target lacks and ``order_by`` names."""
    wanted = [] if order_by is None or isinstance(order_by, Column) else order_by
    wanted = [wanted] if isinstance(wanted, str) else [o for o in wanted if isinstance(o, str)]
    return column in wanted and column.lower() not in {c.lower() for c in target.columns}


def _order_columns(source, order_by) -> list[Column]:
    if order_by is None:
        return []
    items = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return [col(resolve_names(source, [o])[0]) if isinstance(o, str) else o for o in items]


def _one_row_per_key(batch, keys, names, ordering):
    """One row per key by partial aggregation, so a hot key is combined before the shuffle."""
    values = [n for n in names if n not in keys]
    picked_row, count = free_name(keys, "_row"), free_name(keys, "_n")
    row = F.struct(cols(values)) if values else F.struct(F.lit(0).alias("_"))
    if ordering:
        # Equal order values fall through to the row itself: the winner is the same on every run.
        rest = [v for v in values if not _has_map(batch.schema[v].dataType)]
        # Rows that hold maps can't be compared; without them each value is shuffled once.
        by = F.struct(cols(ordering + rest))
        best = F.max(by) if rest == values and values else F.max_by(row, by)
        picked = batch.groupBy(*cols(keys)).agg(best.alias(picked_row))
    else:
        picked = (
            batch.groupBy(*cols(keys))
            .agg(F.first(row).alias(picked_row), F.count(F.lit(1)).alias(count))
            .where(
                F.assert_true(
                    col(count) == 1, F.lit(f"duplicate keys {keys} in the batch; pass order_by")
                ).isNull()
            )
        )
    return picked.select(*[col(n) if n in keys else col(n, of=quoted(picked_row)).alias(n) for n in names])


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return False


def _absent(target, keyed, keys):
    """Rows of the batch whose key the target lacks.

    The target's keys are first cut to those the batch holds. With a small batch
    that is a broadcast filter, and the target is never shuffled.
    """
    held = target.select(cols(keys)).join(keyed.select(cols(keys)), keys, "left_semi").distinct()
    return keyed.join(held, keys, "left_anti").select(cols(keyed.columns))


def _update_matches(target, keyed, keys, values, condition):
    matched = free_name([*target.columns, *keyed.columns], "_matched")
    marked = keyed.withColumn(matched, F.lit(True))
    t, s = target.alias("target"), marked.alias("source")
    on = [col(k, of="target") == col(k, of="source") for k in keys]
    take = col(matched, of="source")
    if condition is not None:
        take = take & (F.expr(condition) if isinstance(condition, str) else condition)
    return t.join(s, on, "left").select(
        *[
            F.when(take, col(c, of="source")).otherwise(col(c, of="target")).alias(c)
            if c in values
            else col(c, of="target")
            for c in target.columns
        ]
    )


def delete_where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows left after a SQL DELETE: a row whose condition is NULL stays."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(~F.coalesce(cond, F.lit(False)))


def incremental_rows(
    source: DataFrame,
    target: DataFrame,
    column: str,
    on_empty: str = "skip",
    inclusive: bool = False,
    keys: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``source`` past the greatest ``column`` of ``target``: what to append.

    The comparison is strict, so a late row equal to that maximum is missed.
    ``inclusive=True`` takes such rows too and, by ``keys``, leaves out those the
    target holds. With an empty target ``"skip"`` gives nothing, ``"full"`` everything.
    """
    if on_empty not in ("skip", "full"):
        raise ValueError(f"on_empty must be skip or full, not {on_empty!r}")
    if inclusive and keys is None:
        raise ValueError("inclusive needs keys")
    value = col(column)
    mark = target.agg(F.max(value)).scalar()
    newer = value >= mark if inclusive else value > mark
    if on_empty == "full":
        newer = newer | mark.isNull()
    rows = source.where(newer)
    if inclusive:
        # Only target rows at the maximum can meet a source row from there on.
        at_mark = target.where(value >= target.agg(F.max(value)).scalar())
        rows = anti_join(rows, at_mark, keys)
    return rows


def incremental_append(source: DataFrame, target: DataFrame, column: str, **options) -> DataFrame:
    """``target`` with ``incremental_rows`` appended."""
    return target.unionByName(incremental_rows(source, target, column, **options))


def watermark(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """One row: the target's maximum if the source is past it, else NULL."""
    newest = source.agg(F.max(col(column))).scalar()
    return target.agg(F.max(col(column)).alias("held")).select(
        F.when(newest > F.col("held"), F.col("held")).alias("update_from")
    )


def latest_snapshot(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the greatest value of ``column``."""
    return df.where(col(column) == df.agg(F.max(col(column))).scalar())
