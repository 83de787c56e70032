"""Key constraints as questions about data: which rows break them, and what a parent change does.

The checks aggregate by key with map-side combine before anything is shuffled, and
report keys with row counts, so their output and their shuffles grow with the
number of distinct keys and not with the rows of a hot one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.names import col, cols, free_name, resolve_names

ON_DELETE = ("cascade", "set_null", "set_default", "restrict", "no_action")


def _list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _any_null(names):
    return reduce(or_, [c.isNull() for c in cols(names)])


def _no_null(names):
    return reduce(and_, [c.isNotNull() for c in cols(names)])


def unique_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``n_rows``. Keys with a NULL never conflict.

    The count's name gets underscores if a key has it.
    """
    keys = resolve_names(df, _list(keys))
    n_rows = free_name(keys, "n_rows")
    counts = df.where(_no_null(keys)).groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias(n_rows))
    return counts.where(col(n_rows) > 1)


def primary_key_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with ``n_rows`` and ``reason``, named as above."""
    keys = resolve_names(df, _list(keys))
    n_rows = free_name(keys, "n_rows")
    counts = df.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias(n_rows))
    null_key = _any_null(keys)
    return counts.where(null_key | (col(n_rows) > 1)).withColumn(
        free_name(keys, "reason"), F.when(null_key, F.lit("null")).otherwise(F.lit("duplicate"))
    )


def foreign_key_orphans(
    child: DataFrame, fk: str | Sequence[str], parent: DataFrame, pk: str | Sequence[str]
) -> DataFrame:
    """Foreign keys of ``child`` that ``parent`` lacks, with ``n_rows``. A NULL in the key passes."""
    fk, pk = resolve_names(child, _list(fk)), resolve_names(parent, _list(pk))
    n_rows = free_name(fk, "n_rows")
    used = child.where(_no_null(fk)).groupBy(*cols(fk)).agg(F.count(F.lit(1)).alias(n_rows))
    return used.join(_as_fk(parent, pk, fk), fk, "left_anti")


def _as_fk(keys: DataFrame, pk: list[str], fk: list[str]) -> DataFrame:
    return keys.select(*[col(p).alias(f) for p, f in zip(pk, fk, strict=True)])


def apply_parent_delete(
    child: DataFrame,
    fk: str | Sequence[str],
    deleted: DataFrame,
    pk: str | Sequence[str],
    action: str,
    default: Mapping[str, object] | None = None,
) -> DataFrame:
    """``child`` after the parent rows with the keys in ``deleted`` are gone.

    ``"restrict"`` and ``"no_action"`` raise if a child row refers to one of them.
    ``"set_default"`` takes the value per foreign-key column from ``default``.
    """
    if action not in ON_DELETE:
        raise ValueError(f"action must be one of {ON_DELETE}, not {action!r}")
    fk, pk = resolve_names(child, _list(fk)), resolve_names(deleted, _list(pk))
    given = dict(zip(resolve_names(child, list(default or {})), (default or {}).values()))
    if action == "set_default" and set(given) != set(fk):
        raise ValueError(f"set_default needs a default for each of {fk}")
    gone = _as_fk(deleted, pk, fk).distinct()
    if action == "cascade":
        return child.join(gone, fk, "left_anti").select(cols(child.columns))
    if action in ("restrict", "no_action"):
        _refuse_if_referenced(child, fk, gone)
        return child
    # Distinct keys on the right, the big side on the left: one row in, one row out,
    # and adaptive execution may split a hot foreign key.
    values = given if action == "set_default" else dict.fromkeys(fk)
    flag = free_name(child.columns, "_gone")
    types = {f.name: f.dataType for f in child.schema.fields}
    changes = {
        c: F.when(col(flag), F.lit(values[c]).cast(types[c])).otherwise(col(c)) for c in fk
    }
    joined = child.join(gone.withColumn(flag, F.lit(True)), fk, "left")
    return joined.withColumns(changes).select(cols(child.columns))


def apply_parent_update(
    child: DataFrame,
    fk: str,
    changes: DataFrame,
    action: str = "cascade",
    default: object = None,
    old: str = "old",
    new: str = "new",
) -> DataFrame:
    """``child`` after parent keys changed from ``changes.old`` to ``changes.new``.

    ``"cascade"`` follows the change; the other actions do what they do on delete.
    An old key that changes to two different new ones is an error; a new key of NULL is
    a value like others. An old key of NULL refers to no row.
    """
    if action not in ON_DELETE:
        raise ValueError(f"action must be one of {ON_DELETE}, not {action!r}")
    fk = resolve_names(child, [fk])[0]
    old, new = resolve_names(changes, [old, new])
    moved = changes.where(~col(old).eqNullSafe(col(new)))
    if action != "cascade":
        return apply_parent_delete(child, fk, moved, old, action, {fk: default})
    dtype = child.schema[fk].dataType
    to = free_name(child.columns, "_to")
    # In a struct a NULL is a value like others, so that (5, NULL) is seen as ambiguous.
    target = F.struct(col(new).cast(dtype).alias("key"))
    mapping = (
        moved.where(col(old).isNotNull())
        .groupBy(col(old).cast(dtype).alias(fk))
        .agg(F.min(target).alias(to), F.max(target).alias(to + "_"))
        .where(F.assert_true(col(to).eqNullSafe(col(to + "_")), F.lit("ambiguous key change")).isNull())
        .select(col(fk), col(to))
    )
    moved_to = F.when(col(to).isNotNull(), col(to).getField("key")).otherwise(col(fk))
    return child.join(mapping, fk, "left").withColumn(fk, moved_to).select(cols(child.columns))


def _refuse_if_referenced(child, fk, gone):
    if not child.select(cols(fk)).join(gone, fk, "left_semi").isEmpty():
        raise ValueError(f"child rows still refer to a changed parent by {fk}")
