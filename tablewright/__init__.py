"""Table work on PySpark: mutation, constraint checks, schema changes, JDBC tables."""

import sys

from pyspark import cloudpickle

from tablewright.functions.columns import capitalize_words, split_columns, struct_to_map
from tablewright.operators.aggregate import two_phase_aggregate
from tablewright.operators.constraints import (
    apply_parent_delete,
    apply_parent_update,
    foreign_key_orphans,
    primary_key_violations,
    unique_violations,
)
from tablewright.operators.evolve import AddColumn, CastColumn, DropColumn, RenameColumn, evolve_schema
from tablewright.operators.joins import anti_join, outer_join, semi_join, sifted_semi_join
from tablewright.operators.layout import bloom_options, z_order_key, z_ordered
from tablewright.operators.mutate import (
    delete_where,
    incremental_append,
    incremental_rows,
    latest_snapshot,
    upsert,
    watermark,
)
from tablewright.operators.ranking import numbered, with_positions
from tablewright.operators.reconcile import differences
from tablewright.operators.reuse import cached
from tablewright.operators.sql_aggregate import drop_aggregate, register_aggregate
from tablewright.operators.uniqueness import repeated_keys
from tablewright.sources.field_ids import NumberedSchema, read_by_id, save_by_id
from tablewright.sources.jdbc import JdbcDatabase, JdbcTarget
from tablewright.sources.partitions import upsert_partitions
from tablewright.sources.rewrite import delete_from_files, upsert_files
from tablewright.sources.skipped import skipped_files

# Python functions travel with the plan: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "AddColumn",
    "CastColumn",
    "DropColumn",
    "JdbcDatabase",
    "JdbcTarget",
    "NumberedSchema",
    "RenameColumn",
    "anti_join",
    "apply_parent_delete",
    "apply_parent_update",
    "bloom_options",
    "cached",
    "capitalize_words",
    "delete_from_files",
    "delete_where",
    "differences",
    "drop_aggregate",
    "evolve_schema",
    "foreign_key_orphans",
    "incremental_append",
    "incremental_rows",
    "latest_snapshot",
    "numbered",
    "outer_join",
    "primary_key_violations",
    "read_by_id",
    "register_aggregate",
    "repeated_keys",
    "save_by_id",
    "semi_join",
    "sifted_semi_join",
    "skipped_files",
    "split_columns",
    "struct_to_map",
    "two_phase_aggregate",
    "unique_violations",
    "upsert",
    "upsert_files",
    "upsert_partitions",
    "watermark",
    "with_positions",
    "z_order_key",
    "z_ordered",
]
