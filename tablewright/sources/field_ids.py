"""Schema changes that rewrite no file: Parquet columns known by number.

Each column has a number for life, which every file holds beside the name. After a rename, old files are read under
the new name; a dropped column's number is never used again, so that a later column of the same name does not
bring old values back; a new column is NULL in files written before.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import col, same_name
from tablewright.operators.evolve import AddColumn, CastColumn, Change, DropColumn, RenameColumn

#: Fixed value: where Spark looks for a column's number.
FIELD_ID = "parquet.field.id"
READ_BY_ID = "spark.sql.parquet.fieldId.read.enabled"
WRITE_IDS = "spark.sql.parquet.fieldId.write.enabled"
#: Types that Spark's reader widens by itself, without a change to the file.
WIDER = {
    T.ByteType(): {T.ShortType(), T.IntegerType(), T.LongType()},
    T.ShortType(): {T.IntegerType(), T.LongType()},
    T.IntegerType(): {T.LongType(), T.DoubleType()},
    T.FloatType(): {T.DoubleType()},
}


@dataclass(frozen=True)
class NumberedSchema:
    """A table's columns with their numbers, and the last number given. Keep its ``json()`` beside the files."""

    columns: T.StructType
    last_id: int

    @classmethod
    def of(cls, schema: T.StructType) -> NumberedSchema:
        fields = [_field(f.name, f.dataType, k) for k, f in enumerate(schema, 1)]
        return cls(T.StructType(fields), len(fields))

    def json(self) -> str:
        return json.dumps({"last_id": self.last_id, "columns": self.columns.jsonValue()})

    @classmethod
    def from_json(cls, text: str) -> NumberedSchema:
        value = json.loads(text)
        return cls(T.StructType.fromJson(value["columns"]), value["last_id"])

    def changed(self, spark: SparkSession, changes: Iterable[Change]) -> NumberedSchema:
        """The schema after the changes, in order. No file is touched.

        A column that is added gets a new number, and no default, as old files can't know one. A type may only
        become one that Spark's reader widens to; rewrite the table with ``evolve_schema`` for others. Names match by
        ``spark.sql.caseSensitive``.
        """
        norm, fields, last = same_name(spark.range(0)), list(self.columns), self.last_id
        for change in changes:
            at = {norm(f.name): k for k, f in enumerate(fields)}
            k = at.get(norm(change.name))
            if isinstance(change, AddColumn):
                if k is not None:
                    raise ValueError(f"column {change.name!r} exists already")
                if change.default is not None:
                    raise ValueError(f"{change.name!r} is NULL in files written before; fill it where it is read")
                last += 1
                fields.append(_field(change.name, T.DataType.fromDDL(change.dtype), last))
                continue
            if k is None:
                raise ValueError(f"no column {change.name!r}; have {[f.name for f in fields]}")
            old = fields[k]
            if isinstance(change, DropColumn):
                del fields[k]
            elif isinstance(change, RenameColumn):
                if at.get(norm(change.to), k) != k:
                    raise ValueError(f"column {change.to!r} exists already")
                fields[k] = T.StructField(change.to, old.dataType, True, old.metadata)
            elif isinstance(change, CastColumn):
                new = T.DataType.fromDDL(change.dtype)
                if new != old.dataType and new not in WIDER.get(old.dataType, ()):
                    raise ValueError(f"files with {old.dataType.simpleString()} can't be read as {new.simpleString()}")
                fields[k] = T.StructField(old.name, new, True, old.metadata)
        return NumberedSchema(T.StructType(fields), last)


def _field(name: str, dtype: T.DataType, number: int) -> T.StructField:
    return T.StructField(name, dtype, True, {FIELD_ID: number})


def save_by_id(df: DataFrame, schema: NumberedSchema, path: str, mode: str = "append") -> None:
    """Write the table's columns of ``df`` with their numbers. Columns that ``df`` lacks are NULL; it may have no others."""
    spark, norm = df.sparkSession, same_name(df)
    if spark.conf.get(WRITE_IDS) != "true":
        raise ValueError(f"{WRITE_IDS} is off: the files would have no numbers")
    own = {norm(c): c for c in df.columns}
    unknown = set(own) - {norm(f.name) for f in schema.columns}
    if unknown:
        raise ValueError(f"the table has no columns {sorted(own[c] for c in unknown)}")
    columns = [
        (col(own[norm(f.name)]) if norm(f.name) in own else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in schema.columns
    ]
    df.select(*columns).write.mode(mode).parquet(path)


def read_by_id(spark: SparkSession, schema: NumberedSchema, *paths: str) -> DataFrame:
    """All files, whatever names their columns had when they were written.

    Spark asks the session, when a query runs, whether numbers count; this turns that on and leaves it on. It changes
    nothing for tables whose columns have no numbers. Fields inside a column are found by name.
    """
    spark.conf.set(READ_BY_ID, "true")
    return spark.read.schema(schema.columns).parquet(*paths)
