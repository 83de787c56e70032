"""Replacing files of a table by others written beside them, so that a run cut short can be finished.

What comes in is written whole to a folder inside the table that readers skip. Then a list of moves is put
beside it under its final name, which makes the change certain: old files aside, new ones in. A move is done if its
source is there and its goal is not, so the list can be worked off again from the start at any time.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Inside the table's folder; Spark skips names that begin so.
STAGE = "_upsert"
#: Where the new files are written.
NEW = f"{STAGE}/new"
MOVES = f"{STAGE}/complete"


def file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, and a function from a place below it to its full name."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return files, lambda below: Path(f"{path.rstrip('/')}/{below}")


def place_below(spark: SparkSession, path: str, uri: str) -> str:
    """A file or folder, named by a URI as ``_metadata`` has it, as a place below the table's folder."""
    jvm = spark._jvm
    files, _ = file_system(spark, path)
    top = files.makeQualified(jvm.org.apache.hadoop.fs.Path(path)).toUri().getPath().rstrip("/")
    full = jvm.java.net.URI(uri).getPath()
    if full != top and not full.startswith(top + "/"):
        raise ValueError(f"{uri} is not below {path}")
    return full[len(top) + 1 :]


def file_uri() -> Column:
    return F.col("_metadata.file_path")


def folder_uri() -> Column:
    return F.regexp_replace(file_uri(), "/[^/]*$", "")


def commit(spark: SparkSession, path: str, moves: list[tuple[str, str]]) -> None:
    """Make the change certain, and do it."""
    files, at = file_system(spark, path)
    out = files.create(at(f"{STAGE}/moves"))
    out.write(bytearray(json.dumps(moves).encode()))
    out.close()
    move(files, at, f"{STAGE}/moves", MOVES)
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Bring a change that was cut short to its end; drop staged files that no list of moves stands for."""
    files, at = file_system(spark, path)
    if files.exists(at(MOVES)):
        size = files.getFileStatus(at(MOVES)).getLen()
        opened = files.open(at(MOVES))
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8") if size else "[]"
        opened.close()
        for here, there in json.loads(text):
            if files.exists(at(here)) and not files.exists(at(there)):
                move(files, at, here, there)
    if files.exists(at(STAGE)):
        files.delete(at(STAGE), True)


def move(files, at, here: str, there: str) -> None:
    files.mkdirs(at(there).getParent())
    if not files.rename(at(here), at(there)):
        raise OSError(f"cannot move {at(here)} to {at(there)}")


def staged_files(spark: SparkSession, path: str, below: str) -> list[str]:
    """Names of the files with rows in a staged folder."""
    files, at = file_system(spark, path)
    if not files.exists(at(below)):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at(below)) if s.isFile()]
    return sorted(n for n in names if not n.startswith(("_", ".")))
