"""Audit the schemas of all files of a directory, not of one footer.

A Parquet read takes its schema from one file: a column that only another file has is
lost, and one that another file lacks reads as null, without a word. The audit reads the footers in
tasks, a batch of files each, and reduces them to the distinct schemas before anything
reaches the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import pandas as pd
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from factloom.sources.publishing import listed

#: Footers that one task reads; at most so many files are read on the driver itself.
BATCH = 64
#: Fixed value: where Spark keeps its own schema in a footer.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


class SchemaDrift(ValueError):
    """Files of one directory have different columns or types."""


def _columns(path: str) -> dict[str, str] | None:
    """Name to type of a file's columns; None where only Spark can open it."""
    try:
        if path.startswith("file:"):
            system, at = pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        elif path.startswith("/"):
            system, at = pyarrow.fs.LocalFileSystem(), path
        else:
            system, at = pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@"))
    except (pyarrow.ArrowInvalid, ImportError, OSError):
        return None
    with system.open_input_file(at) as file:
        schema = pyarrow.parquet.read_schema(file)
    own = (schema.metadata or {}).get(_SPARK_SCHEMA)
    if own is not None:
        return {f.name: f.dataType.simpleString() for f in T.StructType.fromJson(json.loads(own)).fields}
    return {f.name: _kind(f.type) for f in schema}


def _kind(arrow: pyarrow.DataType) -> str:
    try:
        return from_arrow_type(arrow, prefer_timestamp_ntz=True).simpleString()
    except Exception:  # a type that Spark has no name for still tells files apart
        return str(arrow)


def _text(columns: dict[str, str] | None) -> str | None:
    """The same text for the same columns in any order."""
    return None if columns is None else json.dumps(columns, sort_keys=True, ensure_ascii=False)


def _by_spark(spark: SparkSession, path: str) -> str:
    return _text({f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema.fields}) or ""


def _footers(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        yield pd.DataFrame({"path": part["path"], "columns": [_text(_columns(p)) for p in part["path"]]})


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """(columns, files, example): each distinct set of columns, in how many files it is, and one of these.

    ``columns`` is JSON from name to type, by name. Files whose storage only Spark can open are
    read one by one.
    """
    files = listed(spark, path).where(F.col("length") > 0).select("path")
    tasks = max(1, -(-files.count() // BATCH))
    read = files.repartition(tasks).mapInPandas(_footers, "path string, columns string")
    found = read.groupBy("columns").agg(F.count("*").alias("files"), F.min("path").alias("example"))
    unread = [r.path for r in read.where("columns IS NULL").collect()] if found.where("columns IS NULL").count() else []
    if not unread:
        return found
    with ThreadPoolExecutor(8) as pool:
        rest = list(zip(unread, pool.map(lambda p: _by_spark(spark, p), unread), strict=True))
    both = read.where("columns IS NOT NULL").unionByName(spark.createDataFrame(rest, "path string, columns string"))
    return both.groupBy("columns").agg(F.count("*").alias("files"), F.min("path").alias("example"))


def _distinct(spark: SparkSession, path: str, files: list[str]) -> list[tuple[str, str]]:
    """The distinct schemas with an example each; few files need no job."""
    if len(files) > BATCH:
        return [(r.columns, r.example) for r in file_schemas(spark, path).sort("example").collect()]
    with ThreadPoolExecutor(8) as pool:
        texts = list(pool.map(lambda p: _text(_columns(p)) or _by_spark(spark, p), files))
    first: dict[str, str] = {}
    for text, file in sorted(zip(texts, files, strict=True), key=lambda x: x[1]):
        first.setdefault(text, file)
    return list(first.items())


def differences(schemas: list[tuple[str, str]]) -> list[str]:
    """How the columns of the other examples differ from the first."""
    base, example = json.loads(schemas[0][0]), schemas[0][1]
    said = []
    for text, other in schemas[1:]:
        columns = json.loads(text)
        for name in sorted(base.keys() | columns.keys()):
            if base.get(name) != columns.get(name):
                said.append(f"{name} is {columns.get(name, 'missing')} in {other}, {base.get(name, 'missing')} in {example}")
    return said


def require_one_schema(spark: SparkSession, path: str, files: list[str]) -> None:
    """Raise if the files under ``path`` differ in a column's name or type."""
    if len(files) > 1 and len(schemas := _distinct(spark, path, files)) > 1:
        raise SchemaDrift("; ".join(differences(schemas)[:20]))
