"""Read and write directories of files.

How many tasks read a directory follows from its bytes and
``spark.sql.files.maxPartitionBytes``; neither Parquet nor CSV takes a partition
count as a read option.
"""

from __future__ import annotations

import fnmatch
import math
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.sources.audit import require_one_schema
from factloom.sources.publishing import Storage, listed

_READ_OPTIONS: dict[str, dict[str, str]] = {
    "parquet": {},
    # a file whose header differs from the others' is an error, not swapped columns
    "csv": {"header": "true", "sep": "|", "enforceSchema": "false"},
}


def read_options(fmt: str, multi_line: bool = False) -> dict[str, str]:
    if fmt not in _READ_OPTIONS:
        raise ValueError(f"format must be one of {sorted(_READ_OPTIONS)}, not {fmt!r}")
    return _READ_OPTIONS[fmt] | ({"multiLine": "true"} if multi_line and fmt == "csv" else {})


def scan(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    multi_line: bool = False,
    drift: str = "raise",
) -> DataFrame:
    """A directory or file of Parquet, or of pipe-delimited CSV with a header.

    Parquet takes its schema from the footers. Files that differ in a column's name or type raise;
    ``drift="unite"`` reads the columns of all of them, null where a file has none, and
    ``"ignore"`` goes by one footer, for files that one write has made. CSV columns are all text, so that
    typing is left to the contract and no pass over the data infers it. With
    ``multi_line``, quoted CSV values may hold line breaks; each file is then
    read by one task, so files should be of split size.
    """
    if drift not in ("raise", "unite", "ignore"):
        raise ValueError(f"drift must be 'raise', 'unite' or 'ignore', not {drift!r}")
    reader = spark.read.format(fmt).options(**read_options(fmt, multi_line))
    if schema is not None or fmt != "parquet":
        return (reader.schema(schema) if schema else reader).load(path)
    if drift == "unite":
        return reader.option("mergeSchema", "true").load(path)
    found = reader.load(path)
    if drift == "raise" and len(files := found._jdf.inputFiles()) > 1:
        require_one_schema(spark, path, [str(f) for f in files])
    return found


@contextmanager
def read_in(spark: SparkSession, path: str, tasks: int) -> Iterator[int]:
    """Within this, Spark reads the files under ``path`` in about ``tasks`` splits; gives the bytes of a split.

    Parquet has no read option for it: a split is what ``spark.sql.files.maxPartitionBytes`` allows, less
    where ``minPartitionNum`` wants more of them, and every file counts ``openCostInBytes`` on
    top. All three are set so that files larger than a split are cut and smaller ones share
    one. A row group is never cut, so of splits smaller than these some read nothing.
    """
    if isinstance(tasks, bool) or not isinstance(tasks, int) or tasks < 1:
        raise ValueError(f"tasks must be a positive number, not {tasks!r}")
    size = listed(spark, path).agg(F.sum("length").alias("n")).first()["n"] or 0
    split = max(1, math.ceil(size / tasks))
    wanted = {"maxPartitionBytes": str(split), "minPartitionNum": str(tasks), "openCostInBytes": "0"}
    before = {k: spark.conf.get(f"spark.sql.files.{k}", None) for k in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(f"spark.sql.files.{key}", value)
        yield split
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(f"spark.sql.files.{key}")
            else:
                spark.conf.set(f"spark.sql.files.{key}", value)


def place(df: DataFrame, partitions: int | str | None) -> DataFrame:
    """Decide how rows are spread over the tasks that write them.

    ``None``    as they were read: no shuffle. Scan splits are of equal size,
                so the written files are too. The choice for very large data.
    ``"auto"``  round robin, with the number and size of the partitions taken
                by adaptive execution from the bytes it sees
                (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    a number    round robin over exactly that many partitions.

    Round robin looks at no column, so no key can make it uneven.
    """
    if partitions is None:
        return df
    if partitions == "auto":
        return df.hint("rebalance")
    if isinstance(partitions, bool) or not isinstance(partitions, int) or partitions < 1:
        raise ValueError(f"partitions must be None, 'auto' or a positive number, not {partitions!r}")
    return df.repartition(partitions)


def write_parquet(df: DataFrame, path: str, partitions: int | str | None = None) -> str:
    """Replace the directory ``path`` by ``df`` as Snappy Parquet; see ``place`` for ``partitions``."""
    place(df, partitions).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def join_path(base: str, location: str) -> str:
    """A relative location under a storage root."""
    return base.rstrip("/") + "/" + location.strip("/")


def roots(df: DataFrame) -> list[str]:
    """The directories and files that a frame reads, with globs and views resolved."""
    found: list[str] = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            found += [paths.apply(k).toString() for k in range(paths.size())]
    return found


def _apart(a: str, b: str) -> bool:
    a, b = a + "/", b + "/"
    return not (a.startswith(b) or b.startswith(a))


def require_apart(spark: SparkSession, source: DataFrame | str, target: str) -> None:
    """Raise when a directory that ``source`` reads is ``target``, or one lies inside the other.

    An overwrite empties its target before the first row is read, so without
    this check the input would be lost.
    """
    files = Storage(spark)
    for held in [source] if isinstance(source, str) else roots(source):
        if not _apart(files.qualified(held), files.qualified(target)):
            raise ValueError(f"cannot write {target!r} while reading {held!r}: the directories overlap")


def require_outputs_apart(spark: SparkSession, *targets: str) -> None:
    """Raise when two directories that one job writes are one, or one lies inside the other."""
    files = Storage(spark)
    for n, a in enumerate(targets):
        for b in targets[:n]:
            if not _apart(files.qualified(a), files.qualified(b)):
                raise ValueError(f"cannot write both {b!r} and {a!r}: the directories overlap")


def require_no_match(spark: SparkSession, pattern: str, target: str) -> None:
    """Raise when a glob may ever list ``target``, what is in it or what it is in."""
    wanted = re.sub(r"\{[^}]*\}", "*", Storage(spark).qualified(pattern)).split("/")
    held = Storage(spark).qualified(target).split("/")
    if all(fnmatch.fnmatchcase(h, w) for h, w in zip(held, wanted, strict=False)):
        raise ValueError(f"cannot write {target!r} while reading {pattern!r}: the directories overlap")
