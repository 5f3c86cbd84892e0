"""Tables that cut lineage, in the folder that the session's cluster shares."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master may leave it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="factloom-llm-")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/factloom-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written once as Parquet, with the writer's ``options``, and read back: later steps do not compute it again.

    Spark deletes the shuffle files of a finished step when the driver collects its garbage;
    asking for that here keeps the disk free of steps that are done.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").options(**(options or {})).parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """A broadcast hint for at most ``most`` rows; beyond them the join shuffles both sides."""
    return F.broadcast(df) if rows <= most else df


def partitions_for(rows: int, each: int) -> int:
    """Partitions of about ``each`` rows."""
    return max(1, -(-rows // each))


_shipped: set[str] = set()
#: Spark's default for the rows of a batch, and ours; a value that the session has set itself stays.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000")}


def shipped(spark: SparkSession) -> None:
    """Gives Python workers this package, where they cannot import it themselves, and batches of a fit size."""
    # smaller batches to Python: texts may be long, and each executor has a worker for every core
    for key, value in ARROW_BATCH.items():
        if spark.conf.get(key, value[0]) == value[0]:
            spark.conf.set(key, value[1])
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="factloom-ship-")) / "factloom.zip"  # Spark's file server sends it
    with zipfile.ZipFile(archive, "w") as file:
        for path in sorted(package.rglob("*.py")):
            file.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
