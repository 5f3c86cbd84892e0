"""Session settings that hold for one write."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Fixed value: the JVM interprets methods with more bytes than this.
COMPILED = "8000"


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that comes back afterwards."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def compiled_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """Within this, Spark splits a fused method that the JVM would not compile.

    A wide contract over text can make such a method; run as it is, it takes about six
    times as long.
    """
    return _set(spark, _LIMIT, COMPILED)


def writers_side_by_side(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """Within this, a task keeps files of up to ``most`` partitions open, and sorts no rows for them.

    Spark sorts what is left of a task's rows as soon as it has as many files open as the setting says.
    """
    return _set(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most + 1))


#: Nodes of a plan that keep the order in which files are read.
_IN_ORDER = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation"}


def _read_straight(df: DataFrame) -> bool:
    """Whether a frame's rows come from files one by one, so that a task that is run again has them in the same order."""
    plan = df._jdf.queryExecution().analyzed()
    todo, leaves = [plan], plan.collectLeaves()
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() not in _IN_ORDER:
            return False
        todo += [node.children().apply(i) for i in range(node.children().size())]
    files = [leaves.apply(i).relation().getClass().getSimpleName() == "HadoopFsRelation" for i in range(leaves.size())]
    return bool(plan.deterministic()) and all(files)


def dealt_in_order(df: DataFrame) -> AbstractContextManager[None]:
    """Within this, a round robin over a frame that is read straight from files sorts no rows first.

    The sort makes a task that is run again deal its rows alike; it spills the whole rows where a task's
    do not fit its memory. Rows that come from files one by one are in the same order anyway. Any other frame is
    sorted as ever.
    """
    if not _read_straight(df):
        return nullcontext()
    return _set(df.sparkSession, "spark.sql.execution.sortBeforeRepartition", "false")
