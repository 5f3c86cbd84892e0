"""Prepare files as they arrive in a directory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from factloom.contract import SALES, Contract
from factloom.operators.checks import enforce
from factloom.plans.prep import DESC1, Substring, prep
from factloom.sources.files import read_options, require_apart, require_no_match


def prep_stream(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    checkpoint: str,
    fmt: str = "parquet",
    contract: Contract = SALES,
    derive: Sequence[Substring] = DESC1,
    on_error: str = "null",
    declared: Contract | None = None,
) -> StreamingQuery:
    """Start preparing every file not yet seen in ``source`` into Parquet in ``target``.

    The step keeps no state between rows, so there is no watermark. Which files
    are done is kept in ``checkpoint``, which must be on shared storage; the
    query ends once all present files are done, and a later one goes on there.
    With ``declared``, the first row that breaks that contract stops the query.
    """
    require_apart(spark, source, target)
    require_no_match(spark, source, target)  # a glob may list the target once it is there
    arriving = spark.readStream.format(fmt).options(**read_options(fmt)).schema(schema).load(source)
    prepared = prep(arriving, contract, derive, on_error)
    if declared is not None:
        prepared = enforce(prepared, declared)
    writer = prepared.writeStream.format("parquet")
    writer = writer.option("path", target).option("checkpointLocation", checkpoint)
    return writer.option("compression", "snappy").trigger(availableNow=True).start()
