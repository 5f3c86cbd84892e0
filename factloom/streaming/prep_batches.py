"""Prepare files as they arrive, each batch as one publication, with the rejects split off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from factloom.contract import SALES, SALES_IMPORT, Contract
from factloom.operators.checks import enforce, judged
from factloom.plans.prep import DESC1, Substring, prep, write_both
from factloom.sources.files import read_options, require_no_match, require_outputs_apart, write_parquet
from factloom.sources.publishing import beside, note_of, publish


def batch_directory(target: str, number: int) -> str:
    return f"{target.rstrip('/')}/batch={number}"


def prep_batches(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    checkpoint: str,
    rejects: str | None = None,
    fmt: str = "parquet",
    contract: Contract = SALES,
    declared: Contract = SALES_IMPORT,
    derive: Sequence[Substring] = DESC1,
    on_error: str = "null",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start preparing every file not yet seen in ``source``, a batch at a time.

    Batch n becomes the directory ``batch=n`` of ``target``, which readers see as a column ``batch``; with
    ``rejects``, rows that break the ``declared`` contract go to the same directory there, with
    the rules they break, and both are published together. Without, the first such row stops the
    query. A batch that is run again, because the query was stopped before it noted the batch
    as done, replaces its own directories, so no row is there twice. A directory of that
    number that another stream has made is an error: a new ``checkpoint`` needs a new target.

    ``source`` may be a glob. The query ends once all present files are done; a later one goes on there.
    """
    outputs = [target, checkpoint, *([rejects] if rejects else [])]
    require_outputs_apart(spark, *outputs)
    for output in outputs:
        require_no_match(spark, source, output)
    reader = spark.readStream.format(fmt).options(**read_options(fmt)).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    prepared = prep(reader.load(source), contract, derive, on_error)
    rows = enforce(prepared, declared) if rejects is None else judged(prepared, declared, "violations")

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        about = {"stream": session.sparkContext.getLocalProperty("sql.streaming.queryId")}
        out = batch_directory(target, number)
        note = note_of(session, out)
        if note is not None and note.get("stream") != about["stream"]:
            raise FileExistsError(f"{out!r} was made by another stream: a new checkpoint needs a new target")
        if rejects is None:
            publish(session, {out: write_parquet(batch, beside(out, "writing"))}, about)
        else:
            write_both(session, batch, out, batch_directory(rejects, number), about=about)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
