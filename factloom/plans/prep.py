"""The preparation job: clean headings, derive, type, write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.contract import SALES, Contract
from factloom.functions.names import require_columns, require_distinct
from factloom.operators.casting import cast_columns
from factloom.operators.checks import enforce, judged
from factloom.operators.deriving import derive_substring
from factloom.operators.headings import strip_headings
from factloom.plans.compiling import compiled_methods, writers_side_by_side
from factloom.sources.files import place, require_apart, require_outputs_apart, scan, write_parquet
from factloom.sources.publishing import Storage, beside, publish, recover

_KIND = "judged_as"
#: Where a traced reject comes from: the file, and the place of the row in it, from 0.
SOURCE_FILE, SOURCE_ROW = "source_file", "source_row"
#: Rejects that are sent to every task (some 100 bytes each).
BROADCAST_REJECTS = 500_000
#: Of more rejects, the bitmaps that are sent to every task: 4 KB for each 32,768 rows of a file that holds some.
BROADCAST_MARKS = 16_384


class Substring(NamedTuple):
    """A derived column: ``length`` characters of ``source`` from ``start``, counted from 1."""

    name: str
    source: str
    start: int
    length: int


# The column derived from the description.
DESC1 = (Substring("Desc1", "Description", 4, 6),)


def prep(
    df: DataFrame,
    contract: Contract = SALES,
    derive: Sequence[Substring] = DESC1,
    on_error: str = "null",
) -> DataFrame:
    """Clean the headings, append the derived columns and type the contract's columns.

    Columns outside the contract pass through. The plan is one projection over
    the input, with no shuffle, for batch and streaming frames alike.
    """
    cleaned = strip_headings(df)
    derived = {d.name for d in derive}
    needed = [n for n in contract.names if n not in derived]
    require_columns(cleaned, needed + [d.source for d in derive if d.source not in derived])
    for column in derive:
        cleaned = derive_substring(cleaned, *column)
    return cast_columns(cleaned, contract, on_error)


def run_prep(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "parquet",
    contract: Contract = SALES,
    derive: Sequence[Substring] = DESC1,
    on_error: str = "null",
    partitions: int | str | None = None,
    declared: Contract | None = None,
    rejects: str | None = None,
    multi_line: bool = False,
    drift: str = "raise",
    trace: bool = False,
    about: Mapping[str, Any] | None = None,
) -> str:
    """Prepare the files in ``source`` into Parquet in ``target``, replacing what is there.

    With ``declared``, the first row that breaks that contract stops the job; with
    ``rejects`` too, such rows are written there with the rules they break, in a column
    ``violations``, and the job goes on. Both outputs come from one pass over the
    source: it writes one directory for each kind, and their files are then published
    together, so that both are old or both are new. With ``trace`` each reject carries the file and row
    that it was made from; ``trace_back`` finds these again. ``multi_line`` lets quoted CSV
    values hold line breaks. See ``scan`` for ``drift`` between source files; ``about`` goes into the
    note of what is published. Returns ``target``.
    """
    writing, judging = beside(target, "writing"), beside(target, "judged")
    require_outputs_apart(spark, target, *([rejects] if rejects else []), writing, judging)
    if trace and (fmt != "parquet" or rejects is None):
        raise ValueError("only rejects of Parquet files can be traced: other formats do not number their rows")
    for output in filter(None, (target, rejects)):
        recover(spark, output)
    files = scan(spark, source, fmt, multi_line=multi_line, drift=drift)
    for output in filter(None, (target, rejects, writing, judging)):
        require_apart(spark, files, output)
    prepared = prep(traced(files) if trace else files, contract, derive, on_error)
    with compiled_methods(spark):
        if declared is None or rejects is None:
            # beside the target first, so that what is there stays until the new files are whole
            publish(spark, {target: write_parquet(prepared if declared is None else enforce(prepared, declared), writing, partitions)}, about)
            return target
        rows = judged(prepared, declared, "violations")
        if trace:  # only rejects need their origin
            of = {c: F.when(F.col("violations") != "", F.col(c)) for c in (SOURCE_FILE, SOURCE_ROW)}
            rows = rows.withColumns(of)
        write_both(spark, rows, target, rejects, partitions, about)
        return target


def write_both(
    spark: SparkSession, rows: DataFrame, target: str, rejects: str, partitions: int | str | None = None, about: Mapping[str, Any] | None = None
) -> str:
    """Rows without ``violations`` to ``target``, the others to ``rejects``: one write, published as one."""
    require_distinct(rows, [*rows.columns, _KIND])
    both, files = beside(target, "judged"), Storage(spark)
    kind = F.when(F.col("violations") == "", "accepted").otherwise("rejected")
    with writers_side_by_side(spark, 2):
        place(rows.withColumn(_KIND, kind), partitions).write.mode("overwrite").partitionBy(_KIND).option(
            "compression", "snappy").parquet(both)
    staged = {}
    for name, output in (("accepted", target), ("rejected", rejects)):
        staged[output] = f"{both}/{_KIND}={name}"
        if not files.exists(staged[output]):
            write_parquet(spark.createDataFrame([], rows.schema), staged[output])
    published = publish(spark, staged, about)
    files.delete(both)
    return published


def traced(files: DataFrame) -> DataFrame:
    """Rows of Parquet files with the file and the place in it that each is read from."""
    require_distinct(files, [*files.columns, SOURCE_FILE, SOURCE_ROW])
    return files.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.row_index").alias(SOURCE_ROW))


def trace_back(spark: SparkSession, source: str, rejects: DataFrame, keep: Sequence[str] = ("violations",), drift: str = "raise") -> DataFrame:
    """The source rows, as they were read, that traced ``rejects`` were made from, with the columns ``keep`` of these.

    Rejects up to ``BROADCAST_REJECTS`` are broadcast, so that the source is only scanned; more of them are
    joined by file and row, to those source rows that bitmaps of the rejected rows leave. Only where
    there are more than ``BROADCAST_MARKS`` of these is the whole source shuffled.
    """
    wanted = rejects.select(SOURCE_FILE, SOURCE_ROW, *keep)
    held = traced(scan(spark, source, drift=drift))
    if wanted.count() <= BROADCAST_REJECTS:
        wanted = F.broadcast(wanted)
    else:
        held = _marked(held, wanted)
    return held.join(wanted, [SOURCE_FILE, SOURCE_ROW])


def _marked(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``held`` whose file and row are wanted, unless the bitmaps for it are too many; then all."""
    # the functions for bitmaps count from 1
    place = F.col(SOURCE_ROW).cast("long") + 1
    marks = wanted.groupBy(F.col(SOURCE_FILE).alias("marked_file"), F.bitmap_bucket_number(place).alias("marked_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("marked_bits"))
    if marks.count() > BROADCAST_MARKS:
        return held
    place = held[SOURCE_ROW] + 1
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(marks["marked_bits"], F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = (
        (held[SOURCE_FILE] == marks["marked_file"]) & (F.bitmap_bucket_number(place) == marks["marked_bucket"])
        & (F.getbit(byte, (at % 8).cast("int")) == 1))
    return held.join(F.broadcast(marks), marked, "left_semi")
