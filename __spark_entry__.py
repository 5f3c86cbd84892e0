"""Registered queries and the SQL that each is checked against."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from factloom import (
    SALES,
    SALES_IMPORT,
    Contract,
    Field,
    cast_columns,
    check,
    check_rejects,
    derive_substring,
    drop,
    drop_external,
    export_table,
    file_schemas,
    import_external,
    load_table,
    prep,
    prep_batches,
    prep_stream,
    read_ddl,
    read_in,
    recover_load,
    run_chain,
    run_prep,
    scan,
    split,
    strip_headings,
    trace_back,
    write_parquet,
)
from factloom import job
from factloom.operators.checks import require_types
from factloom.sources.publishing import listed
from fixtures import oracle
from fixtures.sales import SALES_DDL, planted_fact, sales_fact, sales_source, scratch, scratch_schema

try:
    from factloom.llm.queries import ORACLE_SQL as LLM_SQL
    from factloom.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:  # the subpackage may be left out
    if not (missing.name or "").startswith(("factloom.llm", "corpus_pipeline")):
        raise
    LLM_SQL, LLM_QUERIES = {}, {}

Query = Callable[[SparkSession, str], DataFrame]


#: Text with 0, 2, 18, 19 and 25 decimals, nines throughout, and text that is no number; the same in both dialects.
_TEXT = (
    "concat(CAST(l_orderkey AS varchar(20)), CASE l_linenumber % 7 WHEN 0 THEN '' WHEN 1 THEN '.99'"
    " WHEN 2 THEN concat('.', repeat('9', 18)) WHEN 3 THEN concat('.', repeat('9', 19))"
    " WHEN 4 THEN concat('.', repeat('9', 25)) WHEN 5 THEN concat('.', repeat('9', 25), 'x') ELSE '000000000.5' END)"
)
#: The digits before the point, in DuckDB; null for what is no number.
_WHOLE = "CASE WHEN regexp_full_match(t, '[0-9]+([.][0-9]*)?') THEN split_part(t, '.', 1) END"

#: Text of up to 40 digits with exponents, and text that is no number; the same in both dialects.
_EXPONENT = (
    "concat(CASE l_linenumber % 7 WHEN 0 THEN '-' ELSE '' END, CASE l_linenumber % 7 WHEN 4 THEN '0.00000000000000000000' ELSE '' END,"
    " CAST(l_orderkey AS varchar(20)), CASE l_linenumber % 7 WHEN 0 THEN '.5E+3' WHEN 1 THEN concat('.', repeat('9', 25), 'e2')"
    " WHEN 2 THEN concat(repeat('0', 25), 'e-25') WHEN 3 THEN 'e99999999999' WHEN 4 THEN 'e30' WHEN 5 THEN concat('.', repeat('9', 25), 'e')"
    " ELSE concat('.', repeat('9', 30), 'e0') END)"
)
#: Their whole parts by arithmetic on the key k, in DuckDB.
_SHIFTED = (
    "CASE l_linenumber % 7 WHEN 0 THEN -(k * 1000 + 500) WHEN 1 THEN k * 100 + 99 WHEN 2 THEN k"
    " WHEN 4 THEN k * CAST(10 ** (10 - length(CAST(k AS varchar))) AS hugeint) WHEN 6 THEN k END"
)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(sales_fact(spark, sf_dir)[0])


def _cast_query(table: str, key: str, **casts: tuple[str, T.DataType]) -> Query:
    """Expressions over a table, each cast to its type through a contract."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = [f"{expr} AS {name}" for name, (expr, _) in casts.items()]
        contract = Contract(tuple(Field(name, type_) for name, (_, type_) in casts.items()))
        return cast_columns(scan(spark, f"{sf_dir}/{table}.parquet").selectExpr(key, *raw), contract)

    return query


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/lineitem.parquet")


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strip_headings(_fact(spark, sf_dir))


def derive_desc1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = scan(spark, f"{sf_dir}/documents.parquet")
    return derive_substring(documents, "Desc1", "text", 4, 6).select("doc_id", "Desc1")


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_columns(strip_headings(_fact(spark, sf_dir)), SALES.without("Desc1"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = scan(spark, f"{sf_dir}/orders.parquet")
    return scan(spark, write_parquet(orders, scratch(spark)))


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = sales_fact(spark, sf_dir)
    name = f"{scratch_schema(spark)}.ext_fact_sale"
    export_table(spark, table, scratch(spark), external=name)
    return spark.table(name)


def import_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    write_parquet(prep(_fact(spark, sf_dir)), f"{base}/prepared")
    return import_external(spark, base, name=f"{scratch_schema(spark)}.ext_fact_sale_import")


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    # from the joined tables at once: the fact as a table would be one more copy of all rows
    write_parquet(prep(sales_source(spark, sf_dir)), f"{base}/prepared")
    name = f"{scratch_schema(spark)}.fact_sale_loaded"
    return spark.table(load_table(import_external(spark, base), name, partitions="auto"))


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared rows with nulls and over-long text planted by value."""
    return planted_fact(spark, sf_dir, oracle.PLANTED)


def _counts(spark: SparkSession, sf_dir: str, suffix: str) -> DataFrame:
    counts = check(_planted(spark, sf_dir), SALES_IMPORT)
    return counts.select(*[c for c in counts.columns if c.endswith(suffix)])


def contract_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir, "_nulls")


def contract_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir, "_too_long")


def contract_text_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = Contract((
        Field("text", T.StringType(), max_length=100),
        Field("source", T.StringType(), max_length=4),
    ))
    return check(scan(spark, f"{sf_dir}/documents.parquet"), limits)


def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split(_planted(spark, sf_dir), SALES_IMPORT)
    return rejected.withColumn("violations", F.array_join("violations", ","))


def contract_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = split(_planted(spark, sf_dir), SALES_IMPORT)
    return accepted


def prep_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, files = sales_fact(spark, sf_dir)
    target = scratch(spark)
    run_prep(spark, files, target)
    return scan(spark, target)


def csv_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch(spark), scratch(spark)
    _fact(spark, sf_dir).write.option("header", True).option("sep", "|").option("compression", "gzip").csv(source)
    run_prep(spark, source, target, fmt="csv")
    return scan(spark, target)


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, files = sales_fact(spark, sf_dir)
    target, checkpoint = scratch(spark), scratch(spark)
    schema = spark.table(table).schema
    prep_stream(spark, files, target, schema, checkpoint).awaitTermination()
    return scan(spark, target)


def files_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each file of a write over three partitions."""
    orders = scan(spark, f"{sf_dir}/orders.parquet")
    written = scan(spark, write_parquet(orders, scratch(spark), partitions=3))
    counts = written.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    even = F.abs(F.col("n") - F.sum("n").over(W.partitionBy()) / 3) <= 3
    return counts.select("n", even.alias("even")).agg(
        F.count("*").alias("files"), F.sum("n").alias("row_count"), F.min("even").alias("even"))


def drop_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table dropped and declared anew over other files; the first files stay."""
    table, _ = sales_fact(spark, sf_dir)
    base, name = scratch(spark), f"{scratch_schema(spark)}.ext_fact_sale"
    first = export_table(spark, table, base, "first", external=name)
    if not drop(spark, name) or drop(spark, name) or spark.catalog.tableExists(name):
        raise RuntimeError("the table was not dropped")
    write_parquet(scan(spark, first).limit(0), f"{base}/empty")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{base}/empty'")
    export_table(spark, table, base, "second", external=name)
    return spark.table(name).unionByName(scan(spark, first))


def load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load takes the place of the first."""
    name = f"{scratch_schema(spark)}.fact_sale_loaded"
    prepared = prep(_fact(spark, sf_dir))
    load_table(prepared.select("SaleKey"), name)
    return spark.table(load_table(prepared, name))


def contract_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, place and type of each column of a prepared write of the whole fact."""
    files = scan(spark, write_parquet(prep(_fact(spark, sf_dir)), scratch(spark)))
    require_types(files, SALES)
    rows = files.count()
    return spark.createDataFrame(
        [(n, f.name, f.dataType.simpleString(), rows) for n, f in enumerate(files.schema.fields, 1)],
        "position long, name string, type string, row_count long")


def command_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, files = sales_fact(spark, sf_dir)
    target = scratch(spark)
    job.main(["prep", files, target, "--enforce"], spark)
    return scan(spark, target)


def chain_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain over a fact with broken rows: the loaded rows, and the rejected ones with their rules."""
    schema, base = scratch_schema(spark), scratch(spark)
    _broken(spark, sf_dir).createOrReplaceTempView("broken_fact_sale")
    loaded = run_chain(spark, "broken_fact_sale", base, f"{schema}.loaded", on_violation="split")
    rejected = scan(spark, f"{base}/rejected").withColumn("TaxRate", F.col("TaxRate").cast(SALES_IMPORT.schema()["TaxRate"].dataType))
    return spark.table(loaded).withColumn("violations", F.lit("")).unionByName(rejected)


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw fact with rows that will break the contract."""
    broken = _fact(spark, sf_dir).withColumn("Quantity", F.expr("nullif(Quantity, 50)"))
    return broken.withColumn("Package", F.expr("CASE WHEN Package = 'SMALL' THEN repeat(Package, 11) ELSE Package END"))


def load_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that were committed and broken off before the table showed them, brought to their end.

    One has the columns of the table and one has others; until they are recovered the old rows are there.
    """
    name, prepared = f"{scratch_schema(spark)}.fact_sale_loaded", prep(_fact(spark, sf_dir))
    load_table(prepared.where("SaleKey % 2 = 0"), name)
    for rows in (prepared.where("SaleKey % 3 = 0"), prepared):
        before = spark.table(name).count()
        load_table(rows, name, publish=False)
        if spark.table(name).count() != before or not recover_load(spark, name) or recover_load(spark, name):
            raise RuntimeError("a load was published before its time, not at all, or twice")
    load_table(prepared.withColumn("loaded", F.lit(3)), name, publish=False)
    if "loaded" in spark.table(name).columns or not recover_load(spark, name):
        raise RuntimeError("a load with other columns was not recovered")
    return spark.table(name)


def drop_external_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table goes and its files stay; a managed table is refused and keeps its rows."""
    table, _ = sales_fact(spark, sf_dir)
    schema, base = scratch_schema(spark), scratch(spark)
    path = export_table(spark, table, base, external=f"{schema}.ext")
    load_table(scan(spark, path), f"{schema}.kept")
    try:
        drop_external(spark, f"{schema}.kept")
        raise RuntimeError("a managed table was dropped as an external one")
    except ValueError:
        pass
    if not drop_external(spark, f"{schema}.ext") or drop_external(spark, f"{schema}.ext"):
        raise RuntimeError("the external table was not dropped")
    return spark.table(f"{schema}.kept").unionByName(scan(spark, path))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two schemas: how many of these the audit finds, and their rows united."""
    target, prepared = scratch(spark), prep(_fact(spark, sf_dir))
    odd = F.col("LineageKey") % 2 == 1
    prepared.where(odd).drop("Package").write.parquet(target)
    prepared.where(~odd).drop("Desc1").write.mode("append").parquet(target)
    try:
        scan(spark, target)
        raise RuntimeError("files of different columns were read by one footer")
    except ValueError:
        pass
    schemas = file_schemas(spark, target).count()
    return scan(spark, target, drift="unite").select(*prepared.columns).withColumn("schemas", F.lit(schemas).cast("long"))


def chain_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which steps ran in a chain whose load fails, and in the one that goes on after it, with the rows of each."""
    table, _ = sales_fact(spark, sf_dir)
    schema, base = scratch_schema(spark), scratch(spark)
    first: dict[str, str] = {}
    second: dict[str, str] = {}
    try:
        run_chain(spark, table, base, f"{schema}.loaded", partitions=0, on_step=first.__setitem__)
    except ValueError:
        first["load"] = "failed"
    loaded = run_chain(spark, table, base, f"{schema}.loaded", resume=True, on_step=second.__setitem__)
    counts = {"export": scan(spark, f"{base}/export"), "prep": scan(spark, f"{base}/prepared"), "load": spark.table(loaded)}
    parts = [
        df.agg(F.lit(step).alias("step"), F.lit(first[step]).alias("first_run"), F.lit(second[step]).alias("second_run"), F.count("*").alias("row_count"))
        for step, df in counts.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def rejects_traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows behind the rejects of a prep, found by file and row, with the rules they break."""
    source, base = scratch(spark), scratch(spark)
    _broken(spark, sf_dir).write.option("compression", "zstd").parquet(source)
    run_prep(spark, source, f"{base}/accepted", declared=SALES_IMPORT, rejects=f"{base}/rejected", trace=True)
    return trace_back(spark, source, scan(spark, f"{base}/rejected")).drop("source_file", "source_row")


def rejects_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of every rule over the planted fact, from its rejects alone."""
    _, rejected = split(_planted(spark, sf_dir), SALES_IMPORT)
    files = scan(spark, write_parquet(rejected.withColumn("violations", F.array_join("violations", ",")), scratch(spark)))
    return check_rejects(files, SALES_IMPORT)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over broken rows, a third of the files a batch, run again after its end: accepted and rejected rows of all batches."""
    source, base = scratch(spark), scratch(spark)
    broken = _broken(spark, sf_dir)
    # files as the scan splits them, so that none grows with the table; what has fewer than three splits is small
    broken.write.option("compression", "zstd").parquet(source)
    if listed(spark, source).count() < 3:
        broken.repartition(3).write.mode("overwrite").parquet(source)
    third = max(1, listed(spark, source).count() // 3)
    for _ in range(2):
        prep_batches(spark, source, f"{base}/accepted", broken.schema, f"{base}/done", f"{base}/rejected", files_per_batch=third).awaitTermination()
    both = scan(spark, f"{base}/accepted").unionByName(scan(spark, f"{base}/rejected"))
    return both.drop("batch").withColumn("TaxRate", F.col("TaxRate").cast(SALES_IMPORT.schema()["TaxRate"].dataType))


def import_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The import by a contract that is read from the table's definition."""
    base = scratch(spark)
    write_parquet(prep(_fact(spark, sf_dir)), f"{base}/prepared")
    return import_external(spark, base, declared=read_ddl(f"CREATE TABLE imported ({SALES_DDL}) USING parquet"))


def read_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a scan reads in about as many tasks as were asked for, for two numbers of tasks."""
    target = scratch(spark)
    scan(spark, f"{sf_dir}/lineitem.parquet").repartition(24).write.parquet(target)
    parts = []
    for tasks in (3, 12):
        with read_in(spark, target, tasks):
            read = scan(spark, target).groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()  # a row a task
        near = tasks - 1 <= len(read) <= 2 * tasks
        parts.append((tasks, near, sum(r["n"] for r in read)))
    return spark.createDataFrame(parts, "wanted int, near boolean, row_count long")


def full_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = sales_fact(spark, sf_dir)
    schema = scratch_schema(spark)
    loaded = run_chain(
        spark, table, scratch(spark), f"{schema}.fact_sale_loaded",
        imported_as=f"{schema}.ext_fact_sale_import",
    )
    return spark.table(loaded)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the prepared sales fact."""
    return prep(sales_source(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    return {
        "scan_parquet": scan_parquet,
        "strip_headings": headings,
        "derive_desc1": derive_desc1,
        "cast_long": _cast_query(
            "lineitem", "l_orderkey",
            k=("l_linenumber", T.LongType()),
            t=("CAST(l_quantity AS STRING)", T.LongType()),
        ),
        "cast_int": _cast_query(
            "lineitem", "l_orderkey",
            v=("l_extendedprice", T.IntegerType()),
            t=("CAST(l_extendedprice AS STRING)", T.IntegerType()),
            w=("l_orderkey * 100000", T.IntegerType()),
        ),
        "cast_date": _cast_query("events", "event_id", d=("ts", T.DateType())),
        "cast_string": _cast_query("part", "p_partkey", s=("p_size", T.StringType())),
        "cast_decimal": _cast_query(
            "lineitem", "l_orderkey",
            v=("l_extendedprice * (1 - l_discount)", T.DecimalType(18, 2)),
            t=("CAST(l_extendedprice AS STRING)", T.DecimalType(18, 2)),
        ),
        "typed_projection": typed_projection,
        "parquet_roundtrip": parquet_roundtrip,
        "export_table": export,
        "import_external": import_prepared,
        "load_table": load,
        "contract_nulls": contract_nulls,
        "contract_lengths": contract_lengths,
        "contract_text_lengths": contract_text_lengths,
        "contract_rejects": contract_rejects,
        "contract_accepted": contract_accepted,
        "prep_job": prep_job,
        "csv_prep": csv_prep,
        "prep_stream": stream,
        "cast_text": _cast_query(
            "lineitem", "l_orderkey", i=(_TEXT, T.IntegerType()), b=(_TEXT, T.LongType()),
        ),
        "files_written": files_written,
        "drop_recreate": drop_recreate,
        "load_twice": load_twice,
        "contract_types": contract_types,
        "command_line": command_line,
        "chain_split": chain_split,
        "load_recovered": load_recovered,
        "drop_external_only": drop_external_only,
        "schema_drift": schema_drift,
        "chain_resumed": chain_resumed,
        "rejects_traced": rejects_traced,
        "rejects_counted": rejects_counted,
        "stream_batches": stream_batches,
        "import_ddl": import_ddl,
        "read_splits": read_splits,
        "cast_exponents": _cast_query(
            "lineitem", "l_orderkey", i=(_EXPONENT, T.IntegerType()), b=(_EXPONENT, T.LongType()),
        ),
        "full_pipeline": full_pipeline,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "scan_parquet": "SELECT * FROM lineitem",
        "strip_headings": oracle.source(),
        "derive_desc1": "SELECT doc_id, substring(text, 4, 6) AS Desc1 FROM documents",
        "cast_long": (
            "SELECT l_orderkey, try_cast(l_linenumber AS bigint) AS k,"
            " try_cast(trunc(try_cast(CAST(l_quantity AS varchar) AS decimal(38,18))) AS bigint) AS t"
            " FROM lineitem"
        ),
        "cast_int": (
            "SELECT l_orderkey, try_cast(trunc(l_extendedprice) AS int) AS v,"
            " try_cast(trunc(try_cast(CAST(l_extendedprice AS varchar) AS decimal(38,18))) AS int) AS t,"
            " try_cast(l_orderkey * 100000 AS int) AS w FROM lineitem"
        ),
        "cast_date": "SELECT event_id, try_cast(ts AS date) AS d FROM events",
        "cast_string": "SELECT p_partkey, CAST(p_size AS varchar) AS s FROM part",
        "cast_decimal": (
            "SELECT l_orderkey, try_cast(CAST(l_extendedprice * (1 - l_discount) AS varchar)"
            " AS decimal(18,2)) AS v,"
            " try_cast(CAST(l_extendedprice AS varchar) AS decimal(18,2)) AS t FROM lineitem"
        ),
        "typed_projection": f"SELECT * EXCLUDE (Desc1) FROM ({oracle.prepared()})",
        "parquet_roundtrip": "SELECT * FROM orders",
        "export_table": oracle.source(spaced=True),
        "import_external": oracle.imported(),
        "load_table": oracle.imported(),
        "contract_nulls": oracle.null_counts(),
        "contract_lengths": oracle.length_counts(),
        "contract_text_lengths": oracle.text_counts(),
        "contract_rejects": oracle.rejected(),
        "contract_accepted": oracle.accepted(),
        "prep_job": oracle.prepared(),
        "csv_prep": oracle.prepared(),
        "prep_stream": oracle.prepared(),
        "cast_text": (
            f"SELECT l_orderkey, try_cast({_WHOLE} AS int) AS i, try_cast({_WHOLE} AS bigint) AS b"
            f" FROM (SELECT l_orderkey, {_TEXT} AS t FROM lineitem)"
        ),
        "files_written": "SELECT CAST(3 AS bigint) AS files, count(*) AS row_count, true AS even FROM orders",
        "drop_recreate": f"{oracle.source(spaced=True)} UNION ALL {oracle.source(spaced=True)}",
        "load_twice": oracle.prepared(),
        "contract_types": oracle.prepared_types(),
        "command_line": oracle.prepared(),
        "chain_split": oracle.chain_split(),
        "load_recovered": f"SELECT *, 3 AS loaded FROM ({oracle.prepared()})",
        "drop_external_only": f"{oracle.source(spaced=True)} UNION ALL {oracle.source(spaced=True)}",
        "schema_drift": oracle.drifted(),
        "chain_resumed": oracle.resumed(),
        "rejects_traced": oracle.traced(),
        "rejects_counted": oracle.all_counts(),
        "stream_batches": oracle.chain_split(),
        "import_ddl": oracle.imported(),
        "read_splits": "SELECT unnest([3, 12]) AS wanted, true AS near, (SELECT count(*) FROM lineitem) AS row_count",
        "cast_exponents": (
            f"SELECT l_orderkey, try_cast({_SHIFTED} AS int) AS i, try_cast({_SHIFTED} AS bigint) AS b"
            " FROM (SELECT *, CAST(l_orderkey AS hugeint) AS k FROM lineitem)"
        ),
        "full_pipeline": oracle.imported(),
        **LLM_SQL,
    }
