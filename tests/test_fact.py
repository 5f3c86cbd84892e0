"""The made fact and the queries over it, on tables of the test's own."""

import datetime

import pytest

import __spark_entry__ as entry
from factloom import scan
from fixtures import sales
from tests.samples import physical_plan


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime.datetime(1995, 3, 5)
    lines = [(o, (o or 0) % 3, 1, n, 50.0 if (o or 1) % 5 == 0 else 1.0, 9.5, 0.1, 0.02, day) for o in [*range(40), 7, None] for n in (1, 2)]
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(o, (o or 0) + 1, day) for o in [*range(39), 7, None]]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    parts = [(p, "a part's name", "SMALL", 3.25) for p in (0, 1, None)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def expected():
    """(sale, customer): order 7 stands there twice in both tables, order 39 and part 2 in none."""
    return sorted((o * 8 + n, o + 1) for o in range(39) for n in (1, 2) if o % 3 < 2 for _ in range(4 if o == 7 else 1))


def test_the_fact_has_no_shuffle_of_whole_rows(spark, tables, monkeypatch):
    made = []
    monkeypatch.setattr(sales, "_build_once", lambda spark, sf_dir, name, make: made.append(make()) or ("", ""))
    sales.sales_fact(spark, tables)
    plan = physical_plan(made[0])
    assert "REBALANCE" not in plan and "RoundRobin" not in plan
    # the lines lie evenly at any size, as they are shuffled by order
    assert "SortMergeJoin" in plan
    assert sorted((r["Sale Key"], r["Customer Key"]) for r in made[0].collect()) == expected()


def test_files_of_the_stream_do_not_grow_with_the_table(spark, tables, monkeypatch):
    seen = []

    def batches(spark, source, target, schema, checkpoint, rejects, files_per_batch):
        seen.append((spark.read.parquet(source).count(), scan(spark, source).inputFiles(), files_per_batch))
        raise InterruptedError

    fact = sales.sales_source(spark, tables)
    monkeypatch.setattr(entry, "prep_batches", batches)
    for parts, files, a_batch in ((9, 9, 3), (1, 3, 1)):
        path = f"{tables}/in-{parts}"
        fact.repartition(parts).write.parquet(path)
        monkeypatch.setattr(entry, "_broken", lambda spark, sf_dir, path=path: spark.read.parquet(path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        spark.conf.set("spark.sql.files.openCostInBytes", "50000")  # a task for each file
        try:
            with pytest.raises(InterruptedError):
                entry.stream_batches(spark, tables)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        rows, found, third = seen[-1]
        assert (rows, len(found), third) == (len(expected()), files, a_batch)


def test_the_csv_copy_of_the_fact_is_compressed(spark, tables, monkeypatch):
    def prepared(spark, source, target, fmt):
        files = spark.read.option("header", True).option("sep", "|").csv(source)
        assert files.count() == len(expected()) and all(f.endswith(".csv.gz") for f in files.inputFiles())
        raise InterruptedError

    fact = sales.sales_source(spark, tables)
    monkeypatch.setattr(entry, "_fact", lambda spark, sf_dir: fact)
    monkeypatch.setattr(entry, "run_prep", prepared)
    with pytest.raises(InterruptedError):
        entry.csv_prep(spark, tables)
