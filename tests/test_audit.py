"""Files of differing schemas, and how many tasks read them."""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from factloom import import_external, job, prep, run_prep, scan, write_parquet
from factloom.sources import audit
from factloom.sources.audit import SchemaDrift, file_schemas
from factloom.sources.files import read_in
from tests.samples import physical_plan, raw_sales


def files_of(spark, folder, **frames):
    """One directory with a file for each frame."""
    for name, df in frames.items():
        df.coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


@pytest.fixture(params=[64, 1])
def batch(request, monkeypatch):
    """Footers read by the driver, or in tasks."""
    monkeypatch.setattr(audit, "BATCH", request.param)


def test_an_extra_or_missing_column_raises(spark, tmp_path, batch):
    plain = spark.range(3).select("id", F.lit("x").alias("t"))
    path = files_of(spark, tmp_path / "d", a=plain, b=plain.withColumn("more", F.lit(1.5)), c=plain.drop("t"))
    with pytest.raises(SchemaDrift) as raised:
        scan(spark, path)
    said = str(raised.value)
    assert "more" in said and "t is" in said and "missing" in said and ".parquet" in said
    united = scan(spark, path, drift="unite")
    assert sorted(united.columns) == ["id", "more", "t"] and united.count() == 9
    assert united.where("more IS NULL").count() == 6 and united.where("t IS NULL").count() == 3
    assert scan(spark, path, drift="ignore").count() == 9


def test_other_types_raise_and_another_order_does_not(spark, tmp_path, batch):
    plain = spark.range(3).select("id", F.lit("x").alias("t"))
    path = files_of(spark, tmp_path / "d", a=plain, b=plain.select("t", "id"), c=plain.withColumn("id", F.col("id") + 1))
    assert sorted(r.id for r in scan(spark, path).collect()) == [0, 0, 1, 1, 1, 2, 2, 2, 3]
    files_of(spark, tmp_path / "d", d=plain.withColumn("id", F.col("id").cast("int")))
    with pytest.raises(SchemaDrift, match="id is int in .*, bigint in|id is bigint in .*, int in"):
        scan(spark, path)


def test_the_audit_counts_files_by_schema(spark, tmp_path):
    plain = spark.range(3)
    path = files_of(spark, tmp_path / "d", a=plain, b=plain, c=plain.withColumn("x", F.lit(1)))
    found = {r.columns: (r.files, r.example) for r in file_schemas(spark, path).collect()}
    assert {k: v[0] for k, v in found.items()} == {json.dumps({"id": "bigint"}): 2, json.dumps({"id": "bigint", "x": "int"}): 1}
    assert all(v[1].startswith("file:") and v[1].endswith(".parquet") for v in found.values())


def test_files_that_spark_has_not_written(spark, tmp_path, batch):
    (tmp_path / "d").mkdir()
    stamp = pa.array([0], pa.timestamp("us"))
    pq.write_table(pa.table({"a": [1], "s": stamp}), tmp_path / "d" / "1.parquet")
    pq.write_table(pa.table({"s": stamp, "a": [2]}), tmp_path / "d" / "2.parquet")
    spark.createDataFrame([(3,)], "a long").selectExpr("a", "TIMESTAMP_NTZ '1970-01-01' AS s").write.mode("append").parquet(str(tmp_path / "d"))
    assert sorted(r.a for r in scan(spark, str(tmp_path / "d")).collect()) == [1, 2, 3]
    pq.write_table(pa.table({"a": [2], "s": stamp.cast(pa.timestamp("us", "UTC"))}), tmp_path / "d" / "3.parquet")
    with pytest.raises(SchemaDrift, match="s is timestamp"):
        scan(spark, str(tmp_path / "d"))


def test_files_that_only_spark_can_open(spark, tmp_path, monkeypatch):
    plain = spark.range(3)
    path = files_of(spark, tmp_path / "d", a=plain, b=plain.withColumn("x", F.lit(1)))
    monkeypatch.setattr(audit, "_columns", lambda p: None)
    with pytest.raises(SchemaDrift, match="x is"):
        scan(spark, path)


def test_globs_partitions_and_single_files(spark, tmp_path, batch):
    spark.range(6).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(str(tmp_path / "p"))
    assert scan(spark, str(tmp_path / "p")).columns == ["id", "k"]
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "q"))
    with pytest.raises(SchemaDrift):
        scan(spark, f"{tmp_path}/{{p/k=0,q}}")
    one = next((tmp_path / "q").glob("part-*"))
    assert scan(spark, str(one)).count() >= 0
    with pytest.raises(ValueError, match="drift"):
        scan(spark, str(one), drift="maybe")


def test_jobs_raise_or_unite(spark, schema, tmp_path):
    source = str(tmp_path / "s")
    raw_sales(spark).coalesce(1).write.parquet(source)
    raw_sales(spark, {"Sale Key": "2"}).withColumn("Extra", F.lit("e")).coalesce(1).write.mode("append").parquet(source)
    target = str(tmp_path / "b" / "prepared")
    with pytest.raises(SchemaDrift, match="Extra"):
        run_prep(spark, source, target)
    job.main(["prep", source, target, "--drift", "unite"], spark)
    assert sorted((r.SaleKey, r.Extra) for r in scan(spark, target).collect()) == [(1, None), (2, "e")]
    prep(raw_sales(spark, {"Sale Key": "3"})).coalesce(1).write.mode("append").parquet(target)
    with pytest.raises(SchemaDrift, match="Extra"):
        import_external(spark, str(tmp_path / "b"))
    assert import_external(spark, str(tmp_path / "b"), drift="unite").count() == 3
    with pytest.raises(ValueError, match="unite"):
        import_external(spark, str(tmp_path / "b"), drift="unite", name=f"{schema}.v")


def test_splits_follow_the_wanted_tasks(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 1).selectExpr("id", "uuid() AS u")
    path = str(tmp_path / "d")
    df.write.option("parquet.block.size", 256 * 1024).parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for tasks in (1, 3, 12):
        with read_in(spark, path, tasks) as split:
            read = scan(spark, path).select(F.spark_partition_id().alias("p")).distinct()
            planned = scan(spark, path).rdd.getNumPartitions()
            assert planned in (tasks, tasks + 1) and split > 0
            # a row group is whole, so a few splits may read nothing
            assert tasks / 2 <= read.count() <= tasks + 1
    many = write_parquet(spark.range(0, 1000, 1, 20), str(tmp_path / "m"))
    with read_in(spark, many, 4):
        assert scan(spark, many).rdd.getNumPartitions() <= 8 and scan(spark, many).count() == 1000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    for bad in (0, True, "3"):
        with pytest.raises(ValueError, match="tasks"), read_in(spark, path, bad):
            pass
    assert "FileScan" in physical_plan(scan(spark, path))
