from __future__ import annotations

from pathlib import Path

import pytest

from factloom import run_prep, scan, write_parquet
from factloom.sources.files import join_path, place, require_apart
from tests.samples import physical_plan, raw_sales


def files(path) -> list[str]:
    return sorted(p.name for p in Path(path).glob("part-*"))


def test_partitions_give_that_many_files(spark, tmp_path):
    target = write_parquet(spark.range(0, 1000, 1, 8), str(tmp_path / "t"), partitions=3)
    assert len(files(target)) == 3
    sizes = [spark.read.parquet(f"{target}/{f}").count() for f in files(target)]
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) <= 8


def test_without_partitions_the_read_ones_are_written(spark, tmp_path):
    df = spark.range(0, 1000, 1, 5)
    assert len(files(write_parquet(df, str(tmp_path / "t")))) == 5
    assert "Exchange" not in physical_plan(place(df, None))


def test_round_robin_plans(spark):
    df = spark.range(0, 1000, 1, 5)
    assert "RoundRobinPartitioning(3)" in physical_plan(place(df, 3))
    automatic = physical_plan(place(df, "auto"))
    assert "RoundRobinPartitioning" in automatic and "REBALANCE_PARTITIONS_BY_NONE" in automatic


@pytest.mark.parametrize("partitions", [0, -1, "three", 2.5, True])
def test_other_partitions_are_refused(spark, partitions):
    with pytest.raises(ValueError, match="partitions"):
        place(spark.range(1), partitions)


def test_files_are_snappy_and_replaced_as_a_whole(spark, tmp_path):
    target = write_parquet(spark.range(0, 100, 1, 4), str(tmp_path / "t"))
    before = files(target)
    write_parquet(spark.range(7).withColumnRenamed("id", "n"), target)
    assert not set(before) & set(files(target))
    assert all(f.endswith(".snappy.parquet") for f in files(target))
    again = scan(spark, target)
    assert again.columns == ["n"] and again.count() == 7


def test_parquet_scan_takes_the_files_schema_and_prunes(spark, tmp_path):
    target = write_parquet(raw_sales(spark), str(tmp_path / "t"))
    df = scan(spark, target)
    assert df.columns == raw_sales(spark).columns
    assert "ReadSchema: struct<Sale Key:string>" in physical_plan(df.select("`Sale Key`"))


def test_csv_is_pipe_delimited_with_a_header_and_all_text(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('Sale Key|Description|Quantity\n1|"a|b"|23.0\n2||7\n', encoding="utf-8")
    df = scan(spark, str(source), "csv")
    assert df.dtypes == [("Sale Key", "string"), ("Description", "string"), ("Quantity", "string")]
    assert df.collect() == [("1", "a|b", "23.0"), ("2", None, "7")]


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError, match="format"):
        scan(spark, "/nowhere", "orc")


def test_location_is_joined_to_the_root():
    assert join_path("abfss://c@s/", "/export/") == "abfss://c@s/export"
    assert join_path("/base", "export") == "/base/export"


@pytest.mark.parametrize("target", ["{0}", "{0}/", "file:{0}", "{0}/inner", "{0}/x/.."])
def test_overlapping_directories_are_refused_and_nothing_is_lost(spark, tmp_path, target):
    source = write_parquet(raw_sales(spark), str(tmp_path / "s"))
    before = files(source)
    with pytest.raises(ValueError, match="overlap"):
        run_prep(spark, source, target.format(source))
    with pytest.raises(ValueError, match="overlap"):
        run_prep(spark, source, str(tmp_path))
    assert files(source) == before and scan(spark, source).count() == 1


def test_directories_with_a_common_prefix_are_apart(spark, tmp_path):
    require_apart(spark, str(tmp_path / "s"), str(tmp_path / "s2"))
