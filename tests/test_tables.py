from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from factloom import (
    SALES,
    SALES_IMPORT,
    drop,
    export_table,
    import_external,
    load_table,
    prep,
    scan,
    write_parquet,
)
from factloom.operators.checks import ContractViolation, require_types
from factloom.sources.files import place
from tests.samples import physical_plan, planted, raw_sales


def parquet_files(path) -> int:
    return len(list(Path(path).glob("part-*")))


@pytest.fixture
def source_table(spark, schema):
    raw_sales(spark, {}, {"Sale Key": "2"}).write.saveAsTable(f"{schema}.fact_sale")
    return f"{schema}.fact_sale"


@pytest.fixture
def base(spark, tmp_path):
    write_parquet(prep(raw_sales(spark, {}, {"Sale Key": "2"})), str(tmp_path / "prepared"))
    return str(tmp_path)


def test_export_writes_the_whole_table(spark, source_table, tmp_path):
    path = export_table(spark, source_table, str(tmp_path))
    assert path == f"{tmp_path}/export"
    exported = scan(spark, path)
    assert exported.schema == spark.table(source_table).schema
    assert sorted(exported.collect()) == sorted(spark.table(source_table).collect())


def test_export_is_a_copy_without_a_shuffle(spark, source_table):
    assert "Exchange" not in physical_plan(place(spark.table(source_table), None))


def test_export_over_the_tables_own_files_is_refused(spark, source_table):
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {source_table}")
    held = described.where("col_name = 'Location'").first().data_type
    with pytest.raises(ValueError, match="overlap"):
        export_table(spark, source_table, held, location="")
    assert spark.table(source_table).count() == 2


def test_export_of_a_view(spark, schema, tmp_path):
    spark.range(3).createOrReplaceTempView("three")
    assert scan(spark, export_table(spark, "three", str(tmp_path))).count() == 3


def test_drop_recreate(spark, schema, source_table, tmp_path):
    external = f"{schema}.ext_export"
    assert not drop(spark, external)
    path = export_table(spark, source_table, str(tmp_path), external=external)
    assert spark.catalog.tableExists(external) and spark.table(external).count() == 2
    kept = parquet_files(path)
    assert drop(spark, external) and not spark.catalog.tableExists(external)
    assert parquet_files(path) == kept > 0
    export_table(spark, source_table, str(tmp_path), external=external)
    export_table(spark, source_table, str(tmp_path), external=external)
    assert spark.table(external).count() == 2


def test_drop_of_a_managed_table_removes_it(spark, schema, source_table):
    assert drop(spark, source_table) and not drop(spark, source_table)


def test_drop_of_a_temporary_view(spark):
    spark.range(3).createOrReplaceTempView("some_view")
    assert drop(spark, "some_view") and not drop(spark, "some_view")


def test_import_has_the_declared_types_in_the_declared_order(spark, base):
    imported = import_external(spark, base)
    require_types(imported, SALES_IMPORT)
    assert sorted(r.TaxRate for r in imported.collect())[0].as_tuple().exponent == -3


def test_import_ignores_order_and_extras_of_the_files(spark, tmp_path):
    prepared = prep(raw_sales(spark)).select(*reversed(SALES.names), F.lit(1).alias("extra"))
    write_parquet(prepared, str(tmp_path / "prepared"))
    require_types(import_external(spark, str(tmp_path)), SALES_IMPORT)


def test_import_of_files_without_a_declared_column_is_refused(spark, tmp_path):
    write_parquet(prep(raw_sales(spark)).drop("Profit", "Desc1"), str(tmp_path / "prepared"))
    with pytest.raises(ValueError, match=r"\['Profit', 'Desc1'\]"):
        import_external(spark, str(tmp_path))


def test_import_of_a_value_too_large_for_its_type_fails(spark, tmp_path):
    large = planted(prep(raw_sales(spark)), TaxRate="9999999999999999.99")
    write_parquet(large, str(tmp_path / "prepared"))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        import_external(spark, str(tmp_path)).collect()


def test_import_name_is_a_view_over_the_files(spark, schema, base):
    name = f"{schema}.ext_import"
    for _ in range(2):
        require_types(import_external(spark, base, name=name), SALES_IMPORT)
    plan = physical_plan(spark.table(name).select("CityKey"))
    assert "ReadSchema: struct<CityKey:int>" in plan
    write_parquet(prep(raw_sales(spark)), f"{base}/prepared")
    assert spark.table(name).count() == 1
    kept = parquet_files(f"{base}/prepared")
    assert drop(spark, name) and parquet_files(f"{base}/prepared") == kept


def test_load_replaces_the_table(spark, schema, base):
    name = f"{schema}.loaded"
    spark.range(5).write.saveAsTable(name)
    assert load_table(import_external(spark, base), name) == name
    loaded = spark.table(name)
    require_types(loaded, SALES_IMPORT)
    assert sorted(r.SaleKey for r in loaded.collect()) == [1, 2]


def test_loaded_table_is_a_managed_parquet_heap(spark, schema):
    name = f"{schema}.loaded"
    load_table(spark.range(0, 900, 1, 2), name, partitions=3)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert described["Type"] == "MANAGED" and described["Provider"].lower() == "parquet"
    assert not {"Num Buckets", "Sort Columns", "# Partition Information"} & set(described)
    assert parquet_files(described["Location"].removeprefix("file:")) == 3


def test_a_load_that_fails_leaves_the_old_table(spark, schema, tmp_path):
    name = f"{schema}.kept"
    load_table(spark.range(4), name)
    with pytest.raises(Exception):
        load_table(spark.range(4).selectExpr("raise_error('no') AS id"), name)
    assert spark.table(name).count() == 4
    assert [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary] == ["kept"]


def test_files_of_a_broken_off_load_do_not_stop_the_next(spark, schema):
    name = f"{schema}.again"
    load_table(spark.range(4), name)
    held = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type
    spark.sql(f"DROP TABLE {name}")
    spark.range(9).write.parquet(held)
    assert spark.table(load_table(spark.range(5), name)).count() == 5


def test_export_of_a_view_over_the_target_is_refused(spark, schema, base):
    import_external(spark, base, name=f"{schema}.view")
    before = parquet_files(f"{base}/prepared")
    for location in ("prepared", ""):
        with pytest.raises(ValueError, match="overlap"):
            export_table(spark, f"{schema}.view", base, location)
    assert parquet_files(f"{base}/prepared") == before


def test_import_never_rounds(spark, tmp_path):
    write_parquet(prep(raw_sales(spark)).withColumn("TaxRate", F.expr("CAST(14.37599 AS decimal(18,5))")), str(tmp_path / "prepared"))
    with pytest.raises(ContractViolation, match="TaxRate"):
        import_external(spark, str(tmp_path))


def test_import_of_a_value_too_large_fails_without_ansi_too(spark, tmp_path, ansi_off):
    write_parquet(planted(prep(raw_sales(spark)), TaxRate="9999999999999999.99"), str(tmp_path / "prepared"))
    with pytest.raises(Exception, match="TaxRate"):
        import_external(spark, str(tmp_path)).collect()


def test_loading_a_table_into_itself_is_refused(spark, schema, source_table):
    with pytest.raises(Exception, match="UNSUPPORTED_OVERWRITE"):
        load_table(spark.table(source_table), source_table)
    assert spark.table(source_table).count() == 2
