from __future__ import annotations

import re
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom import (
    SALES,
    SALES_IMPORT,
    Contract,
    Field,
    Substring,
    enforce,
    prep,
    prep_stream,
    run_chain,
    run_prep,
    scan,
    write_parquet,
)
from factloom import job
from factloom.operators.checks import ContractViolation, require_types
from factloom.plans.compiling import compiled_methods
from tests.samples import GOOD, optimized_plan, physical_plan, raw_sales

GOLDEN = (
    "SaleKey bigint, CityKey int, CustomerKey int, BillToCustomerKey int, StockItemKey int, "
    "InvoiceDateKey date, DeliveryDateKey date, SalespersonKey int, WWIInvoiceID int, "
    "Description string, Package string, Quantity int, UnitPrice decimal(18,2), "
    "TaxRate decimal(18,2), TotalExcludingTax decimal(18,2), TaxAmount decimal(18,2), "
    "Profit decimal(18,2), TotalIncludingTax decimal(18,2), TotalDryItems int, "
    "TotalChillerItems int, LineageKey int, Desc1 string"
)
PREPARED = (
    1, 2, 3, 4, 5, date(2013, 1, 5), date(2013, 1, 6), 6, 7, "abcdefghij", "Each", 23,
    Decimal("1.01"), Decimal("14.38"), Decimal("100.00"), Decimal("-14.38"), Decimal("1.50"),
    Decimal("114.38"), 3, 0, 9, "defghi",
)


def test_contract_counts():
    names = [f.type.simpleString() for f in SALES.fields]
    counts = {n: names.count(n) for n in set(names)}
    assert counts == {"bigint": 1, "int": 10, "date": 2, "string": 3, "decimal(18,2)": 6}
    assert [f.name for f in SALES.fields if f.nullable] == ["DeliveryDateKey"]
    changed = [f for f, g in zip(SALES_IMPORT.fields, SALES.fields) if f != g]
    assert changed == [Field("TaxRate", T.DecimalType(18, 3))]


def test_golden_schema_and_row(spark):
    prepared = prep(raw_sales(spark))
    assert ", ".join(f"{n} {t}" for n, t in prepared.dtypes) == GOLDEN
    assert prepared.schema == SALES.schema()
    assert prepared.collect() == [PREPARED]


def test_prep_is_one_projection_without_a_shuffle(spark, tmp_path):
    source = write_parquet(raw_sales(spark), str(tmp_path / "s"))
    prepared = prep(scan(spark, source))
    assert optimized_plan(prepared).count("Project [") == 1
    plan = physical_plan(prepared)
    assert "*(1) Project" in plan and "Batched: true" in plan and "Exchange" not in plan


def test_generated_methods_are_small_enough_to_be_compiled(spark, tmp_path, capsys):
    """The JVM interprets methods above 8000 bytes, several times slower."""
    text = scan(spark, write_parquet(raw_sales(spark), str(tmp_path / "text")))
    numbers = SALES.without("Description", "Package", "InvoiceDateKey", "DeliveryDateKey", "Desc1").names
    doubles = [c for c in text.columns if c.replace(" ", "") in numbers]
    typed = text.withColumns({c: F.col(f"`{c}`").cast("double") for c in doubles})
    typed = scan(spark, write_parquet(typed, str(tmp_path / "typed")))
    capsys.readouterr()
    enforce(prep(typed), SALES_IMPORT).explain("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)
    assert sizes and max(map(int, sizes)) < 8000
    # Over text the exact casts make a larger one, which the jobs let Spark split.
    with compiled_methods(spark):
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
        assert enforce(prep(text), SALES_IMPORT).count() == 1
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"


def test_extra_columns_stay_ahead_of_the_derived_one(spark):
    prepared = prep(raw_sales(spark).withColumn("Extra Col", F.lit(1.5)))
    assert prepared.columns == [*SALES.names[:-1], "ExtraCol", "Desc1"]
    assert prepared.schema["ExtraCol"].dataType == T.DoubleType()


def test_missing_columns_are_named_at_once(spark):
    with pytest.raises(ValueError, match=r"\['CityKey', 'Description'\]"):
        prep(raw_sales(spark).drop("City Key", "Description"))


def test_a_source_with_the_derived_column_is_refused(spark):
    with pytest.raises(ValueError, match="not distinct"):
        prep(raw_sales(spark).withColumn("Desc1", F.lit("x")))


def test_other_contracts_and_derived_columns(spark):
    contract = Contract((Field("id", T.IntegerType()), Field("head", T.StringType())))
    derive = (Substring("head", "t", 1, 2), Substring("first", "head", 1, 1))
    df = spark.createDataFrame([("1", "abc")], ["i d", "t"])
    assert prep(df, contract, derive).collect() == [(1, "abc", "ab", "a")]


def test_run_prep_writes_and_replaces(spark, tmp_path):
    source = write_parquet(raw_sales(spark, {}, {"Sale Key": "2"}), str(tmp_path / "s"))
    target = str(tmp_path / "t")
    for _ in range(2):
        assert run_prep(spark, source, target, partitions=2) == target
    assert scan(spark, target).count() == 2
    assert len(list(Path(target).glob("part-*"))) == 2


def test_run_prep_keeps_bad_rows_unless_a_contract_is_declared(spark, tmp_path):
    source = write_parquet(raw_sales(spark, {"City Key": "x"}), str(tmp_path / "s"))
    target = run_prep(spark, source, str(tmp_path / "t"))
    assert scan(spark, target).first().CityKey is None
    with pytest.raises(Exception, match="CityKey_nulls"):
        run_prep(spark, source, str(tmp_path / "u"), declared=SALES_IMPORT)


def test_csv_source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ["|".join(GOOD), "|".join(GOOD.values()), "|".join((GOOD | {"Delivery Date Key": ""}).values())]
    (tmp_path / "in" / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    target = run_prep(spark, str(tmp_path / "in"), str(tmp_path / "out"), fmt="csv")
    rows = scan(spark, target).collect()
    assert rows[0] == PREPARED
    assert rows[1].DeliveryDateKey is None and rows[1].SaleKey == 1


@pytest.fixture
def chain(spark, schema, tmp_path):
    def run(*changes, **options):
        raw_sales(spark, *changes).write.mode("overwrite").saveAsTable(f"{schema}.fact_sale")
        target = f"{schema}.loaded"
        return run_chain(spark, f"{schema}.fact_sale", str(tmp_path), target, **options)

    return run


def test_chain_loads_the_declared_table(spark, schema, chain, tmp_path):
    loaded = spark.table(chain({}, {"Sale Key": "2"}, imported_as=f"{schema}.ext_import"))
    require_types(loaded, SALES_IMPORT)
    assert sorted(r.SaleKey for r in loaded.collect()) == [1, 2]
    assert loaded.first().TaxRate == Decimal("14.380")
    assert spark.table(f"{schema}.ext_import").count() == 2
    assert {p.name for p in tmp_path.iterdir()} == {"export", "prepared"}
    assert spark.table(chain({"Sale Key": "3"})).first().SaleKey == 3


def test_chain_stops_at_a_broken_row_and_leaves_the_target(spark, schema, chain):
    loaded = chain({})
    with pytest.raises(Exception, match="Quantity_nulls"):
        chain({}, {"Quantity": "many"})
    assert spark.table(loaded).count() == 1


def test_chain_splits_broken_rows_off(spark, chain, tmp_path):
    loaded = spark.table(chain(
        {}, {"Sale Key": "2", "Quantity": "many"}, {"Sale Key": "3", "Tax Rate": "9999999999999999"},
        on_violation="split", partitions="auto",
    ))
    require_types(loaded, SALES_IMPORT)
    assert [r.SaleKey for r in loaded.collect()] == [1]
    rejected = scan(spark, str(tmp_path / "rejected")).collect()
    assert sorted((r.SaleKey, r.violations) for r in rejected) == [(2, "Quantity_nulls"), (3, "TaxRate_nulls")]


def test_chain_error_stops_the_steps_after_it(spark, schema, tmp_path):
    spark.range(1).write.saveAsTable(f"{schema}.other")
    with pytest.raises(ValueError, match="missing columns"):
        run_chain(spark, f"{schema}.other", str(tmp_path), f"{schema}.loaded")
    assert not spark.catalog.tableExists(f"{schema}.loaded")
    with pytest.raises(ValueError, match="on_violation"):
        run_chain(spark, f"{schema}.other", str(tmp_path), f"{schema}.loaded", on_violation="drop")


def test_args(spark, tmp_path, schema):
    for argv in ([], ["prep"], ["prep", "only-one"], ["chain", "a", "b"]):
        with pytest.raises(SystemExit):
            job.main(argv, spark)
    source = write_parquet(raw_sales(spark, {}, {"Quantity": "many"}), str(tmp_path / "s"))
    target = str(tmp_path / "t")
    for partitions in ("1", "auto"):
        job.main(["prep", source, target, "--partitions", partitions, "--rejects", str(tmp_path / "r")], spark)
        assert scan(spark, target).drop("violations").collect() == [PREPARED]
        assert [r.violations for r in scan(spark, str(tmp_path / "r")).collect()] == ["Quantity_nulls"]
    with pytest.raises(Exception, match="Quantity_nulls"):
        job.main(["prep", source, target, "--enforce"], spark)
    raw_sales(spark).write.saveAsTable(f"{schema}.fact")
    job.main(["chain", f"{schema}.fact", str(tmp_path / "b"), f"{schema}.done", "--exported-as", f"{schema}.ext",
              "--imported-as", f"{schema}.imp", "--prepared-location", "p", "--on-violation", "split"], spark)
    assert spark.table(f"{schema}.done").count() == spark.table(f"{schema}.ext").count() == spark.table(f"{schema}.imp").count() == 1
    assert {p.name for p in (tmp_path / "b").iterdir()} == {"export", "p", "rejected"}


def test_a_contract_from_a_file(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"columns": [{"name": "A", "type": "int"}, {"name": "B", "type": "decimal(9,1)", "declared": "decimal(9,2)", "nullable": true},'
        ' {"name": "C", "type": "string", "max_length": 3}], "derive": [{"name": "C", "source": "T", "start": 1, "length": 3}]}')
    write_parquet(spark.createDataFrame([("7", "1.25", "abcdef")], "A string, B string, T string"), str(tmp_path / "s"))
    job.main(["prep", str(tmp_path / "s"), str(tmp_path / "t"), "--contract", str(tmp_path / "c.json"), "--enforce"], spark)
    assert [tuple(r) for r in scan(spark, str(tmp_path / "t")).collect()] == [(7, Decimal("1.3"), "abcdef", "abc")]


def test_split_reads_the_export_once_and_loads_only_accepted_rows(spark, chain, schema, tmp_path):
    """One write makes both directories, so the prepared rows are computed once."""
    loaded = chain({}, {"Sale Key": "2", "Quantity": "many"}, on_violation="split", imported_as=f"{schema}.imp")
    assert spark.table(loaded).count() == scan(spark, str(tmp_path / "prepared")).count() == 1
    assert not (tmp_path / "prepared__judged").exists()
    chain({}, on_violation="split")
    assert scan(spark, str(tmp_path / "rejected")).count() == 0


def test_a_prepared_directory_stays_until_the_new_one_is_whole(spark, tmp_path):
    good, bad = (write_parquet(raw_sales(spark, c), str(tmp_path / n)) for n, c in (("g", {}), ("b", {"Quantity": "many"})))
    target = run_prep(spark, good, str(tmp_path / "t"), declared=SALES_IMPORT)
    with pytest.raises(Exception, match="Quantity_nulls"):
        run_prep(spark, bad, target, declared=SALES_IMPORT)
    assert scan(spark, target).count() == 1


def test_the_targets_directory_may_not_hold_the_base(spark, schema, tmp_path):
    raw_sales(spark).write.saveAsTable(f"{schema}.fact")
    spark.range(1).write.saveAsTable(f"{schema}.done")
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.done").where("col_name = 'Location'").first().data_type
    with pytest.raises(ValueError, match="overlap"):
        run_chain(spark, f"{schema}.fact", f"{place}/base", f"{schema}.done")
    assert spark.table(f"{schema}.done").count() == 1


def test_prepared_files_of_other_types_stop_the_chain(spark, schema, tmp_path, monkeypatch):
    from factloom.plans import chain as chain_module

    raw_sales(spark).write.saveAsTable(f"{schema}.fact")

    def spoiled(spark, source, target, **options):
        return write_parquet(prep(scan(spark, source)).withColumn("TaxRate", F.lit("x")), target)

    monkeypatch.setattr(chain_module, "run_prep", spoiled)
    with pytest.raises(ContractViolation, match="TaxRate is string"):
        run_chain(spark, f"{schema}.fact", str(tmp_path), f"{schema}.done")


def test_a_glob_over_the_target_is_refused(spark, tmp_path):
    source = write_parquet(raw_sales(spark), str(tmp_path / "g" / "s1"))
    with pytest.raises(ValueError, match="overlap"):
        run_prep(spark, str(tmp_path / "g" / "s*"), source)
    assert scan(spark, source).count() == 1


def test_csv_headers_and_line_breaks(spark, tmp_path):
    for name, text in (("1.csv", "a|b\n1|2\n"), ("2.csv", "b|a\n3|4\n")):
        (tmp_path / "two").mkdir(exist_ok=True)
        (tmp_path / "two" / name).write_text(text)
    with pytest.raises(Exception, match="(?i)header"):
        scan(spark, str(tmp_path / "two"), "csv").collect()
    (tmp_path / "m.csv").write_text('a|b\n"x\ny"|2\n')
    assert [tuple(r) for r in scan(spark, str(tmp_path / "m.csv"), "csv", multi_line=True).collect()] == [("x\ny", "2")]


def test_stream_stops_at_a_broken_row(spark, tmp_path):
    source, target, done = (str(tmp_path / n) for n in ("s", "t", "c"))
    raw = raw_sales(spark, {"Quantity": "many"})
    raw.write.parquet(source)
    query = prep_stream(spark, source, target, raw.schema, done, declared=SALES_IMPORT)
    with pytest.raises(Exception, match="Quantity_nulls"):
        query.awaitTermination()


def test_stream_prepares_each_file_once(spark, tmp_path):
    source, target, done = (str(tmp_path / n) for n in ("s", "t", "c"))
    raw = raw_sales(spark)

    def arrive(*changes):
        raw_sales(spark, *changes).write.mode("append").parquet(source)
        prep_stream(spark, source, target, raw.schema, done).awaitTermination()
        return sorted(r.SaleKey for r in scan(spark, target).collect())

    assert arrive({}) == [1]
    assert arrive({"Sale Key": "2"}) == [1, 2]
    assert scan(spark, target).schema == SALES.schema()
