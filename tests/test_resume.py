"""Chains that go on where they broke off, streams by batches, and contracts from definitions."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import types as T

from factloom import SALES_IMPORT, Contract, Field, export_table, import_external, job, prep, run_chain, scan, write_parquet
from factloom.contract import read_ddl
from factloom.plans import chain as chain_module
from factloom.sources.files import require_no_match
from factloom.sources.publishing import require_one_publication
from factloom.streaming.prep_batches import prep_batches
from factloom.streaming.prep_stream import prep_stream
from fixtures.sales import SALES_DDL
from tests.samples import raw_sales


@pytest.fixture
def chain(spark, schema, tmp_path):
    raw_sales(spark, {}, {"Sale Key": "2"}, {"Sale Key": "3", "Quantity": "many"}).write.saveAsTable(f"{schema}.fact")

    def run(table="fact", **options):
        steps = {}
        options = {"on_violation": "split", "resume": True, **options}
        try:
            run_chain(spark, f"{schema}.{table}", str(tmp_path / "b"), f"{schema}.loaded", on_step=steps.__setitem__, **options)
        except Exception as error:
            steps["error"] = str(error)
        return steps

    return run


ALL = {"export": "ran", "prep": "ran", "import": "ran", "load": "ran"}


def loaded(spark, schema):
    return sorted(r.SaleKey for r in spark.table(f"{schema}.loaded").collect())


def test_a_failed_load_is_resumed_without_export_and_prep(spark, schema, chain, tmp_path, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr(chain_module, "load_table", lambda *a, **k: 1 / 0)
        assert chain() == {"export": "ran", "prep": "ran", "import": "ran", "error": "division by zero"}
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "b").rglob("part-*")}
    assert chain() == {"export": "skipped", "prep": "skipped", "import": "ran", "load": "ran"}
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "b").rglob("part-*")} == files
    assert loaded(spark, schema) == [1, 2]
    assert chain() == {"export": "skipped", "prep": "skipped", "import": "ran", "load": "skipped"}
    assert chain(resume=False) == ALL


def test_a_failed_prep_is_resumed_after_the_export(spark, schema, chain, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr(chain_module, "run_prep", lambda *a, **k: 1 / 0)
        assert chain() == {"export": "ran", "error": "division by zero"}
    assert chain() == {"export": "skipped", "prep": "ran", "import": "ran", "load": "ran"}


def test_new_rows_other_parameters_and_touched_files_run_again(spark, schema, chain, tmp_path):
    assert chain() == ALL
    raw_sales(spark, {"Sale Key": "4"}).write.insertInto(f"{schema}.fact")
    assert chain() == ALL and loaded(spark, schema) == [1, 2, 4]
    assert chain(on_error="fail", on_violation="split").get("error")  # other casts: prep runs, and fails
    assert chain() == {"export": "skipped", "prep": "skipped", "import": "ran", "load": "skipped"}
    one = next((tmp_path / "b" / "rejected").glob("part-*"))
    one.unlink()
    assert chain()["prep"] == "ran"
    next((tmp_path / "b" / "export").glob("part-*")).unlink()
    assert chain()["export"] == "ran"
    spark.sql(f"DROP TABLE {schema}.loaded")
    assert chain() == {"export": "skipped", "prep": "skipped", "import": "ran", "load": "ran"}


def test_views_are_compared_by_their_definition_and_files(spark, schema, chain):
    spark.sql(f"CREATE VIEW {schema}.some AS SELECT * FROM {schema}.fact WHERE `Sale Key` > 1")
    assert chain("some") == ALL and chain("some")["export"] == "skipped"
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.some AS SELECT * FROM {schema}.fact WHERE `Sale Key` < 2")
    assert chain("some")["export"] == "ran" and loaded(spark, schema) == [1]
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.some AS SELECT * FROM {schema}.fact WHERE rand() < 2")
    assert chain("some")["export"] == chain("some")["export"] == "ran"
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.some AS SELECT a.* FROM {schema}.fact a JOIN {schema}.fact b USING (`Sale Key`)")
    assert chain("some")["export"] == chain("some")["export"] == "ran"


def test_resume_on_the_command_line(spark, schema, tmp_path, capsys):
    raw_sales(spark).write.saveAsTable(f"{schema}.fact")
    argv = ["chain", f"{schema}.fact", str(tmp_path / "b"), f"{schema}.loaded", "--resume"]
    job.main(argv, spark)
    assert capsys.readouterr().out.split() == ["export:", "ran", "prep:", "ran", "import:", "ran", "load:", "ran"]
    job.main(argv, spark)
    assert capsys.readouterr().out.split() == ["export:", "skipped", "prep:", "skipped", "import:", "ran", "load:", "skipped"]


def test_an_export_that_fails_keeps_the_old_files(spark, schema, tmp_path):
    raw_sales(spark).write.saveAsTable(f"{schema}.fact")
    export_table(spark, f"{schema}.fact", str(tmp_path))
    spark.sql(f"CREATE VIEW {schema}.bad AS SELECT raise_error('no') AS x FROM {schema}.fact")
    with pytest.raises(Exception, match="no"):
        export_table(spark, f"{schema}.bad", str(tmp_path))
    assert scan(spark, str(tmp_path / "export")).count() == 1


def arrive(spark, source, *changes):
    raw_sales(spark, *changes).coalesce(1).write.mode("append").parquet(source)


def batches(spark, tmp_path, **options):
    source, target, rejects = (str(tmp_path / n) for n in ("s", "t", "r"))
    query = prep_batches(spark, options.pop("source", source), target, raw_sales(spark).schema, options.pop("checkpoint", str(tmp_path / "c")), rejects, files_per_batch=1, **options)
    query.awaitTermination()
    read = lambda path: sorted((r.SaleKey, r.violations) for r in scan(spark, path).collect())
    return read(target), read(rejects)


def test_batches_split_and_replay_without_repeating_rows(spark, tmp_path):
    arrive(spark, str(tmp_path / "s"), {}, {"Sale Key": "2", "Quantity": "many"})
    assert batches(spark, tmp_path) == ([(1, "")], [(2, "Quantity_nulls")])
    arrive(spark, str(tmp_path / "s"), {"Sale Key": "3"})
    arrive(spark, str(tmp_path / "s"), {"Sale Key": "4"}, {"Sale Key": "5", "City Key": "x"})
    both = ([(1, ""), (3, ""), (4, "")], [(2, "Quantity_nulls"), (5, "CityKey_nulls")])
    assert batches(spark, tmp_path) == both
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == ["batch=0", "batch=1", "batch=2"]
    for n in range(3):
        require_one_publication(spark, f"{tmp_path}/t/batch={n}", f"{tmp_path}/r/batch={n}")
    # as if the query had been stopped before it noted the last batch as done
    for file in (tmp_path / "c" / "commits").glob("*2*"):
        file.unlink()
    before = require_one_publication(spark, f"{tmp_path}/t/batch=2")
    assert batches(spark, tmp_path) == both
    assert require_one_publication(spark, f"{tmp_path}/t/batch=2") != before


def test_a_new_checkpoint_does_not_overwrite_the_batches_of_another(spark, tmp_path):
    arrive(spark, str(tmp_path / "s"), {})
    batches(spark, tmp_path)
    with pytest.raises(Exception, match="another stream"):
        batches(spark, tmp_path, checkpoint=str(tmp_path / "c2"))
    assert scan(spark, str(tmp_path / "t")).count() == 1


def test_batches_without_rejects_stop_at_a_broken_row(spark, tmp_path):
    arrive(spark, str(tmp_path / "s"), {"Quantity": "many"})
    query = prep_batches(spark, str(tmp_path / "s"), str(tmp_path / "t"), raw_sales(spark).schema, str(tmp_path / "c"))
    with pytest.raises(Exception, match="Quantity_nulls"):
        query.awaitTermination()
    assert not (tmp_path / "t" / "batch=0").exists()


@pytest.mark.parametrize("pattern, target", [
    ("g/s*", "g/s2"), ("g/s*", "g/s2/in"), ("g/*/x", "g"), ("g/{a,b}", "g/b"), ("g/s?", "g/s1"), ("*/s", "h/s"), ("g/s", "g/s")])
def test_a_target_that_the_sources_glob_may_list_is_refused(spark, tmp_path, pattern, target):
    for n in ("g/s1", "g/a", "g/k/x", "i/s"):
        arrive(spark, str(tmp_path / n), {})
    if pattern == "g/s":
        arrive(spark, str(tmp_path / "g/s"), {})
    schema = raw_sales(spark).schema
    source, out, done = f"{tmp_path}/{pattern}", f"{tmp_path}/{target}", str(tmp_path / "c")
    for start in (lambda: prep_stream(spark, source, out, schema, done), lambda: prep_batches(spark, source, out, schema, done),
                  lambda: prep_batches(spark, source, str(tmp_path / "t"), schema, done, rejects=out)):
        with pytest.raises(ValueError, match="overlap"):
            start()
    require_no_match(spark, source, str(tmp_path / "other" / "t" / "u"))


def test_the_sales_contract_is_read_from_its_definition():
    assert read_ddl(SALES_DDL) == SALES_IMPORT
    bracketed = ", ".join(
        f"[{f.name}] [{'nvarchar' if f.max_length else f.type.simpleString().split('(')[0]}]"
        f"{'(%d)' % f.max_length if f.max_length else '(' + f.type.simpleString().split('(')[1] if '(' in f.type.simpleString() else ''}"
        f" {'NULL' if f.nullable else 'NOT NULL'}" for f in SALES_IMPORT.fields)
    for text in (bracketed, f"CREATE EXTERNAL TABLE [a].[b]\n(\n{bracketed}\n)\nWITH (LOCATION = '/x/', DATA_SOURCE = d)", f"create table b ({SALES_DDL}) USING parquet"):
        assert read_ddl(text) == SALES_IMPORT


def test_other_definitions():
    assert read_ddl("a varchar(max) null, `b c` char(3) NOT NULL, [null able] array<int>, d NVARCHAR (7), e decimal(5,1)") == Contract((
        Field("a", T.StringType(), True), Field("b c", T.StringType(), False, 3), Field("null able", T.ArrayType(T.IntegerType()), True),
        Field("d", T.StringType(), True, 7), Field("e", T.DecimalType(5, 1), True)))
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR|parse"):
        read_ddl("a b c d")
    with pytest.raises(ValueError, match="not closed"):
        read_ddl("CREATE TABLE x (a int")


def test_a_definition_on_the_command_line(spark, tmp_path):
    (tmp_path / "d.sql").write_text(SALES_DDL.replace("Package varchar(50)", "Package varchar(3)"))
    source = write_parquet(raw_sales(spark, {}, {"Package": "Box"}), str(tmp_path / "s"))
    job.main(["prep", source, str(tmp_path / "t"), "--declared", str(tmp_path / "d.sql"), "--rejects", str(tmp_path / "r"), "--trace"], spark)
    assert [r.violations for r in scan(spark, str(tmp_path / "r")).collect()] == ["Package_too_long"]
    assert Path(scan(spark, str(tmp_path / "r")).first().source_file.removeprefix("file:")).exists()
    write_parquet(prep(raw_sales(spark)), str(tmp_path / "prepared"))
    assert import_external(spark, str(tmp_path), declared=read_ddl(SALES_DDL)).schema == SALES_IMPORT.schema()
