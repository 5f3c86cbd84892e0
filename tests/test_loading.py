"""Loads that fail or are killed, and files that are not a load's own."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from factloom import drop, drop_external, drop_managed, export_table, import_external, load_table, prep, recover_load, run_chain, run_prep, scan, write_parquet
from factloom.sources import loading
from factloom.sources.loading import load_record, loaded_rows, remove_leftovers, versions_home
from factloom.sources.publishing import Storage
from factloom.sources.tables import WrongKind, table_kind, table_location
from tests.samples import raw_sales


class Killed(BaseException):
    """What no handler catches, as if the process were gone."""


def default_place(spark, schema, table):
    return spark.catalog.getDatabase(schema).locationUri.removeprefix("file:") + "/" + table


def rows(spark, name):
    spark.catalog.refreshTable(name)
    return sorted(r[0] for r in spark.table(name).collect())


def kill_at(monkeypatch, point):
    """Kills the load at one step; the number of notes tells record from publication."""
    count = iter(range(99))

    def killed(*args, **kwargs):
        raise Killed

    if point == "after writing":
        monkeypatch.setattr(loading, "_records", killed)
    elif point in ("at the mark", "at the record", "at the note of done"):
        which = ("at the mark", "at the record", "at the note of done").index(point)
        write = Storage.write_note
        monkeypatch.setattr(Storage, "write_note", lambda *a: killed() if next(count) == which else write(*a))
    elif point == "before publication":
        monkeypatch.setattr(loading, "_publish", killed)
    elif point == "between drop and rename":
        monkeypatch.setattr(loading, "_take_name", killed)
    elif point == "before the old version goes":
        monkeypatch.setattr(loading, "_finish", killed)


POINTS = ["at the mark", "at the record", "before publication", "between drop and rename", "before the old version goes", "at the note of done"]


@pytest.mark.parametrize("other_columns", [False, True])
@pytest.mark.parametrize("point", POINTS)
def test_a_killed_load_leaves_old_or_new_rows(spark, schema, monkeypatch, point, other_columns):
    name = f"{schema}.t"
    load_table(spark.range(3), name)
    new = spark.range(10, 15).withColumnRenamed("id", "other") if other_columns else spark.range(10, 15)
    old_rows, new_rows = [0, 1, 2], [10, 11, 12, 13, 14]
    with monkeypatch.context() as patched:
        kill_at(patched, point)
        if point == "between drop and rename" and not other_columns:
            load_table(new, name)  # a switch of versions has no such gap
        else:
            with pytest.raises(Killed):
                load_table(new, name)
    counted = point not in ("at the mark", "at the record")
    if point == "between drop and rename" and other_columns:
        assert not spark.catalog.tableExists(name)
    else:
        assert rows(spark, name) in (old_rows, new_rows)
    assert recover_load(spark, name) == (counted and not (point == "between drop and rename" and not other_columns))
    assert rows(spark, name) == (new_rows if counted else old_rows)
    assert not recover_load(spark, name)
    # the next load is not hindered by what was left, and leftovers can go
    load_table(spark.range(7), name)
    remove_leftovers(spark, name)
    assert rows(spark, name) == list(range(7))
    assert [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary] == ["t"]
    assert len([n for n in Storage(spark).names(versions_home(spark, name)) if n != "_commits"]) <= 1


@pytest.mark.parametrize("point", ["at the record", "before publication", "between drop and rename", "before the old version goes"])
def test_a_killed_first_load_and_one_over_another_table(spark, schema, monkeypatch, point):
    spark.range(4).write.saveAsTable(f"{schema}.made")
    for name, before in ((f"{schema}.first", None), (f"{schema}.made", [0, 1, 2, 3])):
        with monkeypatch.context() as patched:
            kill_at(patched, point)
            with pytest.raises(Killed):
                load_table(spark.range(9, 11), name)
        counted = point != "at the record"
        assert recover_load(spark, name) == counted
        if not counted and before is None:
            assert not spark.catalog.tableExists(name)
        else:
            assert rows(spark, name) == ([9, 10] if counted else before)


def test_a_load_of_the_same_columns_is_one_change_of_the_catalog(spark, schema):
    name = f"{schema}.t"
    places = set()
    for n in range(1, 4):
        load_table(spark.range(n), name)
        assert table_kind(spark, name) == "MANAGED" and rows(spark, name) == list(range(n))
        places.add(table_location(spark, name))
    assert len(places) == 3
    # the versions before are gone, as the rows of a dropped table are
    assert sum(Path(p.removeprefix("file:")).exists() for p in places) == 1
    assert [(r.seq, r.shown) for r in loaded_rows(spark, name).collect()] == [(1, False), (2, False), (3, True)]
    assert drop(spark, name) and not any(Path(p.removeprefix("file:")).exists() for p in places)
    load_table(spark.range(5), name)
    assert rows(spark, name) == list(range(5))


def test_rows_inserted_into_a_loaded_table_are_its_own(spark, schema):
    name = f"{schema}.t"
    load_table(spark.range(2), name)
    spark.range(5, 6).write.insertInto(name)
    assert rows(spark, name) == [0, 1, 5]
    load_table(spark.range(1), name)
    assert rows(spark, name) == [0]


def test_a_table_of_others_at_the_default_directory_keeps_its_rows(spark, schema):
    place = default_place(spark, schema, "t")
    spark.range(3).write.option("path", place).saveAsTable(f"{schema}.other")
    for n in (2, 4):
        load_table(spark.range(n), f"{schema}.t")
        assert rows(spark, f"{schema}.t") == list(range(n)) and rows(spark, f"{schema}.other") == [0, 1, 2]
    load_table(spark.range(6).withColumnRenamed("id", "x"), f"{schema}.t")
    assert rows(spark, f"{schema}.t") == list(range(6)) and rows(spark, f"{schema}.other") == [0, 1, 2]


def test_a_load_from_files_at_the_default_directory_keeps_them(spark, schema):
    place = default_place(spark, schema, "t")
    spark.range(3).write.parquet(place)
    load_table(scan(spark, place), f"{schema}.t")
    assert rows(spark, f"{schema}.t") == [0, 1, 2] and scan(spark, place).count() == 3


def test_a_chain_whose_base_is_the_default_directory_keeps_its_files(spark, schema):
    raw_sales(spark, {}, {"Sale Key": "2", "Quantity": "many"}).write.saveAsTable(f"{schema}.fact")
    base = default_place(spark, schema, "loaded")
    loaded = run_chain(spark, f"{schema}.fact", base, f"{schema}.loaded", on_violation="split")
    assert spark.table(loaded).count() == 1
    assert [scan(spark, f"{base}/{n}").count() for n in ("export", "prepared", "rejected")] == [2, 1, 1]


def test_a_directory_of_versions_that_no_load_made_is_refused(spark, schema):
    spark.range(3).write.parquet(default_place(spark, schema, "t__versions"))
    with pytest.raises(FileExistsError, match="no load"):
        load_table(spark.range(2), f"{schema}.t")


def test_an_import_or_export_never_drops_a_managed_table(spark, schema, tmp_path):
    write_parquet(prep(raw_sales(spark)), str(tmp_path / "prepared"))
    spark.range(3).write.saveAsTable(f"{schema}.kept")
    with pytest.raises(WrongKind, match="managed"):
        import_external(spark, str(tmp_path), name=f"{schema}.kept")
    raw_sales(spark).write.saveAsTable(f"{schema}.fact")
    with pytest.raises(WrongKind, match="managed"):
        export_table(spark, f"{schema}.fact", str(tmp_path), external=f"{schema}.kept")
    for names in ({"imported_as": f"{schema}.kept"}, {"exported_as": f"{schema}.kept"}):
        with pytest.raises(WrongKind, match="managed"):
            run_chain(spark, f"{schema}.fact", str(tmp_path / "b"), f"{schema}.done", **names)
    assert rows(spark, f"{schema}.kept") == [0, 1, 2] and not (tmp_path / "export").exists() and not (tmp_path / "b").exists()


def test_drop_by_kind(spark, schema, tmp_path):
    spark.range(3).write.saveAsTable(f"{schema}.managed")
    spark.range(3).write.option("path", str(tmp_path / "e")).saveAsTable(f"{schema}.external")
    spark.sql(f"CREATE VIEW {schema}.view AS SELECT 1 AS x")
    with pytest.raises(WrongKind):
        drop_external(spark, f"{schema}.managed")
    for name in ("external", "view"):
        with pytest.raises(WrongKind):
            drop_managed(spark, f"{schema}.{name}")
        assert drop_external(spark, f"{schema}.{name}") and not drop_external(spark, f"{schema}.{name}")
    assert drop_managed(spark, f"{schema}.managed") and not drop_managed(spark, f"{schema}.managed")
    assert scan(spark, str(tmp_path / "e")).count() == 3


def test_a_quoted_name_and_a_failed_load(spark, schema):
    name = f"`{schema}`.`T_1`"
    load_table(spark.range(2), name)
    with pytest.raises(Exception):
        load_table(spark.range(4).selectExpr("raise_error('no') AS id"), name)
    assert rows(spark, name) == [0, 1]


def test_rows_straight_from_files_are_dealt_unsorted(spark, schema, tmp_path):
    from factloom.plans.compiling import dealt_in_order

    key = "spark.sql.execution.sortBeforeRepartition"
    spark.range(1000).write.parquet(str(tmp_path / "s"))
    files = spark.read.parquet(str(tmp_path / "s"))
    frames = {
        "false": [files, files.where("id % 2 = 0").selectExpr("id + 1 AS n")],
        "true": [files.distinct(), files.join(files.alias("b"), "id"), files.repartition(2), files.selectExpr("rand() AS r"), spark.range(9)]}
    for wanted, some in frames.items():
        for df in some:
            with dealt_in_order(df):
                assert spark.conf.get(key) == wanted
            assert spark.conf.get(key) == "true"
    name = load_table(files, f"{schema}.dealt", partitions="auto")
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(1000))
