"""Load a managed table by versions, so that a load that is broken off loses nothing.

Every load writes its rows to a directory of its own, which no table has yet, and marks it as
its own. Then it writes a commit record: from here on the load counts, and ``recover_load`` brings
it to its end if the job is killed. Last it publishes the version:

- Where the table's present files are a version too and the columns are the same, the table is pointed
  at the new directory: one change in the catalog, so the name shows the old rows or the new ones.
- Otherwise (the first load, other columns, a table of other make) the version has been written as a managed
  table of another name, which takes the name; a table that has it is dropped as its kind asks. If
  the job is killed between the two, the name is gone until ``recover_load``, which every load runs first.

Records lie in ``<table>__versions`` beside the table's default directory. A directory is deleted only
if it holds the mark of a load that a record names: files that others put at the default
directory of the name, or anywhere else, are never touched. One job at a time loads a table: a second
one that commits meanwhile fails at its record.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.plans.compiling import dealt_in_order
from factloom.sources.files import place, require_apart
from factloom.sources.publishing import Storage
from factloom.sources.tables import drop, table_kind, table_location

MARK = "_loaded_version.json"


def _names(spark: SparkSession, name: str) -> tuple[str, str]:
    parts = name.replace("`", "").split(".")
    return (parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()), parts[-1]


def versions_home(spark: SparkSession, name: str) -> str:
    """Where the versions and records of a table lie."""
    database, table = _names(spark, name)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}__versions"


def _commits(home: str) -> str:
    return f"{home}/_commits"


def _records(files: Storage, home: str) -> list[dict[str, Any]]:
    """The whole records, oldest first, and whether each was published."""
    names = files.names(_commits(home))
    found = []
    for n in names:
        if n.endswith(".json") and not n.startswith((".", "done")):
            note = files.read_note(f"{_commits(home)}/{n}")
            if note is not None:
                found.append({**note, "seq": int(n.removesuffix(".json")), "done": f"done-{n}" in names})
    return sorted(found, key=lambda r: r["seq"])


def _columns(df: DataFrame) -> str:
    """Names and types in order, as text; nullability is not kept by tables."""
    return json.dumps([[f.name, f.dataType.json()] for f in df.schema.fields])


def _is_version(files: Storage, location: str | None, record: dict[str, Any]) -> bool:
    note = files.read_note(f"{location.rstrip('/')}/{MARK}") if location else None
    return note is not None and note.get("id") == record["id"]


def load_record(spark: SparkSession, name: str) -> dict[str, Any] | None:
    """The record of the load that the table shows, or None if it shows something else."""
    files = Storage(spark)
    location = table_location(spark, name)
    shown = [r for r in _records(files, versions_home(spark, name)) if _is_version(files, location, r)]
    return shown[-1] if shown else None


def _publish(spark: SparkSession, files: Storage, name: str, record: dict[str, Any]) -> None:
    """Make the table show a committed version; what is done already is not done again."""
    if not _is_version(files, table_location(spark, name), record):
        if record["staged"] is None:
            if table_kind(spark, name) is None:
                return  # dropped by its owner meanwhile
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(record['location'])}")
        elif spark.catalog.tableExists(record["staged"]):
            drop(spark, name)
            _take_name(spark, files, record, name)
    spark.catalog.refreshTable(name)


def _take_name(spark: SparkSession, files: Storage, record: dict[str, Any], name: str) -> None:
    """Rename a staged table. Where files of others lie at the name's default directory, which a
    managed table cannot share, the name becomes an external table over the version instead."""
    database, table = _names(spark, name)
    taken = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"
    if files.exists(taken) and not files.names(taken):
        files.delete(taken)  # an empty directory
    if not files.exists(taken):
        spark.sql(f"ALTER TABLE {record['staged']} RENAME TO {name}")
        return
    kept = f"{versions_home(spark, name)}/{record['id']}"
    if not files.exists(kept):
        files.move(record["location"], kept)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(kept)}")
    spark.sql(f"DROP TABLE IF EXISTS {record['staged']}")


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _finish(spark: SparkSession, files: Storage, name: str, home: str, record: dict[str, Any]) -> None:
    """Note that a version is published, and delete the one before it if a load made it."""
    files.write_note(f"{_commits(home)}/done-{record['seq']:08d}.json", {"id": record["id"]})
    before, now = record.get("before"), table_location(spark, name)
    if before is not None and now is not None and files.qualified(before["location"]) != files.qualified(now) and _is_version(files, before["location"], before):
        files.delete(before["location"])


def recover_load(spark: SparkSession, name: str) -> bool:
    """Publish a version that was committed and not published; say whether there was one.

    A load that was killed before its record never counted: the table is as it was, and the
    files of that load stay under ``versions_home`` or as a table ``<name>__loading_<id>`` until they are
    removed by ``remove_leftovers``.
    """
    files, home = Storage(spark), versions_home(spark, name)
    records = _records(files, home)
    if not records or records[-1]["done"]:
        return False
    _publish(spark, files, name, records[-1])
    _finish(spark, files, name, home, records[-1])
    return True


def remove_leftovers(spark: SparkSession, name: str) -> list[str]:
    """Delete what broken-off loads of the table left; return what it was.

    To be run while no load of the table is under way.
    """
    recover_load(spark, name)
    files, home = Storage(spark), versions_home(spark, name)
    database, table = _names(spark, name)
    shown, gone = table_location(spark, name), []
    for entry in files.names(home):
        path = f"{home}/{entry}"
        if not entry.startswith(("_", ".")) and (shown is None or files.qualified(path) != files.qualified(shown)):
            files.delete(path)
            gone.append(path)
    for t in spark.catalog.listTables(database):
        if t.name.startswith(f"{table}__loading_") and table_kind(spark, f"{database}.{t.name}") == "MANAGED":
            drop(spark, f"{database}.{t.name}")
            gone.append(f"{database}.{t.name}")
    return gone


def load_table(
    df: DataFrame, name: str, partitions: int | str | None = None, source: str | None = None, publish: bool = True
) -> str:
    """Replace the managed table ``name`` by ``df``; return the name.

    The table is a heap: no buckets, no sort order, no partition columns. Rows are spread without regard
    to their values; see ``place`` for ``partitions``. A load that fails leaves the old table as it
    was; one that was killed is brought to its end by the next, or by ``recover_load``. ``source`` is
    kept in the commit record, for who wants to know what the rows were made from. Without ``publish``
    the load is committed and the name goes on showing the old rows until ``recover_load``.
    """
    spark = df.sparkSession
    files, home = Storage(spark), versions_home(spark, name)
    if files.names(home) and not files.exists(_commits(home)):
        raise FileExistsError(f"{home!r} holds files that no load of {name} has made")
    held = table_location(spark, name)
    try:
        for place_of in filter(None, (held, home)):
            require_apart(spark, df, place_of)
    except ValueError as overlap:
        raise ValueError(f"[UNSUPPORTED_OVERWRITE] {name} cannot be replaced by rows read from it") from overlap
    recover_load(spark, name)
    records = _records(files, home)
    shown = load_record(spark, name)
    number = uuid.uuid4().hex
    same = shown is not None and table_kind(spark, name) in ("MANAGED", "EXTERNAL") and _columns(spark.table(name)) == _columns(df)
    location, staged = _written(spark, files, df, name, home, number, partitions, same)
    seq = records[-1]["seq"] + 1 if records else 1
    # numbers of broken records are passed over
    while files.exists(f"{_commits(home)}/{seq:08d}.json"):
        seq += 1
    before = None
    if shown is not None:
        before = {"id": shown["id"], "location": table_location(spark, name)}
    record = {"id": number, "location": location, "staged": staged, "before": before, "source": source}
    files.write_note(f"{_commits(home)}/{seq:08d}.json", record)
    if publish:
        record["seq"] = seq
        _publish(spark, files, name, record)
        _finish(spark, files, name, home, record)
    return name


def _written(
    spark: SparkSession, files: Storage, df: DataFrame, name: str, home: str, number: str, partitions: int | str | None, same: bool
) -> tuple[str, str | None]:
    """The rows in a directory of their own, marked; and the table they were staged as, if any."""
    writer = place(df, partitions).write.mode("error").option("compression", "snappy")
    if same:
        location, staged = f"{home}/{number}", None
        try:
            with dealt_in_order(df):
                writer.parquet(location)
        except Exception:
            files.delete(location)
            raise
    else:
        database, table = _names(spark, name)
        staged = f"`{database}`.`{table}__loading_{number[:8]}`"
        try:
            with dealt_in_order(df):
                writer.format("parquet").saveAsTable(staged)
        except Exception:
            drop(spark, staged)
            files.delete(f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{_names(spark, staged)[1]}")
            raise
        location = table_location(spark, staged)
    files.write_note(f"{location.rstrip('/')}/{MARK}", {"id": number, "table": name})
    return location, staged


def loaded_rows(spark: SparkSession, name: str) -> DataFrame:
    """Each committed load of a table: seq, id, source and whether the table shows it."""
    files = Storage(spark)
    location = table_location(spark, name)
    rows = [(r["seq"], r["id"], r["source"], _is_version(files, location, r)) for r in _records(files, versions_home(spark, name))]
    return spark.createDataFrame(rows, "seq long, id string, source string, shown boolean").orderBy(F.col("seq"))
