"""Catalog tables: export one to files, declare one over files, load one."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.contract import SALES_IMPORT, Contract
from factloom.functions.names import folded, require_columns
from factloom.operators.checks import ContractViolation
from factloom.sources.files import join_path, require_apart, scan, write_parquet
from factloom.sources.publishing import beside, publish


def _quoted_path(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


class WrongKind(ValueError):
    """A name belongs to a table of another kind than the one to be dropped."""


def table_kind(spark: SparkSession, name: str) -> str | None:
    """``"MANAGED"``, ``"EXTERNAL"``, ``"VIEW"`` or ``"TEMPORARY"``; None for a name that is not there."""
    return spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else None


def drop(spark: SparkSession, name: str) -> bool:
    """Drop a table or view of any kind if it exists; say whether it did.

    The files of a managed table go with it; those of an external one, and those under a view, stay.
    """
    kind = table_kind(spark, name)
    if kind is None:
        return False
    spark.sql(f"DROP {'VIEW' if kind in ('VIEW', 'TEMPORARY') else 'TABLE'} IF EXISTS {name}")
    return True


def drop_external(spark: SparkSession, name: str) -> bool:
    """Drop an external table or a view if it exists; say whether it did. Files stay.

    A managed table of that name is an error: dropping it would delete its files.
    """
    if table_kind(spark, name) == "MANAGED":
        raise WrongKind(f"{name} is a managed table: dropping it as an external one would delete its files")
    return drop(spark, name)


def drop_managed(spark: SparkSession, name: str) -> bool:
    """Drop a managed table with its files if it exists; say whether it did. Any other kind is an error."""
    if table_kind(spark, name) not in (None, "MANAGED"):
        raise WrongKind(f"{name} is no managed table")
    return drop(spark, name)


def table_location(spark: SparkSession, name: str) -> str | None:
    """Where a table's files are; None for a view or a name that is not there."""
    if not spark.catalog.tableExists(name):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    rows = described.where(F.col("col_name") == "Location").select("data_type").take(1)
    return rows[0][0] if rows else None


def export_table(
    spark: SparkSession,
    table: str,
    base: str,
    location: str = "export",
    external: str | None = None,
    partitions: int | str | None = None,
    about: Mapping[str, Any] | None = None,
) -> str:
    """Write all of ``table`` as Snappy Parquet under ``base``; return the directory.

    The files are written beside the directory and published when they are whole, with ``about``
    in their note. With ``external``, a catalog table of that name is declared over the files, in place
    of any earlier external one; a managed table of that name is an error, before anything is written.
    """
    path = join_path(base, location)
    source = spark.table(table)
    for at in (path, beside(path, "writing")):
        require_apart(spark, source, at)
    if external is not None and table_kind(spark, external) == "MANAGED":
        raise WrongKind(f"{external} is a managed table and would lose its files")
    publish(spark, {path: write_parquet(source, beside(path, "writing"), partitions)}, about)
    if external is not None:
        drop_external(spark, external)
        spark.sql(f"CREATE TABLE {external} USING parquet LOCATION {_quoted_path(path)}")
    return path


_WIDER = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def _may_become(present: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of one type is one of the other, unchanged."""
    if isinstance(present, T.DecimalType) and isinstance(declared, T.DecimalType):
        return declared.scale >= present.scale and declared.precision >= present.precision
    if type(present) in _WIDER and type(declared) in _WIDER:
        return _WIDER[type(declared)] >= _WIDER[type(present)]
    return present == declared


def _declared_columns(df: DataFrame, declared: Contract) -> list[str]:
    """SQL for each declared column: as it is, or in a type that holds all its values.

    The one case where a value may not fit is a decimal whose scale grows and whose
    precision does not; such a value raises, whatever the session's ANSI setting.
    """
    require_columns(df, declared.names)
    present = {folded(df, f.name): f.dataType for f in df.schema.fields}
    columns = []
    for f in declared.fields:
        held, name = present[folded(df, f.name)], "`" + f.name.replace("`", "``") + "`"
        if not _may_become(held, f.type):
            raise ContractViolation(f"{f.name} is {held.simpleString()} in the files, which {f.type.simpleString()} cannot hold")
        kind = f.type.simpleString()
        if held == f.type:
            columns.append(f"{name} AS {name}")
        elif isinstance(held, T.DecimalType) and f.type.precision - f.type.scale < held.precision - held.scale:
            text = f.name.replace("'", "\\'")
            raised = f"raise_error('[NUMERIC_VALUE_OUT_OF_RANGE] {text} has a value that {kind} cannot hold')"
            columns.append(f"CASE WHEN {name} IS NULL THEN NULL ELSE coalesce(try_cast({name} AS {kind}), CAST({raised} AS {kind})) END AS {name}")
        else:
            columns.append(f"CAST({name} AS {kind}) AS {name}")
    return columns


def as_declared(df: DataFrame, declared: Contract) -> DataFrame:
    """The declared columns of ``df``, in the declared types and order.

    Scales and integers may grow; a type that would round, cut or overflow raises.
    """
    return df.selectExpr(*_declared_columns(df, declared))


def import_external(
    spark: SparkSession,
    base: str,
    location: str = "prepared",
    declared: Contract = SALES_IMPORT,
    name: str | None = None,
    drift: str = "raise",
) -> DataFrame:
    """The Parquet files under ``base`` as a table of the declared columns, types and order.

    The files are read with the schema they have and cast: Spark refuses to
    read a decimal of one scale as another, and would read a column the files
    lack as null. See ``scan`` for ``drift`` between files. With ``name``, the same select is kept
    in the catalog as a view over the files, in place of any earlier one or of an external
    table; a managed table of that name is an error. No data is copied.
    """
    path = join_path(base, location)
    if name is not None and drift == "unite":
        raise ValueError("a view goes by one footer: it cannot unite files of differing columns")
    files = scan(spark, path, drift=drift)
    imported = as_declared(files, declared)
    if name is None:
        return imported
    drop_external(spark, name)
    columns, quoted = ", ".join(_declared_columns(files, declared)), path.replace("`", "``")
    spark.sql(f"CREATE VIEW {name} AS SELECT {columns} FROM parquet.`{quoted}`")
    return spark.table(name)
