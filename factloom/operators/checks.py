"""Check a frame against a contract: nulls, lengths and types.

A value is judged as the contract would hold it: when the frame's type is not
the declared one, the rules look at the value after a ``try_cast`` to it, so a
value that does not fit counts as a null (or as ``mistyped`` where null is
allowed). Parquet tables do not enforce NOT NULL, hence these rules.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.contract import Contract, Field
from factloom.functions.casts import cast_to
from factloom.functions.names import column, folded, require_columns, require_distinct

_BROKEN = "broken rule"


class ContractViolation(ValueError):
    """The schema differs from the contract."""


def _longer_than(text: Column, limit: int) -> Column:
    """Whether ``text`` needs more than ``limit`` UTF-16 units, the unit of nvarchar(n).

    Text is held as UTF-8, with one to three bytes for each unit, so its size
    answers most cases; only the others are encoded. A unit is two bytes.
    """
    size = F.octet_length(text)
    exact = F.octet_length(F.encode(text, "UTF-16BE")) > 2 * limit
    return F.coalesce((size > limit) & ((size > 3 * limit) | exact), F.lit(False))


def _field_rules(field: Field, present: T.StructField) -> dict[str, Column]:
    raw = column(present.name)
    value = cast_to(raw, present.dataType, field.type, "null")
    rules = {}
    if not field.nullable:
        rules[f"{field.name}_nulls"] = value.isNull()
    elif present.dataType != field.type:
        rules[f"{field.name}_mistyped"] = value.isNull() & raw.isNotNull()
    if field.max_length is not None:
        rules[f"{field.name}_too_long"] = _longer_than(value, field.max_length)
    return rules


def rules(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Rule name to a condition, never null, that is true where a row breaks the rule."""
    require_columns(df, contract.names)
    present = {folded(df, f.name): f for f in df.schema.fields}
    found: dict[str, Column] = {}
    for field in contract.fields:
        found |= _field_rules(field, present[folded(df, field.name)])
    return found


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """One row with, per rule, the number of rows that break it.

    One scan: a partial aggregate per task, then one small row per task to the
    final one. Rules that the caller does not select are not computed.
    """
    return df.agg(*[F.count_if(broken).alias(name) for name, broken in rules(df, contract).items()])


def _broken_names(found: dict[str, Column]) -> Column:
    """The names of the rules that a row breaks, with commas; empty for a good row."""
    return F.concat_ws(",", *[F.when(broken, F.lit(name)) for name, broken in found.items()])


def split(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """The rows that keep every rule, and the others with a ``violations`` array.

    Together they are all rows of ``df``.
    """
    found = rules(df, contract)
    broken = reduce(or_, found.values(), F.lit(False))
    rejected = df.where(broken)
    labels = F.split(_broken_names(rules(rejected, contract)), ",")
    return df.where(~broken), rejected.withColumn("violations", labels)


def judged(df: DataFrame, contract: Contract, name: str) -> DataFrame:
    """``df`` with a column ``name``: the rules a row breaks, with commas, or an empty text."""
    require_distinct(df, [*df.columns, name])
    return df.select("*", _broken_names(rules(df, contract)).alias(name))


def check_rejects(rejects: DataFrame, contract: Contract, name: str = "violations") -> DataFrame:
    """What ``check`` would count over all judged rows, from the rejected ones alone.

    A row that breaks a rule is among the rejects, with all the rules it breaks in ``name``, so
    the counts cost no second scan of the others and nothing in the pass that wrote both.
    """
    listed = F.split(F.col(name), ",")
    return rejects.agg(*[F.count_if(F.array_contains(listed, rule)).alias(rule) for rule in rules(rejects, contract)])


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` whose job stops at the first row that breaks a rule, naming all the rules it breaks.

    Parquet tables take nulls in columns declared NOT NULL, so this is how a
    write keeps to the contract. It is a filter that raises, run in the same
    pass as the write, and no column selection can leave it out.
    """
    found = rules(df, contract)
    if not found:
        return df
    require_distinct(df, [*df.columns, _BROKEN])
    # The partition id, of no effect here, keeps the optimizer from moving the filter below
    # the casts, which would then be computed twice in one large method.
    names = F.concat_ws("", _broken_names(found), F.when(F.spark_partition_id() < 0, F.lit("")))
    stop = F.raise_error(F.concat(F.lit("a row breaks the contract: "), column(_BROKEN)))
    passes = F.when(column(_BROKEN) != "", stop.cast("boolean")).otherwise(True)
    return df.select("*", names.alias(_BROKEN)).where(passes).select(*[column(c) for c in df.columns])


def type_differences(df: DataFrame, contract: Contract, extras: bool = False) -> list[str]:
    """How names, order and types differ from the contract; metadata only.

    With ``extras``, columns outside the contract may lie anywhere between its own.
    """
    differences = []
    names = [c for c in df.columns if not extras or c in contract.names]
    if names != contract.names:
        differences.append(f"columns are {names}, declared {contract.names}")
    present = {f.name: f.dataType for f in df.schema.fields}
    for field in contract.fields:
        if field.name in present and present[field.name] != field.type:
            differences.append(
                f"{field.name} is {present[field.name].simpleString()}, "
                f"declared {field.type.simpleString()}"
            )
    return differences


def require_types(df: DataFrame, contract: Contract, extras: bool = False) -> None:
    differences = type_differences(df, contract, extras)
    if differences:
        raise ContractViolation("; ".join(differences))
