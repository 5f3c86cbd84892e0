"""Type a frame's columns against a contract."""

from __future__ import annotations

from pyspark.sql import DataFrame

from factloom.contract import Contract
from factloom.functions.casts import cast_to, require_mode
from factloom.functions.names import column, folded, require_columns


def cast_columns(df: DataFrame, contract: Contract, on_error: str = "null") -> DataFrame:
    """Replace each contract column, in its place, by its cast; leave all others alone.

    All casts are in one projection. Names match as the session compares them,
    and the result carries the contract's spelling.
    """
    require_mode(df.sparkSession, on_error)
    require_columns(df, contract.names)
    declared = {folded(df, f.name): f for f in contract.fields}
    columns = []
    for present in df.schema.fields:
        field = declared.get(folded(df, present.name))
        if field is None:
            columns.append(column(present.name))
        else:
            typed = cast_to(column(present.name), present.dataType, field.type, on_error)
            columns.append(typed.alias(field.name))
    return df.select(*columns)
