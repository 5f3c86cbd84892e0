"""Derived text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.names import column, require_columns, require_distinct


def derive_substring(df: DataFrame, name: str, source: str, start: int, length: int) -> DataFrame:
    """Keep all columns and append ``name``: ``length`` characters of ``source`` from ``start``.

    Positions count from 1 and in characters, not bytes; text that ends early
    gives what is left of it, and null gives null.
    """
    require_columns(df, [source])
    require_distinct(df, [*df.columns, name])
    return df.select("*", F.substring(column(source), start, length).alias(name))
