"""Column names as the session compares them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def folded(df: DataFrame, name: str) -> str:
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive").lower() == "true"
    return name if sensitive else name.lower()


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise once, naming every column that is missing."""
    present = {folded(df, c) for c in df.columns}
    missing = [n for n in dict.fromkeys(names) if folded(df, n) not in present]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")


def require_distinct(df: DataFrame, names: list[str]) -> None:
    """Raise when two of ``names`` would be one column to ``df``'s session."""
    seen = Counter(folded(df, n) for n in names)
    clashes = [n for n in names if seen[folded(df, n)] > 1]
    if clashes:
        raise ValueError(f"column names are not distinct: {clashes}")
