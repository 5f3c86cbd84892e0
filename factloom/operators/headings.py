"""Clean column headings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from factloom.functions.names import require_distinct


def strip_headings(df: DataFrame) -> DataFrame:
    """Remove ASCII white space, and only that, from every heading.

    One projection whatever the number of columns. Raises when two headings
    become the same name.
    """
    cleaned = [re.sub(r"\s", "", name, flags=re.ASCII) for name in df.columns]
    require_distinct(df, cleaned)
    return df.toDF(*cleaned)
