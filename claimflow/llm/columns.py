"""Names for helper columns beside a caller's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of df needs."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
