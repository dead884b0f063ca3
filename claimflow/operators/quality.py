"""Constraint reports: duplicates, orphans, missing and over-long values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count. Counted first, so a hot key travels once."""
    used = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def constraint_violations(df: DataFrame, key: str, rules: dict[str, int | None]) -> DataFrame:
    """(key, column, kind, length): NULL in a required column (limit None) or text beyond its limit."""
    found = []
    for name, limit in rules.items():
        col = F.col(name).cast("string")
        bad = col.isNull() if limit is None else F.length(col) > limit
        found.append(F.when(bad, F.struct(
            F.lit(name).alias("column"), F.lit("missing" if limit is None else "too long").alias("kind"),
            F.length(col).alias("length"))))
    return df.select(F.col(key).alias("key"), F.explode(F.filter(F.array(*found), lambda v: v.isNotNull())).alias("v")).select(
        "key", "v.column", "v.kind", "v.length"
    )


def anomaly(report: DataFrame, source: str, key: str, kind: str, detail, severity: str) -> DataFrame:
    """A report in the shape of the anomaly table."""
    return report.select(
        F.lit(source).alias("source"), F.col(key).cast("string").alias("key"), F.lit(kind).alias("kind"),
        detail.cast("string").alias("detail"), F.lit(severity).alias("severity"), F.lit(0).alias("resolved"),
    )


def anomalies(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
