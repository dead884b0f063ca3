"""Joins to a table that is unique by key, for rows of which one key may hold a large part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.columns import fresh_name
from claimflow.llm.scratch import save

#: A key's rows are dealt to so many blocks.
BLOCKS = 64


def split_lookup(rows: DataFrame, table: DataFrame, key: str, spread: Column, blocks: int = BLOCKS) -> DataFrame:
    """Left join of rows to ``table``, unique by ``key``, that never brings a frequent key's rows together.

    Rows are dealt to blocks by ``spread``. The table first meets the different (key, block) pairs,
    at most ``blocks`` a key and combined before the shuffle, and rows then meet these. A NULL key finds nothing.
    """
    block = fresh_name(rows, "block")
    dealt = rows.withColumn(block, F.pmod(F.xxhash64(spread), F.lit(blocks)))
    met = dealt.select(key, block).distinct().join(table, key)
    return dealt.join(met, [key, block], "left").drop(block)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with ``idx``, the place from 0 within their group along ``order``, and ``n``, the group's size.

    Rows are sorted by ranges of (group, order), so a large group is in many tasks; its part of each range is
    counted, and these counts, one per group and range, summed up. ``order`` must tell rows apart. No group is NULL.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = save(ranged.withColumn("at", F.monotonically_increasing_id()), "ranged").withColumn("range", F.shiftright("at", 33))
    counted = ranged.groupBy(group, "range").agg(F.min("at").alias("first"), F.count("*").alias("many"))
    whole = Window.partitionBy(group)
    earlier = F.sum("many").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counted.select(group, "range", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"), F.sum("many").over(whole).alias("n"))
    return ranged.join(shifts, [group, "range"]).select(*rows.columns, (F.col("at") + F.col("shift")).alias("idx"), "n")
