"""State as catalog tables bucketed by process, for reports and runs that join whole tables.

Rows of a process are in the same bucket file of every table, sorted, so joins and aggregates by process move none of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimflow.sources.tables import KEYED, StateTables


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write a table bucketed and sorted by ``key``, one file per bucket, and read it back. A table of this name is replaced."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def serve(store: StateTables, prefix: str, buckets: int, *names: str, path: str | None = None) -> dict[str, DataFrame]:
    """The store's tables, those kept by process as catalog tables ``prefix_name``; with ``path`` their files lie under it.

    They are as of now; a later call replaces them.
    """
    state = store.load(*names)
    for name, table in state.items():
        if name in KEYED:
            state[name] = save_bucketed(table, f"{prefix}_{name}", KEYED[name], buckets, f"{path}/{name}" if path else None)
    return state


def served(spark: SparkSession, prefix: str, *names: str) -> dict[str, DataFrame]:
    """Tables that ``serve`` wrote."""
    return {name: spark.table(f"{prefix}_{name}") for name in names or tuple(KEYED)}
