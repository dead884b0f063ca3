"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimflow.session import fresh_path


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors.

    The folder goes when the application ends, or earlier by ``drop``. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = fresh_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    _fs(spark, path)[0].deleteOnExit(_fs(spark, path)[1])
    saved = spark.read.schema(df.schema).parquet(path)
    saved._scratch = path
    return saved


def drop(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for table in tables:
        fs, path = _fs(table.sparkSession, table._scratch)
        fs.delete(path, True)


def _fs(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def release(spark) -> None:
    """Let Spark's cleaner delete the shuffle files of finished jobs now, not at the driver's next collection."""
    spark.sparkContext._jvm.System.gc()
