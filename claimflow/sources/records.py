"""Landed portal records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.schemas import RECORD


def read_portal_records(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """JSON-lines records with their file and split; a batch read is ordered too."""
    reader = spark.readStream if streaming else spark.read
    records = reader.schema(RECORD).options(**options).json(path).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    return records if streaming else with_order(records)


def read_detail_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines records with ``_keys``, the keys each one really has: a key with null is told from no key.

    A line that is no JSON object has neither keys nor values.
    """
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    read = lines.select(
        F.from_json("value", RECORD).alias("record"), F.json_object_keys("value").alias("_keys"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    return with_order(read.select("record.*", "_keys", "_file", "_start"))


def with_order(records: DataFrame) -> DataFrame:
    """Reading order as ``_order``: file, offset of the split, position inside the split.

    Re-reading the same files repeats it. A stream adds it inside foreachBatch.
    """
    order = F.struct(
        F.col("_file").alias("file"), F.col("_start").alias("start"),
        F.monotonically_increasing_id().alias("position"),
    )
    return records.withColumn("_order", order).drop("_file", "_start")


def to_raw_json(*columns: str) -> Column:
    """The full record as JSON text with null keys kept."""
    body = F.struct(*[F.col(name) for name in columns])
    return F.to_json(body, {"ignoreNullFields": "false"})
