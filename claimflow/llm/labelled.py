"""Labelled documents for the classifiers: the held-out fold and a bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True for the fold that is never learned from; NULL ids have no label and are not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(order, doc_id, text, label) of at most ``bound`` labelled rows, chosen by a hash of the id.

    Labels decide, so that only the texts of the sample are moved; its ids are the one thing
    broadcast, ``bound`` of them at most. Rows without a label or of the held-out fold are left out.
    """
    rows = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).filter(
        F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("_id"))
    )
    order = F.md5(F.col("_id").cast("string"))
    chosen = rows.groupBy("_id").agg(F.max("label").alias("label")).withColumn("order", order).orderBy("order").limit(bound)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), texts.doc_id == chosen._id).select("order", "doc_id", "text", "label")
