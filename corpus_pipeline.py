"""From raw documents to a training mix: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimflow.llm import decontaminate, jaccard_join, mixing, paragraphs, quality
from claimflow.llm.scratch import save


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It learns from the labels of the documents given."""
    return quality.reject_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs, 5, 80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in several documents stay in one of them."""
    return paragraphs.remove_repeated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document goes into the mix, and its words there."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram jaccard join", one_of_each),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
]

#: The classifier and the hashed bands are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
