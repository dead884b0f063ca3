"""Aggregates per process that runs keep and extend, instead of reading all events, steps and users again.

A summary row holds the first event on or after a floor, the latest load time of events and steps, the highest
user and the latest exit. All are minima and maxima, and no run takes an event, step or user away or dates one anew, so the
summary of what a run added, merged into the stored one, is the summary of everything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.functions.clock import stamp
from claimflow.operators import transitions as t

POLICIES = {"first_event": "least", "changed_at": "greatest", "user_id": "greatest", "left_at": "greatest"}


def summarised(event: DataFrame, step: DataFrame, history: DataFrame, floor) -> DataFrame:
    """One row per process that has an event, step or user among the rows given: process and the kept aggregates."""
    parts = (
        event.select("process", F.when(F.col("happened_at") >= stamp(floor), F.col("happened_at")).alias("first_event"), F.col("loaded_at").alias("changed_at")),
        step.select("process", F.col("loaded_at").alias("changed_at")),
        history.select("process", "user_id", "left_at"),
    )
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    return rows.groupBy("process").agg(
        F.min("first_event").alias("first_event"), F.max("changed_at").alias("changed_at"),
        F.max("user_id").cast("int").alias("user_id"), F.max("left_at").alias("left_at"))


def merged(summary: DataFrame, news: DataFrame) -> DataFrame:
    """The stored summary with the summary of added rows; ``news`` has one row per process, and any of the columns."""
    return t.upsert(summary, t._typed(news, "summary"), ["process"], POLICIES)


def last_change(process: DataFrame, summary: DataFrame) -> DataFrame:
    """Latest load time of a process, its events and its steps."""
    newest = summary.select(F.col("process").alias("id"), "changed_at")
    return process.select("id", "loaded_at").join(newest, "id", "left").select("id", F.greatest("loaded_at", "changed_at").alias("last_change"))


def current_user(summary: DataFrame) -> DataFrame:
    """Highest user id and latest exit of the processes that have a user."""
    return summary.filter("user_id IS NOT NULL").select("process", "user_id", "left_at")
