"""Streams with state per key: the last slot of each queue, and the ids seen before.

The state lies in the stream's checkpoint, in the version of each micro-batch, so a replayed batch starts from the state
it had. Results go to Spark's file sink, which takes every batch once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from claimflow.operators.slots import _advance, business_base, from_micros, micros

#: The state store that keeps state on disk; processors with state of their own need it.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Slots(StatefulProcessor):
    """Slots of a queue's rows, in order within each micro-batch, after the last slot of the batches before."""

    def __init__(self, names: list[str], order: list[str]) -> None:
        self.names, self.order = names, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "slot bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(rows)
        batch.columns = self.names  # pandas rows lose names that are no identifiers
        batch = batch.sort_values(self.order)
        before = self.last.get()[0] if self.last.exists() else None
        last, slots = _advance(before, batch["_base"].tolist())
        self.last.update((last,))
        yield batch.assign(_slot=slots)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.last.update((int(initialState["_last"].iloc[0]),))

    def close(self) -> None:
        pass


class _FirstSeen(StatefulProcessor):
    """The first row of a key that no earlier batch and no earlier run has seen."""

    def __init__(self, names: list[str]) -> None:
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = next(rows).head(1)
        for _ in rows:
            pass
        if not self.seen.exists():
            self.seen.update((True,))
            first.columns = self.names
            yield first

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass


def _use_provider(spark: SparkSession) -> None:
    if "RocksDB" not in spark.conf.get(PROVIDER[0], ""):
        spark.conf.set(*PROVIDER)


def kept_slots(rows: DataFrame, queue: str, ts: str, order: list[str], name: str = "slot", carry: DataFrame | None = None) -> DataFrame:
    """A stream of rows with ``name``, their slot.

    Rows of a queue are taken in ``order`` within a micro-batch; between micro-batches the order of arrival is final. ``carry``
    (queue, last_slot) continues the queues of an earlier run. A queue's rows of one micro-batch are worked on together,
    so the source's limit per trigger bounds what a task holds.
    """
    _use_provider(rows.sparkSession)
    columns = rows.columns
    key = F.to_json(F.struct(F.col(queue).alias("q"))).alias("_queue")  # a text that tells NULL from every value
    based = rows.withColumn("_base", business_base(micros(F.col(ts)))).withColumn("_queue", key)
    schema = StructType([*based.schema.fields, StructField("_slot", LongType())])
    first = None
    if carry is not None:
        first = carry.select(F.to_json(F.struct(F.col("queue").alias("q"))).alias("_queue"), micros(F.col("last_slot")).alias("_last")).groupBy("_queue")
    out = based.groupBy("_queue").transformWithStateInPandas(_Slots(based.columns, order), schema, "append", "none", first)
    return out.select(*[c for c in columns if c != name], from_micros(F.col("_slot")).alias(name))


def first_seen(rows: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """A stream of the rows whose key comes for the first time, one per key; ``known`` (one column) lists keys of earlier runs.

    Rows with a NULL key are one key. Nothing is read of the batches before but the keys' state.
    """
    _use_provider(rows.sparkSession)
    first = None
    if known is not None:
        first = known.select(F.col(known.columns[0]).alias(key)).distinct().withColumn("_known", F.lit(True)).groupBy(key)
    return rows.groupBy(key).transformWithStateInPandas(_FirstSeen(rows.columns), rows.schema, "append", "none", first)


def write_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a stream to the end of its source into parquet files; a replayed batch adds nothing."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
