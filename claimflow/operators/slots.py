"""Business-hours slot assignment: an ordered fold per queue, run in parallel.

Each row gets the slot after the previous one, so a queue is a chain. One step maps
the last slot L to the next: with b the row's base time, b for L < b; b again when
L + 5 min would pass closing time on the day of b; L + 5 min otherwise. As a function
of L a step is made of constants and shifts, and so is any run of steps. A chunk of
a queue can therefore be summarised without knowing where it starts, the summaries
composed, and every chunk replayed with its true start. No queue has to fit one task.

1. range-partition by queue and order, sort, checkpoint (fixes the chunks)
2. per chunk: the step function of the first queue and the last slot of the last one
3. per queue that crosses chunks: compose the summaries (at most one row per chunk)
4. per chunk: replay
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.session import checkpointed

# Opening and closing time, spacing, and days before an opening date is stale.
_MINUTE = 60 * 1_000_000
_DAY = 24 * 60 * _MINUTE
_OPEN = (8 * 60 + 15) * _MINUTE
_CLOSE = 18 * 60 * _MINUTE
STEP = 5 * _MINUTE
STALE_DAYS = 5

_EARLIEST = np.iinfo(np.int64).min
_LATEST = np.iinfo(np.int64).max
_ORIGIN = "timestamp_ntz'1970-01-01 00:00:00'"


def micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_ORIGIN), ts)


def from_micros(col: Column) -> Column:
    return F.timestamp_add("MICROSECOND", col, F.expr(_ORIGIN))


def fresh_or_now(opened: Column, now: Column, days: int = STALE_DAYS) -> Column:
    """``now`` for an opening date that is missing or older than ``days``."""
    limit = F.timestamp_add("DAY", F.lit(-days), now)
    return F.when(opened.isNull() | (opened < limit), now).otherwise(opened)


def business_base(at: Column) -> Column:
    """Microseconds of the first business time at or after ``at`` (also microseconds)."""
    clock = F.pmod(at, F.lit(_DAY))
    midnight = at - clock
    weekday = F.pmod((midnight / _DAY).cast("long") + 3, F.lit(7))  # 0 = Monday

    def opening(days: int) -> Column:
        return midnight + (days * _DAY + _OPEN)

    return (
        F.when(weekday == 5, opening(2))
        .when(weekday == 6, opening(1))
        .when(clock < _OPEN, opening(0))
        .when((clock >= _CLOSE) & (weekday == 4), opening(3))
        .when(clock >= _CLOSE, opening(1))
        .otherwise(at)
    )


def _window(base: int) -> tuple[int, int]:
    """Last slots from which + 5 min lands on the day of ``base`` at or after closing time."""
    midnight = base - base % _DAY
    return midnight + _CLOSE - STEP, midnight + _DAY - STEP


def _advance(last: int | None, bases: list[int]) -> tuple[int | None, list[int]]:
    slots = []
    for base in bases:
        if last is None or last < base:
            last = base
        else:
            low, high = _window(base)
            last = base if low <= last < high else last + STEP
        slots.append(last)
    return last, slots


class Transfer:
    """A run of steps as a function of the last slot before it.

    ``open`` holds the intervals of starting slots that no step has reset yet (they
    come out shifted by ``shift``); ``closed`` maps the others to entries of
    ``values``. An entry lasts until it is reset, at most one business day of steps,
    so the lists stay short however long the run is.
    """

    def __init__(self) -> None:
        self.shift = 0
        self.open: list[tuple[int, int]] = [(_EARLIEST, _LATEST)]
        self.closed: list[tuple[int, int]] = []  # (start, index into values)
        self.values = np.empty(0, dtype=np.int64)

    def step(self, base: int) -> None:
        low, high = _window(base)
        values = self.values
        if len(values):
            reset = (values < base) | ((values >= low) & (values < high))
            values = np.where(reset, base, values + STEP)
        kept, fresh = [], []
        for start, end in self.open:
            cuts = [(start, min(end, max(start, base - self.shift)))]
            rest = cuts[0][1]
            cuts.append((max(rest, low - self.shift), min(end, high - self.shift)))
            fresh += [cut for cut in cuts if cut[0] < cut[1]]
            kept += [
                piece for piece in ((rest, min(end, low - self.shift)), (max(rest, high - self.shift), end))
                if piece[0] < piece[1]
            ]
        if fresh:
            self.closed += [(start, len(values)) for start, _ in fresh]
            values = np.append(values, base)
        self.open, self.values = kept, values
        self.shift += STEP
        if len(values) > 1024:
            self._compact()

    def _compact(self) -> None:
        self.values, index = np.unique(self.values, return_inverse=True)
        edges = sorted([(start, int(index[i])) for start, i in self.closed] + [(start, -1) for start, _ in self.open])
        merged = [edge for n, edge in enumerate(edges) if n == 0 or edges[n - 1][1] != edge[1]]
        self.closed = [edge for edge in merged if edge[1] >= 0]

    def pieces(self) -> tuple[list[int], list[bool], list[int], int]:
        """Starts of the pieces, whether each is constant, its constant, and the shift."""
        self._compact()
        edges = sorted([(s, True, int(self.values[i])) for s, i in self.closed] + [(s, False, 0) for s, _ in self.open])
        starts, fixed, constants = (list(part) for part in zip(*edges))
        return starts, fixed, constants, self.shift


def apply_pieces(last: int | None, starts: list[int], fixed: list[bool], constants: list[int], shift: int) -> int:
    place = 0 if last is None else bisect_right(starts, last) - 1
    return int(constants[place]) if fixed[place] else last + shift


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int | None, list[int]]]:
    """(queue, carried slot, bases) of each run of rows of one queue."""
    keys = batch.column("_queue").to_numpy(zero_copy_only=False)
    bases, carry = batch.column("_base").to_numpy(), batch.column("_carry")
    if len(keys):
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(edges[:-1], edges[1:]):
            yield keys[start], carry[start].as_py(), bases[start:end].tolist()


_SUMMARY = (
    "chunk int, queue string, starts array<bigint>, fixed array<boolean>, constants array<bigint>, "
    "shift bigint, tail bigint"
)
_SUMMARY_ARROW = pa.schema([
    ("chunk", pa.int32()), ("queue", pa.string()), ("starts", pa.list_(pa.int64())), ("fixed", pa.list_(pa.bool_())),
    ("constants", pa.list_(pa.int64())), ("shift", pa.int64()), ("tail", pa.int64()),
])
_CARRY = "chunk int, queue string, start bigint"


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = queue = chunk = last = None
    transfer = Transfer()
    for batch in batches:
        runs = list(_runs(batch))
        for number, (key, carry, bases) in enumerate(runs):
            if first is None:
                first, chunk = key, batch.column("_chunk")[0].as_py()
            if key == first:
                for base in bases:
                    transfer.step(base)
            else:
                if key != queue:
                    last = carry
                if number == len(runs) - 1:  # only the queue still open at the end of a batch can cross the chunk
                    last, _ = _advance(last, bases)
            queue = key
    if first is None:
        return
    starts, fixed, constants, shift = transfer.pieces()
    rows = [dict(chunk=chunk, queue=first, starts=starts, fixed=fixed, constants=constants, shift=shift, tail=None)]
    if queue != first:
        rows.append(dict(chunk=chunk, queue=queue, tail=last))
    yield pa.RecordBatch.from_pylist(rows, schema=_SUMMARY_ARROW)


def _compose(group: pa.Table) -> pa.Table:
    """True start of every chunk that continues the queue."""
    rows = sorted(group.to_pylist(), key=lambda row: row["chunk"])
    last = rows[0]["carry"]
    out = []
    for row in rows:
        if row["starts"] is None:
            last = row["tail"]
            continue
        if last is not None:
            out.append(dict(chunk=row["chunk"], queue=row["queue"], start=last))
        last = apply_pieces(last, row["starts"], row["fixed"], row["constants"], row["shift"])
    schema = pa.schema([("chunk", pa.int32()), ("queue", pa.string()), ("start", pa.int64())])
    return pa.Table.from_pylist(out, schema=schema)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    queue = last = None
    for batch in batches:
        slots: list[int] = []
        for key, carry, bases in _runs(batch):
            if key != queue:
                queue, last = key, carry
            last, some = _advance(last, bases)
            slots += some
        kept = [name for name in batch.schema.names if name not in ("_queue", "_base", "_carry", "_chunk")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(name) for name in kept] + [pa.array(slots, pa.int64())], names=[*kept, "_slot"]
        )


def assign_slots(
    df: DataFrame, queue: Column | None, ts: str, order: list[str], name: str = "slot",
    carry: DataFrame | None = None, partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: the slot of every row, in ``order`` within its queue.

    ``order`` must be total inside a queue. ``queue`` None means one queue for all.
    ``carry`` (queue, last_slot) continues queues from an earlier run.
    """
    columns = df.columns
    # a text key that tells NULL from every value
    key = F.to_json(F.struct((F.lit(0) if queue is None else queue).alias("q")))
    rows = df.withColumn("_queue", key).withColumn("_base", business_base(micros(F.col(ts))))
    if carry is None:
        rows = rows.withColumn("_carry", F.lit(None).cast("long"))
    else:
        starts = carry.select(
            F.to_json(F.struct(F.col("queue").alias("q"))).alias("_queue"), micros(F.col("last_slot")).alias("_carry")
        )
        rows = rows.join(starts, "_queue", "left")
    by = ["_queue", *order]
    spread = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    chunks = spread.sortWithinPartitions(*by).withColumn("_chunk", F.spark_partition_id())
    chunks = checkpointed(chunks)

    summaries = chunks.select("_chunk", "_queue", "_base", "_carry").mapInArrow(_summarise, _SUMMARY)
    if carry is not None:
        summaries = summaries.join(starts.withColumnRenamed("_queue", "queue"), "queue", "left")
    else:
        summaries = summaries.withColumn("_carry", F.lit(None).cast("long"))
    starts_of_chunks = summaries.withColumnRenamed("_carry", "carry").groupBy("queue").applyInArrow(_compose, _CARRY)
    # at most one row per chunk
    known = F.broadcast(starts_of_chunks.select(
        F.col("chunk").alias("_chunk"), F.col("queue").alias("_queue"), F.col("start").alias("_start")))
    ready = chunks.join(known, ["_chunk", "_queue"], "left").withColumn(
        "_carry", F.coalesce("_start", "_carry")
    ).select(*columns, "_queue", "_base", "_carry", "_chunk")
    schema = ready.drop("_queue", "_base", "_carry", "_chunk").withColumn("_slot", F.lit(0).cast("long")).schema
    replayed = ready.mapInArrow(_replay, schema)
    return replayed.withColumn(name, from_micros(F.col("_slot"))).select(*[c for c in columns if c != name], name)


def last_slots(assigned: DataFrame, queue: str, order: list[str], name: str = "slot") -> DataFrame:
    """(queue, last_slot) to hand to the next run."""
    return assigned.groupBy(F.col(queue).alias("queue")).agg(
        F.max_by(F.col(name), F.struct(*order)).alias("last_slot")
    )
