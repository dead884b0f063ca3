"""State per key: micro-batches, replays and earlier runs give what one batch gives."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from claimflow.operators.slots import assign_slots, last_slots
from claimflow.sources.tables import append_history, read_history
from claimflow.streaming import ingest as i
from claimflow.streaming import keyed as k

SCHEMA = "id long, q string, t timestamp_ntz, v string"


def made(count, start=0):
    rng = random.Random(count)
    rows = [(start + n, rng.choice(["a", "b", None]), datetime(2024, 1, 5) + timedelta(minutes=rng.randrange(9000)), f"v{n}") for n in range(count)]
    return sorted(rows, key=lambda row: (row[2], row[0]))


def land(spark, path, number, part):
    spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(path / f"p={number}"))


def source(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(path / "*"))


def forget(checkpoint, batch):
    """As after a crash between a batch's output and the note that it is done."""
    for name in (str(batch), f".{batch}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)


def slots_of(df):
    return {row.id: row.slot for row in df.collect()}


def test_slots_go_on_from_the_state(spark, tmp_path):
    data, checkpoint = made(120), tmp_path / "progress"
    parts = [data[:50], data[50:80], data[80:]]

    def run():
        i.run_to_end(k.write_once(k.kept_slots(source(spark, tmp_path / "in"), "q", "t", ["t", "id"]), str(tmp_path / "out"), str(checkpoint)))
        return slots_of(spark.read.parquet(str(tmp_path / "out")))

    whole = slots_of(assign_slots(spark.createDataFrame(data, SCHEMA), F.col("q"), "t", ["t", "id"]))
    land(spark, tmp_path / "in", 0, parts[0])
    land(spark, tmp_path / "in", 1, parts[1])
    run()
    forget(checkpoint, 1)  # the second batch comes again
    assert run() == {n: slot for n, slot in whole.items() if n in {row[0] for row in parts[0] + parts[1]}}
    land(spark, tmp_path / "in", 2, parts[2])
    assert run() == whole
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(data)


def test_slots_go_on_from_an_earlier_run(spark, tmp_path):
    data = made(60)
    before = assign_slots(spark.createDataFrame(data[:30], SCHEMA), F.col("q"), "t", ["t", "id"])
    land(spark, tmp_path / "in", 0, data[30:])
    out = k.kept_slots(source(spark, tmp_path / "in"), "q", "t", ["t", "id"], carry=last_slots(before, "q", ["t", "id"]))
    i.run_to_end(k.write_once(out, str(tmp_path / "out"), str(tmp_path / "progress")))
    whole = slots_of(assign_slots(spark.createDataFrame(data, SCHEMA), F.col("q"), "t", ["t", "id"]))
    assert slots_of(spark.read.parquet(str(tmp_path / "out"))) == {n: slot for n, slot in whole.items() if n in {row[0] for row in data[30:]}}


def test_an_id_is_taken_once(spark, tmp_path):
    checkpoint = tmp_path / "progress"
    rows = lambda ids: [(n, None, datetime(2024, 1, 5), "x") for n in ids]
    land(spark, tmp_path / "in", 0, rows([1, 2, 2, 3, 7]))
    land(spark, tmp_path / "in", 1, rows([3, 4, None, None, 8]))
    known = spark.createDataFrame([(7,), (8,), (8,)], "stored long")

    def run():
        stream = k.first_seen(source(spark, tmp_path / "in"), "id", known)
        i.run_to_end(k.write_once(stream, str(tmp_path / "out"), str(checkpoint)))
        return sorted((row.id for row in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)

    assert run() == [1, 2, 3, 4, None]
    forget(checkpoint, 1)
    assert run() == [1, 2, 3, 4, None]
    land(spark, tmp_path / "in", 2, rows([1, 4, 5, 7]))
    assert run() == [1, 2, 3, 4, 5, None]


def test_late_snapshots_are_taken_until_the_watermark(spark, tmp_path):
    day = lambda d, h=0: datetime(2024, 1, d, h)
    parts = [
        [(1, None, day(5, 9), "a"), (1, None, day(5, 11), "b"), (2, None, day(6, 1), "c")],
        [(1, None, day(5, 23), "late"), (2, None, day(8, 1), "d")],  # a day late: taken
        [(3, None, day(12), "e")],  # closes the 5th
        [(1, None, day(5, 23), "too late")],
        [(3, None, day(20), "f")],
    ]
    for number, part in enumerate(parts):
        land(spark, tmp_path / "in", number, part)
    stream = i.daily_latest(source(spark, tmp_path / "in"), "id", "v", "t", "2 days")
    i.run_to_end(i.write_days(stream, str(tmp_path / "out"), str(tmp_path / "progress")))
    got = sorted((str(row.day), row.id, row.v) for row in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("2024-01-05", 1, "late"), ("2024-01-06", 2, "c"), ("2024-01-08", 2, "d"), ("2024-01-12", 3, "e")]
    one = spark.read.parquet(str(tmp_path / "out")).filter("day = DATE'2024-01-05'")
    assert "(day" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_only_days_that_can_hold_a_snapshot_are_read(spark, tmp_path):
    rows = [(n, f"C{n}", "{}", datetime(2024, 1, d)) for d in range(1, 29) for n in range(5) if d < 20 or n == 3]
    rows += [(9, "late", "{}", datetime(2024, 1, 2, 5))]
    history = spark.createDataFrame(rows, "id long, claim string, json string, captured_at timestamp_ntz")
    append_history(history.filter("id <> 9"), str(tmp_path / "h"))
    append_history(history.filter("id = 9"), str(tmp_path / "h"))  # captured early, landed late
    history.groupBy("id").agg(F.max("captured_at").alias("captured_at")).write.parquet(str(tmp_path / "latest"))
    latest = spark.read.parquet(str(tmp_path / "latest"))
    found = i.snapshots_since(read_history(spark, str(tmp_path / "h")), latest, "2024-01-19 00:00:00")
    assert sorted((row.id, row.captured_at.day) for row in found.collect()) == [(0, 19), (1, 19), (2, 19), (3, 28), (4, 19)]
    assert "dynamicpruningexpression" in found._jdf.queryExecution().executedPlan().toString()
    all_ = i.snapshots_since(read_history(spark, str(tmp_path / "h")), latest, "2024-01-01 00:00:00")
    assert (9, 2) in {(row.id, row.captured_at.day) for row in all_.collect()}
