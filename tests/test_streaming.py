"""A stream gives what one batch gives."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from claimflow.operators.slots import assign_slots
from claimflow.plans import jobs
from claimflow.sources.tables import StateTables
from claimflow.streaming import ingest as i

SCHEMA = "id long, q string, t timestamp_ntz, v string"


def write(spark, path, parts):
    for number, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(path / f"p={number}"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(path / "*"))


def rows(count):
    rng = random.Random(9)
    made = [(n, rng.choice("abc"), datetime(2024, 1, 5) + timedelta(minutes=rng.randrange(9000)), f"v{n}") for n in range(count)]
    return sorted(made, key=lambda row: (row[2], row[0]))


def test_slots(spark, tmp_path):
    data = rows(300)
    stream = write(spark, tmp_path / "in", [data[:100], data[100:180], data[180:]])
    i.run_to_end(i.slot_stream(stream, "q", "t", ["t", "id"], str(tmp_path / "out"), str(tmp_path / "progress")))
    got = {row.id: row.slot for row in spark.read.parquet(str(tmp_path / "out" / "slots")).collect()}
    whole = assign_slots(spark.createDataFrame(data, SCHEMA), F.col("q"), "t", ["t", "id"])
    assert got == {row.id: row.slot for row in whole.collect()}


def test_latest(spark, tmp_path):
    data = rows(200)
    stream = write(spark, tmp_path / "in", [data[:50], data[50:]])
    latest = i.latest_per_key(stream, "q", "v", "t")
    i.run_to_end(i.write_latest(latest, str(tmp_path / "out"), str(tmp_path / "progress")))
    got = {row.q: row.v for row in i.read_latest(spark, str(tmp_path / "out"), "q", "v", "t").collect()}
    assert got == {q: [row for row in data if row[1] == q][-1][3] for q in "abc"}


def test_ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for number in range(2):
        text = "\n".join(json.dumps({"idProcesso": n, "noSinistro": str(n), "idUsuario": 1}) for n in range(1 + number, 4 + number))
        (landing / f"{number}.json").write_text(text)
    store = StateTables(spark, str(tmp_path / "state"), buckets=4)
    store.seed()

    def run(progress):
        i.run_to_end(i.ingest_stream(spark, str(landing), store, str(tmp_path / progress), lambda: "2026-03-10 12:00:00", files_per_batch=1))

    run("progress")
    assert sorted(row.id for row in store.load("process")["process"].collect()) == [1, 2, 3, 4]
    assert store.version() == 2
    run("lost-progress")  # everything is read again, and known records are only synchronised
    assert sorted(row.id for row in store.load("process")["process"].collect()) == [1, 2, 3, 4]
    assert store.load("queue")["queue"].count() == 4


def test_ingest_beside_other_runs(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = StateTables(spark, str(tmp_path / "state"), buckets=4)
    store.seed()

    def run(number, *ids):
        text = "\n".join(json.dumps({"idProcesso": n, "noSinistro": str(n), "idUsuario": 1}) for n in ids)
        (landing / f"{number}.json").write_text(text)
        i.run_to_end(i.ingest_stream(spark, str(landing), store, str(tmp_path / "progress"), lambda: "2026-03-10 12:00:00"))

    run(0, 1, 2)
    snapshot = spark.createDataFrame([(1, 22, None)], "process long, status int, status_text string")
    jobs.audit(store, snapshot, "2026-05-10 12:00:00")
    run(1, 3, 4)
    state = store.load("process", "queue", "user_history")
    assert sorted(row.id for row in state["process"].collect()) == [1, 2, 3, 4]
    assert sorted(row.process for row in state["queue"].collect()) == [1, 2, 3, 4]
    assert state["user_history"].select("process").distinct().count() == 4
    # the last batch again, as after a crash between its commit and its progress
    for name in ("1", ".1.crc"):
        (tmp_path / "progress" / "commits" / name).unlink(missing_ok=True)
    before = store.version()
    run(2, 5)
    assert sorted(row.id for row in store.load("process")["process"].collect()) == [1, 2, 3, 4, 5]
    assert store.version() == before + 1


def test_landed_records_are_compressed(spark):
    """The records of the binding are landed as packed files and read back whole."""
    from claimflow.binding.q_stateful import _landed
    from claimflow.sources.records import read_portal_records

    read = read_portal_records(spark, _landed(spark, "/root/testdata/sf0.001", "packed"))
    assert all(file.endswith(".json.gz") for file in read.inputFiles())
    assert read.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
