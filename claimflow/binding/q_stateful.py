"""Slots, streams and whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.binding import warehouse as w
from claimflow.binding.catalog import query
from claimflow.operators.slots import assign_slots, business_base, from_micros, micros
from claimflow.session import fresh_path
from claimflow.sources.tables import append_history, load, read_history
from claimflow.streaming import ingest as i
from claimflow.streaming import keyed as k

BASE = """
    CASE WHEN isodow({ts}) >= 6 THEN date_trunc('day', {ts}) + (8 - isodow({ts})) * INTERVAL 1 DAY + INTERVAL '8 hours 15 minutes'
         WHEN CAST({ts} AS TIME) < TIME '08:15:00' THEN date_trunc('day', {ts}) + INTERVAL '8 hours 15 minutes'
         WHEN CAST({ts} AS TIME) >= TIME '18:00:00' THEN date_trunc('day', {ts})
              + CASE WHEN isodow({ts}) = 5 THEN INTERVAL 3 DAY ELSE INTERVAL 1 DAY END + INTERVAL '8 hours 15 minutes'
         ELSE {ts} END"""

NEXT = """
    CASE WHEN r.base > c.slot THEN r.base
         WHEN CAST(c.slot + INTERVAL 5 MINUTE AS TIME) >= TIME '18:00:00' AND CAST(c.slot + INTERVAL 5 MINUTE AS DATE) = CAST(r.base AS DATE) THEN r.base
         ELSE c.slot + INTERVAL 5 MINUTE END"""


def _chain(queue: str) -> str:
    return f"""
    WITH RECURSIVE ranked AS (
        SELECT event_id, {queue} AS q, {BASE.format(ts='ts')} AS base, row_number() OVER (PARTITION BY {queue} ORDER BY ts, event_id) AS n FROM events),
    chain AS (
        SELECT event_id, q, n, base AS slot FROM ranked WHERE n = 1
        UNION ALL
        SELECT r.event_id, r.q, r.n, {NEXT} FROM chain c JOIN ranked r ON r.q = c.q AND r.n = c.n + 1)
    SELECT event_id, slot FROM chain"""


def _events(spark, sf):
    return load(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])


@query("business_base", f"SELECT event_id, {BASE.format(ts='ts')} AS base FROM events")
def base(spark, sf):
    return _events(spark, sf).select("event_id", from_micros(business_base(micros(F.col("ts")))).alias("base"))


@query("slots", _chain("user_id"))
def slots(spark, sf):
    return assign_slots(_events(spark, sf), F.col("user_id"), "ts", ["ts", "event_id"]).select("event_id", "slot")


@query("slots_crowded", _chain("event_type"))
def slots_crowded(spark, sf):
    return assign_slots(_events(spark, sf), F.col("event_type"), "ts", ["ts", "event_id"], partitions=16).select("event_id", "slot")


@query("slots_one_queue", _chain("0"))
def slots_one_queue(spark, sf):
    return assign_slots(_events(spark, sf), None, "ts", ["ts", "event_id"], partitions=16).select("event_id", "slot")


@query("latest_per_key", "SELECT user_id, arg_max(props, (ts, event_id)) AS props FROM events GROUP BY 1")
def latest(spark, sf):
    history = load(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return i.latest_per_key(history, "user_id", "props", "at").drop("at")


def _stream(spark, sf):
    schema = load(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query("stream_latest", "SELECT user_id, arg_max(props, (ts, event_id)) AS props FROM events GROUP BY 1")
def stream_latest(spark, sf):
    out = fresh_path(spark, "latest")
    history = _stream(spark, sf).withColumn("at", F.struct("ts", "event_id"))
    i.run_to_end(i.write_latest(i.latest_per_key(history, "user_id", "props", "at"), out, f"{out}-progress"))
    return i.read_latest(spark, out, "user_id", "props", "at").select("user_id", "props")


@query("stream_slots", _chain("user_id"))
def stream_slots(spark, sf):
    out = fresh_path(spark, "slots")
    rows = _stream(spark, sf).select("event_id", "ts", "user_id")
    i.run_to_end(i.slot_stream(rows, "user_id", "ts", ["ts", "event_id"], out, f"{out}-progress"))
    return spark.read.parquet(f"{out}/slots").select("event_id", "slot")


@query("dedupe_known", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)")
def dedupe_known(spark, sf):
    lines = load(spark, sf, "lineitem", ["l_partkey", "l_quantity"])
    return i.dedupe_known(lines.select("l_partkey"), lines.filter("l_quantity > 48").select("l_partkey"), "l_partkey")


def _in_parts(spark, sf, *parts):
    """The events as a stream of one micro-batch per part."""
    path = fresh_path(spark, "parts")
    events = load(spark, sf, "events")
    for number, part in enumerate(parts):
        events.filter(part).coalesce(1).write.parquet(f"{path}/part={number}")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


@query("stream_kept_slots", _chain("user_id"))
def stream_kept_slots(spark, sf):
    """Two micro-batches, one after the other in time; the last slots are kept as state."""
    out, cut = fresh_path(spark, "kept-slots"), F.expr("timestamp_ntz'2024-01-16 00:00:00'")
    rows = _in_parts(spark, sf, F.col("ts") < cut, F.col("ts") >= cut).select("event_id", "ts", "user_id")
    i.run_to_end(k.write_once(k.kept_slots(rows, "user_id", "ts", ["ts", "event_id"]), out, f"{out}-progress"))
    return spark.read.parquet(out).select("event_id", "slot")


@query("stream_first_seen", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error')")
def stream_first_seen(spark, sf):
    """Ids of three micro-batches that no earlier run has stored, each once."""
    out = fresh_path(spark, "first-seen")
    known = load(spark, sf, "events").filter("event_type = 'error'").select("user_id")
    rows = _in_parts(spark, sf, *[F.col("event_id") % 3 == part for part in range(3)]).select("user_id", "ts")
    i.run_to_end(k.write_once(k.first_seen(rows, "user_id", known), out, f"{out}-progress"))
    return spark.read.parquet(out).select("user_id")


@query("daily_latest", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, arg_max(props, (ts, event_id)) AS props, max(ts) AS ts FROM events GROUP BY 1, 2""")
def daily_latest(spark, sf):
    # one event per user and time, as in a history of captures
    events = load(spark, sf, "events").groupBy("user_id", "ts").agg(F.max_by("props", "event_id").alias("props"))
    return i.daily_latest(events, "user_id", "props", "ts", "1 day").withColumn("day", F.col("day").cast("string"))


@query("snapshots_since", """
    SELECT user_id AS id, event_type AS claim, ts AS captured_at FROM events e
    WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND ts = (SELECT max(ts) FROM events l WHERE l.user_id = e.user_id)""")
def snapshots_since(spark, sf):
    path = fresh_path(spark, "snapshots")
    rows = load(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("claim"), F.col("props").alias("json"), F.col("ts").alias("captured_at"))
    append_history(rows, path)
    latest = rows.groupBy("id").agg(F.max("captured_at").alias("captured_at"))
    return i.snapshots_since(read_history(spark, path), latest, "2024-01-20 00:00:00").select("id", "claim", "captured_at")


def _landed(spark, sf, name):
    """The records of the binding as JSON files. As plain text they would take many times the room of all that is made of them."""
    path = fresh_path(spark, name)
    w.records(spark, sf).drop("_order").write.option("compression", "gzip").json(path)
    return path


@query("stream_ingest", "SELECT o_orderkey AS id, 'C' || o_orderkey AS claim, o.opened FROM orders LEFT JOIN std_opened o ON o.id = o_orderkey WHERE o_orderkey <> 0")
def stream_ingest(spark, sf):
    from claimflow.sources.tables import StateTables

    store = StateTables(spark, fresh_path(spark, "state"))
    store.seed()
    landing = _landed(spark, sf, "landing")
    i.run_to_end(i.ingest_stream(spark, landing, store, f"{landing}-progress", lambda: "2001-08-16 12:00:00"))
    return store.load("process")["process"].select("id", "claim", "opened")
