"""Whole runs over the state by bucket, merged layers, kept summaries and the seeds."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from claimflow.binding import sql as s
from claimflow.binding import warehouse as w
from claimflow.binding.catalog import query
from claimflow.binding.q_transitions import _GONE as _EXITS
from claimflow.binding.q_transitions import _KEPT, AT, BEFORE, FLOOR, NOW, _shown, _snapshot
from claimflow.operators import normalise as n
from claimflow.operators import relational as r
from claimflow.operators import summaries as m
from claimflow.operators import transitions as t
from claimflow.plans import jobs
from claimflow.session import fresh_path
from claimflow.sources import dictionaries as dic
from claimflow.sources.bucketed import save_bucketed
from claimflow.sources.records import read_detail_records, read_portal_records
from claimflow.sources.tables import StateTables, load


def _records(spark, sf, status):
    """What the portal shows: all orders but those of a status."""
    return w._as_records(w.cases(spark, sf).filter(F.col("o_orderstatus") != status))


@lru_cache(maxsize=2)
def _stored(application, spark, sf):
    """A store after two capture runs: all but open orders, then all but finished ones."""
    store = StateTables(spark, fresh_path(spark, "runs"), buckets=8)
    store.seed()
    first = jobs.capture(store, _records(spark, sf, "O"), BEFORE)
    second = jobs.capture(store, _records(spark, sf, "F"), NOW)
    return store, (first.metrics, second.metrics)


def stored(spark, sf):
    return _stored(spark.sparkContext.applicationId, spark, sf)


@query("run_capture_process", f"SELECT {_KEPT['process']} FROM load_process_rows")
def run_capture_process(spark, sf):
    return stored(spark, sf)[0].load("process")["process"].drop("loaded_at", "active")


#: A finished order is gone if its user shows others in the second run.
_GONE = "std.o_orderstatus = 'F' AND std.user_id IN (SELECT user_id FROM std WHERE o_orderstatus <> 'F')"


@query("run_capture_queue", f"""
    SELECT id AS process, CASE WHEN {_GONE} THEN 2 ELSE 1 END AS status, CASE WHEN {_GONE} THEN '{t.GONE_MESSAGE}' END AS message, 0 AS attempts FROM std""")
def run_capture_queue(spark, sf):
    return stored(spark, sf)[0].load("queue")["queue"].select("process", "status", "message", "attempts")


@query("run_capture_history", f"""
    SELECT id AS process, user_id, CASE WHEN o_orderstatus = 'O' THEN {AT} ELSE TIMESTAMP '{BEFORE}' END AS entered_at,
           CASE WHEN {_GONE} THEN {AT} END AS left_at, CASE WHEN {_GONE} THEN 0 ELSE 1 END AS is_current FROM std""")
def run_capture_history(spark, sf):
    return stored(spark, sf)[0].load("user_history")["user_history"]


@query("run_capture_event", f"""
    SELECT id AS process, event_id AS event, coalesce({s.text_or_null('text', 200)}, '') AS text, happened_at FROM std_event""")
def run_capture_event(spark, sf):
    return stored(spark, sf)[0].load("event")["event"].drop("loaded_at")


@query("run_capture_contact", "SELECT process, kind, type, area, value, 1 AS principal FROM load_contact_rows")
def run_capture_contact(spark, sf):
    state = stored(spark, sf)[0].load("contact", "party")
    party = state["party"].select("process", F.col("id").alias("party"), F.col("type").alias("kind"))
    return state["contact"].join(party, ["process", "party"]).select("process", "kind", "type", "area", "value", "principal")


@query("run_capture_raw", f"""
    SELECT id, claim, CASE WHEN o_orderstatus = 'O' THEN {AT} ELSE TIMESTAMP '{BEFORE}' END AS captured_at, 1 AS captures FROM std""")
def run_capture_raw(spark, sf):
    """Latest capture of each record, and how often it is in the history."""
    state = stored(spark, sf)[0].load("raw_latest", "raw_history")
    often = state["raw_history"].groupBy("id").agg(F.count("*").cast("int").alias("captures"))
    return state["raw_latest"].select("id", "claim", "captured_at").join(often, "id")


@query("run_metrics", """
    SELECT 1 AS run, count(*) FILTER (WHERE o_orderstatus <> 'O') AS read, count(*) FILTER (WHERE o_orderstatus <> 'O') AS new, 0::BIGINT AS known FROM std
    UNION ALL SELECT 2, count(*) FILTER (WHERE o_orderstatus <> 'F'), count(*) FILTER (WHERE o_orderstatus = 'O'), count(*) FILTER (WHERE o_orderstatus = 'P') FROM std""")
def run_metrics(spark, sf):
    """Counted while the batches were written."""
    first, second = stored(spark, sf)[1]
    return first.select(F.lit(1).alias("run"), "*").union(second.select(F.lit(2).alias("run"), "*"))


@query("run_summary", f"""
    SELECT id AS process, user_id, CASE WHEN {_GONE} THEN {AT} END AS left_at,
           CASE WHEN cycle > 0 OR id IN (SELECT id FROM std_event) THEN CASE WHEN o_orderstatus = 'O' THEN {AT} ELSE TIMESTAMP '{BEFORE}' END END AS changed_at
    FROM std""")
def run_summary(spark, sf):
    return stored(spark, sf)[0].load("summary")["summary"].drop("first_event")


@lru_cache(maxsize=2)
def _worked(application, spark, sf):
    """A store after a capture, an enrichment, a dispatch with its outcomes booked, and an audit."""
    store = StateTables(spark, fresh_path(spark, "worked"), buckets=8)
    store.seed()
    jobs.capture(store, _records(spark, sf, "O"), BEFORE)
    enriched = jobs.enrich(store, _records(spark, sf, "F"), NOW)
    jobs.dispatch(store, NOW, "r")
    key = F.col("o_orderkey")
    code = F.when(key % 3 == 0, 201).when(key % 3 == 1, 409)
    body = F.when(key % 3 == 0, F.concat(F.lit('{"id":'), key, F.lit(',"message":"ok"}'))).when(key % 3 == 1, F.lit('{"message":"twice"}'))
    responses = load(spark, sf, "orders", ["o_orderkey"]).select(
        key.alias("process"), code.alias("status_code"), body.alias("body"), F.when(key % 3 == 2, "timeout").alias("error"))
    jobs.book(store, "r", responses, NOW)
    jobs.audit(store, _snapshot(spark, sf), NOW)
    return store, enriched.metrics


def worked(spark, sf):
    return _worked(spark.sparkContext.applicationId, spark, sf)


@query("run_enrich_metrics", """
    SELECT count(*) AS read, count(*) FILTER (WHERE o_orderstatus = 'O') AS new, count(*) FILTER (WHERE o_orderstatus = 'P') AS known
    FROM std WHERE o_orderstatus <> 'F'""")
def run_enrich_metrics(spark, sf):
    return worked(spark, sf)[1]


@query("run_enrich_vehicle", f"""
    SELECT v.process, CASE WHEN s.o_orderstatus = 'P' THEN left(s.plate, 10) ELSE v.plate END AS plate, v.chassis,
           CASE WHEN s.o_orderstatus = 'P' THEN left(s.brand, 50) ELSE v.brand END AS brand,
           CASE WHEN s.o_orderstatus = 'P' THEN left(s.model, 100) ELSE v.model END AS model, v.submodel, v.year, CAST(v.value AS DOUBLE) AS value, v.encumbered
    FROM load_vehicle_rows v JOIN std s ON s.id = v.process""")
def run_enrich_vehicle(spark, sf):
    return worked(spark, sf)[0].load("vehicle")["vehicle"].withColumn("value", F.col("value").cast("double")).drop("id", "loaded_at")


_CLOSING = f"""
    closing AS (
        SELECT p.id, CASE WHEN p.o_orderstatus = 'O' THEN 22 WHEN o_orderpriority = '1-URGENT' THEN 22 WHEN o_orderpriority = '2-HIGH' THEN 98 END AS found
        FROM load_process_rows p JOIN orders ON o_orderkey = p.id
        WHERE o_orderpriority <> '4-NOT SPECIFIED' AND portal_status NOT IN (22, 98) AND date_diff('day', opened, {AT}) > 15)"""


@query("run_book_queue", f"""
    WITH {_CLOSING.strip()}
    SELECT s.id AS process, CASE s.id % 3 WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 3 END AS status, 1 AS attempts, {AT} AS last_attempt,
           CASE WHEN found IS NULL THEN 1 ELSE 0 END AS active
    FROM std s LEFT JOIN closing c ON c.id = s.id""")
def run_book_queue(spark, sf):
    return worked(spark, sf)[0].load("queue")["queue"].select("process", "status", "attempts", "last_attempt", "active")


@query("run_book_sla", f"""
    SELECT id AS process, CASE WHEN id % 3 = 0 THEN {AT} END AS sent,
           CASE WHEN id % 3 = 0 THEN CAST(date_diff('minute', CASE WHEN o_orderstatus = 'O' THEN {AT} ELSE TIMESTAMP '{BEFORE}' END, {AT}) AS INTEGER) END AS queue_minutes
    FROM std""")
def run_book_sla(spark, sf):
    return worked(spark, sf)[0].load("sla")["sla"].select("process", "sent", "queue_minutes")


@query("run_book_logs", """
    SELECT 'api' AS log, id AS process, CASE id % 3 WHEN 0 THEN 201 WHEN 1 THEN 409 ELSE 500 END AS status_code FROM std
    UNION ALL SELECT 'notification', id, CASE id % 3 WHEN 0 THEN 201 ELSE 500 END FROM std WHERE id % 3 <> 1""")
def run_book_logs(spark, sf):
    logs = worked(spark, sf)[0].load("api_log", "notification_log")
    return logs["api_log"].select(F.lit("api").alias("log"), "process", "status_code").union(
        logs["notification_log"].select(F.lit("notification"), "process", "status_code"))


@query("run_audit_process", f"""
    WITH {_CLOSING.strip()}
    SELECT p.id, coalesce(found, portal_status) AS portal_status,
           CASE found WHEN 22 THEN '{t.CLOSED_PHASE}' WHEN 98 THEN '{t.CANCELLED_PHASE}' ELSE phase END AS phase,
           CASE WHEN found IS NOT NULL THEN 0 ELSE alert END AS alert
    FROM load_process_rows p LEFT JOIN closing c ON c.id = p.id""")
def run_audit_process(spark, sf):
    return worked(spark, sf)[0].load("process")["process"].select("id", "portal_status", "phase", "alert")


def _summary(spark, sf):
    """The summary kept over three runs, of which each brings a part of the events, steps and users."""
    event, step, history = w.event(spark, sf), w.step(spark, sf), w.user_history(spark, sf)

    def part(i):
        return m.summarised(
            event.filter(F.col("event") % 3 == i), step.filter(F.col("task") % 3 == i), history.filter(F.col("user_id") % 3 == i), FLOOR)

    return m.merged(m.merged(part(0), part(1)), part(2))


@query("kept_summary", f"""
    WITH facts AS (
        SELECT process, CASE WHEN happened_at >= TIMESTAMP '{FLOOR}' THEN happened_at END AS first_event, loaded_at AS changed_at, NULL AS user_id, NULL AS left_at FROM event
        UNION ALL SELECT process, NULL, loaded_at, NULL, NULL FROM step
        UNION ALL SELECT process, NULL, NULL, user_id, left_at FROM user_history)
    SELECT process, min(first_event) AS first_event, max(changed_at) AS changed_at, CAST(max(user_id) AS INTEGER) AS user_id, max(left_at) AS left_at
    FROM facts GROUP BY 1""")
def kept_summary(spark, sf):
    return _summary(spark, sf)


@query("kept_last_change", "SELECT id, last_change FROM changes")
def kept_last_change(spark, sf):
    return m.last_change(w.process(spark, sf), _summary(spark, sf))


@query("kept_current_user", "SELECT process, user_id, left_at FROM owner")
def kept_current_user(spark, sf):
    return m.current_user(_summary(spark, sf))


@query("kept_opening_repair", f"""
    SELECT id, CASE WHEN (opened IS NULL OR opened < TIMESTAMP '{FLOOR}') AND first IS NOT NULL THEN first ELSE opened END AS opened
    FROM process LEFT JOIN (SELECT process, min(happened_at) AS first FROM event WHERE happened_at >= TIMESTAMP '{FLOOR}' GROUP BY 1) e
        ON e.process = id""")
def kept_opening_repair(spark, sf):
    return t.repair_from(w.process(spark, sf), _summary(spark, sf), FLOOR).select("id", "opened")


def _bucketed(spark, sf, *names):
    """Claims tables of the binding, bucketed by process."""
    path = fresh_path(spark, "bucketed")
    prefix = "t" + path.rsplit("-", 1)[-1]
    tables = w.claims(spark, sf)
    return {name: save_bucketed(tables[name], f"{prefix}_{name}", "id" if name == "process" else "process", 8, f"{path}/{name}") for name in names}


@query("bucketed_last_change", "SELECT id, last_change FROM changes")
def bucketed_last_change(spark, sf):
    return r.last_change(*_bucketed(spark, sf, "process", "event", "step").values())


@query("bucketed_close_history", f"""
    WITH {_EXITS.strip()}
    SELECT h.process, h.user_id, h.entered_at, CASE WHEN g.process IS NOT NULL THEN {AT} ELSE h.left_at END AS left_at,
           CASE WHEN g.process IS NOT NULL THEN 0 ELSE h.is_current END AS is_current
    FROM user_history h LEFT JOIN gone g ON g.process = h.process AND g.user_id = h.user_id""")
def bucketed_close_history(spark, sf):
    tables = _bucketed(spark, sf, "user_history", "queue")
    return t.close_disappeared(tables["user_history"], tables["queue"], _shown(spark, sf), NOW)["user_history"]


@query("state_buckets", """
    SELECT o_orderkey AS process, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 3 ELSE 2 END AS status,
           CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS attempts FROM orders""")
def state_buckets(spark, sf):
    """Two commits of a part of the buckets each, over a whole table."""
    store = StateTables(spark, fresh_path(spark, "buckets"), buckets=16)
    store.commit(0, {"queue": w.queue(spark, sf).withColumn("attempts", F.lit(0))})
    for half in (F.col("process") % 2 == 0, F.col("process") % 2 == 1):
        ids = store.load("queue")["queue"].filter((F.col("process") % 7 == 0) & half).select("process")
        buckets = store.touched(ids)
        queue = store.load("queue", buckets=buckets)["queue"]
        store.commit(store.version() + 1, {"queue": t.update_where(queue, ids, "process", F.lit(True), {"attempts": F.col("attempts") + 1})}, buckets=buckets)
    return store.load("queue")["queue"].select("process", "status", "attempts")


# --- layers ------------------------------------------------------------------


def _lines(spark, sf, name, status, *fields):
    """JSON lines of the orders of some states; a field is SQL for its text, or NULL for no key."""
    text = load(spark, sf, "orders").filter(status).selectExpr(f"concat('{{', concat_ws(',', {', '.join(fields)}), '}}') AS value")
    path = fresh_path(spark, name)
    text.write.text(path)
    return path


_ID = "concat('\"idProcesso\":', o_orderkey)"


@query("merge_layers", """
    SELECT o_orderkey AS id, 'Ana' AS nmAnalista,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN NULL WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' THEN 'F' || o_orderkey
                WHEN o_orderstatus <> 'O' AND o_orderpriority = '1-URGENT' THEN NULL ELSE 'L' || o_orderkey END AS nomeSegurado,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderstatus <> 'O' AND o_orderpriority <> '4-NOT SPECIFIED' THEN 'D' END AS marca,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'Listed' WHEN o_orderstatus <> 'O' THEN 'Detail' ELSE 'PROCESSO RECEPCIONADO' END AS phase
    FROM orders WHERE o_orderkey <> 0""")
def merge_layers(spark, sf):
    """Keys that a later layer has win with null, too; keys that it lacks leave the earlier layers' values."""
    one = lambda key, value: f"CASE WHEN {value} THEN '\"{key}\":null' END"
    listing = _lines(spark, sf, "listing", "true", _ID, "concat('\"nomeSegurado\":\"L', o_orderkey, '\"')", "'\"nmAnalista\":\"Ana\"'",
                     "CASE WHEN o_orderpriority = '5-LOW' THEN '\"dsStatus\":\"Listed\"' ELSE '\"dsStatus\":\"\"' END")
    by_id = _lines(spark, sf, "by-id", "o_orderstatus <> 'O'", _ID, one("nomeSegurado", "o_orderpriority = '1-URGENT'"),
                   "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN '\"marca\":\"D\"' END", "'\"status_processo\":\"Detail\"'", "'\"nmAnalista\":\"Other\"'")
    follow_up = _lines(spark, sf, "follow-up", "o_orderstatus = 'F'", _ID, one("marca", "o_orderpriority = '2-HIGH'"),
                       "CASE o_orderpriority WHEN '3-MEDIUM' THEN '\"nomeSegurado\":null' WHEN '5-LOW' THEN NULL ELSE concat('\"nomeSegurado\":\"F', o_orderkey, '\"') END")
    merged = n.merge_layers(read_portal_records(spark, listing), read_detail_records(spark, by_id), read_detail_records(spark, follow_up))
    return n.with_id(merged).select(F.col("idProcesso").alias("id"), "nmAnalista", "nomeSegurado", "marca", F.col("status_processo").alias("phase"))


# --- seeds -------------------------------------------------------------------


def _seed_rows() -> str:
    rows = [("file_type", code, sigla, label) for code, sigla, label in dic.FILE_TYPES]
    rows += [("queue_status", code, sigla, f"{label}|{attention}") for code, sigla, label, attention in dic.QUEUE_STATUSES]
    rows += [("party_type", code, None, label) for code, label in dic.PARTY_TYPES]
    rows += [("contact_type", code, None, label) for code, label in dic.CONTACT_TYPES]
    rows += [("area_code", code, uf, f"{state}|{region}") for code, uf, state, region in dic.AREA_CODES]
    text = lambda value: "NULL" if value is None else f"'{value}'"
    return ", ".join(f"('{name}', {code}, {text(short)}, {text(label)})" for name, code, short, label in rows)


@query("seeds", f"""
    WITH listed AS (SELECT * FROM (VALUES {_seed_rows()}) v(name, code, short, label)),
    used AS (SELECT 'file_type' AS name, file_type AS code, count(*) AS rows FROM process GROUP BY 2
        UNION ALL SELECT 'queue_status', status, count(*) FROM queue GROUP BY 2
        UNION ALL SELECT 'party_type', type, count(*) FROM party GROUP BY 2
        UNION ALL SELECT 'contact_type', type, count(*) FROM contact GROUP BY 2
        UNION ALL SELECT 'area_code', area, count(*) FROM contact GROUP BY 2)
    SELECT l.name, l.code, l.short, l.label, coalesce(u.rows, 0)::BIGINT AS rows FROM listed l LEFT JOIN used u ON u.name = l.name AND u.code = l.code""")
def seeds(spark, sf):
    """Every seeded code after it was written and read, with the rows of the claims tables that use it."""
    store = StateTables(spark, fresh_path(spark, "seeds"))
    store.seed()
    tables, claims = store.load(*dic.dictionaries(spark)), w.claims(spark, sf)
    described = {
        "file_type": ("sigla", "label"), "queue_status": ("sigla", "concat(label, '|', attention)"), "party_type": ("NULL", "label"),
        "contact_type": ("NULL", "label"), "area_code": ("uf", "concat(state, '|', region)")}
    used = {"file_type": ("process", "file_type"), "queue_status": ("queue", "status"), "party_type": ("party", "type"),
            "contact_type": ("contact", "type"), "area_code": ("contact", "area")}
    parts = []
    for name, (short, label) in described.items():
        table, column = used[name]
        counted = claims[table].groupBy(F.col(column).cast("int").alias("code")).agg(F.count("*").alias("rows"))
        listed = tables[name].selectExpr(f"'{name}' AS name", "code", f"CAST({short} AS STRING) AS short", f"{label} AS label")
        parts.append(listed.join(counted, "code", "left").select("name", "code", "short", "label", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole
