"""Sources, sinks and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.binding import warehouse as w
from claimflow.binding.catalog import query
from claimflow.binding.q_stateful import _landed
from claimflow.operators import normalise as n
from claimflow.operators import transitions as t
from claimflow.session import fresh_path
from claimflow.sources import dictionaries as dic
from claimflow.sources import tables as tab
from claimflow.sources.records import read_portal_records, to_raw_json

NOW = "2001-08-16 12:00:00"


@query("load_projection", "SELECT p_partkey, p_brand FROM part")
def load_projection(spark, sf):
    return tab.load(spark, sf, "part", ["p_partkey", "p_brand"])


@query("known_ids", "SELECT DISTINCT l_orderkey FROM lineitem")
def known_ids(spark, sf):
    return tab.known_ids(tab.load(spark, sf, "lineitem"), "l_orderkey")


@query("area_map", "SELECT n_nationkey AS code, n_name AS uf FROM nation WHERE n_regionkey <> 2")
def area_map(spark, sf):
    areas = tab.load(spark, sf, "nation").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("uf"), (F.col("n_regionkey") != 2).cast("int").alias("active"))
    return dic.load_area_map(areas)


@query("typed_params", """
    SELECT 'K' || p_partkey AS key, CAST(CASE WHEN p_size > 25 THEN p_size END AS BIGINT) AS number,
           CASE WHEN p_size <= 25 THEN p_name END AS text FROM part""")
def typed_params(spark, sf):
    return dic.typed_params(tab.load(spark, sf, "part").select(
        F.concat(F.lit("K"), "p_partkey").alias("key"), F.col("p_name").alias("text"),
        F.when(F.col("p_size") > 25, F.col("p_size")).alias("number")))


@query("param_number", "SELECT max(p_size) FILTER (WHERE p_name = 'red widget') AS red, CAST(NULL AS BIGINT) AS absent FROM part")
def param_number(spark, sf):
    params = tab.load(spark, sf, "part").groupBy(F.col("p_name").alias("key")).agg(F.max("p_size").cast("long").alias("number"))
    out = dic.param_number(params, {"red": "red widget", "absent": "no such part"})
    return out.withColumn("red", F.col("red").cast("int"))


@query("portal_records", "SELECT id, claim, phase, alert, portal_status, user_id FROM std")
def portal_records(spark, sf):
    """Landed as JSON, read back and standardised."""
    read = read_portal_records(spark, _landed(spark, sf, "records"))
    return n.standardise(read).select("id", "claim", "phase", "alert", "portal_status", "user_id")


@query("raw_json", """
    SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","segment":'
           || CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'null' ELSE '"' || c_mktsegment || ' é"' END || '}' AS json FROM customer""")
def raw_json(spark, sf):
    rows = tab.load(spark, sf, "customer").withColumn(
        "segment", F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.concat("c_mktsegment", F.lit(" é"))))
    return rows.select("c_custkey", to_raw_json("c_custkey", "c_name", "segment").alias("json"))


def _snapshots(spark, sf):
    """Events as raw snapshots of the process named by their user."""
    return tab.load(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("claim"), F.col("props").alias("json"), F.col("ts").alias("captured_at"),
        F.struct("ts", "event_id").alias("_order"))


def _latest(rows):
    from claimflow.operators.relational import last_per_key

    return last_per_key(rows, "id", "_order").drop("_order")


@query("raw_latest_upsert", """
    WITH one AS (SELECT user_id, event_type, props, ts, ts < TIMESTAMP '2024-01-16' AS old,
                        row_number() OVER (PARTITION BY user_id, ts < TIMESTAMP '2024-01-16' ORDER BY ts DESC, event_id DESC) AS n FROM events),
    st AS (SELECT * FROM one WHERE n = 1 AND old AND event_type <> 'error'), ba AS (SELECT * FROM one WHERE n = 1 AND NOT old)
    SELECT coalesce(st.user_id, ba.user_id) AS id, coalesce(st.event_type, ba.event_type) AS claim,
           coalesce(ba.props, st.props) AS json, coalesce(ba.ts, st.ts) AS captured_at
    FROM st FULL JOIN ba ON ba.user_id = st.user_id""")
def raw_latest_upsert(spark, sf):
    rows = _snapshots(spark, sf)
    cut = F.expr("timestamp_ntz'2024-01-16 00:00:00'")
    stored = _latest(rows.filter(F.col("captured_at") < cut)).filter("claim <> 'error'")
    batch = _latest(rows.filter(F.col("captured_at") >= cut))
    return t.upsert(stored, batch, ["id"], {"json": "overwrite", "captured_at": "overwrite"})


@query("raw_history_append", """
    SELECT user_id AS id, event_type AS claim, props AS json, ts AS captured_at FROM events
    UNION ALL SELECT user_id, event_type, props, ts FROM events WHERE event_type = 'click'""")
def raw_history_append(spark, sf):
    path = fresh_path(spark, "history")
    rows = _snapshots(spark, sf).drop("_order")
    tab.append_history(rows, path)
    tab.append_history(rows.filter("claim = 'click'"), path)
    return tab.read_history(spark, path).drop("capture_date")


@query("state_commit", """
    SELECT o_orderkey AS process, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 3 ELSE 2 END AS status FROM orders""")
def state_commit(spark, sf):
    store = tab.StateTables(spark, fresh_path(spark, "state"))
    queue = w.queue(spark, sf)
    store.commit(0, {"queue": queue.filter("status = 1")})
    store.commit(1, {"queue": store.load("queue")["queue"].unionByName(queue.filter("status <> 1"))})
    store.commit(1, {"queue": queue.filter("status = 2")})  # replay of a committed version: ignored
    return store.load("queue")["queue"].select("process", "status")


def _runs(spark, sf):
    """Every user is a run that opens with its first event and closes with its last."""
    status = F.when(F.col("event_type") == "click", "RODANDO").when(F.col("event_type") == "error", "ERRO").otherwise("SUCESSO")
    return tab.load(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("ts").alias("logged_at"), status.alias("status"),
        F.col("event_id").alias("read"), F.col("user_id").alias("new"), F.col("props").alias("message"))


@query("run_log", """
    SELECT run_id, started, CASE WHEN status <> 'RODANDO' THEN latest END AS ended,
           CASE WHEN status <> 'RODANDO' THEN date_sub('second', started, latest) END AS seconds, status, read, new, message
    FROM (SELECT CAST(user_id AS VARCHAR) AS run_id, min(ts) AS started, max(ts) AS latest,
                 CASE arg_max(event_type, ts) WHEN 'click' THEN 'RODANDO' WHEN 'error' THEN 'ERRO' ELSE 'SUCESSO' END AS status,
                 arg_max(event_id, ts) AS read, user_id AS new, arg_max(props, ts) AS message FROM events GROUP BY user_id)""")
def run_log(spark, sf):
    return tab.run_summary(_runs(spark, sf))


@query("run_close", f"""
    SELECT 'r1' AS run_id, TIMESTAMP '{NOW}' AS logged_at, 'SUCESSO' AS status, count(*) AS read,
           count(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS new, repeat('m', 4000) AS message FROM orders""")
def run_close(spark, sf):
    from claimflow.binding.q_relational import batch_metrics

    return tab.close_run(batch_metrics(spark, sf), "r1", NOW, "SUCESSO", "m" * 5000)


@query("api_log", f"""
    SELECT 'r1' AS run_id, doc_id AS process, 'platform' AS target, 'POST' AS action, CAST(n_chars AS INTEGER) AS status_code,
           left(text, 4000) AS payload, left(text || text, 4000) AS response, TIMESTAMP '{NOW}' AS logged_at FROM documents""")
def api_log(spark, sf):
    sends = tab.load(spark, sf, "documents").select(
        F.col("doc_id").alias("process"), F.col("n_chars").cast("int").alias("status_code"), F.col("text").alias("payload"),
        F.concat("text", "text").alias("response"))
    path = fresh_path(spark, "api-log")
    tab.append_log(tab.api_log_rows(sends, "r1", "platform", "POST", NOW), path)
    return spark.read.parquet(path)


@query("notification_log", f"""
    SELECT 'r1' AS run_id, doc_id AS process, 202 AS status_code, lang AS payload, left(text, 4000) AS message,
           TIMESTAMP '{NOW}' AS logged_at FROM documents""")
def notification_log(spark, sf):
    notes = tab.load(spark, sf, "documents").select(
        F.col("doc_id").alias("process"), F.lit(202).alias("status_code"), F.col("lang").alias("payload"), F.col("text").alias("message"))
    return tab.notification_log_rows(notes, "r1", NOW)
