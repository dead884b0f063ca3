"""Warehouse transitions. Stored are the orders that are not open; the batch shows those not finished."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from claimflow.binding import sql as s
from claimflow.binding import warehouse as w
from claimflow.binding.catalog import query
from claimflow.binding.q_cleanse import STANDARDISED, flat
from claimflow.operators import normalise as n
from claimflow.operators import relational as r
from claimflow.operators import transitions as t
from claimflow.session import saved
from claimflow.sources.tables import load

NOW, BEFORE = "2001-08-16 12:00:00", "2001-08-15 12:00:00"
FLOOR = "1998-01-01 00:00:00"
AT = f"TIMESTAMP '{NOW}'"
# the stored side and the batch side, as SQL conditions
STORED = "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O'"
_KEPT = {
    "process": "id, claim, file_type, portal_status, uf, company, opened, occurred, phase, alert",
    "vehicle": "process, plate, chassis, brand, model, submodel, year, CAST(value AS DOUBLE) AS value, encumbered",
    "event": "process, event, text, happened_at",
    "step": "process, task, name, status, happened_at",
}


@lru_cache(maxsize=4)
def _prepared(application, spark, sf):
    return saved(n.standardise(w.batch_records(spark, sf)), "prepared")


def batch(spark, sf):
    """The standardised batch. As in a job, it is written once and feeds every table."""
    return _prepared(spark.sparkContext.applicationId, spark, sf)


@query("prepared_batch", f"{STANDARDISED} WHERE o_orderstatus <> 'F'")
def prepared_batch(spark, sf):
    return flat(batch(spark, sf))


def _earlier(spark, sf):
    return n.standardise(w._as_records(w.cases(spark, sf).filter("o_orderstatus <> 'O'")))


def _stored_event_labels(spark, sf):
    """Labels of odd kinds of events, of which some wait for a real one."""
    label = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("Evento ID: "), F.col("n_nationkey"))).otherwise(F.col("n_name"))
    return t._typed(load(spark, sf, "nation").filter("n_nationkey % 2 = 1").select(
        F.col("n_nationkey").alias("code"), label.alias("label"), F.lit("Stored").alias("phase"), F.lit(1).alias("active")), "workflow_event")


#: People, contacts and captures of the stored processes, as an earlier load left them, marked so that nothing may change them.
_PRIOR = {
    "party": lambda rows: t.party_rows(rows, BEFORE).withColumn("name", F.concat(F.lit("Old "), F.col("name"))),
    "contact": lambda rows: t.contact_rows(rows, BEFORE).withColumn("principal", F.lit(0)),
    "raw_latest": lambda rows: t.raw_latest_rows(rows, BEFORE),
    "raw_history": lambda rows: t._history_rows(rows, BEFORE),
}


class State(w.Claims):
    """The stored part of the binding."""

    def __missing__(self, name):
        if name in _PRIOR:  # the ids of the binding are text, those of the warehouse are not
            self[name] = _PRIOR[name](_earlier(self.spark, self.sf))
        elif name == "workflow_event":
            self[name] = _stored_event_labels(self.spark, self.sf)
        elif name in ("queue", "vehicle", "event", "step", "document", "sla", "user_history", "process"):
            table = super().__missing__(name)
            self[name] = w.known(table, self.spark, self.sf, "id" if name == "process" else "process")
        else:
            super().__missing__(name)
        return self[name]


def state(spark, sf):
    return State(spark, sf)


def _loaded(spark, sf, table):
    return t.load_new(state(spark, sf), batch(spark, sf), NOW)[table]


def _vehicle(df):
    return df.withColumn("value", F.col("value").cast("double")).drop("id", "loaded_at")


# --- generic ----------------------------------------------------------------


@query("upsert_policies", """
    WITH st AS (
        SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '2-HIGH' THEN 's' || o_orderkey END AS a,
               CASE WHEN o_orderpriority <> '5-LOW' THEN 's' END AS b,
               CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '3-MEDIUM' THEN NULL ELSE 'text' END AS c, o_orderpriority AS d, 's' AS e
        FROM orders WHERE o_orderstatus <> 'O'),
    ba AS (
        SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN 'b' || o_orderkey END AS a, 'b' AS b,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'filled' WHEN '3-MEDIUM' THEN '' ELSE 'other' END AS c,
               CASE WHEN o_orderpriority <> '2-HIGH' THEN 'd' END AS d, 'b' AS e
        FROM orders WHERE o_orderstatus <> 'F')
    SELECT id, coalesce(ba.a, st.a) AS a, coalesce(st.b, ba.b) AS b,
           CASE WHEN st.id IS NULL OR (coalesce(st.c, '') = '' AND ba.c <> '') THEN ba.c ELSE st.c END AS c,
           CASE WHEN ba.id IS NOT NULL THEN ba.d ELSE st.d END AS d, coalesce(st.e, ba.e) AS e
    FROM st FULL JOIN ba USING (id)""")
def upsert_policies(spark, sf):
    orders = load(spark, sf, "orders")
    p = F.col("o_orderpriority")
    key = F.col("o_orderkey")
    stored = orders.filter("o_orderstatus <> 'O'").select(
        key.alias("id"), F.when(p != w.HIGH, F.concat(F.lit("s"), key)).alias("a"), F.when(p != w.LOW, F.lit("s")).alias("b"),
        F.when(p == w.URGENT, "").when(p != w.MEDIUM, "text").alias("c"), p.alias("d"), F.lit("s").alias("e"))
    news = orders.filter("o_orderstatus <> 'F'").select(
        key.alias("id"), F.when(p != w.LOW, F.concat(F.lit("b"), key)).alias("a"), F.lit("b").alias("b"),
        F.when(p == w.URGENT, "filled").when(p == w.MEDIUM, "").otherwise("other").alias("c"),
        F.when(p != w.HIGH, F.lit("d")).alias("d"), F.lit("b").alias("e"))
    return t.upsert(stored, news, ["id"], {"a": "batch_wins", "b": "state_wins", "c": "keep_if_blank", "d": "overwrite"})


@query("insert_absent", """
    WITH st AS (SELECT DISTINCT l_orderkey, l_suppkey, 'stored' AS note FROM lineitem WHERE l_returnflag = 'R'),
    ba AS (SELECT l_orderkey, l_suppkey, 'part ' || l_partkey AS note,
                  row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_shipdate, l_partkey, l_linenumber) AS n
           FROM lineitem WHERE l_returnflag <> 'R')
    SELECT * FROM st UNION ALL
    SELECT l_orderkey, l_suppkey, note FROM ba
    WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM st WHERE st.l_orderkey = ba.l_orderkey AND st.l_suppkey = ba.l_suppkey)""")
def insert_absent(spark, sf):
    lines = load(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_suppkey"]
    stored = lines.filter("l_returnflag = 'R'").select(*keys, F.lit("stored").alias("note")).distinct()
    news = lines.filter("l_returnflag <> 'R'").select(
        *keys, F.concat(F.lit("part "), F.col("l_partkey")).alias("note"),
        F.struct("l_shipdate", "l_partkey", "l_linenumber").alias("_order"))
    return t.insert_absent(stored, news, keys, order="_order")


def _labels(spark, sf):
    lines = load(spark, sf, "lineitem")
    code = F.col("l_suppkey").cast("int")
    label = F.when(F.col("l_returnflag") == "N", F.concat(F.lit("Status ID: "), code)).otherwise(F.concat(F.lit("Label "), F.col("l_partkey")))
    return lines.select(code.alias("code"), label.alias("label"), F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("_order"))


def _dictionary(spark, sf):
    label = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("Status ID: "), F.col("n_nationkey"))).otherwise(F.col("n_name"))
    return load(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), label.alias("label"))


_DICT = "SELECT n_nationkey AS code, CASE WHEN n_regionkey = 0 THEN 'Status ID: ' || n_nationkey ELSE n_name END AS label FROM nation"
_NEWS = """
    SELECT code, label, row_number() OVER (PARTITION BY code ORDER BY {real} l_orderkey, l_linenumber, l_partkey) AS n
    FROM (SELECT CAST(l_suppkey AS INTEGER) AS code, l_orderkey, l_linenumber, l_partkey,
                 CASE WHEN l_returnflag = 'N' THEN 'Status ID: ' || l_suppkey ELSE 'Label ' || l_partkey END AS label FROM lineitem)"""


@query("dictionary_growth", f"""
    WITH d AS ({_DICT}), b AS ({_NEWS.format(real="starts_with(label, 'Status ID:'),")}), f AS (SELECT * FROM b WHERE n = 1)
    SELECT coalesce(d.code, f.code) AS code,
           CASE WHEN d.code IS NULL OR (starts_with(d.label, 'Status ID:') AND NOT starts_with(f.label, 'Status ID:')) THEN f.label
                ELSE d.label END AS label
    FROM d FULL JOIN f ON f.code = d.code""")
def dictionary_growth(spark, sf):
    return t.grow_dictionary(_dictionary(spark, sf), _labels(spark, sf), "Status ID:")


@query("dictionary_insert", f"""
    WITH d AS ({_DICT}), b AS ({_NEWS.format(real="")}), f AS (SELECT * FROM b WHERE n = 1)
    SELECT coalesce(d.code, f.code) AS code, CASE WHEN d.code IS NULL THEN f.label ELSE d.label END AS label
    FROM d FULL JOIN f ON f.code = d.code""")
def dictionary_insert(spark, sf):
    return t.grow_dictionary(_dictionary(spark, sf), _labels(spark, sf), "Status ID:", upgrade=False)


@query("surrogate_key", "SELECT count(DISTINCT (process, user_id)) AS keys, count(*) AS rows FROM user_history")
def surrogate_key(spark, sf):
    keys = w.user_history(spark, sf).select(t.surrogate_key("process", "user_id").alias("k"))
    return keys.agg(F.countDistinct("k").alias("keys"), F.count(F.lit(1)).alias("rows"))


@query("numbered_ids", "SELECT event_id, 100 + row_number() OVER (ORDER BY user_id, ts, event_id) AS id FROM events")
def numbered_ids(spark, sf):
    rows = load(spark, sf, "events", ["event_id", "user_id", "ts"])
    return t.numbered_ids(rows, ["user_id", "ts", "event_id"], "id", offset=100).select("event_id", "id")


# --- initial load -----------------------------------------------------------


def _appended(table: str, columns: str, new: str) -> str:
    key = "id" if table == "process" else "process"
    return f"SELECT {columns} FROM {table} WHERE {key} IN ({STORED}) UNION ALL {new}"


@query("load_process", _appended("process", _KEPT["process"], f"""
    SELECT {_KEPT['process']} FROM load_process_rows WHERE o_orderstatus = 'O'"""))
def load_process(spark, sf):
    return _loaded(spark, sf, "process").drop("loaded_at", "active")


@query("load_queue", f"""
    SELECT process, status, attempts, active FROM queue WHERE process IN ({STORED})
    UNION ALL SELECT o_orderkey, 1, 0, 1 FROM orders WHERE o_orderstatus = 'O' AND o_orderkey <> 0""")
def load_queue(spark, sf):
    return _loaded(spark, sf, "queue").select("process", "status", "attempts", "active")


@query("load_vehicle", _appended("vehicle", _KEPT["vehicle"], f"""
    SELECT {_KEPT['vehicle']} FROM load_vehicle_rows WHERE o_orderstatus = 'O'"""))
def load_vehicle(spark, sf):
    return _vehicle(_loaded(spark, sf, "vehicle"))


@query("load_party", "SELECT process, type, CASE WHEN o_orderstatus <> 'O' THEN 'Old ' ELSE '' END || name AS name, tax_id FROM load_party_rows")
def load_party(spark, sf):
    return _loaded(spark, sf, "party").drop("id", "loaded_at")


@query("load_contact", "SELECT process, kind, type, area, value, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS principal FROM load_contact_rows")
def load_contact(spark, sf):
    loaded = t.load_new(state(spark, sf), batch(spark, sf), NOW)
    party = loaded["party"].select(F.col("id").alias("party"), "process", F.col("type").alias("kind"))
    return loaded["contact"].join(party, ["process", "party"]).select("process", "kind", "type", "area", "value", "principal")


@query("load_event", _appended("event", _KEPT["event"], f"""
    SELECT id, event_id, coalesce({s.text_or_null('text', 200)}, ''), happened_at FROM std_event WHERE o_orderstatus = 'O'"""))
def load_event(spark, sf):
    return _loaded(spark, sf, "event").drop("loaded_at")


@query("load_step", _appended("step", _KEPT["step"], f"""
    SELECT id, cycle, left(task_name, 200), left(task_status, 50), {AT} FROM std WHERE o_orderstatus = 'O' AND cycle > 0"""))
def load_step(spark, sf):
    return _loaded(spark, sf, "step").drop("loaded_at")


_LAST_DOCUMENT = """
    SELECT id AS process, name, max_by(status, position) AS status FROM std_document
    WHERE id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = '{status}') GROUP BY 1, 2"""


@query("load_document", _appended("document", "process, name, status", _LAST_DOCUMENT.format(status="O")))
def load_document(spark, sf):
    return _loaded(spark, sf, "document").drop("loaded_at")


@query("load_sla", _appended("sla", "process, received, captured, status", f"""
    SELECT s.id, o.opened, {AT}, 'PENDENTE_ENVIO' FROM std s LEFT JOIN std_opened o ON o.id = s.id WHERE o_orderstatus = 'O'"""))
def load_sla(spark, sf):
    return _loaded(spark, sf, "sla").select("process", "received", "captured", "status")


@query("load_user", """
    SELECT id, login FROM robot_user
    UNION ALL
    SELECT user_id, arg_min(user_name, id) FROM std WHERE o_orderstatus = 'O' AND user_id NOT IN (SELECT id FROM robot_user) GROUP BY 1""")
def load_user(spark, sf):
    return _loaded(spark, sf, "robot_user").select("id", "login")


@query("load_user_history", _appended("user_history", "process, user_id, entered_at, is_current", f"""
    SELECT id, user_id, {AT}, 1 FROM std WHERE o_orderstatus = 'O'"""))
def load_user_history(spark, sf):
    return _loaded(spark, sf, "user_history").drop("left_at")


@query("load_status_dictionary", f"""
    SELECT code, label FROM portal_status
    UNION ALL
    SELECT portal_status, arg_min(coalesce({s.text_or_null('phase', 100)}, 'Status ID: ' || portal_status), id) FROM std
    WHERE o_orderstatus = 'O' AND portal_status <> 0 AND portal_status NOT IN (SELECT code FROM portal_status) GROUP BY 1""")
def load_status_dictionary(spark, sf):
    return _loaded(spark, sf, "portal_status").select("code", "label")


@query("load_event_dictionary", f"""
    SELECT n_nationkey AS code, CASE WHEN n_regionkey = 0 THEN 'Evento ID: ' || n_nationkey ELSE n_name END AS label, 'Stored' AS phase
    FROM nation WHERE n_nationkey % 2 = 1
    UNION ALL
    SELECT event_id, arg_min(coalesce({s.text_or_null('text', 100)}, 'Evento ID: ' || event_id), (id, position)) AS label, 'Fase a Mapear' AS phase
    FROM std_event WHERE o_orderstatus = 'O' AND event_id > 0 AND event_id % 2 = 0 GROUP BY 1""")
def load_event_dictionary(spark, sf):
    return _loaded(spark, sf, "workflow_event").select("code", "label", "phase")


_CAPTURED = f"SELECT id, claim, CASE WHEN o_orderstatus = 'O' THEN {AT} ELSE TIMESTAMP '{BEFORE}' END AS captured_at FROM std"


@query("load_raw", _CAPTURED)
def load_raw(spark, sf):
    return _loaded(spark, sf, "raw_latest").select("id", "claim", "captured_at")


@query("load_raw_history", _CAPTURED)
def load_raw_history(spark, sf):
    return _loaded(spark, sf, "raw_history").select("id", "claim", "captured_at")


# --- backfill and sync ------------------------------------------------------


def _known(spark, sf):
    tables = state(spark, sf)
    return tables, r.exists_in(batch(spark, sf), tables["process"], ["id"])


@query("backfill_process", f"""
    SELECT p.id, p.claim, coalesce(b.portal_status, p.portal_status) AS portal_status, coalesce(p.opened, o.opened) AS opened,
           coalesce(p.occurred, try_cast({s.nullify('b.occurred_text', '', 'nan', 'none', 'nat')} AS TIMESTAMP)) AS occurred,
           coalesce(left(trim(b.phase), 150), p.phase) AS phase, CASE WHEN b.id IS NOT NULL THEN b.alert ELSE p.alert END AS alert
    FROM process p LEFT JOIN std b ON b.id = p.id AND b.o_orderstatus = 'P' LEFT JOIN std_opened o ON o.id = b.id
    WHERE p.o_orderstatus <> 'O'""")
def backfill_process(spark, sf):
    tables, known = _known(spark, sf)
    return t.backfill_process(tables["process"], known).select("id", "claim", "portal_status", "opened", "occurred", "phase", "alert")


@query("backfill_vehicle", f"""
    SELECT v.process, CASE WHEN b.id IS NOT NULL THEN left(b.plate, 10) ELSE v.plate END AS plate, v.chassis,
           CASE WHEN b.id IS NOT NULL THEN left(b.brand, 50) ELSE v.brand END AS brand,
           CASE WHEN b.id IS NOT NULL THEN left(b.model, 100) ELSE v.model END AS model,
           CASE WHEN b.id IS NOT NULL THEN nullif(left(trim(b.submodel), 150), '') ELSE v.submodel END AS submodel,
           CASE WHEN b.id IS NOT NULL THEN {s.whole('b.year_text')} ELSE v.year END AS year,
           CAST(CASE WHEN b.id IS NOT NULL THEN CAST({s.money('b.value_text')} AS DECIMAL(18,2)) ELSE v.value END AS DOUBLE) AS value,
           CASE WHEN b.id IS NOT NULL THEN b.encumbered ELSE v.encumbered END AS encumbered
    FROM vehicle v LEFT JOIN std b ON b.id = v.process AND b.o_orderstatus = 'P' WHERE v.process IN ({STORED})""")
def backfill_vehicle(spark, sf):
    tables, known = _known(spark, sf)
    return _vehicle(t.backfill_vehicle(tables["vehicle"], known))


@query("backfill_event", f"""
    WITH ev AS (SELECT * FROM event WHERE process IN ({STORED})),
    ba AS (SELECT id AS process, event_id AS event,
                  coalesce(arg_min(said, position) FILTER (WHERE said <> ''), '') AS text, arg_min(happened_at, position) AS happened_at
           FROM (SELECT *, coalesce({s.text_or_null('text', 200)}, '') AS said FROM std_event WHERE o_orderstatus = 'P' AND event_id > 0)
           GROUP BY 1, 2)
    SELECT ev.process, ev.event, CASE WHEN ev.text = '' AND ba.text <> '' THEN ba.text ELSE ev.text END AS text, ev.happened_at
    FROM ev LEFT JOIN ba ON ba.process = ev.process AND ba.event = ev.event
    UNION ALL
    SELECT * FROM ba WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.process = ba.process AND ev.event = ba.event)""")
def backfill_event(spark, sf):
    tables, known = _known(spark, sf)
    return t.backfill_events(tables["event"], known, NOW).drop("loaded_at")


@query("backfill_document", f"""
    WITH d AS (SELECT * FROM document WHERE process IN ({STORED})), ba AS ({_LAST_DOCUMENT.format(status="P")})
    SELECT coalesce(d.process, ba.process) AS process, coalesce(d.name, ba.name) AS name, coalesce(ba.status, d.status) AS status
    FROM d FULL JOIN ba ON ba.process = d.process AND ba.name = d.name""")
def backfill_document(spark, sf):
    tables, known = _known(spark, sf)
    return t.backfill_documents(tables["document"], known, NOW).drop("loaded_at")


def _people(spark, sf):
    """Stored analysts: one per finished or failed order with an accepted line, under a long id."""
    accepted = w.lines(spark, sf, "l_returnflag", "l_suppkey").filter("l_returnflag = 'A'")
    rows = accepted.groupBy(F.col("l_orderkey").alias("process")).agg(F.min("l_suppkey").alias("supp"))
    rows = w.known(rows, spark, sf)
    party = t._typed(rows.select(F.col("process").alias("id"), "process", F.lit(4).alias("type"),
                                 F.concat(F.lit("Old "), F.col("supp")).alias("name")), "party")
    contact = t._typed(rows.filter("supp > 50").select(
        F.col("process").alias("id"), "process", F.col("process").alias("party"), F.lit(3).alias("type"), F.lit("old@t.com").alias("value"),
        F.lit(0).alias("principal")), "contact")
    return party, contact


_STORED_ANALYST = f"SELECT l_orderkey AS process, min(l_suppkey) AS supp FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey IN ({STORED}) GROUP BY 1"
_NAMED = f"SELECT id, left(trim(analyst_name), 150) AS name, left(trim(analyst_email), 150) AS email FROM std WHERE o_orderstatus = 'P' AND {s.nullify('analyst_name')} IS NOT NULL"


@query("backfill_analyst_party", f"""
    WITH st AS ({_STORED_ANALYST}), na AS ({_NAMED})
    SELECT process, 4 AS type, 'Old ' || supp AS name FROM st
    UNION ALL SELECT id, 4, name FROM na WHERE id NOT IN (SELECT process FROM st)""")
def backfill_analyst_party(spark, sf):
    _, known = _known(spark, sf)
    return t.backfill_analyst(*_people(spark, sf), known, NOW)["party"].select("process", "type", "name")


@query("backfill_analyst_contact", f"""
    WITH st AS ({_STORED_ANALYST}), na AS ({_NAMED} AND contains(analyst_email, '@'))
    SELECT st.process, coalesce(na.email, CASE WHEN supp > 50 THEN 'old@t.com' END) AS value,
           CASE WHEN supp > 50 THEN 0 ELSE 1 END AS principal
    FROM st LEFT JOIN na ON na.id = st.process WHERE supp > 50 OR na.id IS NOT NULL
    UNION ALL SELECT id, email, 1 FROM na WHERE id NOT IN (SELECT process FROM st)""")
def backfill_analyst_contact(spark, sf):
    _, known = _known(spark, sf)
    out = t.backfill_analyst(*_people(spark, sf), known, NOW)
    party = out["party"].select(F.col("id").alias("party"), "process")
    return out["contact"].join(party, ["process", "party"]).select("process", "value", "principal")


@query("sync_process", """
    SELECT p.id, coalesce(b.portal_status, p.portal_status) AS portal_status, coalesce(left(trim(b.phase), 150), p.phase) AS phase,
           CASE WHEN b.id IS NOT NULL THEN b.alert ELSE p.alert END AS alert
    FROM process p LEFT JOIN std b ON b.id = p.id AND b.o_orderstatus = 'P' WHERE p.o_orderstatus <> 'O'""")
def sync_process(spark, sf):
    return t.sync_known(state(spark, sf), batch(spark, sf), NOW)["process"].select("id", "portal_status", "phase", "alert")


@query("sync_event", f"""
    WITH ev AS (SELECT * FROM event WHERE process IN ({STORED})),
    ba AS (SELECT id, event_id, arg_min(left(text, 200), position) AS text, arg_min(happened_at, position) AS happened_at
           FROM std_event WHERE o_orderstatus = 'P' GROUP BY 1, 2)
    SELECT process, event, text, happened_at FROM ev
    UNION ALL
    SELECT * FROM ba WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.process = ba.id AND ev.event = ba.event_id)""")
def sync_event(spark, sf):
    return t.sync_known(state(spark, sf), batch(spark, sf), NOW)["event"].drop("loaded_at")


@query("sync_step", f"""
    WITH sp AS (SELECT * FROM step WHERE process IN ({STORED}))
    SELECT process, task, name, status, happened_at FROM sp
    UNION ALL
    SELECT id, cycle, left(task_name, 200), left(task_status, 50), {AT} FROM std
    WHERE o_orderstatus = 'P' AND cycle > 0 AND NOT EXISTS (SELECT 1 FROM sp WHERE sp.process = std.id AND sp.task = std.cycle)""")
def sync_step(spark, sf):
    return t.sync_known(state(spark, sf), batch(spark, sf), NOW)["step"].drop("loaded_at")


# --- exits, repair, reconciliation, audit -----------------------------------


def _shown(spark, sf):
    """The portal shows the open lines of the users of one region."""
    users = load(spark, sf, "supplier").join(load(spark, sf, "nation").filter("n_regionkey = 1"), F.col("s_nationkey") == F.col("n_nationkey"))
    lines = load(spark, sf, "lineitem", ["l_orderkey", "l_suppkey", "l_linestatus"]).filter("l_linestatus = 'O'")
    return lines.join(users.select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey", "left_semi").select(
        F.col("l_suppkey").cast("int").alias("user_id"), F.col("l_orderkey").alias("id"))


_GONE = """
    shown AS (SELECT DISTINCT CAST(l_suppkey AS INTEGER) AS user_id, l_orderkey AS id FROM lineitem
              JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_linestatus = 'O' AND n_regionkey = 1),
    gone AS (SELECT user_id, process FROM user_history h WHERE is_current = 1 AND user_id IN (SELECT user_id FROM shown)
             AND NOT EXISTS (SELECT 1 FROM shown WHERE shown.user_id = h.user_id AND shown.id = h.process))"""


@query("disappeared", f"WITH {_GONE.strip()} SELECT user_id, process FROM gone")
def disappeared(spark, sf):
    return t.disappeared(w.user_history(spark, sf), _shown(spark, sf))


@query("close_disappeared_history", f"""
    WITH {_GONE.strip()}
    SELECT h.process, h.user_id, h.entered_at, CASE WHEN g.process IS NOT NULL THEN {AT} ELSE h.left_at END AS left_at,
           CASE WHEN g.process IS NOT NULL THEN 0 ELSE h.is_current END AS is_current
    FROM user_history h LEFT JOIN gone g ON g.process = h.process AND g.user_id = h.user_id""")
def close_disappeared_history(spark, sf):
    return t.close_disappeared(w.user_history(spark, sf), w.queue(spark, sf), _shown(spark, sf), NOW)["user_history"]


_RETIRED = """
    SELECT id, process, CASE WHEN hit THEN 2 ELSE status END AS status, attempts, CASE WHEN hit THEN {at} ELSE last_attempt END AS last_attempt,
           CASE WHEN hit THEN '{message}' ELSE message END AS message, active
    FROM (SELECT *, status = 1 AND process IN ({ids}) AS hit FROM queue)"""


def _queue(df):
    return df.drop("slot", "loaded_at")


@query("close_disappeared_queue", f"WITH {_GONE.strip()}" + _RETIRED.format(
    at=AT, message=t.GONE_MESSAGE, ids="SELECT process FROM gone"))
def close_disappeared_queue(spark, sf):
    return _queue(t.close_disappeared(w.user_history(spark, sf), w.queue(spark, sf), _shown(spark, sf), NOW)["queue"])


@query("opening_repair", f"""
    SELECT id, CASE WHEN (opened IS NULL OR opened < TIMESTAMP '{FLOOR}') AND first IS NOT NULL THEN first ELSE opened END AS opened
    FROM process LEFT JOIN (SELECT process, min(happened_at) AS first FROM event WHERE happened_at >= TIMESTAMP '{FLOOR}' GROUP BY 1) e
        ON e.process = id""")
def opening_repair(spark, sf):
    return t.repair_opening(w.process(spark, sf), w.event(spark, sf), FLOOR).select("id", "opened")


@query("reconcile", _RETIRED.format(at=AT, message=t.RECONCILED_MESSAGE, ids="""
    SELECT p.id FROM process p JOIN queue q2 ON q2.process = p.id
    WHERE q2.status IN (1, 3) AND q2.active = 1
      AND p.claim || CASE WHEN file_type = 2 THEN 'T' ELSE '' END IN (SELECT 'C' || o_orderkey FROM orders WHERE o_totalprice > 200000
          UNION SELECT 'C' || o_orderkey || 'T' FROM orders WHERE o_totalprice < 100000)"""))
def reconcile(spark, sf):
    from claimflow.plans.views import ready_claims

    orders = load(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    claim = F.concat(F.lit("C"), F.col("o_orderkey"))
    stock = orders.filter("o_totalprice > 200000").select(claim.alias("claim")).unionByName(
        orders.filter("o_totalprice < 100000").select(F.concat(claim, F.lit("T")).alias("claim")))
    return _queue(t.reconcile(w.queue(spark, sf), ready_claims(w.claims(spark, sf)), stock, NOW))


def _snapshot(spark, sf):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return load(spark, sf, "orders").filter(priority != w.UNSPECIFIED).select(
        F.col("o_orderkey").alias("process"), F.when(status == "O", 22).when(status == "P", 0).alias("status"),
        F.when(priority == w.URGENT, "Processo Concluído").when(priority == w.HIGH, "cancelado").otherwise("em aberto").alias("status_text"))


_FOUND = f"""
    closing AS (
        SELECT p.id, CASE WHEN o_orderstatus = 'O' THEN 22 WHEN o_orderpriority = '1-URGENT' THEN 22 WHEN o_orderpriority = '2-HIGH' THEN 98 END AS found
        FROM process p JOIN (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED') ON o_orderkey = p.id
        WHERE portal_status NOT IN (22, 98) AND date_diff('day', opened, {AT}) > 15)"""


@query("audit_close_process", f"""
    WITH {_FOUND.strip()}
    SELECT p.id, coalesce(found, portal_status) AS portal_status,
           CASE found WHEN 22 THEN '{t.CLOSED_PHASE}' WHEN 98 THEN '{t.CANCELLED_PHASE}' ELSE phase END AS phase,
           CASE WHEN found IS NOT NULL THEN 0 ELSE alert END AS alert
    FROM process p LEFT JOIN closing c ON c.id = p.id""")
def audit_close_process(spark, sf):
    return t.audit_close(w.claims(spark, sf), _snapshot(spark, sf), NOW)["process"].select("id", "portal_status", "phase", "alert")


@query("audit_close_queue", f"""
    WITH {_FOUND.strip()}
    SELECT id, CASE WHEN process IN (SELECT id FROM closing WHERE found IS NOT NULL) THEN 0 ELSE active END AS active FROM queue""")
def audit_close_queue(spark, sf):
    return t.audit_close(w.claims(spark, sf), _snapshot(spark, sf), NOW)["queue"].select("id", "active")


@query("audit_close_history", f"""
    WITH {_FOUND.strip()}
    SELECT process, user_id, CASE WHEN hit THEN {AT} ELSE left_at END AS left_at, CASE WHEN hit THEN 0 ELSE is_current END AS is_current
    FROM (SELECT *, is_current = 1 AND process IN (SELECT id FROM closing WHERE found IS NOT NULL) AS hit FROM user_history)""")
def audit_close_history(spark, sf):
    return t.audit_close(w.claims(spark, sf), _snapshot(spark, sf), NOW)["user_history"].drop("entered_at")


@query("audit_counts", f"""
    WITH {_FOUND.strip()},
    stale AS (SELECT id FROM process WHERE portal_status NOT IN (22, 98) AND date_diff('day', opened, {AT}) > 15)
    SELECT count(found) AS closed, count(*) - count(found) AS still_open FROM stale LEFT JOIN closing USING (id)""")
def audit_counts(spark, sf):
    return t.audit_counts(w.process(spark, sf), _snapshot(spark, sf), NOW)
