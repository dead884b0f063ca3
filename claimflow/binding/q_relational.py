"""Guards, joins, top-1 lookups, aggregates and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.binding import warehouse as w
from claimflow.binding.catalog import query
from claimflow.operators import quality as q
from claimflow.operators import relational as r
from claimflow.operators import transitions as t
from claimflow.sources.tables import known_ids as stored_ids
from claimflow.sources.tables import load

NOW = "2001-08-16 12:00:00"
FLOOR = "1998-01-01 00:00:00"


def _orders(spark, sf):
    return load(spark, sf, "orders")


def _by_status(spark, sf, *statuses):
    return _orders(spark, sf).filter(F.col("o_orderstatus").isin(*statuses))


@query("new_records", "SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def new_records(spark, sf):
    stored = load(spark, sf, "lineitem", ["l_orderkey"]).withColumnRenamed("l_orderkey", "o_orderkey")
    return r.new_records(_orders(spark, sf), stored, ["o_orderkey"])


@query("known_records", "SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def known_records(spark, sf):
    stored = load(spark, sf, "lineitem", ["l_orderkey"]).withColumnRenamed("l_orderkey", "o_orderkey")
    return r.known_records(_orders(spark, sf), stored, ["o_orderkey"])


@query("missing_from", """
    SELECT l_suppkey, l_orderkey FROM lineitem WHERE l_returnflag = 'R'
    EXCEPT SELECT l_suppkey, l_orderkey FROM lineitem WHERE l_returnflag = 'A'""")
def missing_from(spark, sf):
    lines = load(spark, sf, "lineitem", ["l_suppkey", "l_orderkey", "l_returnflag"])
    keys = ["l_suppkey", "l_orderkey"]
    seen = lines.filter("l_returnflag = 'A'")
    return r.missing_from(lines.filter("l_returnflag = 'R'").select(*keys).distinct(), seen, keys)


@query("with_id", "SELECT o_orderkey FROM orders WHERE o_orderkey <> 0")
def with_id(spark, sf):
    from claimflow.operators.normalise import with_id as keep

    return keep(_orders(spark, sf).select("o_orderkey"), "o_orderkey")


@query("stale_open", f"""
    SELECT id, claim, portal_status, opened FROM process
    WHERE portal_status NOT IN (22, 98) AND date_diff('day', opened, TIMESTAMP '{NOW}') > 15""")
def stale_open(spark, sf):
    return t.stale_open(w.process(spark, sf), NOW).select("id", "claim", "portal_status", "opened")


@query("dispatchable", "SELECT id, process, status FROM queue WHERE status IN (1, 3) AND active = 1")
def dispatchable(spark, sf):
    from claimflow.plans.views import dispatchable as keep

    return keep(w.queue(spark, sf)).select("id", "process", "status")


@query("since_floor", f"SELECT process, event, happened_at FROM event WHERE happened_at >= TIMESTAMP '{FLOOR}'")
def since_floor(spark, sf):
    return r.since(w.event(spark, sf), FLOOR).select("process", "event", "happened_at")


@query("fresh_or_now", f"""
    SELECT id, CASE WHEN opened IS NULL OR opened < TIMESTAMP '2001-07-01 00:00:00' - INTERVAL 5 DAY
                    THEN TIMESTAMP '2001-07-01 00:00:00' ELSE opened END AS at
    FROM process""")
def fresh_or_now(spark, sf):
    from claimflow.operators.slots import fresh_or_now as fresh

    now = F.expr("timestamp_ntz'2001-07-01 00:00:00'")
    return w.process(spark, sf).select("id", fresh(F.col("opened"), now).alias("at"))


@query("valid_contact", """
    SELECT * FROM contact WHERE CASE WHEN type = 3 THEN contains(value, '@') ELSE value IS NOT NULL END""")
def valid_contact(spark, sf):
    return r.valid_contact(w.contact(spark, sf)).drop("process")


@query("queue_process_join", """
    SELECT q.id, q.status, p.claim, p.opened FROM queue q JOIN process p ON p.id = q.process""")
def queue_process_join(spark, sf):
    process = w.process(spark, sf).select(F.col("id").alias("process"), "claim", "opened")
    return w.queue(spark, sf).join(process, "process").select("id", "status", "claim", "opened")


@query("with_labels", """
    SELECT p.id, f.sigla, s.label AS status, r_name AS operator_status
    FROM process p LEFT JOIN file_type f ON f.code = file_type LEFT JOIN portal_status s ON s.code = p.portal_status
    LEFT JOIN region ON r_regionkey = s.operator_status""")
def with_labels(spark, sf):
    tables = w.claims(spark, sf)
    return r.with_labels(
        tables["process"],
        (tables["file_type"], "code", "file_type", {"sigla": "sigla"}),
        (tables["portal_status"], "code", "portal_status", {"status": "label", "_op": "operator_status"}),
        (tables["operator_status"], "code", "_op", {"operator_status": "label"}),
    ).select("id", "sigla", "status", "operator_status")


@query("party_of_type", """
    SELECT p.id, b.id AS broker, b.name FROM process p LEFT JOIN party b ON b.process = p.id AND b.type = 3""")
def party_of_type(spark, sf):
    broker = r.party_of_type(w.party(spark, sf), 3).select(F.col("process").alias("id"), F.col("id").alias("broker"), "name")
    return w.process(spark, sf).select("id").join(broker, "id", "left")


@query("lookup_default", "SELECT s_suppkey, coalesce(n_name, 'none') AS nation FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey <> 2")
def lookup_default(spark, sf):
    pairs = load(spark, sf, "nation").filter("n_regionkey <> 2").select("n_nationkey", "n_name")
    return r.lookup(load(spark, sf, "supplier"), pairs, F.col("s_nationkey"), F.lit("none"), "nation").select("s_suppkey", "nation")


@query("best_contact", """
    SELECT DISTINCT c.party, e.value AS email_value, t.area AS phone_area, t.value AS phone_value
    FROM contact c LEFT JOIN email e ON e.party = c.party LEFT JOIN phone t ON t.party = c.party""")
def best_contact(spark, sf):
    best = r.best_contact(w.contact(spark, sf), {"email": 3, "phone": 2}, ("process", "party"), tie=w.CONTACT_TIE)
    return best.select("party", "email_value", "phone_area", "phone_value")


@query("party_key", """
    SELECT process, type, max(id) AS party FROM party GROUP BY process, type""")
def party_key(spark, sf):
    return r.party_key(w.party(spark, sf))


@query("last_change", "SELECT id, last_change FROM changes")
def last_change(spark, sf):
    return r.last_change(w.process(spark, sf), w.event(spark, sf), w.step(spark, sf))


@query("min_event", f"SELECT process, min(happened_at) AS first_event FROM event WHERE happened_at >= TIMESTAMP '{FLOOR}' GROUP BY 1")
def min_event(spark, sf):
    return r.min_event(w.event(spark, sf), FLOOR)


@query("current_user", "SELECT process, user_id, left_at FROM owner")
def current_user(spark, sf):
    return r.current_user(w.user_history(spark, sf))


@query("batch_metrics", """
    SELECT count(*) AS read, count(*) FILTER (WHERE k IS NULL) AS new, count(*) FILTER (WHERE k IS NOT NULL) AS known
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) ON k = o_orderkey""")
def batch_metrics(spark, sf):
    batch = _orders(spark, sf).select(F.col("o_orderkey").alias("id"))
    known = load(spark, sf, "lineitem", ["l_orderkey"]).withColumnRenamed("l_orderkey", "id")
    return r.batch_metrics(batch, known)


@query("batch_users", "SELECT DISTINCT CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events WHERE event_type <> 'error'")
def batch_users(spark, sf):
    users = load(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    return r.batch_users(users)


@query("first_per_key", """
    SELECT user_id, ts, event_id, event_type, value FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def first_per_key(spark, sf):
    rows = load(spark, sf, "events", ["user_id", "ts", "event_id", "event_type", "value"])
    ordered = rows.withColumn("_order", F.struct("ts", "event_id"))
    return r.first_per_key(ordered, "user_id", "_order").drop("_order")


@query("last_per_key", """
    SELECT user_id, ts, event_id, event_type, value FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def last_per_key(spark, sf):
    rows = load(spark, sf, "events", ["user_id", "ts", "event_id", "event_type", "value"])
    ordered = rows.withColumn("_order", F.struct("ts", "event_id"))
    return r.last_per_key(ordered, "user_id", "_order").drop("_order")


@query("top1_line", """
    SELECT l_orderkey, l_extendedprice, l_partkey, l_linenumber, l_suppkey FROM
        (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_linenumber, l_suppkey) AS n
         FROM lineitem) WHERE n = 1""")
def top1_line(spark, sf):
    columns = ["l_orderkey", "l_extendedprice", "l_partkey", "l_linenumber", "l_suppkey"]
    return r.top1(load(spark, sf, "lineitem", columns), ["l_orderkey"],
                  [F.col("l_extendedprice").desc(), "l_partkey", "l_linenumber", "l_suppkey"])


@query("first_row", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1")
def first_row(spark, sf):
    return r.first_row(load(spark, sf, "part", ["p_partkey", "p_name", "p_retailprice"]), [F.col("p_retailprice").desc(), "p_partkey"])


@query("union_dates", """
    SELECT id, max(seen) AS seen FROM (SELECT id, loaded_at AS seen FROM process UNION ALL SELECT process, loaded_at FROM event
        UNION ALL SELECT process, loaded_at FROM step) GROUP BY id""")
def union_dates(spark, sf):
    own = w.process(spark, sf).select("id", F.col("loaded_at").alias("seen"))
    facts = [df.select(F.col("process").alias("id"), F.col("loaded_at").alias("seen")) for df in (w.event(spark, sf), w.step(spark, sf))]
    return r.union_dates(own, *facts).groupBy("id").agg(F.max("seen").alias("seen"))


@query("ordered_distinct", """
    SELECT conv_id, turn, array_to_string(list_filter(parts, lambda e, i: list_position(parts, e) = i), ' ') AS words
    FROM (SELECT conv_id, turn, string_split(text, ' ') AS parts FROM conversations)""")
def ordered_distinct(spark, sf):
    words = F.array_distinct(F.split("text", " "))
    return load(spark, sf, "conversations").select("conv_id", "turn", F.array_join(words, " ").alias("words"))


@query("changed_count", f"""
    SELECT count(*) AS changed FROM process p JOIN
        (SELECT process, min(happened_at) AS f FROM event WHERE happened_at >= TIMESTAMP '{FLOOR}' GROUP BY 1) e ON e.process = p.id
    WHERE (opened IS NULL OR opened < TIMESTAMP '{FLOOR}') AND f IS DISTINCT FROM opened""")
def changed_count(spark, sf):
    before = w.process(spark, sf)
    return r.changed_count(before, t.repair_opening(before, w.event(spark, sf), FLOOR), "id", ["opened"])


@query("quality_duplicates", """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def quality_duplicates(spark, sf):
    return q.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("quality_orphans", """
    SELECT o_orderkey, count(*) AS rows FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""")
def quality_orphans(spark, sf):
    return q.orphans(_orders(spark, sf), load(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


_VIOLATIONS = """
    SELECT o_orderkey AS key, 'status' AS "column", 'missing' AS kind, CAST(NULL AS INTEGER) AS length FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, 'o_orderpriority', 'too long', CAST(length(o_orderpriority) AS INTEGER) FROM orders WHERE length(o_orderpriority) > 8"""


def _violations(spark, sf):
    rows = _orders(spark, sf).withColumn("status", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")))
    return q.constraint_violations(rows, "o_orderkey", {"status": None, "o_orderpriority": 8})


@query("quality_violations", _VIOLATIONS)
def quality_violations(spark, sf):
    return _violations(spark, sf)


@query("quality_anomalies", f"""
    SELECT 'lineitem' AS source, CAST(l_orderkey AS VARCHAR) AS key, 'duplicate key' AS kind, CAST(count(*) AS VARCHAR) AS detail,
           'high' AS severity, 0 AS resolved FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL
    SELECT 'orders', CAST(o_orderkey AS VARCHAR), 'orphan', CAST(count(*) AS VARCHAR), 'medium', 0
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey
    UNION ALL
    SELECT 'orders', CAST(key AS VARCHAR), kind, "column", 'low', 0 FROM ({_VIOLATIONS})""")
def quality_anomalies(spark, sf):
    return q.anomalies(
        q.anomaly(quality_duplicates(spark, sf), "lineitem", "l_orderkey", "duplicate key", F.col("rows"), "high"),
        q.anomaly(quality_orphans(spark, sf), "orders", "o_orderkey", "orphan", F.col("rows"), "medium"),
        _violations(spark, sf).select(
            F.lit("orders").alias("source"), F.col("key").cast("string").alias("key"), "kind", F.col("column").alias("detail"),
            F.lit("low").alias("severity"), F.lit(0).alias("resolved")),
    )
