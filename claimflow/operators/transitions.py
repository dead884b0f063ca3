"""Warehouse transitions: (state tables, batch, now) -> changed state tables.

Nothing here writes. A batch holds one standardised row per process (``first_per_key``).
Updates are left joins from the state to a batch that is unique by key, so a small
batch is broadcast and the state is neither shuffled nor multiplied.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.functions import cleanse as c
from claimflow.functions.clock import stamp
from claimflow.operators import normalise as n
from claimflow.operators import relational as r
from claimflow.schemas import TABLES
from claimflow.session import work_dir
from claimflow.sources.dictionaries import load_area_map
from claimflow.sources.tables import raw_latest_rows

State = dict[str, DataFrame]
Keep = Callable[[DataFrame, str], DataFrame]

# Fixed values.
COMPANY = "SEGURADORA CLIENTE"
PENDING_SLA = "PENDENTE_ENVIO"
NEW_EVENT_PHASE = "Fase a Mapear"
STATUS_PREFIX = "Status ID:"
EVENT_PREFIX = "Evento ID:"
GONE_MESSAGE = "Processo finalizado/transferido no Portal (Baixa Automática)"
RECONCILED_MESSAGE = "Conciliado via Snapshot D-1 (Fabric)"
CLOSED_STATUS = 22
CANCELLED_STATUS = 98
CLOSED_PHASE = "PROCESSO FINALIZADO (Auditoria Automática)"
CANCELLED_PHASE = "PROCESSO CANCELADO (Auditoria Automática)"
STALE_DAYS = 15


def surrogate_key(*columns: str) -> Column:
    """Id from the natural key: the same on every run, with no read-back."""
    return F.xxhash64(*columns)


def numbered_ids(df: DataFrame, order: list[str], name: str, offset: int = 0) -> DataFrame:
    """Dense ids 1, 2, 3, .. in ``order``, where an output must have them.

    Ids are a running count per partition plus the size of the partitions before it,
    so the whole table is never ordered in one task.
    """
    columns = df.columns
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    work_dir(df.sparkSession)
    rows = rows.checkpoint()
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition, whatever the table holds
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    within = F.col("_row") - F.shiftleft(F.col("_part").cast("long"), 33)
    return rows.join(F.broadcast(before), "_part").select(
        *columns, (within + F.col("_before") + 1 + offset).alias(name)
    )


# --- generic upsert ---------------------------------------------------------


def upsert(
    state: DataFrame, batch: DataFrame, keys: list[str], policies: dict[str, str], insert: bool = True
) -> DataFrame:
    """Update stored rows by key and, if wanted, insert the missing ones.

    ``batch`` must be unique by ``keys``. Policy per column: ``batch_wins`` (a non-null
    batch value), ``state_wins`` (only fill a NULL), ``keep_if_blank`` (only fill NULL
    or empty text, never with empty text), ``overwrite``, ``least`` and ``greatest`` (of both, NULL aside). Other columns are kept.
    """
    news = batch.select(*keys, *[F.col(name).alias(f"_{name}") for name in policies], F.lit(True).alias("_hit"))
    joined = state.join(news, keys, "left")

    def merged(name: str) -> Column:
        old, new = F.col(name), F.col(f"_{name}")
        rule = {
            "batch_wins": F.coalesce(new, old),
            "state_wins": F.coalesce(old, new),
            "keep_if_blank": F.when((F.coalesce(old, F.lit("")) == "") & (new != ""), new).otherwise(old),
            "overwrite": F.when(F.col("_hit"), new).otherwise(old),
            "least": F.least(old, new),
            "greatest": F.greatest(old, new),
        }
        return rule[policies[name]].alias(name)

    updated = joined.select(*[merged(name) if name in policies else F.col(name) for name in state.columns])
    if not insert:
        return updated
    return updated.unionByName(r.missing_in(batch, state, keys).select(*state.columns))


def insert_absent(state: DataFrame, batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Append the batch rows whose key is new.

    Inside the batch the first in ``order`` counts; without it the batch must be unique by ``keys``.
    """
    return state.unionByName(absent_rows(state, batch, keys, order))


def absent_rows(state: DataFrame, batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Only the rows ``insert_absent`` appends."""
    if order:
        rest = [name for name in batch.columns if name not in (*keys, order)]
        first = F.min_by(F.struct(*rest), F.col(order))
        batch = batch.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")
    return r.missing_in(batch, state, keys).select(*state.columns)


def update_where(state: DataFrame, ids: DataFrame, key: str, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set ``values`` on the rows listed in ``ids`` (one column, any duplicates) that meet ``condition``."""
    name = ids.columns[0]
    marks = ids.select(F.col(name).alias(key)).distinct().withColumn("_hit", F.lit(True))
    joined = state.join(marks, key, "left")
    change = F.col("_hit").isNotNull() & F.coalesce(condition, F.lit(False))
    return joined.select(
        *[F.when(change, values[col]).otherwise(F.col(col)).alias(col) if col in values else F.col(col)
          for col in state.columns]
    )


# --- rows of the initial load -----------------------------------------------


def _typed(df: DataFrame, table: str) -> DataFrame:
    """All columns of a table, absent ones as NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[table]
    ])


def process_rows(batch: DataFrame, areas: DataFrame, now) -> DataFrame:
    rows = r.resolve_uf(batch, areas).select(
        "id", c.clamp(F.col("claim"), 50).alias("claim"), c.file_type_code(F.col("file_type_text")).alias("file_type"),
        "portal_status", "uf", F.lit(COMPANY).alias("company"), "opened",
        c.to_timestamp(F.col("occurred_text")).alias("occurred"), c.clamp(c.strip(F.col("phase")), 150).alias("phase"),
        "alert", stamp(now).alias("loaded_at"), F.lit(1).alias("active"),
    )
    return _typed(rows, "process")


def queue_rows(batch: DataFrame, now) -> DataFrame:
    rows = batch.select(
        surrogate_key("id").alias("id"), F.col("id").alias("process"), F.lit(1).alias("status"),
        F.lit(0).alias("attempts"), stamp(now).alias("loaded_at"), F.lit(1).alias("active"),
    )
    return _typed(rows, "queue")


def _or_null(name: str, length: int) -> Column:
    text = c.clamp(c.strip(F.col(name)), length)
    return F.when(text != "", text).alias(name)


def vehicle_rows(batch: DataFrame, now) -> DataFrame:
    rows = batch.select(
        surrogate_key("id").alias("id"), F.col("id").alias("process"),
        c.clamp(c.clean_plate(F.col("plate")), 10).alias("plate"),
        _or_null("chassis", 50), _or_null("brand", 50), _or_null("model", 100), _or_null("submodel", 150),
        c.parse_year(F.col("year_text")).alias("year"),
        c.to_money(c.parse_money(F.col("value_text"))).alias("value"), "encumbered", stamp(now).alias("loaded_at"),
    )
    return _typed(rows, "vehicle")


def party_rows(batch: DataFrame, now) -> DataFrame:
    """Insured always; broker and insurer analyst when they have a name."""

    def entry(kind: Column, name: Column, tax_id: Column) -> Column:
        return F.struct(kind.alias("type"), name.alias("name"), tax_id.alias("tax_id"))

    nothing = F.lit(None).cast("string")
    people = F.array(
        entry(c.party_type_code(F.col("file_type_text")),
              c.clamp(c.strip(F.coalesce(F.col("insured_name"), F.lit(""))), 150),
              c.clamp(c.strip(F.col("tax_id")), 20)),
        entry(F.lit(3), c.text_or_null(F.col("broker_name"), 150), nothing),
        entry(F.lit(4), c.text_or_null(F.col("analyst_name"), 150), nothing),
    )
    rows = (
        batch.select(F.col("id").alias("process"), F.explode(people).alias("p"))
        .filter(F.col("p.name").isNotNull())
        .select("process", "p.*", stamp(now).alias("loaded_at"))
        .withColumn("id", surrogate_key("process", "type"))
    )
    return _typed(rows, "party")


def contact_rows(batch: DataFrame, now) -> DataFrame:
    """Every insured e-mail, one phone per insured and broker, one e-mail per broker and analyst."""
    shape = "struct<kind: int, type: int, area: int, value: string, place: int>"

    def entry(kind: Column, kind_of_contact: int, area: Column, value: Column, place: Column = F.lit(0)) -> Column:
        return F.struct(
            kind.cast("int").alias("kind"), F.lit(kind_of_contact).alias("type"), area.cast("int").alias("area"),
            value.alias("value"), place.cast("int").alias("place"),
        )

    insured, broker, analyst = c.party_type_code(F.col("file_type_text")), F.lit(3), F.lit(4)
    no_area = F.lit(None).cast("int")
    phone = c.clean_phone(F.col("insured_phone"), F.col("ddd"))
    broker_phone = c.clean_phone(F.col("broker_phone"), F.col("broker_ddd"))

    def named(name: str, value: Column) -> Column:
        return F.when(c.nullify(F.col(name)).isNotNull(), value)

    single = F.array(
        entry(insured, 2, phone["area"], c.clamp(phone["number"], 150)),
        entry(broker, 3, no_area, named("broker_name", c.clamp(c.strip(F.col("broker_email")), 150))),
        entry(broker, 2, broker_phone["area"], named("broker_name", c.clamp(broker_phone["number"], 150))),
        entry(analyst, 3, no_area, named("analyst_name", c.clamp(c.strip(F.col("analyst_email")), 150))),
    )
    emails = F.transform(
        c.email_parts(F.col("insured_email")), lambda email, place: entry(insured, 3, no_area, email, place)
    )
    everything = F.concat(F.coalesce(emails, F.array().cast(f"array<{shape}>")), single)
    rows = r.valid_contact(
        batch.select(F.col("id").alias("process"), F.explode(everything).alias("e")).select("process", "e.*")
    )
    rows = rows.select(
        surrogate_key("process", "kind", "type", "place").alias("id"), "process",
        F.xxhash64("process", F.col("kind")).alias("party"), "type", "area", "value", F.lit(1).alias("principal"),
        stamp(now).alias("loaded_at"),
    )
    return _typed(rows, "contact")


def event_rows(batch: DataFrame, now) -> DataFrame:
    rows = dated_events(batch).select(
        F.col("id").alias("process"), F.col("event_id").alias("event"), "text", "happened_at", stamp(now).alias("loaded_at")
    )
    return _typed(rows, "event")


def dated_events(batch: DataFrame, need_id: bool = False) -> DataFrame:
    """Dated events with cleansed text."""
    rows = n.valid_events(n.explode_events(batch), need_id)
    return rows.withColumn("text", F.coalesce(c.text_or_null(F.col("text"), 200), F.lit("")))


def step_rows(batch: DataFrame, now) -> DataFrame:
    rows = batch.filter(F.col("cycle") > 0).select(
        F.col("id").alias("process"), F.col("cycle").alias("task"), c.clamp(F.col("task_name"), 200).alias("name"),
        c.clamp(F.col("task_status"), 50).alias("status"), stamp(now).alias("happened_at"), stamp(now).alias("loaded_at"),
    )
    return _typed(rows, "step")


def document_rows(batch: DataFrame, now) -> DataFrame:
    """One row per (process, name); the last status in the list counts."""
    rows = n.explode_documents(batch).groupBy(F.col("id").alias("process"), "name").agg(
        F.max_by("status", "position").alias("status")
    )
    return _typed(rows.withColumn("loaded_at", stamp(now)), "document")


def sla_rows(batch: DataFrame, now) -> DataFrame:
    rows = batch.select(
        surrogate_key("id").alias("id"), F.col("id").alias("process"), F.col("opened").alias("received"),
        stamp(now).alias("captured"), F.lit(PENDING_SLA).alias("status"),
    )
    return _typed(rows, "sla")


def user_rows(batch: DataFrame) -> DataFrame:
    """One row per user; the first login in order counts."""
    rows = batch.filter(F.col("user_id") > 0).groupBy(F.col("user_id").alias("id")).agg(
        F.min_by("user_name", "_order").alias("login")
    )
    return _typed(rows.withColumn("name", F.col("login")), "robot_user")


def user_history_rows(batch: DataFrame, now) -> DataFrame:
    rows = batch.filter(F.col("user_id") > 0).select(
        F.col("id").alias("process"), "user_id", stamp(now).alias("entered_at"), F.lit(1).alias("is_current")
    )
    return _typed(rows, "user_history")


# --- dictionaries -----------------------------------------------------------


def new_labels(dictionary: DataFrame, batch: DataFrame, prefix: str, upgrade: bool, **defaults) -> DataFrame:
    """One dictionary row per code of the batch: the best label, or the first one without ``upgrade``."""
    rank = F.struct(_is_waiting("label", prefix).alias("waiting"), F.col("_order")) if upgrade else F.struct("_order")
    news = batch.groupBy("code").agg(F.min_by("label", rank).alias("label"))
    for name, value in defaults.items():
        news = news.withColumn(name, F.lit(value))
    return news.select(*[
        (F.col(f) if f in news.columns else F.lit(None)).cast(dictionary.schema[f].dataType).alias(f)
        for f in dictionary.columns
    ])


def grow_dictionary(dictionary: DataFrame, batch: DataFrame, prefix: str, upgrade: bool = True, **defaults) -> DataFrame:
    """Add new codes; replace a placeholder label by a real one.

    ``batch`` holds (code, label, _order) with any number of rows per code. A real
    label beats a placeholder; among equals the first in order counts. Without
    ``upgrade`` the first label counts as it is and stored labels stay.
    """
    waiting = _is_waiting("label", prefix)
    news = new_labels(dictionary, batch, prefix, upgrade, **defaults)
    out = dictionary
    if upgrade:
        side = news.filter(~waiting).select("code", F.col("label").alias("_label"))
        better = F.when(waiting & F.col("_label").isNotNull(), F.col("_label")).otherwise(F.col("label"))
        out = dictionary.join(side, "code", "left").withColumn("label", better).select(*dictionary.columns)
    return out.unionByName(r.missing_in(news, dictionary, ["code"]).select(*dictionary.columns))


def _is_waiting(label: str, prefix: str) -> Column:
    return c.is_placeholder(F.col(label), prefix)


def status_labels(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col("portal_status") != 0).select(
        F.col("portal_status").alias("code"),
        c.label_or_placeholder(F.col("phase"), STATUS_PREFIX, F.col("portal_status")).alias("label"),
        F.struct("_order", F.lit(0).alias("position")).alias("_order"),
    )


def event_labels(batch: DataFrame) -> DataFrame:
    entries = batch.select("_order", F.posexplode("events").alias("position", "e")).filter(F.col("e.event_id") > 0)
    return entries.select(
        F.col("e.event_id").alias("code"),
        c.label_or_placeholder(F.col("e.text"), EVENT_PREFIX, F.col("e.event_id")).alias("label"),
        F.struct("_order", "position").alias("_order"),
    )


_DICTIONARIES = {
    "portal_status": (status_labels, STATUS_PREFIX, {"final": 0, "active": 1}),
    "workflow_event": (event_labels, EVENT_PREFIX, {"phase": NEW_EVENT_PHASE, "active": 1}),
}


def _history_rows(batch: DataFrame, now) -> DataFrame:
    return raw_latest_rows(batch, now).withColumn("capture_date", F.col("captured_at").cast("date"))


# --- load, backfill, sync ---------------------------------------------------


def unstored(state: State, batch: DataFrame) -> DataFrame:
    """The records of the batch that are not stored yet, materialised: a dozen tables read them."""
    work_dir(batch.sparkSession)
    return r.missing_in(batch, state["process"], ["id"]).checkpoint()


def stored(state: State, batch: DataFrame) -> DataFrame:
    """The records of the batch that are stored, materialised."""
    work_dir(batch.sparkSession)
    return r.exists_in(batch, state["process"], ["id"]).checkpoint()


def load_rows(state: State, new: DataFrame, now) -> State:
    """The rows the load adds to each table, for records that are not stored yet (``unstored``)."""
    labels = {
        name: absent_rows(state[name], new_labels(state[name], source(new), prefix, False, **defaults), ["code"])
        for name, (source, prefix, defaults) in _DICTIONARIES.items()
    }
    return {
        "process": process_rows(new, load_area_map(state["area_code"]), now),
        "queue": queue_rows(new, now),
        "vehicle": vehicle_rows(new, now),
        "party": party_rows(new, now),
        "contact": contact_rows(new, now),
        "event": event_rows(new, now),
        "step": step_rows(new, now),
        "document": document_rows(new, now),
        "raw_history": _history_rows(new, now),
        "raw_latest": absent_rows(state["raw_latest"], raw_latest_rows(new, now), ["id"]),
        "sla": absent_rows(state["sla"], sla_rows(new, now), ["process"]),
        "robot_user": absent_rows(state["robot_user"], user_rows(new), ["id"]),
        "user_history": absent_rows(state["user_history"], user_history_rows(new, now), ["process", "user_id"]),
        **labels,
    }


def with_rows(state: State, added: State) -> State:
    """The state with the added rows behind it."""
    return {**state, **{name: state[name].unionByName(rows) for name, rows in added.items()}}


def load_new(state: State, batch: DataFrame, now) -> State:
    """Split the records that are not stored yet over all tables."""
    added = load_rows(state, r.missing_in(batch, state["process"], ["id"]), now)
    return {name: state[name].unionByName(rows) for name, rows in added.items()}


def backfill_raw(raw_latest: DataFrame, captured: DataFrame) -> DataFrame:
    """The latest captures with those of a batch in place of the stored ones; a stored claim stays.

    Stored text is not joined with the text that replaces it: either is moved once, and the stored one not at all for a small batch.
    """
    claims = raw_latest.select("id", F.col("claim").alias("_claim"), F.lit(True).alias("_hit"))
    news = captured.join(claims, "id", "left").withColumn("claim", F.when(F.col("_hit"), F.col("_claim")).otherwise(F.col("claim")))
    kept = raw_latest.join(captured.select("id"), "id", "left_anti")
    return kept.unionByName(news.select(*raw_latest.columns))


def backfill_process(process: DataFrame, batch: DataFrame) -> DataFrame:
    news = batch.select(
        "id", "opened", c.to_timestamp(F.col("occurred_text")).alias("occurred"),
        c.clamp(c.strip(F.col("phase")), 150).alias("phase"), "portal_status", "alert",
    )
    return upsert(process, news, ["id"], {
        "opened": "state_wins", "occurred": "state_wins", "phase": "batch_wins", "portal_status": "batch_wins",
        "alert": "overwrite",
    }, insert=False)


def backfill_vehicle(vehicle: DataFrame, batch: DataFrame) -> DataFrame:
    """Overwrite everything but the chassis; texts are clamped as they come."""
    news = batch.select(
        F.col("id").alias("process"), c.clamp(F.coalesce(F.col("plate"), F.lit(c.PLATE_PLACEHOLDER)), 10).alias("plate"),
        c.clamp(F.col("brand"), 50).alias("brand"), c.clamp(F.col("model"), 100).alias("model"), _or_null("submodel", 150),
        c.parse_year(F.col("year_text")).alias("year"),
        c.to_money(c.parse_money(F.col("value_text"))).alias("value"), "encumbered",
    )
    columns = [name for name in news.columns if name != "process"]
    return upsert(vehicle, news, ["process"], dict.fromkeys(columns, "overwrite"), insert=False)


def backfill_events(event: DataFrame, batch: DataFrame, now, news: DataFrame | None = None) -> DataFrame:
    """Insert unseen (process, event); fill a blank stored text, and nothing else.

    Inside the batch the first entry is inserted and the first non-blank text fills it. ``news`` is ``event_news`` where it is kept.
    """
    return upsert(event, event_news(batch, now) if news is None else news, ["process", "event"], {"text": "keep_if_blank"})


def event_news(batch: DataFrame, now) -> DataFrame:
    """One row per (process, event) of a backfill."""
    entries = dated_events(batch, need_id=True).withColumnsRenamed({"id": "process", "event_id": "event"})
    spoken = F.min_by("text", F.when(F.col("text") != "", F.col("position")))
    return entries.groupBy("process", "event").agg(
        F.coalesce(spoken, F.lit("")).alias("text"), F.min_by("happened_at", "position").alias("happened_at")
    ).withColumn("loaded_at", stamp(now))


def _as_made(rows: DataFrame, name: str) -> DataFrame:
    return rows


def backfill_documents(document: DataFrame, batch: DataFrame, now, keep: Keep = _as_made) -> DataFrame:
    return upsert(document, keep(document_rows(batch, now), "papers"), ["process", "name"], {"status": "overwrite"})


def backfill_analyst(party: DataFrame, contact: DataFrame, batch: DataFrame, now, keep: Keep = _as_made) -> State:
    """Insert the insurer analyst where absent; insert or replace the e-mail of the stored one."""
    named = batch.filter(c.nullify(F.col("analyst_name")).isNotNull())
    rows = r.party_of_type(party_rows(named, now), 4)
    stored = r.party_of_type(party, 4)
    parties = party.unionByName(r.missing_in(rows, stored, ["process"]))
    holder = r.party_key(r.party_of_type(parties, 4).join(rows.select("process"), "process", "left_semi")).drop("type")
    emails = named.select(
        F.col("id").alias("process"), c.clamp(c.strip(F.col("analyst_email")), 150).alias("value")
    ).filter(F.col("value").contains("@"))
    news = emails.join(holder, "process").select(
        F.xxhash64("party", F.lit(3), F.lit(0)).alias("id"), "process", "party", F.lit(3).alias("type"),
        F.lit(None).cast("int").alias("area"), "value", F.lit(1).alias("principal"), stamp(now).alias("loaded_at"),
    )
    return {"party": parties, "contact": upsert(contact, keep(news, "emails"), ["process", "party", "type"], {"value": "overwrite"})}


def backfill_changes(state: State, known: DataFrame, now, events: DataFrame | None = None, keep: Keep = _as_made) -> tuple[State, State]:
    """(rewritten tables, added rows) of a backfill; ``known`` holds stored processes only.

    An upsert reads its news twice. A run writes them once: ``keep`` does so, and ``events`` are the ``event_news`` kept already.
    """
    rewritten = {
        "raw_latest": backfill_raw(state["raw_latest"], raw_latest_rows(known, now)),
        "process": backfill_process(state["process"], known),
        "vehicle": backfill_vehicle(state["vehicle"], known),
        "event": backfill_events(state["event"], known, now, events),
        "document": backfill_documents(state["document"], known, now, keep),
        **backfill_analyst(state["party"], state["contact"], known, now, keep),
        **{name: grow_dictionary(state[name], source(known), prefix, True, **defaults)
           for name, (source, prefix, defaults) in _DICTIONARIES.items()},
    }
    added = {
        "raw_history": _history_rows(known, now),
        "sla": absent_rows(state["sla"], sla_rows(known, now), ["process"]),
        "robot_user": absent_rows(state["robot_user"], user_rows(known), ["id"]),
        "user_history": absent_rows(state["user_history"], user_history_rows(known, now), ["process", "user_id"]),
    }
    return rewritten, added


def backfill(state: State, batch: DataFrame, now) -> State:
    """Refresh stored processes with everything a full record carries."""
    rewritten, added = backfill_changes(state, r.exists_in(batch, state["process"], ["id"]), now)
    return {**rewritten, **{name: state[name].unionByName(rows) for name, rows in added.items()}}


def sync_changes(state: State, known: DataFrame, now) -> tuple[State, State]:
    """(rewritten tables, added rows) of a sync; ``known`` holds stored processes only (``stored``)."""
    news = known.select("id", c.clamp(c.strip(F.col("phase")), 150).alias("phase"), "portal_status", "alert")
    process = upsert(state["process"], news, ["id"], {
        "phase": "batch_wins", "portal_status": "batch_wins", "alert": "overwrite"}, insert=False)
    entries = n.valid_events(n.explode_events(known), need_id=False).select(
        F.col("id").alias("process"), F.col("event_id").alias("event"), c.clamp(F.col("text"), 200).alias("text"),
        "happened_at", stamp(now).alias("loaded_at"), "position",
    )
    return {"process": process}, {
        "event": absent_rows(state["event"], entries, ["process", "event"], order="position"),
        "step": absent_rows(state["step"], step_rows(known, now), ["process", "task"]),
    }


def sync_known(state: State, batch: DataFrame, now) -> State:
    """Phase, status and alert of stored processes; unseen events and steps are appended."""
    rewritten, added = sync_changes(state, r.exists_in(batch, state["process"], ["id"]), now)
    return {**rewritten, **{name: state[name].unionByName(rows) for name, rows in added.items()}}


# --- exits, repairs, reconciliation -----------------------------------------


def disappeared(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Open (user, process) pairs of the users in the batch that the batch no longer shows."""
    pairs = batch.select("user_id", F.col("id").alias("process")).dropna()
    # few users: their list is the small side, and the history stays where it is
    users = pairs.select("user_id").distinct()
    active = history.filter(F.col("is_current") == 1).select("user_id", "process").join(users, "user_id", "left_semi")
    return r.missing_from(active, pairs, ["user_id", "process"]).distinct()


def close_disappeared(history: DataFrame, queue: DataFrame, batch: DataFrame, now) -> State:
    """Close what left the portal: history gets an exit, pending queue rows are retired.

    Use the batch before deduplication (the same process may be listed by two users),
    and only if it was read completely. Users without any row in it are not touched.
    """
    work_dir(batch.sparkSession)
    return close_gone(history, queue, disappeared(history, batch).checkpoint(), now)


def close_gone(history: DataFrame, queue: DataFrame, gone: DataFrame, now) -> State:
    """``close_disappeared`` for the (user, process) pairs that are gone."""
    # by process alone, as the tables are kept; a process has few users
    marks = gone.groupBy("process").agg(F.collect_set("user_id").alias("_users"))
    left = history.join(marks, "process", "left")
    hit = F.coalesce(F.array_contains("_users", F.col("user_id")), F.lit(False))
    closed = left.withColumns({
        "left_at": F.when(hit, stamp(now)).otherwise(F.col("left_at")),
        "is_current": F.when(hit, 0).otherwise(F.col("is_current")),
    }).select(*history.columns)
    retired = update_where(queue, gone.select("process"), "process", F.col("status") == 1, {
        "status": F.lit(2), "message": F.lit(GONE_MESSAGE), "last_attempt": stamp(now)})
    return {"user_history": closed, "queue": retired}


def repair_opening(process: DataFrame, events: DataFrame, floor) -> DataFrame:
    """A missing or too early opening date becomes the first event on or after ``floor``."""
    return repair_from(process, r.min_event(events, floor), floor)


def repair_from(process: DataFrame, first_events: DataFrame, floor) -> DataFrame:
    """``repair_opening`` from the first event per process (process, first_event)."""
    first = first_events.select(F.col("process").alias("id"), "first_event")
    bad = F.col("opened").isNull() | (F.col("opened") < stamp(floor))
    repaired = F.when(bad & F.col("first_event").isNotNull(), F.col("first_event")).otherwise(F.col("opened"))
    return process.join(first, "id", "left").withColumn("opened", repaired).select(*process.columns)


def reconcile(queue: DataFrame, view: DataFrame, stock: DataFrame, now) -> DataFrame:
    """Retire pending rows whose treated claim is already in the stock snapshot.

    ``view`` needs only the columns of ``views.ready_claims``; the full ready view works too.
    """
    claims = stock.select(F.col(stock.columns[0]).alias("sinistro_tratado"))
    found = r.exists_in(view.select("id_processo", "sinistro_tratado"), claims, ["sinistro_tratado"])
    return update_where(queue, found.select("id_processo"), "process", F.col("status") == 1, {
        "status": F.lit(2), "message": F.lit(RECONCILED_MESSAGE), "last_attempt": stamp(now)})


# --- audit ------------------------------------------------------------------


def stale_open(process: DataFrame, now, days: int = STALE_DAYS, closed: tuple[int, ...] = (CLOSED_STATUS, CANCELLED_STATUS)) -> DataFrame:
    """Processes still open after ``days`` calendar days. An unknown status does not count as open."""
    age = F.date_diff(stamp(now).cast("date"), F.col("opened").cast("date"))
    return process.filter(~F.col("portal_status").isin(*closed) & (age > days))


def snapshot_status(status: Column, text: Column) -> Column:
    """Status by number, else by the words of the status text."""
    words = F.upper(F.coalesce(text, F.lit("")))
    return (
        F.when(status != 0, status)
        .when(words.contains("FINALIZADO") | words.contains("CONCLU"), CLOSED_STATUS)
        .when(words.contains("CANCELADO"), CANCELLED_STATUS)
    )


def audited(process: DataFrame, snapshot: DataFrame, now) -> DataFrame:
    """(id, found): stale processes with the status the snapshot (process, status, status_text) shows.

    Of several rows of a process the latest ``captured_at`` counts, where the snapshot has it, then the highest status.
    """
    found = snapshot_status(F.col("status"), F.col("status_text"))
    taken = [F.col("captured_at")] if "captured_at" in snapshot.columns else []
    seen = snapshot.filter(found.isNotNull()).groupBy("process").agg(F.max_by(found, F.struct(*taken, found)).alias("found"))
    return stale_open(process, now).select("id").join(seen.withColumnRenamed("process", "id"), "id", "left")


def audit_close(state: State, snapshot: DataFrame, now) -> State:
    """Close the stale processes that the snapshot shows as finished or cancelled."""
    return close_found(state, closing_rows(state["process"], snapshot, now), now)


def closing_rows(process: DataFrame, snapshot: DataFrame, now) -> DataFrame:
    """(id, found) of the stale processes that the snapshot shows as finished or cancelled."""
    return audited(process, snapshot, now).filter(F.col("found").isin(CLOSED_STATUS, CANCELLED_STATUS))


def close_found(state: State, closing: DataFrame, now) -> State:
    """Process, queue and history with the ``closing_rows`` closed."""
    news = closing.select(
        "id", F.when(F.col("found") == CLOSED_STATUS, CLOSED_PHASE).otherwise(CANCELLED_PHASE).alias("phase"),
        F.col("found").alias("portal_status"), F.lit(0).alias("alert"),
    )
    ids = closing.select("id")
    return {
        "process": upsert(state["process"], news, ["id"], dict.fromkeys(("phase", "portal_status", "alert"), "overwrite"),
                          insert=False),
        "queue": update_where(state["queue"], ids, "process", F.lit(True), {"active": F.lit(0)}),
        "user_history": update_where(state["user_history"], ids, "process", F.col("is_current") == 1, {
            "left_at": stamp(now), "is_current": F.lit(0)}),
    }


def audit_counts(process: DataFrame, snapshot: DataFrame, now) -> DataFrame:
    closed = F.coalesce(F.col("found").isin(CLOSED_STATUS, CANCELLED_STATUS), F.lit(False))
    return audited(process, snapshot, now).agg(
        F.count_if(closed).alias("closed"), F.count_if(~closed).alias("still_open"))


# --- outcomes ---------------------------------------------------------------


def outcome_status(code: Column) -> Column:
    return F.when(code.isin(200, 201), 2).when(code == 409, 4).otherwise(3)


def apply_outcomes(queue: DataFrame, outcomes: DataFrame, now) -> DataFrame:
    """Queue rows after a send attempt: (queue_id, status, message, slot) of ``outcomes``.

    Of several outcomes of one queue row the latest slot counts, so a queue row stays one row.
    """
    one = r.top1(outcomes, ["queue_id"], [F.col("slot").desc_nulls_last(), F.col("status"), F.col("message")])
    news = one.select(
        F.col("queue_id").alias("id"), F.col("status").alias("_status"), F.col("message").alias("_message"),
        F.col("slot").alias("_slot"), F.lit(True).alias("_hit"),
    )
    hit = F.col("_hit").isNotNull()
    joined = queue.join(news, "id", "left")
    changed = {
        "status": F.col("_status"), "message": F.col("_message"), "slot": F.col("_slot"),
        "attempts": F.col("attempts") + 1, "last_attempt": stamp(now),
    }
    return joined.withColumns(
        {name: F.when(hit, value).otherwise(F.col(name)) for name, value in changed.items()}
    ).select(*queue.columns)


def stamp_sla(sla: DataFrame, outcomes: DataFrame, now) -> DataFrame:
    """Sent time and minutes in the queue on the first success, never again."""
    sent = outcomes.filter(F.col("status") == 2).select("process")
    return update_where(sla, sent, "process", F.col("sent").isNull(), {
        "sent": stamp(now), "queue_minutes": c.minute_boundaries(F.col("captured"), stamp(now))})


def notifications(outcomes: DataFrame) -> DataFrame:
    """Outcomes worth a message: a success, or an error other than a conflict."""
    return outcomes.filter(F.col("status").isin(2, 3))
