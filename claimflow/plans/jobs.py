"""The three runs: capture, enrichment and audit, on committed state tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce, wraps

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimflow.functions.clock import stamp
from claimflow.operators import normalise as n
from claimflow.operators import relational as r
from claimflow.operators import summaries as m
from claimflow.operators import transitions as t
from claimflow.plans import dispatch as d
from claimflow.plans.views import ready_keys, ready_queue
from claimflow.session import dropped, saved, saved_bytes, tidy, work_dir
from claimflow.sources.tables import APPENDED, KEYED, CommitRefused, StateTables, api_log_rows, append_log, bucket_of, close_run, notification_log_rows, open_run

# Events before this date do not count for the opening date; how a run ends; what a send is logged as.
EVENT_FLOOR = "2026-01-01 00:00:00"
SUCCESS, FAILURE = "SUCESSO", "ERRO"
SUCCESS_MESSAGE = "Execução concluída com êxito."
FAILURE_MESSAGE = "Falha Crítica: "
SEND_TARGET, SEND_ACTION = "PlataformaGestao", "POST_ACIONAMENTO"


@dataclass
class RunResult:
    committed: bool
    changed: tuple[str, ...] = ()
    metrics: DataFrame | None = None  # read, new, known


def _tidy(run: Callable[..., RunResult]) -> Callable[..., RunResult]:
    @wraps(run)
    def cleaned(store: StateTables, *args, **kwargs) -> RunResult:
        with tidy(store.spark):
            return run(store, *args, **kwargs)

    return cleaned


def prepared(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Standardised records as read, and one per process. Written once: every table reads its columns of them.

    Only records whose process is listed several times are shuffled.
    """
    seen = saved(n.standardise(records), "seen")
    several = saved(seen.groupBy("id").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select("id"), "several")
    listed = r.first_per_key(seen.join(several, "id", "left_semi"), "id", "_order")
    return seen, seen.join(several, "id", "left_anti").unionByName(listed)


def _joined(*parts: t.State) -> t.State:
    """Added rows of several steps, per table."""
    out: t.State = {}
    for part in parts:
        for name, rows in part.items():
            out[name] = out[name].unionByName(rows) if name in out else rows
    return out


def marked(batch: DataFrame, process: DataFrame, part: Column | None = None) -> tuple[DataFrame, dict[str, int]]:
    """The batch with ``_known``, whether its process is stored, materialised; and what was counted while it was written.

    With ``part``, the number of its part, the rows are kept by ``_part``, so that who stages one reads no others.
    """
    seen = Observation("batch")
    # written before: Spark knows how few they are before it moves whole records
    stored = saved(r.stored_keys(batch, process, ["id"]), "stored")
    rows = batch.join(stored.withColumn("_known", F.lit(True)), "id", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(~F.col("_known")).alias("new"), F.count_if("_known").alias("known"))
    marked = saved(rows, "marked") if part is None else saved(rows.withColumn("_part", part), "marked", "_part")
    dropped(stored)
    return marked, seen.get


def _kept_captures(state: t.State, new: DataFrame) -> DataFrame:
    """Stored captures of new records, by id alone. There are hardly any: written before, they move no raw text of the batch."""
    return saved(r.stored_keys(new, state["raw_latest"], ["id"]), "captures")


def _added_facts(added: t.State, extra: DataFrame | None = None) -> DataFrame:
    history = added["user_history"] if extra is None else added["user_history"].unionByName(extra, allowMissingColumns=True)
    return m.summarised(added["event"], added["step"], history, EVENT_FLOOR)


def _exits(processes: DataFrame, now) -> DataFrame:
    """History rows that only say when a process left."""
    return processes.select("process", F.lit(None).cast("int").alias("user_id"), stamp(now).alias("left_at"))


def capture_changes(state: t.State, batch: DataFrame, gone: DataFrame | None, now) -> tuple[t.State, t.State]:
    """Load, sync, exits and opening dates, in this order: (rewritten tables, added rows).

    ``batch`` is ``marked``; ``gone`` lists the (user, process) pairs that left. The state needs no other buckets
    than those of both: the first event of a process is kept in its summary.
    """
    work_dir(batch.sparkSession)
    rows, new = batch.drop("_known"), batch.filter("NOT _known").drop("_known")
    loaded = t.load_rows({**state, "raw_latest": t._typed(_kept_captures(state, new), "raw_latest")}, new, now)
    middle = t.with_rows(state, loaded)
    # what was new is stored by now
    rewritten, synced = t.sync_changes(middle, rows, now)
    added = _joined(loaded, synced)
    added = {**added, "event": saved(added["event"], "event"), "step": saved(added["step"], "step")}  # stored, and summarised
    after = {**t.with_rows(state, added), **rewritten}
    facts = _added_facts(added, None if gone is None else _exits(gone, now))
    rewritten["summary"] = saved(m.merged(state["summary"], facts), "summary")
    if gone is not None:
        rewritten = {**rewritten, **t.close_gone(after["user_history"], after["queue"], gone, now)}
    rewritten["process"] = t.repair_from(rewritten["process"], rewritten["summary"], EVENT_FLOOR)
    return rewritten, {name: rows for name, rows in added.items() if name not in rewritten}


def enrichment_changes(state: t.State, batch: DataFrame, now) -> tuple[t.State, t.State]:
    """Load what is new, backfill what was known before: (rewritten tables, added rows). ``batch`` is ``marked``."""
    work_dir(batch.sparkSession)
    known, new = batch.filter("_known").drop("_known"), batch.filter("NOT _known").drop("_known")
    loaded = t.load_rows({**state, "raw_latest": t._typed(_kept_captures(state, new), "raw_latest")}, new, now)
    events = saved(t.event_news(known, now), "events")
    # no process is both new and known: what is loaded of a table kept by process goes through no join with what is backfilled
    rewritten, filled = t.backfill_changes({**t.with_rows(state, loaded), **{name: state[name] for name in KEYED}}, known, now, events, saved)
    rewritten = {name: rows.unionByName(loaded[name]) if name in KEYED else rows for name, rows in rewritten.items()}
    added = _joined(loaded, filled)
    added["user_history"] = saved(added["user_history"], "users")  # stored, and summarised
    inserted = r.missing_in(events, state["event"], ["process", "event"])
    facts = _added_facts({**added, "event": loaded["event"].unionByName(inserted.select(*loaded["event"].columns))})
    rewritten["summary"] = m.merged(state["summary"], saved(facts, "facts"))
    return rewritten, {name: rows for name, rows in added.items() if name not in rewritten}


def _shared(changes: t.State) -> t.State:
    """Of the tables those that are not kept by process."""
    return {name: rows for name, rows in changes.items() if name not in KEYED and name not in APPENDED}


def _shared_of_capture(state: t.State, batch: DataFrame, now) -> tuple[t.State, t.State]:
    return {}, _shared(t.load_rows(state, batch.filter("NOT _known").drop("_known"), now))


def _shared_of_enrichment(state: t.State, batch: DataFrame, now) -> tuple[t.State, t.State]:
    known, new = batch.filter("_known").drop("_known"), batch.filter("NOT _known").drop("_known")
    loaded = t.load_rows(state, new, now)
    rewritten, filled = t.backfill_changes(t.with_rows(state, loaded), known, now)
    return _shared(rewritten), {name: rows for name, rows in _shared(_joined(loaded, filled)).items() if name not in rewritten}


Changes = Callable[..., tuple[t.State, t.State]]


def _commit_batch(
    store: StateTables, version: int, batch: DataFrame, parts: list[list[int]], changes: Changes, shared: Changes, now, marker: str | None = None,
) -> tuple[str, ...]:
    """Commit a ``marked`` batch; returns the changed tables.

    Each of several ``parts`` is made of its own rows of the batch and of the store alone. What is not kept by process is made of the whole batch, with the first.
    """
    changed: dict[str, None] = {}

    def made(number: int) -> tuple[t.State, t.State]:
        own, whole = batch, None
        if len(parts) > 1:
            own = batch.filter(F.col("_part") == number).drop("_part")
            whole = shared(store.load(), batch.drop("_part"), now) if number == 0 else ({}, {})
        rewritten, added = changes(store.load(buckets=parts[number]), own, parts[number])
        if whole is not None:
            kept = [{name: rows for name, rows in tables.items() if name in KEYED or name in APPENDED} for tables in (rewritten, added)]
            rewritten, added = kept[0] | whole[0], kept[1] | whole[1]
        changed.update(dict.fromkeys((*rewritten, *added)))
        return rewritten, added

    _commit(store, version, {}, None, marker, sorted(bucket for part in parts for bucket in part), parts=[partial(made, number) for number in range(len(parts))])
    return tuple(changed)


def _part(parts: list[list[int]], buckets: int) -> Column | None:
    """The number of the part that a record belongs to, if there are several."""
    number = reduce(lambda rest, i: F.when(bucket_of(F.col("id"), buckets).isin(parts[i]), i).otherwise(rest), range(1, len(parts)), F.lit(0))
    return number if len(parts) > 1 else None


def _commit(
    store: StateTables, version: int, rewritten: t.State, added: t.State | None = None, marker: str | None = None, buckets: list[int] | None = None,
    parts: list[Callable[[], tuple[t.State, t.State]]] | None = None,
) -> None:
    if not store.commit(version, rewritten, added, marker, buckets, parts=parts):
        raise CommitRefused(f"version {version} was committed by another run")


def _metrics(spark: SparkSession, counted: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(counted["read"], counted["new"], counted["known"])], "read long, new long, known long")


@_tidy
def capture(
    store: StateTables, records: DataFrame, now, version: int | None = None, complete: bool = True, marker: str | None = None,
    by_id: DataFrame | None = None, follow_up: DataFrame | None = None,
) -> RunResult:
    """Capture run over listed records and, where they landed, their details. Without ``version`` it takes the next one; a given one that is committed is skipped, and so is a booked ``marker``.

    ``complete`` says that every page was read; otherwise nothing counts as gone. Only the buckets of the
    batch and of what is gone are read and written.
    """
    last = store.version()
    version = last + 1 if version is None else version
    if version <= last or marker is not None and store.booked(marker):
        return RunResult(False)
    if by_id is not None or follow_up is not None:
        records = n.merge_layers(records, by_id, follow_up)
    seen, batch = prepared(records)
    gone, touched = None, batch.select(F.col("id").alias("process"))
    if complete:
        gone = saved(t.disappeared(store.load("user_history")["user_history"], seen), "gone")
        touched = touched.union(gone.select("process"))
    buckets = store.touched(touched)
    parts = store.parts(saved_bytes(seen), buckets)
    batch, counted = marked(batch, store.load("process", buckets=buckets)["process"], _part(parts, store.buckets))
    dropped(seen)

    def changes(before: t.State, rows: DataFrame, part: list[int]) -> tuple[t.State, t.State]:
        left = gone if gone is None or len(parts) == 1 else gone.filter(bucket_of(F.col("process"), store.buckets).isin(part))
        return capture_changes(before, rows, left, now)

    changed = _commit_batch(store, version, batch, parts, changes, _shared_of_capture, now, marker)
    dropped(batch)
    return RunResult(True, changed, _metrics(store.spark, counted))


@_tidy
def enrich(store: StateTables, records: DataFrame, now, version: int | None = None) -> RunResult:
    """Enrichment run over full records; reads and writes the buckets of the batch."""
    last = store.version()
    version = last + 1 if version is None else version
    if version <= last:
        return RunResult(False)
    seen, batch = prepared(records)
    buckets = store.touched(batch.select("id"))
    parts = store.parts(saved_bytes(seen), buckets)
    batch, counted = marked(batch, store.load("process", buckets=buckets)["process"], _part(parts, store.buckets))
    dropped(seen)
    changed = _commit_batch(store, version, batch, parts, lambda before, rows, _: enrichment_changes(before, rows, now), _shared_of_enrichment, now)
    dropped(batch)
    return RunResult(True, changed, _metrics(store.spark, counted))


def summarise(store: StateTables, version: int | None = None) -> RunResult:
    """Build the summaries of all processes anew, for a store that was filled in another way."""
    version = store.version() + 1 if version is None else version
    state = store.load("event", "step", "user_history")
    _commit(store, version, {"summary": m.summarised(state["event"], state["step"], state["user_history"], EVENT_FLOOR)})
    return RunResult(True, ("summary",))


def logged(spark: SparkSession, log: str, run_id: str, clock: Callable[[], datetime], run: Callable[[], RunResult]) -> RunResult:
    """Do a run between an opening and a closing row of the run log."""
    append_log(open_run(spark, run_id, clock()), log)
    nothing = spark.range(1).select(F.lit(0).alias("read"), F.lit(0).alias("new"))
    try:
        result = run()
        closing = close_run(nothing if result.metrics is None else result.metrics, run_id, clock(), SUCCESS, SUCCESS_MESSAGE)
    except Exception as error:
        append_log(close_run(nothing, run_id, clock(), FAILURE, f"{FAILURE_MESSAGE}{error}"), log)
        raise
    append_log(closing, log)
    return result


@_tidy
def audit(store: StateTables, snapshot: DataFrame, now, version: int | None = None) -> RunResult:
    """Close what the snapshot shows as finished; only the buckets of these processes are written."""
    version = store.version() + 1 if version is None else version
    closing = saved(t.closing_rows(store.load("process")["process"], snapshot, now), "closing")
    buckets = store.touched(closing.select("id"))
    before = store.load("process", "queue", "user_history", "summary", buckets=buckets)
    left = before["user_history"].filter("is_current = 1").join(closing.select(F.col("id").alias("process")), "process", "left_semi")
    changed = t.close_found(before, closing, now)
    changed["summary"] = m.merged(before["summary"], _exits(left.select("process").distinct(), now))
    _commit(store, version, changed, buckets=buckets)
    return RunResult(True, tuple(changed))


def outbox(store: StateTables, now) -> DataFrame:
    """Slots and payloads of everything ready to send."""

    def ready(buckets: list[int]) -> DataFrame:
        """The ready rows of some buckets: all rows of a process lie in one."""
        state = store.load(buckets=buckets)
        keys = saved(ready_keys(state), "keys")  # every table is cut down to them
        # written before they are ordered: that reads them twice, and what was moved to join them is gone by then
        return saved(ready_queue(state, summary=state["summary"], keys=keys), "ready")

    whole = reduce(DataFrame.unionByName, [ready(part) for part in store.parts(store.narrow_bytes())])
    return d.dispatch_batch(whole, store.load("parameter")["parameter"], now)


@_tidy
def dispatch(store: StateTables, now, run_id: str) -> RunResult:
    """Commit the outbox of a run, for the sender to read. A run that has one keeps it."""
    marker = f"dispatch:{run_id}"
    if store.booked(marker):
        return RunResult(False)
    version = store.version() + 1
    _commit(store, version, {}, {"outbox": outbox(store, now).withColumn("run_id", F.lit(run_id))}, marker)
    return RunResult(True, ("outbox",))


def _last_sent(sent: DataFrame) -> DataFrame:
    """Several parties multiply a queue row; the last one in the order of sending counts."""
    return r.top1(sent, ["id_fila"], [F.struct(*d.ORDER).desc(), F.col("data_agendada").desc()])


def _booked(sent: DataFrame, responses: DataFrame) -> DataFrame:
    work_dir(sent.sparkSession)
    one = _last_sent(sent).select(F.col("id_fila").alias("queue_id"), F.col("id_processo").alias("process"), F.col("data_agendada").alias("slot"))
    return saved(d.outcomes(one, responses), "outcomes")


def record_outcomes(store: StateTables, sent: DataFrame, responses: DataFrame, now, version: int | None = None) -> DataFrame:
    """Book the responses of an outbox; returns the outcomes worth a message."""
    version = store.version() + 1 if version is None else version
    booked = _booked(sent, responses)
    buckets = store.touched(booked.select("process"))
    before = store.load("queue", "sla", buckets=buckets)
    _commit(store, version, {
        "queue": t.apply_outcomes(before["queue"], booked, now), "sla": t.stamp_sla(before["sla"], booked, now)}, buckets=buckets)
    return t.notifications(booked)


@_tidy
def book(store: StateTables, run_id: str, responses: DataFrame, now, target: str = SEND_TARGET, to: str = d.NOTIFY_TO) -> RunResult:
    """Book the landed responses to a committed outbox: queue, SLA, a log row per send and per notification, in one commit.

    The notifications themselves are the payloads of the notification log. A run is booked once.
    """
    marker = f"book:{run_id}"
    if store.booked(marker):
        return RunResult(False)
    version = store.version() + 1
    sent = store.load("outbox")["outbox"].filter(F.col("run_id") == run_id)
    booked = _booked(sent, responses)
    buckets = store.touched(booked.select("process"))
    before = store.load("queue", "sla", buckets=buckets)
    outcome = booked.select(F.col("queue_id").alias("id_fila"), "status", "status_code", "request_id", "message")
    sends = sent.join(outcome, "id_fila").select(
        F.col("id_processo").alias("process"), "status_code", F.col("payload_json").alias("payload"), F.col("message").alias("response"))
    worth = _last_sent(sent).join(t.notifications(outcome), "id_fila")
    note = F.to_json(F.struct(*d.notification_columns(now, to)))
    notes = worth.select(F.col("id_processo").alias("process"), "status_code", note.alias("payload"), "message")
    _commit(store, version, {
        "queue": t.apply_outcomes(before["queue"], booked, now), "sla": t.stamp_sla(before["sla"], booked, now),
    }, {
        "api_log": api_log_rows(sends, run_id, target, SEND_ACTION, now), "notification_log": notification_log_rows(notes, run_id, now),
    }, marker, buckets)
    return RunResult(True, ("queue", "sla", "api_log", "notification_log"))
