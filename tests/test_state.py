"""State by bucket, kept summaries, merged layers and counted batches."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimflow.operators import normalise as n
from claimflow.operators import relational as r
from claimflow.operators import summaries as m
from claimflow.plans import jobs
from claimflow.plans import views as v
from claimflow.schemas import TABLES
from claimflow.sources.records import read_detail_records, read_portal_records
from claimflow.sources.tables import KEYED, StateTables

DAYS = ["2026-03-10 12:00:00", "2026-03-11 12:00:00", "2026-03-12 12:00:00", "2026-03-13 12:00:00"]
MILLIS = 1767272400000


def record(i, user=7, **more):
    return {"idProcesso": i, "noSinistro": str(i), "idUsuario": user, "usuario_origem": f"user{user}", "nomeSegurado": f"Name {i}", "idStatusCorrente": 3, **more}


@pytest.fixture
def land(spark, tmp_path):
    def write(records, name):
        path = tmp_path / name
        path.mkdir()
        (path / "0.json").write_text("\n".join(json.dumps(one) for one in records))
        return str(path)

    return lambda records, name: read_portal_records(spark, write(records, name))


@pytest.fixture
def store(spark, tmp_path):
    made = StateTables(spark, str(tmp_path / "state"), buckets=8)
    made.seed()
    return made


@pytest.fixture
def fine(spark, tmp_path):
    made = StateTables(spark, str(tmp_path / "fine"))
    made.seed()
    return made


def files(store, table):
    """bucket -> names of its files."""
    folders = Path(store.root, table).glob("bucket=*")
    return {int(folder.name.split("=")[1]): sorted(file.name for file in folder.glob("*.parquet")) for folder in folders}


def rewritten(before, after):
    return {bucket for bucket in after if after[bucket] != before.get(bucket)}


def rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df, store):
    """The state tables that the plan reads."""
    text = df._jdf.queryExecution().optimizedPlan().toString() + "".join(df.inputFiles())
    return {name for name in KEYED if f"{store.root}/{name}/" in text}


def entry(day, kind, text):
    return {"dataHoraEvento": MILLIS + day * 86_400_000, "idEvento": kind, "evento": text}


def test_a_batch_writes_no_more_buckets_than_it_has_processes(spark, fine, land):
    store = fine
    listed = [record(i, nmCorretor="Bia", telefoneCorretor="1133334444", logWorkFlow=[entry(0, 5, "x")]) for i in range(1, 201)]
    jobs.capture(store, land(listed, "all"), DAYS[0])
    assert all(len(files(store, name)) > 40 for name in ("process", "queue", "party", "contact", "event", "raw_latest", "summary"))
    before = {name: files(store, name) for name in KEYED}
    known = [{**listed[i], "dsStatus": "Changed", "logWorkFlow": [entry(0, 5, "x"), entry(1, 6, "y")]} for i in (3, 77)]
    jobs.capture(store, land([*known, record(999)], "some"), DAYS[1], complete=False)
    touched = set(store.touched(spark.createDataFrame([(4,), (78,), (999,)], "id long")))
    for name in KEYED:
        assert rewritten(before[name], files(store, name)) <= touched and len(touched) <= 3, name
    process = store.load("process")["process"]
    assert process.count() == 201 and rows(process.filter("phase = 'Changed'"), "id") == [(4,), (78,)]
    assert store.load("event")["event"].count() == 202
    before = {name: files(store, name) for name in KEYED}
    jobs.enrich(store, land([{**listed[9], "nmAnalista": "Caio", "emailAnalistaTw": "caio@s.com"}], "full"), DAYS[2])
    snapshot = spark.createDataFrame([(999, 22, None)], "process long, status int, status_text string")
    for name in KEYED:
        assert rewritten(before[name], files(store, name)) <= set(store.touched(spark.createDataFrame([(10,)], "id long"))), name
    assert rows(r.party_of_type(store.load("party")["party"], 4), "process", "name") == [(10, "Caio")]
    before = {name: files(store, name) for name in KEYED}
    jobs.audit(store, snapshot, DAYS[3])
    assert all(len(rewritten(before[name], files(store, name))) <= 1 for name in KEYED)


def test_a_run_reads_only_the_buckets_it_touches(spark, store, land):
    jobs.capture(store, land([record(i) for i in range(100)], "all"), DAYS[0])
    one = store.load("process", buckets=store.touched(spark.createDataFrame([(5,)], "id long")))["process"]
    assert "(bucket" in plan(one).split("PartitionFilters: [")[1].split("]")[0]
    read = one.select("_metadata.file_path").distinct() if "_metadata" in one.columns else one.withColumn("file", F.input_file_name()).select("file").distinct()
    assert read.count() == 1 and rows(one.filter("id = 5"), "id") == [(5,)]
    assert store.load("process", buckets=[])["process"].count() == 0


def test_exits_write_the_buckets_of_what_is_gone(spark, store, land):
    jobs.capture(store, land([record(i) for i in range(1, 101)], "all"), DAYS[0])
    before = files(store, "queue")
    gone = {1, 50, 100}
    jobs.capture(store, land([record(i) for i in range(1, 101) if i not in gone], "rest"), DAYS[1])
    state = store.load("queue", "user_history", "summary")
    assert {row.process for row in state["queue"].filter("status = 2").collect()} == gone
    assert {row.process for row in state["user_history"].filter("is_current = 0").collect()} == gone
    assert {row.process for row in state["summary"].filter("left_at IS NOT NULL").collect()} == gone
    assert len(before) == len(files(store, "queue"))


def test_rows_of_another_bucket_are_refused(spark, store, land):
    jobs.capture(store, land([record(i) for i in range(50)], "all"), DAYS[0])
    process = store.load("process")["process"]
    with pytest.raises(ValueError, match="does not touch"):
        store.commit(store.version() + 1, {"process": process}, buckets=[1])
    assert store.version() == 1 and store.load("process")["process"].count() == 49


def test_a_broken_run_changes_all_or_nothing(spark, store, land, monkeypatch):
    jobs.capture(store, land([record(i) for i in range(1, 30)], "all"), DAYS[0])

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(StateTables, "_create", broken)
        with pytest.raises(OSError):
            jobs.capture(store, land([record(i) for i in range(1, 40)], "more"), DAYS[1])
    assert store.version() == 1 and store.load("process")["process"].count() == 29
    with monkeypatch.context() as patch:
        patch.setattr(StateTables, "_put_in_place", broken)
        with pytest.raises(OSError):
            jobs.capture(store, land([record(i) for i in range(1, 40)], "again"), DAYS[1])
    # the next run finds it committed, and finishes it first
    other = StateTables(spark, store.root, buckets=3)
    assert other.buckets == 8 and other.version() == 2
    for name in ("process", "queue", "summary", "raw_latest"):
        assert other.load(name)[name].count() == 39, name
    assert other.load("raw_history")["raw_history"].count() == 29 + 10
    assert other.version() == 2 and other.load("raw_history")["raw_history"].count() == 39


def test_kept_summary_equals_the_whole_aggregate(spark, store, land):
    log = lambda *days: [entry(day, 5 + day, f"day {day}") for day in days]
    first = [record(i, user=7 + i % 2, logWorkFlow=log(2, 4), idCicloCorrente=i % 3) for i in range(1, 21)]
    jobs.capture(store, land(first, "one"), DAYS[0])
    second = [record(i, user=7 + i % 2, logWorkFlow=log(-400, 1, 2, 4, 6), idCicloCorrente=5) for i in range(5, 26)]
    jobs.capture(store, land(second, "two"), DAYS[1])
    jobs.capture(store, land([record(i, user=9, logWorkFlow=log(3)) for i in (1, 30)], "three"), DAYS[2])
    jobs.enrich(store, land([record(i, logWorkFlow=log(0, 9) + [entry(12, 0, "no kind")]) for i in (2, 30, 31)], "four"), DAYS[3])
    snapshot = spark.createDataFrame([(6, 22, None), (7, 98, None)], "process long, status int, status_text string")
    jobs.audit(store, snapshot, "2026-06-01 00:00:00")
    state = store.load()
    whole = m.summarised(state["event"], state["step"], state["user_history"], jobs.EVENT_FLOOR)
    assert rows(state["summary"], "*") == rows(whole, "*") and state["summary"].count() == 27
    assert state["summary"].filter("left_at IS NOT NULL").count() > 2
    assert rows(m.last_change(state["process"], state["summary"]), "*") == rows(r.last_change(state["process"], state["event"], state["step"]), "*")
    assert rows(m.current_user(state["summary"]), "*") == rows(r.current_user(state["user_history"]), "*")
    for view in (v.ready_queue, v.history):
        assert rows(view(state, summary=state["summary"]), "*") == rows(view(state), "*")
    # the views need no event, step or user any more
    assert not {"event", "step", "user_history"} & scanned(v.history(state, summary=state["summary"]), store)
    assert {"event", "step", "user_history"} <= scanned(v.history(state), store)
    before = rows(state["summary"], "*")
    jobs.summarise(store)
    assert rows(store.load("summary")["summary"], "*") == before


def test_opening_dates_come_from_the_summary(spark, store, land):
    """An event of an earlier run repairs the date of a later one, and no stored event is read for it."""
    jobs.capture(store, land([record(1, logWorkFlow=[entry(3, 5, "x")]), record(2)], "one"), DAYS[0])
    state = store.load()
    late = state["process"].withColumn("opened", F.lit("2025-05-05 00:00:00").cast("timestamp_ntz"))
    store.commit(store.version() + 1, {"process": late})
    jobs.capture(store, land([record(1), record(2, logWorkFlow=[entry(5, 5, "y")])], "two"), DAYS[1])
    opened = {row.id: str(row.opened) for row in store.load("process")["process"].collect()}
    assert opened == {1: "2026-01-04 10:00:00", 2: "2026-01-06 10:00:00"}
    state = store.load()
    _, batch = jobs.prepared(land([record(1)], "three"))
    batch, _ = jobs.marked(batch, state["process"])
    changed, _ = jobs.capture_changes(state, batch, None, DAYS[2])
    assert "event" not in scanned(changed["process"], store)


def test_batches_are_counted_while_they_are_written(spark, store, land):
    jobs.capture(store, land([record(i) for i in range(1, 11)], "one"), DAYS[0])
    result = jobs.capture(store, land([record(i) for i in (9, 10, 10, 11, 12, 13)] + [{"noSinistro": "no id"}], "two"), DAYS[1])
    assert tuple(result.metrics.first()) == (5, 3, 2)
    assert "Join" not in plan(result.metrics)
    nothing = jobs.capture(store, land([{"noSinistro": "no id"}], "three"), DAYS[2])
    assert nothing.committed and tuple(nothing.metrics.first()) == (0, 0, 0)


def test_present_keys_win(spark, tmp_path):
    def write(name, *records):
        (tmp_path / name).mkdir()
        (tmp_path / name / "0.json").write_text("\n".join(one if isinstance(one, str) else json.dumps(one) for one in records))
        return str(tmp_path / name)

    listing = read_portal_records(spark, write("listing", *[record(i, marca="L", placa="P", nmAnalista="Ana") for i in range(1, 6)]))
    by_id = read_detail_records(spark, write(
        "by_id", {"idProcesso": 1, "marca": None, "status_processo": "Detail", "idUsuario": 99, "nmAnalista": None}, {"idProcesso": 2, "marca": "D", "placa": None},
        "", "no json", "[1]", {"marca": "no id"}, {"idProcesso": 3, "marca": "first"}, {"idProcesso": 3, "marca": None}, {"idProcesso": 9, "marca": "not listed"}))
    follow_up = read_detail_records(spark, write("follow_up", {"idProcesso": 2, "marca": None, "placa": "F"}, {"idProcesso": 4, "logWorkFlow": None, "nomeSegurado": "F"}))
    merged = n.merge_layers(listing, by_id, follow_up)
    assert rows(merged, "idProcesso", "marca", "placa", "nomeSegurado", "nmAnalista", "idUsuario", "status_processo") == [
        (1, None, "P", "Name 1", "Ana", 7, "Detail"), (2, None, "F", "Name 2", "Ana", 7, n.DEFAULT_PHASE), (3, None, "P", "Name 3", "Ana", 7, n.DEFAULT_PHASE),
        (4, "L", "P", "F", "Ana", 7, n.DEFAULT_PHASE), (5, "L", "P", "Name 5", "Ana", 7, n.DEFAULT_PHASE)]
    # without keys, NULL says nothing
    assert rows(n.merge_layers(listing, by_id.drop("_keys")).filter("idProcesso < 3"), "idProcesso", "marca", "placa") == [(1, "L", "P"), (2, "D", "P")]
    assert n.merge_layers(listing.limit(0), by_id, follow_up).count() == 0
    assert n.merge_layers(listing, by_id.limit(0), follow_up.limit(0)).filter("marca = 'L'").count() == 5


def test_capture_takes_nulls_of_details(spark, store, tmp_path, land):
    detail = tmp_path / "detail"
    detail.mkdir()
    (detail / "0.json").write_text(json.dumps({"idProcesso": 1, "placa": None, "marca": "Ford"}))
    jobs.capture(store, land([record(1, placa="ABC1234", marca="Fiat"), record(2, placa="XYZ9876")], "list"), DAYS[0], by_id=read_detail_records(spark, str(detail)))
    assert rows(store.load("vehicle")["vehicle"], "process", "plate", "brand") == [(1, "AVI0000", "Ford"), (2, "XYZ9876", "")] or rows(
        store.load("vehicle")["vehicle"], "process", "plate", "brand") == [(1, "AVI0000", "Ford"), (2, "XYZ9876", None)]


def test_contacts_belong_to_a_process_and_party(spark):
    """Two parties of one number in different processes keep their own contacts."""
    contact = spark.createDataFrame(
        [(1, 10, 5, 3, None, "a@x", 1), (2, 20, 5, 3, None, "b@x", 1)], "id long, process long, party long, type int, area int, value string, principal int")
    best = r.best_contact(contact, {"email": 3, "phone": 2}, ("process", "party"))
    assert rows(best, "process", "party", "email_value") == [(10, 5, "a@x"), (20, 5, "b@x")]


def test_plans(spark, store, land):
    """One load plans its new records once; the views read each table of people as often as a role needs it, and no more."""
    from claimflow.operators import transitions as t

    jobs.capture(store, land([record(i) for i in range(1, 11)], "one"), DAYS[0])
    state = store.load()
    _, batch = jobs.prepared(land([record(i) for i in range(8, 15)], "two"))
    loaded = t.load_rows(state, t.unstored(state, batch), DAYS[1])
    count = lambda df, word: df._jdf.queryExecution().optimizedPlan().toString().count(word)
    # the guard against stored processes is in none of them
    assert sum(count(df, "LeftAnti") for name, df in loaded.items()) == 6
    assert all(count(loaded[name], "Join") == 0 for name in ("queue", "party", "contact", "event", "step", "document", "raw_history"))
    assert sum(count(df, "Relation") for df in loaded.values()) <= 20
    keys = v.ready_keys(state).checkpoint()
    with_keys, without = v.ready_queue(state, summary=state["summary"], keys=keys), v.ready_queue(state, summary=state["summary"])
    assert rows(with_keys, "*") == rows(without, "*") and count(with_keys, "Relation") < count(without, "Relation") / 2
    history = v.history(state, summary=state["summary"])
    assert count(history, "LeftSemi") <= 3 and count(r.first_per_key(batch, "id", "_order"), "to_json") == 0


def test_bucketed_tables_stay_in_place(spark, store, land, tmp_path):
    from claimflow.operators import transitions as t
    from claimflow.sources.bucketed import serve, served

    jobs.capture(store, land([record(i, user=7 + i % 2, logWorkFlow=[entry(i % 4, 5, "x")], idCicloCorrente=i % 3) for i in range(1, 61)], "all"), DAYS[0])
    names = ("process", "event", "step", "queue", "user_history", "summary")
    state = serve(store, "served", 4, *names, path=str(tmp_path / "served"))
    again = served(spark, "served", *names)
    plain = store.load(*names)
    assert all(rows(again[name], "*") == rows(plain[name], "*") == rows(state[name], "*") for name in names)
    gone = spark.createDataFrame([(8, 1), (7, 2), (9, 3)], "user_id int, process long").checkpoint()
    closed = t.close_gone(again["user_history"], again["queue"], gone, DAYS[1])
    whole = t.close_gone(plain["user_history"], plain["queue"], gone, DAYS[1])
    for name in closed:
        assert rows(closed[name], "*") == rows(whole[name], "*")
    assert rows(closed["user_history"].filter("is_current = 0"), "process") == [(1,), (2,)]
    changes = r.last_change(again["process"], again["event"], again["step"])
    assert rows(changes, "*") == rows(r.last_change(plain["process"], plain["event"], plain["step"]), "*")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        joined = r.last_change(*served(spark, "served", "process", "event", "step").values())
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        tables = served(spark, "served", "user_history", "queue")
        for table in t.close_gone(tables["user_history"], tables["queue"], gone, DAYS[1]).values():
            # what is moved comes from the exits alone
            assert all("FileScan" not in part.split("SortMergeJoin")[0] for part in plan(table).split("Exchange")[1:]) and "Bucketed: true" in plan(table)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_added_rows_leave_stored_files_alone(spark, store, land):
    """New processes are put beside the stored ones of their bucket; doing it again changes nothing."""
    jobs.capture(store, land([record(i) for i in range(1, 41)], "one"), DAYS[0])
    before = {name: files(store, name) for name in ("raw_latest", "party", "vehicle")}
    jobs.capture(store, land([record(i) for i in range(1, 61)], "two"), DAYS[1])
    for name, old in before.items():
        new = files(store, name)
        assert all(set(old[bucket]) <= set(new[bucket]) for bucket in old) and new != old and store.load(name)[name].count() == 60, name
    store.compact("party")
    assert store.load("party")["party"].count() == 60


def test_a_half_moved_run_is_finished(spark, store, land, monkeypatch):
    jobs.capture(store, land([record(i) for i in range(1, 30)], "one"), DAYS[0])
    move, left = StateTables._move, [9]

    def some(self, source, target):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("lost")
        move(self, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(StateTables, "_move", some)
        with pytest.raises(OSError):
            jobs.capture(store, land([record(i) for i in range(1, 50)], "two"), DAYS[1])
    other = StateTables(spark, store.root)
    assert other.version() == 2
    for name in ("process", "queue", "raw_latest", "summary", "party"):
        assert other.load(name)[name].count() == 49 and other.load(name)[name].distinct().count() == 49, name
    assert other.load("raw_history")["raw_history"].count() == 29 + 20


def test_prepared_batch_is_written_by_column(spark, land):
    """No table reads the raw text of a record for its other columns, and only repeated records are shuffled."""
    seen, batch = jobs.prepared(land([record(1), record(2), record(2, nomeSegurado="Later"), record(3)], "one"))
    assert seen.count() == 4 and rows(batch, "id", "insured_name") == [(1, "Name 1"), (2, "Name 2"), (3, "Name 3")]
    narrow = plan(batch.select("id", "user_id")).split("Union")[1]
    once = narrow.split("FileScan")[1].split("ReadSchema: ")[1].split("\n")[0]
    assert "user_id" in once and "raw_json" not in once and "Exchange hashpartitioning" not in narrow.split("FileScan")[1]


def test_a_load_reads_only_its_columns(spark):
    """Of the prepared batch a load reads the columns of its table, and makes no stored people that it does not need."""
    from claimflow.binding import q_transitions as q

    text = plan(q.load_user_history(spark, "/root/testdata/sf0.001"))
    assert "ExistingRDD" not in text and "FileScan parquet" in text and not any(name in text for name in ("raw_json", "insured_name", "plate"))


def test_a_run_keeps_no_copies_of_its_batch(spark, store, land, monkeypatch):
    """What a run wrote of its batch is gone when it ends, and so are its shuffle files."""
    listed = [record(i, logWorkFlow=[entry(0, 5, "x")]) for i in range(1, 41)]
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    saved, commit, written, during = jobs.saved, store.commit, {}, []

    def noted(df, name):
        table = saved(df, name)
        written.setdefault(name, []).extend(Path(file.removeprefix("file://")) for file in table.inputFiles())
        return table

    monkeypatch.setattr(jobs, "saved", noted)
    store.commit = lambda *args, **kwargs: during.append(spark.conf.get(cleanup, None)) or commit(*args, **kwargs)
    jobs.capture(store, land(listed[:30], "one"), DAYS[0])
    jobs.enrich(store, land(listed, "two"), DAYS[1])
    assert during == ["true", "true"] and spark.conf.get(cleanup, None) != "true"
    assert len(written["seen"]) >= 2 and len(written["marked"]) >= 2
    assert not [path for name in ("seen", "marked") for path in written[name] if path.exists()]
    assert store.load("process")["process"].count() == store.load("raw_latest")["raw_latest"].count() == 40


def test_a_capture_without_its_process_is_kept_once(spark, store, land):
    """A stored capture stays when its process is loaded; the others are added."""
    old = spark.createDataFrame([(2, "old", "{}")], "id long, claim string, json string").withColumn("captured_at", F.lit(DAYS[0]).cast("timestamp_ntz"))
    store.commit(store.version() + 1, {"raw_latest": old})
    jobs.capture(store, land([record(i) for i in range(1, 5)], "one"), DAYS[1])
    assert rows(store.load("raw_latest")["raw_latest"], "id", "claim") == [(1, "1"), (2, "old"), (3, "3"), (4, "4")]


def test_empty_tables_move_nothing(spark, land):
    """A first run has no stored rows to compare its batch with: no record is shuffled or sorted for them."""
    from claimflow.sources.tables import empty

    _, batch = jobs.prepared(land([record(i) for i in range(1, 5)], "one"))
    joined = batch.join(empty(spark, "process").select("id", "active"), "id", "left").select("id", "active")
    assert "process" not in plan(joined) and plan(joined).count("Join") == plan(batch).count("Join")
    missing = r.missing_in(batch, empty(spark, "process"), ["id"])
    assert plan(missing).count("Join") == plan(batch).count("Join") and missing.count() == 4
    assert empty(spark, "queue").count() == 0 and empty(spark, "queue").dtypes == [(f.name, f.dataType.simpleString()) for f in TABLES["queue"]]


def test_what_a_run_wrote_for_itself_goes_with_it(spark, store, land):
    """Of everything that a run saved or checkpointed only the store is left."""
    from claimflow.session import work_dir

    left = lambda: {str(path) for path in Path(work_dir(spark).removeprefix("file:")).rglob("part-*")}
    listed = [record(i, placa="ABC1234", logWorkFlow=[entry(0, 5, "x")]) for i in range(1, 41)]
    before = left()
    jobs.capture(store, land(listed[:30], "one"), DAYS[0])
    jobs.capture(store, land(listed[5:], "two"), DAYS[1])
    jobs.enrich(store, land(listed, "three"), DAYS[2])
    jobs.dispatch(store, DAYS[2], "r")
    answers = spark.createDataFrame([(i, 201, None, None) for i in range(1, 41)], "process long, status_code int, body string, error string")
    jobs.book(store, "r", answers, DAYS[3])
    jobs.audit(store, spark.createDataFrame([(7, 22, None)], "process long, status int, status_text string"), DAYS[3])
    assert left() == before
    assert store.load("outbox")["outbox"].count() == store.load("api_log")["api_log"].count() == 40 - 5


def test_raw_text_is_written_alone(spark, store, land, monkeypatch):
    """While a table of raw text is staged no other one is: the disk holds the shuffle files of one."""
    from pyspark.sql import DataFrameWriter

    write, open_now, beside = DataFrameWriter.parquet, [], {}

    def noted(self, path, *args, **kwargs):
        name = path.rsplit("/", 1)[1]
        open_now.append(name)
        for one in open_now:
            beside.setdefault(one, set()).update(open_now)
        write(self, path, *args, **kwargs)
        open_now.remove(name)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    jobs.capture(store, land([record(i) for i in range(1, 31)], "one"), DAYS[0])
    assert beside["raw_latest"] == {"raw_latest"} and beside["raw_history"] == {"raw_history"}
    assert len(beside["process"]) > 1


def test_stored_captures_are_replaced(spark):
    """Every stored row of a listed id gets the new text and keeps its claim, and stored text is not joined with new text."""
    from claimflow.operators import transitions as t

    shape = "id long, claim string, json string, captured_at timestamp_ntz"
    at = lambda table: table.withColumn("captured_at", F.lit(DAYS[0]).cast("timestamp_ntz"))
    stored = at(spark.createDataFrame([(1, "a", "old", None), (2, None, "old", None), (2, "c", "old", None), (None, "n", "old", None), (9, "z", "old", None)], shape))
    news = spark.createDataFrame([(1, "A", "new", None), (2, "B", "new", None), (3, "C", "new", None), (None, "N", "new", None)], shape)
    expected = t.upsert(stored, news, ["id"], {"json": "overwrite", "captured_at": "overwrite"})
    found = t.backfill_raw(stored, news)
    assert rows(found, "*") == rows(expected, "*") and found.columns == expected.columns and found.count() == 7
    assert "_json" in plan(expected) and "_json" not in plan(found)


def test_guards_keep_no_table_of_keys(spark):
    """Neither the stored keys nor those of the batch are grouped."""
    stored, batch = (spark.createDataFrame(ids, "id long") for ids in ([(1,), (2,), (2,), (None,)], [(2,), (2,), (3,), (None,)]))
    for guard, left in ((r.exists_in, [(2,), (2,)]), (r.missing_in, [(3,), (None,)])):
        found = guard(batch, stored, ["id"])
        assert rows(found, "id") == left and "Aggregate" not in plan(found)
    assert rows(r.stored_keys(batch, stored, ["id"]), "id") == [(2,)]


def test_large_batch_is_staged_a_few_buckets_at_a_time(spark, land, tmp_path, monkeypatch):
    """The parts of a table are written one after the other, and together they are what one write holds."""
    papers = [{"dsDocumento": "Report", "status": "S1"}]
    listed = [record(i, user=7 + i % 2, documentos=papers, nmCorretor=f"Broker {i}", emailCorretor=f"b{i}@b.com") for i in range(1, 60)]
    later = [record(i, user=7 + i % 2, dsStatus="LATER", nmAnalista="Ana", emailAnalistaTw="ana@t.com") for i in range(20, 80)]
    found = {}
    for name, size in (("one", 1 << 40), ("each", 1)):
        monkeypatch.setattr("claimflow.sources.tables.PART_BYTES", size)
        store = StateTables(spark, str(tmp_path / name), buckets=3)
        store.seed()
        jobs.capture(store, land(listed, f"{name}-1"), DAYS[0])
        if name == "each":  # every write names its files anew
            writes = {file.split("-", 2)[2].split(".")[0] for bucket in files(store, "raw_latest").values() for file in bucket}
            assert len(writes) == len(files(store, "raw_latest")) == 3
        jobs.enrich(store, land(later, f"{name}-2"), DAYS[1])
        jobs.dispatch(store, DAYS[2], "r")
        state = store.load(*KEYED, "outbox", "robot_user", "portal_status")
        found[name] = {table: sorted(map(str, rows.collect())) for table, rows in state.items()}
    assert found["each"]["outbox"] and found["each"] == found["one"]


def test_part_refuses_rows_of_other_buckets(spark, store, land, monkeypatch):
    monkeypatch.setattr("claimflow.sources.tables.PART_BYTES", 1)
    jobs.capture(store, land([record(i) for i in range(1, 40)], "a"), DAYS[0])
    with pytest.raises(ValueError, match="does not touch"):
        store.commit(store.version() + 1, {"process": store.load("process")["process"]}, buckets=[1, 2], size=100)


def test_each_part_is_made_of_its_own_rows(spark, land, tmp_path, monkeypatch):
    """A large batch is kept by part: what stages a part reads the batch's rows of that part alone, and exits go with theirs."""
    listed = [record(i, logWorkFlow=[entry(0, 5, "x")]) for i in range(1, 40)]
    changes, made, found = jobs.capture_changes, [], {}

    def noted(state, batch, gone, now):
        made.append(({row.id for row in batch.select("id").collect()}, plan(batch.select("id")).split("PartitionFilters: [")[1].split("]")[0]))
        return changes(state, batch, gone, now)

    monkeypatch.setattr(jobs, "capture_changes", noted)
    for name, size in (("one", 1 << 40), ("each", 1)):
        monkeypatch.setattr("claimflow.sources.tables.PART_BYTES", size)
        store = StateTables(spark, str(tmp_path / name), buckets=2)
        store.seed()
        made.clear()
        jobs.capture(store, land(listed[:30], f"{name}-1"), DAYS[0])
        jobs.capture(store, land(listed[10:], f"{name}-2"), DAYS[1])
        state = store.load("queue", "user_history", "summary", "robot_user")
        found[name] = {table: rows(df, *[c for c in df.columns if c != "id"]) for table, df in state.items()}
    assert found["each"] == found["one"] and store.load("queue")["queue"].filter("status = 2").count() == 10
    assert ["(_part" in filters for _, filters in made] == [True] * 4
    assert made[0][0] | made[1][0] == set(range(1, 31)) and not made[0][0] & made[1][0]
