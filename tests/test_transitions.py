"""Transition laws on landed records."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimflow.operators import quality as q
from claimflow.operators import relational as r
from claimflow.operators import transitions as t
from claimflow.plans import dispatch as d
from claimflow.plans import jobs
from claimflow.plans import views as v
from claimflow.schemas import TABLES
from claimflow.sources.dictionaries import dictionaries
from claimflow.sources.records import read_portal_records
from claimflow.sources.tables import CommitRefused, StateTables, empty, run_summary

NOW = datetime(2026, 3, 10, 12, 0)
LATER = datetime(2026, 3, 11, 9, 30)

ANA = {
    "idProcesso": 1, "noSinistro": "900001", "tpExpediente": "TRC", "idStatusCorrente": 1, "flAlerta": "S", "ddd": "11",
    "nmBeneficiario": "  ANA   LIMA ", "cpfCnpj": "123456789.0", "emailBeneficiario": "a@x.com, b@x.com",
    "telefoneBeneficiario": "(11) 98765-4321", "vrFipe": "45.900,00", "anoVeiculo": "2019.0", "usuario_origem": "user1", "idUsuario": 7,
    "nmCorretor": "Bia", "emailCorretor": "bia@c.com", "telefoneCorretor": "2133334444",
    "nmAnalista": "Caio", "emailAnalistaTw": "caio@s.com", "idCicloCorrente": 3, "dsStatusCorrenteProcesso": "Vistoria", "dsStatus": "Aberta",
    "logWorkFlow": [{"dataHoraEvento": 1767272400000, "idEvento": 5, "evento": "Opened"}, {"idEvento": 6, "evento": "No date"},
                    {"dataHoraEvento": 1767276000000, "idEvento": 5, "evento": "Again"}, {"dataHoraEvento": 1767276000000}],
    "documentos": [{"dsDocumento": "Report", "dsStatus": "Received"}, {"dsDocumento": "nan"}, {"nomeDocumento": "Report", "status": "Late"}],
}
BOB = {"idProcesso": 2, "noSinistro": "900002", "idStatusCorrente": 9, "dsStatus": "nan", "nomeSegurado": "Bob", "flAlerta": False,
       "usuario_origem": "user1", "idUsuario": 7, "dsUF": "mg", "dtAberturaSinistro": "2026-01-05"}
EVA = {"idProcesso": 3, "noSinistro": "900003", "nomeSegurado": "Eva", "usuario_origem": "user2", "idUsuario": 8}


@pytest.fixture
def land(spark, tmp_path):
    def write(*records, name="r"):
        path = tmp_path / name
        path.mkdir(exist_ok=True)
        (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(json.dumps(record) for record in records))
        return read_portal_records(spark, str(path))

    return write


@pytest.fixture
def start(spark):
    return {**{name: empty(spark, name) for name in TABLES}, **dictionaries(spark)}


def frozen(state):
    return {name: table.checkpoint() for name, table in state.items()}


def rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)


def loaded(start, records):
    _, batch = jobs.prepared(records)
    return frozen({**start, **t.load_new(start, batch, NOW)}), batch


def test_load_splits_a_record(start, land):
    state, _ = loaded(start, land(ANA, BOB, {"noSinistro": "no id"}, {"idProcesso": 0}))
    assert rows(state["process"], "id", "claim", "file_type", "portal_status", "uf", "phase", "alert") == [
        (1, "900001", 2, 1, "SP", "Vistoria", 1), (2, "900002", 0, 9, "MG", "nan", 0)]
    assert str(state["process"].filter("id = 1").first().opened) == "2026-01-01 10:00:00"
    assert rows(state["party"], "process", "type", "name", "tax_id") == [
        (1, 2, "ANA   LIMA", "123456789.0"), (1, 3, "Bia", None), (1, 4, "Caio", None), (2, 1, "Bob", None)]
    contacts = state["contact"].join(state["party"].select(F.col("id").alias("party"), F.col("type").alias("role")), "party")
    assert rows(contacts, "role", "type", "area", "value") == [
        (2, 2, 11, "11987654321"), (2, 3, None, "a@x.com"), (2, 3, None, "b@x.com"),
        (3, 2, 21, "33334444"), (3, 3, None, "bia@c.com"), (4, 3, None, "caio@s.com")]
    assert rows(state["event"], "process", "event", "text") == [(1, 0, ""), (1, 5, "Again"), (1, 5, "Opened")]
    assert rows(state["document"], "process", "name", "status") == [(1, "Report", "Late")]
    assert rows(state["step"], "process", "task", "name", "status") == [(1, 3, "Vistoria", "Aberta")]
    assert rows(state["portal_status"], "code", "label") == [(1, "Vistoria"), (9, "Status ID: 9")]
    assert rows(state["workflow_event"], "code", "label") == [(5, "Opened")]
    assert rows(state["vehicle"], "process", "plate", "year")[0] == (1, "AVI0000", 2019)
    assert float(state["vehicle"].filter("process = 1").first().value) == 45900.0
    assert rows(state["user_history"], "process", "user_id", "is_current") == [(1, 7, 1), (2, 7, 1)]
    assert json.loads(state["raw_latest"].filter("id = 1").first().json)["noSinistro"] == "900001"


def test_loading_twice_changes_nothing(start, land):
    records = land(ANA, BOB)
    state, batch = loaded(start, records)
    again = {**state, **t.load_new(state, batch, LATER)}
    for name in state:
        assert again[name].count() == state[name].count(), name


def test_keys_stay_unique(start, land):
    state, batch = loaded(start, land(ANA, BOB, ANA))
    state = frozen({**state, **t.sync_known(state, batch, LATER)})
    for table, key in (("process", ["id"]), ("queue", ["id"]), ("party", ["id"]), ("contact", ["id"]), ("sla", ["process"]),
                       ("raw_latest", ["id"]), ("user_history", ["process", "user_id"]), ("portal_status", ["code"])):
        assert q.duplicate_keys(state[table], key).count() == 0, table


def test_sync_is_idempotent(start, land):
    state, _ = loaded(start, land(ANA))
    news = {**ANA, "dsStatusCorrenteProcesso": "Pago", "flAlerta": "N", "idCicloCorrente": 4, "idStatusCorrente": None,
            "logWorkFlow": ANA["logWorkFlow"] + [{"dataHoraEvento": 1767279600000, "idEvento": 8, "evento": "Paid"}]}
    _, batch = jobs.prepared(land(news, name="s"))
    once = frozen({**state, **t.sync_known(state, batch, LATER)})
    assert rows(once["process"], "id", "phase", "alert", "portal_status") == [(1, "Pago", 0, 1)]
    assert rows(once["event"], "event") == [(0,), (5,), (5,), (8,)]
    assert rows(once["step"], "task") == [(3,), (4,)]
    twice = t.sync_known(once, batch, LATER)
    for name, table in twice.items():
        assert rows(table, "*") == rows(once[name], "*")


def test_backfill(start, land):
    state, _ = loaded(start, land(BOB, EVA))
    full = {**BOB, "dsStatus": "Em análise", "dtSinistro": "2026-02-02", "nmAnalista": "Caio", "emailAnalistaTw": "caio@s.com", "placa": "ABC1234",
            "logWorkFlow": [{"dataHoraEvento": 1767272400000, "idEvento": 5, "evento": ""}, {"dataHoraEvento": 1767272500000, "idEvento": 5, "evento": "Said"},
                            {"dataHoraEvento": 1767272400000, "idEvento": 0, "evento": "no id"}]}
    _, batch = jobs.prepared(land(full, name="b"))
    after = frozen({**state, **t.backfill(state, batch, LATER)})
    bob = after["process"].filter("id = 2").first()
    assert bob.phase == "Em análise" and str(bob.opened) == "2026-01-01 10:00:00" and str(bob.occurred)[:10] == "2026-01-05"
    assert rows(after["portal_status"].filter("code = 9"), "label") == [("Em análise",)]
    assert rows(after["event"], "process", "event", "text") == [(2, 5, "Said")]
    assert rows(r.party_of_type(after["party"], 4), "process", "name") == [(2, "Caio")]
    assert rows(after["contact"], "value") == [("caio@s.com",)]
    assert rows(after["vehicle"], "process", "plate") == [(2, "ABC1234"), (3, "AVI0000")]
    assert after["raw_history"].count() == 3 and after["raw_latest"].count() == 2
    _, other = jobs.prepared(land({**full, "emailAnalistaTw": "new@s.com"}, name="b2"))
    last = t.backfill(after, other, LATER)
    assert rows(last["contact"], "value") == [("new@s.com",)]


def test_disappeared_only_for_users_in_the_batch(start, land):
    state, _ = loaded(start, land(ANA, BOB, EVA))
    error = state["queue"].withColumn("status", F.when(F.col("process") == 1, 3).otherwise(F.col("status")))
    seen, _ = jobs.prepared(land({**BOB, "idProcesso": 5}, name="d"))
    out = frozen(t.close_disappeared(state["user_history"], error, seen, LATER))
    assert rows(out["user_history"], "process", "is_current") == [(1, 0), (2, 0), (3, 1)]
    assert out["user_history"].filter("is_current = 0 AND left_at IS NULL").count() == 0
    assert rows(out["queue"], "process", "status") == [(1, 3), (2, 2), (3, 1)]


def test_repair_opening(spark, start, land):
    state, _ = loaded(start, land(ANA, EVA))
    process = state["process"].withColumn("opened", F.lit("2025-05-05").cast("timestamp_ntz"))
    fixed = t.repair_opening(process, state["event"], jobs.EVENT_FLOOR)
    assert rows(fixed.withColumn("o", F.col("opened").cast("string")), "id", "o") == [(1, "2026-01-01 10:00:00"), (3, "2025-05-05 00:00:00")]


def test_dictionary_labels(spark):
    stored = spark.createDataFrame([(9, "Status ID: 9"), (8, "Known")], "code int, label string")
    batch = spark.createDataFrame(
        [(9, "Real", 2), (9, "Later", 3), (9, "Status ID: 9", 1), (8, "Other", 1), (7, "Status ID: 7", 1), (7, "Seven", 2), (6, "Status ID: 6", 1)],
        "code int, label string, _order int")
    assert rows(t.grow_dictionary(stored, batch, "Status ID:"), "code", "label") == [
        (6, "Status ID: 6"), (7, "Seven"), (8, "Known"), (9, "Real")]
    assert rows(t.grow_dictionary(stored, batch, "Status ID:", upgrade=False), "code", "label") == [
        (6, "Status ID: 6"), (7, "Status ID: 7"), (8, "Known"), (9, "Status ID: 9")]


def test_outcomes_stamp_the_sla_once(spark, start, land):
    state, _ = loaded(start, land(ANA, BOB, EVA))
    sent = state["queue"].select(F.col("id").alias("queue_id"), "process", "slot")
    responses = spark.createDataFrame(
        [(1, 201, '{"id":7,"message":"ok"}', None), (2, 409, '{"message":"dup"}', None), (3, 500, None, "down")],
        "process long, status_code int, body string, error string")
    booked = d.outcomes(sent, responses)
    queue = t.apply_outcomes(state["queue"], booked, LATER)
    assert rows(queue, "process", "status", "attempts") == [(1, 2, 1), (2, 4, 1), (3, 3, 1)]
    sla = t.stamp_sla(state["sla"], booked, LATER).checkpoint()
    assert rows(sla.filter("sent IS NOT NULL"), "process", "queue_minutes", "status") == [(1, 1290, "PENDENTE_ENVIO")]
    again = t.stamp_sla(sla, booked, datetime(2026, 4, 1))
    assert rows(again, "*") == rows(sla, "*")
    assert rows(t.notifications(booked), "process") == [(1,), (3,)]


def test_audit(spark, start, land):
    state, _ = loaded(start, land({**ANA, "idStatusCorrente": 5}, {**BOB, "logWorkFlow": ANA["logWorkFlow"]}, EVA))
    snapshot = spark.createDataFrame([(1, None, "Processo Concluído"), (2, 98, None), (3, 22, None)], "process long, status int, status_text string")
    out = t.audit_close(state, snapshot, NOW)
    # process 3 has neither status nor opening date
    assert rows(out["process"], "id", "portal_status") == [(1, 22), (2, 98), (3, None)]
    assert rows(out["queue"], "process", "active") == [(1, 0), (2, 0), (3, 1)]
    assert rows(out["user_history"], "process", "is_current") == [(1, 0), (2, 0), (3, 1)]
    assert tuple(t.audit_counts(state["process"], snapshot, NOW).first()) == (2, 0)


def test_reconcile(spark, start, land):
    state, _ = loaded(start, land(ANA, BOB, EVA))
    stock = spark.createDataFrame([("900001T",), ("900002",), ("900002",)], "claim string")
    out = t.reconcile(state["queue"], v.ready_queue(state), stock, LATER)
    assert rows(out, "process", "status") == [(1, 2), (2, 2), (3, 1)]
    assert rows(t.reconcile(state["queue"], v.ready_claims(state), stock, LATER), "*") == rows(out, "*")


def test_views_multiply_with_parties(spark, start, land):
    state, _ = loaded(start, land(ANA, BOB, EVA))
    assert v.ready_queue(state).count() == 3 and v.history(state).count() == 3
    extra = spark.createDataFrame([(77, 2, 1, "Second", None, None), (78, 2, 1, "Third", None, None)], state["party"].schema)
    more = {**state, "party": state["party"].unionByName(extra)}
    assert v.ready_queue(more).filter("id_processo = 2").count() == 3
    assert v.history(more).filter("id_processo = 2").count() == 3
    none = {**state, "party": state["party"].filter("process <> 3")}
    assert v.ready_queue(none).filter("id_processo = 3").first().nome_segurado is None
    assert len(v.ready_queue(state).columns) == 37 and len(v.history(state).columns) == 37
    v.register_views(spark, state)
    assert spark.sql("SELECT nome_segurado FROM vw_processos_prontos_envio WHERE id_processo = 1").first()[0] == "ANA LIMA"
    assert spark.sql("SELECT papel_envolvido FROM vw_historico_geral_processos WHERE id_processo = 1").first()[0] == "Terceiro"


def test_payload(spark, start, land):
    state, _ = loaded(start, land(ANA, BOB))
    out = {row.id_processo: json.loads(row.payload_json) for row in d.dispatch_batch(v.ready_queue(state), state["parameter"], NOW).collect()}
    ana, bob = out[1], out[2]
    assert (ana["solicitanteId"], ana["servicoId"], ana["naturezaId"]) == (80, 2, 3)
    assert ana["sinistro"] == "900001T" and ana["fipeValue"] == 45900.0
    assert ana["envolvido"]["document"] == {"type": 1, "value": "00123456789"} and ana["envolvido"]["email"] == "a@x.com"
    # eight digits: the broker phone carries its area elsewhere and is left out
    assert ana["corretor"] == {"typeId": 3, "name": "Bia", "email": "bia@c.com"}
    assert ana["analista"] == {"typeId": 4, "name": "Caio", "email": "caio@s.com"}
    assert ana["detalhes"] == d.DETAILS + "10/03/2026" and bob["detalhes"] == d.DETAILS + "10/03/2026" + d.ANALYST_NOTE
    assert "corretor" not in bob and "analista" not in bob and "phones" not in bob["envolvido"]
    assert {ana["dataHora"], bob["dataHora"]} == {"2026-03-10T12:00:00", "2026-03-10T12:05:00"}


def test_run_log(spark, land, tmp_path):
    store, log = StateTables(spark, str(tmp_path / "state"), buckets=4), str(tmp_path / "log")
    store.seed()
    times = iter([NOW, LATER] * 2)
    jobs.logged(spark, log, "r1", lambda: next(times), lambda: jobs.capture(store, land(ANA, BOB), NOW))

    def broken():
        raise ValueError("x" * 5000)

    with pytest.raises(ValueError):
        jobs.logged(spark, log, "r2", lambda: next(times), broken)
    runs = {row.run_id: row for row in run_summary(spark.read.parquet(log)).collect()}
    assert (runs["r1"].status, runs["r1"].read, runs["r1"].new, runs["r1"].seconds) == ("SUCESSO", 2, 2, 77400)
    assert runs["r2"].status == "ERRO" and len(runs["r2"].message) == 4000 and runs["r2"].ended == LATER


def test_local_now(spark):
    from zoneinfo import ZoneInfo

    from claimflow.functions.clock import local_now

    here = datetime.now(ZoneInfo("America/Sao_Paulo")).replace(tzinfo=None)
    assert abs((local_now(spark.range(1)).first().now - here).total_seconds()) < 60


def test_building_a_view_runs_no_job(spark, start, land):
    state, _ = loaded(start, land(ANA, BOB))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("views", "building")
    v.register_views(spark, state)
    assert list(tracker.getJobIdsForGroup("views")) == []
    spark.sparkContext.setJobGroup("", "")


def test_one_outcome_per_queue_row(spark):
    sent = spark.createDataFrame([(1, 7, NOW), (2, 7, LATER)], "queue_id long, process long, slot timestamp_ntz")
    responses = spark.createDataFrame(
        [(7, 500, None, "x", NOW), (7, 201, '{"id":3}', None, LATER), (7, 201, '{"id":3}', None, LATER)],
        "process long, status_code int, body string, error string, received_at timestamp_ntz")
    booked = d.outcomes(sent, responses)
    assert rows(booked, "queue_id", "status") == [(1, 2), (2, 2)]
    named = responses.withColumn("queue_id", F.lit(2).cast("long"))
    assert rows(d.outcomes(sent, named), "queue_id", "status") == [(2, 2)]
    queue = spark.createDataFrame([(1, 7, 1, 0), (2, 7, 1, 0)], "id long, process long, status int, attempts int").withColumns(
        {"message": F.lit(None).cast("string"), "slot": F.lit(None).cast("timestamp_ntz"), "last_attempt": F.lit(None).cast("timestamp_ntz")})
    twice = booked.union(booked)
    assert rows(t.apply_outcomes(queue, twice, LATER), "id", "attempts", "slot") == [(1, 1, NOW), (2, 1, LATER)]


def test_details_are_merged_into_the_listing(spark, land, tmp_path):
    store = StateTables(spark, str(tmp_path / "state"), buckets=4)
    store.seed()
    listed = [{"idProcesso": 1, "noSinistro": "1", "nmAnalista": "Caio", "idUsuario": 7, "nomeSegurado": "Old"},
              {"idProcesso": 2, "noSinistro": "2", "dsStatus": "Listed", "idUsuario": 7}, {"idProcesso": 3, "noSinistro": "3", "idUsuario": 7}]
    details = [{"idProcesso": 1, "status_processo": "Detail", "nomeSegurado": "New", "nmAnalista": "Not this one"},
               {"idProcesso": 2, "status_processo": "Detail"}, {"idProcesso": 9, "status_processo": "Unlisted"}]
    more = [{"idProcesso": 1, "nomeSegurado": "Newest", "marca": "Ford"}]
    jobs.capture(store, land(*listed, name="listing"), NOW, by_id=land(*details, name="detail"), follow_up=land(*more, name="more"))
    state = store.load("process", "party", "vehicle", "raw_history")
    assert rows(state["process"], "id", "phase") == [(1, "Detail"), (2, "Listed"), (3, "PROCESSO RECEPCIONADO")]
    assert rows(state["vehicle"].filter("process = 1"), "brand") == [("Ford",)]
    assert {row.name for row in state["party"].filter("process = 1").collect()} >= {"Newest", "Caio"}
    # by capture date
    assert state["raw_history"].filter("capture_date = DATE'2026-03-10'").count() == 3
    assert "PartitionFilters: [isnotnull(capture_date" in state["raw_history"].filter(
        "capture_date = DATE'2026-03-10'")._jdf.queryExecution().executedPlan().toString()


def test_dispatch_and_book(spark, land, tmp_path):
    store = StateTables(spark, str(tmp_path / "state"), buckets=4)
    store.seed()
    jobs.capture(store, land(ANA, BOB, EVA), NOW)
    assert jobs.dispatch(store, NOW, "r1").committed and not jobs.dispatch(store, LATER, "r1").committed
    assert rows(store.load("outbox")["outbox"], "run_id", "id_processo") == [("r1", 1), ("r1", 2), ("r1", 3)]
    responses = spark.createDataFrame(
        [(1, 201, '{"id":7,"message":"ok"}', None), (2, 409, '{"message":"twice"}', None), (3, None, None, "timeout")],
        "process long, status_code int, body string, error string")
    assert jobs.book(store, "r1", responses, LATER).committed and not jobs.book(store, "r1", responses, LATER).committed
    state = store.load("queue", "sla", "api_log", "notification_log")
    assert rows(state["queue"], "process", "status", "attempts") == [(1, 2, 1), (2, 4, 1), (3, 3, 1)]
    assert state["sla"].filter("sent IS NOT NULL").count() == 1
    assert rows(state["api_log"], "run_id", "process", "status_code") == [("r1", 1, 201), ("r1", 2, 409), ("r1", 3, 500)]
    notes = {row.process: json.loads(row.payload) for row in state["notification_log"].collect()}
    assert set(notes) == {1, 3} and notes[1]["sucesso"] and not notes[3]["sucesso"] and notes[1]["acionamentoId"] == 7


def test_a_taken_version_is_refused(spark, land, tmp_path):
    store = StateTables(spark, str(tmp_path / "state"), buckets=4)
    store.seed()
    other = StateTables(spark, store.root)
    queue = spark.createDataFrame([], store.load("queue")["queue"].schema)
    assert store.commit(1, {"queue": queue}, marker="a:1") and store.booked("a:1") and not store.booked("a:2")
    other.version = lambda: 0  # has not seen version 1 yet
    with pytest.raises(CommitRefused):
        other.commit(1, {"queue": queue})
    assert store.version() == 1 and store.compact("queue") and store.version() == 2


def test_a_closing_row_is_later_than_an_opening_one(spark):
    log = spark.createDataFrame([("r", NOW, "SUCESSO", 1, 1, "ok"), ("r", NOW, "RODANDO", None, None, None)], TABLES["run_log"])
    assert run_summary(log).first().status == "SUCESSO"


def test_runs_on_committed_state(spark, land, tmp_path):
    store = StateTables(spark, str(tmp_path / "state"), buckets=4)
    assert store.version() == -1 and store.seed() and not store.seed()
    assert jobs.capture(store, land(ANA, BOB, name="one"), NOW).committed
    assert not jobs.capture(store, land(EVA, name="two"), NOW, version=1).committed
    jobs.capture(store, land(ANA, EVA, name="three"), LATER)
    state = store.load()
    assert rows(state["process"], "id") == [(1,), (2,), (3,)]
    assert rows(state["queue"], "process", "status") == [(1, 1), (2, 2), (3, 1)]
    jobs.enrich(store, land({**EVA, "dsStatus": "Nova"}, name="four"), LATER)
    assert store.load("process")["process"].filter("id = 3").first().phase == "Nova"
    out = jobs.outbox(store, LATER).checkpoint()
    responses = spark.createDataFrame([(1, 201, '{"id":7,"message":"ok"}', None)], "process long, status_code int, body string, error string")
    assert jobs.record_outcomes(store, out, responses, LATER).count() == 1
    assert rows(store.load("queue")["queue"], "process", "status") == [(1, 2), (2, 2), (3, 1)]
    snapshot = spark.createDataFrame([(1, 22, None)], "process long, status int, status_text string")
    jobs.audit(store, snapshot, LATER)
    assert store.load("process")["process"].filter("id = 1").first().portal_status == 22


def test_no_task_aggregates_a_whole_table(spark):
    """A table may be one row group: its rows are dealt out by order before they are grouped, and guards keep no table of stored keys."""
    from claimflow.binding import q_transitions as q
    from claimflow.binding import warehouse as w

    sf = "/root/testdata/sf0.001"
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for table in (w.vehicle(spark, sf), w.user_history(spark, sf), w.document(spark, sf), q._people(spark, sf)[0]):
        scan = plan(table).split("lineitem.parquet")[0].rsplit("FileScan", 1)[0]
        last = scan.rsplit("Aggregate", 1)[1]
        assert "REPARTITION_BY_NUM" in last
    news, stored = spark.range(5).withColumnRenamed("id", "key"), spark.range(3, 9).withColumnRenamed("id", "key").repartition(2)
    missing, known = r.missing_in(news, stored, ["key"]), r.exists_in(news, stored, ["key"])
    assert sorted(row.key for row in missing.collect()) == [0, 1, 2] and sorted(row.key for row in known.collect()) == [3, 4]
    assert missing._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1  # the keys of the batch
