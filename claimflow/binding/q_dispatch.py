"""Payloads, responses and outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.binding import sql as s
from claimflow.binding import warehouse as w
from claimflow.binding.catalog import query
from claimflow.binding.q_stateful import BASE, NEXT
from claimflow.binding.q_views import READY, ready
from claimflow.operators import transitions as t
from claimflow.operators.normalise import normalise_response as normalise
from claimflow.plans import dispatch as d
from claimflow.sources.dictionaries import dictionaries
from claimflow.sources.tables import load

NOW = "2001-08-03 12:00:00"
AT = f"TIMESTAMP '{NOW}'"


def responses(spark, sf):
    """A landed response per order."""
    orders = load(spark, sf, "orders")
    p, st, key = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey")
    code = F.when(st == "F", F.lit(None)).when(p == w.URGENT, 201).when(p == w.HIGH, 200).when(p == w.MEDIUM, 409).when(p == w.LOW, 204).otherwise(500)
    body = (
        F.when(p == w.URGENT, F.concat(F.lit('{"id":'), key, F.lit(',"message":"ok"}')))
        .when(p == w.HIGH, F.concat(F.lit('{"id":0,"acionamentoId":"A'), key, F.lit('","message":"  "}')))
        .when(p == w.MEDIUM, F.lit('{"message":"duplicate"}')).otherwise(F.lit('{"error":"down"}')))
    return orders.select(key.alias("process"), code.alias("status_code"), body.alias("body"),
                         F.when(st == "F", F.lit("timeout")).alias("error"))


_RESPONSE = f"""
    answer AS (
        SELECT o_orderkey AS process,
               CASE WHEN o_orderstatus = 'F' THEN 500 WHEN o_orderpriority = '1-URGENT' THEN 201 WHEN o_orderpriority = '2-HIGH' THEN 200
                    WHEN o_orderpriority = '3-MEDIUM' THEN 409 WHEN o_orderpriority = '5-LOW' THEN 204 ELSE 500 END AS status_code,
               CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderkey AS VARCHAR)
                    WHEN o_orderpriority = '2-HIGH' THEN 'A' || o_orderkey END AS request_id,
               CASE WHEN o_orderstatus = 'F' THEN 'Erro de conexão com PlataformaGestao: timeout' WHEN o_orderpriority = '1-URGENT' THEN 'ok'
                    WHEN o_orderpriority = '2-HIGH' THEN '  ' WHEN o_orderpriority = '3-MEDIUM' THEN 'duplicate'
                    WHEN o_orderpriority = '5-LOW' THEN 'Sucesso sem conteúdo' ELSE '{{"error":"down"}}' END AS message
        FROM orders),
    booked AS (
        SELECT q.id AS queue_id, q.process, q.slot, status_code,
               CASE WHEN status_code IN (200, 201) THEN 2 WHEN status_code = 409 THEN 4 ELSE 3 END AS status, request_id,
               CASE WHEN trim(a.message) IN ('', 'None') THEN 'Cadastrado com Sucesso (Dados Completos)' ELSE a.message END AS message
        FROM queue q JOIN answer a ON a.process = q.process WHERE q.status IN (1, 3) AND active = 1)"""


def booked(spark, sf):
    from claimflow.plans.views import dispatchable

    sent = dispatchable(w.queue(spark, sf)).select(F.col("id").alias("queue_id"), "process", "slot")
    return d.outcomes(sent, responses(spark, sf))


# the answer to order 0 repeats id 0, which counts as no id
@query("normalise_response", f"""
    WITH {_RESPONSE.strip()}
    SELECT process, status_code, nullif(request_id, '0') AS request_id, message FROM answer""")
def normalise_response(spark, sf):
    return normalise(responses(spark, sf))


@query("outcome_message", """
    SELECT conv_id, turn, CASE WHEN trim(m) IN ('', 'None') THEN 'Cadastrado com Sucesso (Dados Completos)' ELSE m END AS message
    FROM (SELECT conv_id, turn, CASE role WHEN 'user' THEN text || ' | Detalhes: ' || role || ', ' || role WHEN 'system' THEN ' ' ELSE 'None' END AS m
          FROM conversations)""")
def outcome_message(spark, sf):
    rows = load(spark, sf, "conversations")
    role = F.col("role")
    message = F.when(role == "user", F.col("text")).when(role == "system", " ").otherwise("None")
    warnings = F.when(role == "user", F.array(role, role)).otherwise(F.array().cast("array<string>"))
    return rows.select("conv_id", "turn", d.outcome_message(message, warnings).alias("message"))


@query("outcomes", f"""
    WITH {_RESPONSE.strip()}
    SELECT queue_id, process, slot, status_code, status, nullif(request_id, '0') AS request_id, message FROM booked""")
def outcomes(spark, sf):
    return booked(spark, sf)


@query("apply_outcomes", f"""
    WITH {_RESPONSE.strip()}
    SELECT q.id, coalesce(b.status, q.status) AS status, q.attempts + CASE WHEN b.queue_id IS NULL THEN 0 ELSE 1 END AS attempts,
           CASE WHEN b.queue_id IS NULL THEN q.last_attempt ELSE {AT} END AS last_attempt,
           CASE WHEN b.queue_id IS NULL THEN q.message ELSE b.message END AS message,
           CASE WHEN b.queue_id IS NULL THEN q.slot ELSE b.slot END AS slot
    FROM queue q LEFT JOIN booked b ON b.queue_id = q.id""")
def apply_outcomes(spark, sf):
    return t.apply_outcomes(w.queue(spark, sf), booked(spark, sf), NOW).select("id", "status", "attempts", "last_attempt", "message", "slot")


@query("sla_minutes", f"""
    WITH {_RESPONSE.strip()}
    SELECT process, CASE WHEN hit THEN {AT} ELSE sent END AS sent,
           CASE WHEN hit THEN CAST(date_diff('minute', captured, {AT}) AS INTEGER) ELSE queue_minutes END AS queue_minutes
    FROM (SELECT *, sent IS NULL AND process IN (SELECT process FROM booked WHERE status = 2) AS hit FROM sla)""")
def sla_minutes(spark, sf):
    return t.stamp_sla(w.sla(spark, sf), booked(spark, sf), NOW).select("process", "sent", "queue_minutes")


@query("notify", f"WITH {_RESPONSE.strip()} SELECT queue_id, process, status, message FROM booked WHERE status IN (2, 3)")
def notify(spark, sf):
    return t.notifications(booked(spark, sf)).select("queue_id", "process", "status", "message")


@query("notification", f"""
    WITH {_RESPONSE.strip()},
    v AS ({READY})
    SELECT id_fila, CAST(status = 2 AS INTEGER) AS sucesso, cia, '03/08/2001' AS data, '12:00' AS hora,
           coalesce(strftime(data_portal, '%Y-%m-%d %H:%M:%S'), 'Não informada') AS data_portal, coalesce(placa_veiculo, 'Não informada') AS placa,
           uf_processo AS uf, coalesce(chassi_veiculo, 'Não informada') AS chassi, sinistro_tratado AS sinistro,
           coalesce(try_cast(request_id AS BIGINT), 0) AS "acionamentoId", message AS mensagem_api, 'Não informado' AS usuario_portal,
           coalesce(nome_segurado, 'Não informado') AS nome_segurado, {s.dedupe_emails('email_segurado')} AS email_segurado,
           coalesce(CAST(ddd_segurado AS VARCHAR), '') || coalesce(tel_segurado, '') AS telefone_segurado,
           coalesce(nome_corretor, 'Não informado') AS nome_corretor, {s.dedupe_emails('email_corretor')} AS email_corretor,
           coalesce(tel_corretor, 'Não informado') AS telefone_corretor, upper(coalesce(nome_analista_operadora, 'SISTEMA')) AS nome_analista_operadora,
           coalesce(email_analista_operadora, '') AS email_analista_operadora,
           coalesce(nome_analista_seguradora, 'Não informado') AS nome_analista_seguradora,
           coalesce(email_analista_seguradora, '') AS email_analista_seguradora
    FROM v JOIN booked ON queue_id = id_fila WHERE status IN (2, 3)""")
def notification(spark, sf):
    done = t.notifications(booked(spark, sf)).select(F.col("queue_id").alias("id_fila"), "status", "request_id", "message")
    rows = ready(spark, sf).join(done, "id_fila")
    note = d.build_notification(rows.withColumn("cia", F.col("cia")), NOW)
    # the queue id is not part of the message; the claim identifies it here
    return note.drop("email_destino").withColumn("sucesso", F.col("sucesso").cast("int")).withColumn(
        "id_fila", F.regexp_replace("sinistro", "[CT]", "").cast("long"))


_PAYLOAD = f"""
    SELECT id_fila, 80 AS "solicitanteId", 2 AS "servicoId", 3 AS "naturezaId", sinistro_tratado AS sinistro, {s.iso('dt_sinistro')} AS "sinistroDataHora",
           {s.iso('slot')} AS "dataHora", coalesce(placa_veiculo, 'AVI0000') AS placa, uf_processo AS uf, coalesce(chassi_veiculo, '') AS chassi,
           valor_fipe AS "fipeValue",
           'Capturado via RPA Portal Seguradora - 03/08/2001' || CASE WHEN coalesce(trim(nome_analista_seguradora), '') <> ''
               AND contains({s.first_email('email_analista_seguradora')}, '@') THEN '' ELSE ' | Analista Seguradora: ' || coalesce(trim(nome_analista_seguradora), '') END AS detalhes,
           tipo_envolvido_id AS type_id, nome_segurado AS name, {s.first_email('email_segurado')} AS email, tipo_doc_id AS doc_type,
           coalesce(doc_formatado, '') AS doc,
           CASE WHEN length(regexp_replace(coalesce(CAST(ddd_segurado AS VARCHAR), '') || tel_segurado, '[^0-9]', '', 'g')) IN (10, 11)
                THEN coalesce(CAST(ddd_segurado AS VARCHAR), '') || tel_segurado END AS phone,
           CASE WHEN contains({s.first_email('email_corretor')}, '@') THEN nome_corretor END AS broker,
           CASE WHEN contains({s.first_email('email_corretor')}, '@') THEN {s.first_email('email_corretor')} END AS broker_email,
           CASE WHEN contains({s.first_email('email_corretor')}, '@') AND length(regexp_replace(tel_corretor, '[^0-9]', '', 'g')) IN (10, 11)
                THEN tel_corretor END AS broker_phone,
           CASE WHEN contains({s.first_email('email_analista_seguradora')}, '@') THEN nome_analista_seguradora END AS analyst
    FROM {{source}}"""


def _flat(rows):
    p = F.col("payload")
    return rows.select(
        "id_fila", *[p[name].alias(name) for name in ("solicitanteId", "servicoId", "naturezaId")],
        *[p[name].alias(name) for name in ("sinistro", "sinistroDataHora", "dataHora", "placa", "uf", "chassi", "fipeValue", "detalhes")],
        p["envolvido"]["typeId"].alias("type_id"), p["envolvido"]["name"].alias("name"), p["envolvido"]["email"].alias("email"),
        p["envolvido"]["document"]["type"].alias("doc_type"), p["envolvido"]["document"]["value"].alias("doc"),
        F.get(p["envolvido"]["phones"], F.lit(0))["number"].alias("phone"),
        p["corretor"]["name"].alias("broker"), p["corretor"]["email"].alias("broker_email"),
        F.get(p["corretor"]["phones"], F.lit(0))["number"].alias("broker_phone"), p["analista"]["name"].alias("analyst"))


@query("payload", f"""
    WITH v AS ({READY}) {_PAYLOAD.format(source=f"(SELECT *, coalesce(data_agendada, {AT}) AS slot FROM v)")}""")
def payload(spark, sf):
    built = d.build_payload(ready(spark, sf), F.lit(80), F.lit(2), F.lit(3), NOW)
    return _flat(built)


@query("dispatch", f"""
    WITH RECURSIVE v AS ({READY}),
    dated AS (SELECT *, CASE WHEN data_portal IS NULL OR data_portal < {AT} - INTERVAL 5 DAY THEN {AT} ELSE data_portal END AS ts FROM v),
    ranked AS (SELECT *, {BASE.format(ts='ts')} AS base, row_number() OVER (PARTITION BY uf_processo ORDER BY data_portal NULLS FIRST, id_fila,
        nome_segurado NULLS FIRST, nome_corretor NULLS FIRST, email_corretor NULLS FIRST, nome_analista_seguradora NULLS FIRST) AS n FROM dated),
    chain AS (
        SELECT uf_processo AS q, n, base AS slot FROM ranked WHERE n = 1
        UNION ALL
        SELECT r.uf_processo, r.n, {NEXT} FROM chain c JOIN ranked r ON r.uf_processo = c.q AND r.n = c.n + 1),
    placed AS (SELECT ranked.*, slot FROM ranked JOIN chain ON chain.q = uf_processo AND chain.n = ranked.n)
    {_PAYLOAD.format(source='placed')}""")
def dispatch(spark, sf):
    out = d.dispatch_batch(ready(spark, sf), dictionaries(spark)["parameter"], NOW, queue=F.col("uf_processo"))
    flat = _flat(out)
    return flat.withColumns({name: F.col(name).cast("int") for name in ("solicitanteId", "servicoId", "naturezaId")})
