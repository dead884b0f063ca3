"""From ready rows to payloads, and from responses to outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions import cleanse as c
from claimflow.functions.clock import stamp
from claimflow.operators import relational as r
from claimflow.operators import transitions as t
from claimflow.operators.normalise import normalise_response
from claimflow.operators.slots import assign_slots, fresh_or_now

# Fixed values.
DETAILS = "Capturado via RPA Portal Seguradora - "
ANALYST_NOTE = " | Analista Seguradora: "
WARNINGS = " | Detalhes: "
ALL_GOOD = "Cadastrado com Sucesso (Dados Completos)"
NOTIFY_TO = (
    "analista@empresa-operadora.com.br, gestao1@empresa-operadora.com.br, gestao2@empresa-operadora.com.br"
)
UNKNOWN_F = "Não informada"
UNKNOWN_M = "Não informado"
PARAMETER_KEYS = {"requester": "ID_SOLICITANTE", "service": "ID_SERVICO", "nature": "ID_NATUREZA"}


def _said(col: Column) -> Column:
    """Stripped text, NULL if it says nothing."""
    return c.nullify(c.strip(col.cast("string")))


def _phones(number: Column) -> Column:
    """One-element phone list, NULL unless the number has ten or eleven digits."""
    digits = F.length(F.regexp_replace(number, "[^0-9]", ""))
    return F.when(digits.isin(10, 11), F.array(F.struct(number.alias("number"), F.lit(1).alias("typeId"))))


def build_payload(rows: DataFrame, requester: Column, service: Column, nature: Column, now) -> DataFrame:
    """Add ``payload``: the nested request of a ready row whose ``data_agendada`` is set.

    Absent parts are NULL, which ``to_json`` leaves out.
    """
    area = F.coalesce(F.col("ddd_segurado").cast("string"), F.lit(""))
    insured_phone = _phones(F.concat(area, _said(F.col("tel_segurado"))))
    broker_name, broker_email = _said(F.col("nome_corretor")), c.first_email(F.col("email_corretor"))
    analyst_name = F.coalesce(c.strip(F.col("nome_analista_seguradora")), F.lit(""))
    analyst_email = c.first_email(F.col("email_analista_seguradora"))
    has_analyst = (analyst_name != "") & analyst_email.contains("@")
    details = F.concat(F.lit(DETAILS), F.date_format(stamp(now), "dd/MM/yyyy"))

    payload = F.struct(
        requester.alias("solicitanteId"),
        service.alias("servicoId"),
        nature.alias("naturezaId"),
        F.coalesce("sinistro_tratado", F.lit("")).alias("sinistro"),
        c.iso_ts(F.col("dt_sinistro")).alias("sinistroDataHora"),
        c.iso_ts(F.col("data_agendada"), stamp(now)).alias("dataHora"),
        F.coalesce("placa_veiculo", F.lit(c.PLATE_PLACEHOLDER)).alias("placa"),
        F.coalesce("uf_processo", F.lit("SP")).alias("uf"),
        F.coalesce("chassi_veiculo", F.lit("")).alias("chassi"),
        F.col("valor_fipe").cast("double").alias("fipeValue"),
        F.when(has_analyst, details).otherwise(F.concat(details, F.lit(ANALYST_NOTE), analyst_name)).alias("detalhes"),
        F.struct(
            F.coalesce("tipo_envolvido_id", F.lit(1)).alias("typeId"),
            F.coalesce("nome_segurado", F.lit("")).alias("name"),
            c.first_email(F.col("email_segurado")).alias("email"),
            F.struct(
                F.coalesce("tipo_doc_id", F.lit(1)).alias("type"),
                F.coalesce("doc_formatado", F.lit("")).alias("value"),
            ).alias("document"),
            insured_phone.alias("phones"),
        ).alias("envolvido"),
        F.when(
            broker_name.isNotNull() & broker_email.contains("@"),
            F.struct(F.lit(3).alias("typeId"), broker_name.alias("name"), broker_email.alias("email"),
                     _phones(_said(F.col("tel_corretor"))).alias("phones")),
        ).alias("corretor"),
        F.when(
            has_analyst,
            F.struct(F.lit(4).alias("typeId"), analyst_name.alias("name"), analyst_email.alias("email")),
        ).alias("analista"),
    )
    return rows.withColumn("payload", payload)


# Several parties of a role repeat a queue row; these columns tell the repeats apart.
# Rows that agree in all of them have the same payload but for the slot.
ORDER = (
    "data_portal", "id_fila", "nome_segurado", "nome_corretor", "email_corretor", "nome_analista_seguradora",
    "email_analista_seguradora", "placa_veiculo", "doc_formatado", "ddd_segurado", "tel_segurado", "email_segurado",
    "tel_corretor", "chassi_veiculo", "tipo_envolvido_id",
)


def dispatch_batch(view: DataFrame, params: DataFrame, now, queue: Column | None = None,
                   carry: DataFrame | None = None) -> DataFrame:
    """Ready rows with slot and payload: the outbox of one run.

    Rows go by portal date (missing first, then queue id); stale dates count as now.
    """
    order = list(ORDER)
    dated = view.withColumn("_at", fresh_or_now(F.col("data_portal"), stamp(now)))
    slotted = assign_slots(dated, queue, "_at", order, name="data_agendada", carry=carry).drop("_at")

    def number(name: str) -> Column:
        return params.filter(F.col("key") == PARAMETER_KEYS[name]).agg(F.max("number")).scalar()

    built = build_payload(slotted, number("requester"), number("service"), number("nature"), now)
    return built.withColumn("payload_json", F.to_json("payload"))


def outcome_message(message: Column, warnings: Column | None = None) -> Column:
    text = F.coalesce(message, F.lit(""))
    if warnings is not None:
        text = F.when(F.size(warnings) > 0, F.concat(text, F.lit(WARNINGS), F.array_join(warnings, ", "))).otherwise(text)
    return F.when((c.strip(text) == "") | (text == "None"), F.lit(ALL_GOOD)).otherwise(text)


def outcomes(sent: DataFrame, responses: DataFrame) -> DataFrame:
    """One outcome per sent row (queue_id, process, slot) from its landed response.

    Responses may name the queue row (``queue_id``) and their time (``received_at``). Of several for one
    queue row, or for one process where rows are not named, the latest counts.
    """
    key = ["process", *[name for name in ("queue_id",) if name in responses.columns]]
    latest = [F.col("received_at").desc_nulls_last()] if "received_at" in responses.columns else []
    one = r.top1(responses, key, [*latest, F.col("status_code").asc_nulls_last(), F.col("body"), F.col("error")])
    answers = normalise_response(one, key)
    return sent.join(answers, key).select(
        "queue_id", "process", "slot", "status_code", t.outcome_status(F.col("status_code")).alias("status"),
        "request_id", outcome_message(F.col("message")).alias("message"),
    )


def build_notification(rows: DataFrame, now, to: str = NOTIFY_TO) -> DataFrame:
    """Flat message record of ready rows joined with their outcome (status, request_id, message); ``to`` lists the recipients."""
    return rows.select(*notification_columns(now, to))


def notification_columns(now, to: str = NOTIFY_TO) -> list[Column]:

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(default))

    return [
        F.lit(to).alias("email_destino"),
        (F.col("status") == 2).alias("sucesso"),
        text("cia", t.COMPANY).alias("cia"),
        F.date_format(stamp(now), "dd/MM/yyyy").alias("data"),
        F.date_format(stamp(now), "HH:mm").alias("hora"),
        F.coalesce(F.date_format("data_portal", "yyyy-MM-dd HH:mm:ss"), F.lit(UNKNOWN_F)).alias("data_portal"),
        text("placa_veiculo", UNKNOWN_F).alias("placa"),
        text("uf_processo", "SP").alias("uf"),
        text("chassi_veiculo", UNKNOWN_F).alias("chassi"),
        text("sinistro_tratado", UNKNOWN_F).alias("sinistro"),
        F.coalesce(F.col("request_id").try_cast("long"), F.lit(0)).alias("acionamentoId"),
        text("message", "").alias("mensagem_api"),
        F.lit(UNKNOWN_M).alias("usuario_portal"),
        text("nome_segurado", UNKNOWN_M).alias("nome_segurado"),
        c.dedupe_emails(F.col("email_segurado")).alias("email_segurado"),
        F.concat(text("ddd_segurado", ""), text("tel_segurado", "")).alias("telefone_segurado"),
        text("nome_corretor", UNKNOWN_M).alias("nome_corretor"),
        c.dedupe_emails(F.col("email_corretor")).alias("email_corretor"),
        text("tel_corretor", UNKNOWN_M).alias("telefone_corretor"),
        F.upper(text("nome_analista_operadora", "SISTEMA")).alias("nome_analista_operadora"),
        text("email_analista_operadora", "").alias("email_analista_operadora"),
        text("nome_analista_seguradora", UNKNOWN_M).alias("nome_analista_seguradora"),
        text("email_analista_seguradora", "").alias("email_analista_seguradora"),
    ]
