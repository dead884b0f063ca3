"""Record and table schemas.

Portal values arrive in mixed JSON types (a flag may be "S", true or 1), so the
record schema reads every loose scalar as text and the cleansing functions type it.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


TEXT, LONG, INT, TS = StringType(), LongType(), IntegerType(), TimestampNTZType()
MONEY = DecimalType(18, 2)

WORKFLOW_ENTRY = _struct(
    ("dataHoraEvento", TEXT), ("idEvento", LONG), ("evento", TEXT), ("statusProcesso", TEXT), ("observacao", TEXT),
)

DOCUMENT_ENTRY = _struct(
    ("dsDocumento", TEXT), ("nomeDocumento", TEXT), ("descricao", TEXT),
    ("dsStatus", TEXT), ("statusDocumento", TEXT), ("status", TEXT),
)

_TEXT_KEYS = (
    "noSinistro tpExpediente status_processo dsStatusCorrenteProcesso dsStatus dsStatusCorrente "
    "flAlerta flBaixaGravame dsUF ddd nmBeneficiario nomeSegurado cpfCnpj cpfSegurado emailBeneficiario "
    "emailSegurado telefoneBeneficiario nmCorretor emailCorretor telefoneCorretor dddCorr nmAnalista "
    "emailAnalistaTw placaVeiculo placa nmMarca dsMarca marca nmModelo dsModelo modelo chassi nrChassi "
    "subModeloVeiculo subModelo vrFipe valorFipe valorMercado anoVeiculo nrAnoFabricacao anoFabricacao ano "
    "dtSinistro dtAberturaSinistro dsTpFinanciamento usuario_origem"
).split()

RECORD = StructType(
    [StructField("idProcesso", LONG, True), StructField("idStatusCorrente", TEXT, True),
     StructField("idCicloCorrente", TEXT, True), StructField("idUsuario", INT, True)]
    + [StructField(key, TEXT, True) for key in _TEXT_KEYS]
    + [StructField("logWorkFlow", ArrayType(WORKFLOW_ENTRY), True)]
    + [StructField(key, ArrayType(DOCUMENT_ENTRY), True)
       for key in ("documentos", "listaDocumentos", "documentosProcesso")]
)

TABLES: dict[str, StructType] = {
    "raw_latest": _struct(("id", LONG), ("claim", TEXT), ("json", TEXT), ("captured_at", TS)),
    "raw_history": _struct(("id", LONG), ("claim", TEXT), ("json", TEXT), ("captured_at", TS), ("capture_date", DateType())),
    "process": _struct(
        ("id", LONG), ("claim", TEXT), ("file_type", INT), ("portal_status", INT), ("uf", TEXT), ("company", TEXT),
        ("opened", TS), ("occurred", TS), ("phase", TEXT), ("alert", INT), ("loaded_at", TS), ("active", INT)),
    "queue": _struct(
        ("id", LONG), ("process", LONG), ("status", INT), ("attempts", INT), ("slot", TS), ("last_attempt", TS),
        ("message", TEXT), ("loaded_at", TS), ("active", INT)),
    "vehicle": _struct(
        ("id", LONG), ("process", LONG), ("plate", TEXT), ("chassis", TEXT), ("brand", TEXT), ("model", TEXT),
        ("submodel", TEXT), ("year", INT), ("value", MONEY), ("encumbered", INT), ("loaded_at", TS)),
    "party": _struct(
        ("id", LONG), ("process", LONG), ("type", INT), ("name", TEXT), ("tax_id", TEXT), ("loaded_at", TS)),
    "contact": _struct(
        ("id", LONG), ("process", LONG), ("party", LONG), ("type", INT), ("area", INT), ("value", TEXT), ("principal", INT),
        ("loaded_at", TS)),
    "event": _struct(
        ("process", LONG), ("event", LONG), ("text", TEXT), ("happened_at", TS), ("loaded_at", TS)),
    "step": _struct(
        ("process", LONG), ("task", LONG), ("name", TEXT), ("status", TEXT), ("happened_at", TS), ("loaded_at", TS)),
    "document": _struct(("process", LONG), ("name", TEXT), ("status", TEXT), ("loaded_at", TS)),
    "sla": _struct(
        ("id", LONG), ("process", LONG), ("received", TS), ("captured", TS), ("sent", TS), ("queue_minutes", INT), ("status", TEXT)),
    "user_history": _struct(
        ("process", LONG), ("user_id", INT), ("entered_at", TS), ("left_at", TS), ("is_current", INT)),
    # what the runs keep of a process's events, steps and users, so that they need not be read again
    "summary": _struct(("process", LONG), ("first_event", TS), ("changed_at", TS), ("user_id", INT), ("left_at", TS)),
    "robot_user": _struct(("id", INT), ("name", TEXT), ("login", TEXT), ("email", TEXT)),
    "portal_status": _struct(
        ("code", INT), ("label", TEXT), ("context", TEXT), ("operator_status", INT), ("final", INT), ("active", INT)),
    "operator_status": _struct(("code", INT), ("label", TEXT), ("active", INT)),
    "workflow_event": _struct(("code", LONG), ("label", TEXT), ("phase", TEXT), ("active", INT)),
    "file_type": _struct(("code", INT), ("sigla", TEXT), ("label", TEXT), ("active", INT)),
    "queue_status": _struct(("code", INT), ("sigla", TEXT), ("label", TEXT), ("attention", INT), ("active", INT)),
    "party_type": _struct(("code", INT), ("label", TEXT), ("active", INT)),
    "contact_type": _struct(("code", INT), ("label", TEXT), ("active", INT)),
    "area_code": _struct(("code", INT), ("uf", TEXT), ("state", TEXT), ("region", TEXT), ("active", INT)),
    "parameter": _struct(("key", TEXT), ("text", TEXT), ("number", LONG)),
    "run_log": _struct(
        ("run_id", TEXT), ("logged_at", TS), ("status", TEXT), ("read", LONG), ("new", LONG), ("message", TEXT)),
    "api_log": _struct(
        ("run_id", TEXT), ("process", LONG), ("target", TEXT), ("action", TEXT), ("status_code", INT),
        ("payload", TEXT), ("response", TEXT), ("logged_at", TS)),
    "notification_log": _struct(
        ("run_id", TEXT), ("process", LONG), ("status_code", INT), ("payload", TEXT), ("message", TEXT), ("logged_at", TS)),
    # what a run hands to the sender: the ready view's columns, slot and payload
    "outbox": _struct(
        ("run_id", TEXT), ("id_fila", LONG), ("id_processo", LONG), ("cia", TEXT), ("uf_processo", TEXT), ("sinistro_tratado", TEXT),
        ("tipo_envolvido_id", INT), ("nome_segurado", TEXT), ("email_segurado", TEXT), ("ddd_segurado", INT), ("tel_segurado", TEXT),
        ("doc_formatado", TEXT), ("nome_corretor", TEXT), ("email_corretor", TEXT), ("tel_corretor", TEXT),
        ("nome_analista_seguradora", TEXT), ("email_analista_seguradora", TEXT), ("nome_analista_operadora", TEXT),
        ("email_analista_operadora", TEXT), ("data_portal", TS), ("placa_veiculo", TEXT), ("chassi_veiculo", TEXT),
        ("data_agendada", TS), ("payload_json", TEXT)),
    "anomaly": _struct(
        ("source", TEXT), ("key", TEXT), ("kind", TEXT), ("detail", TEXT), ("severity", TEXT), ("resolved", INT)),
}
