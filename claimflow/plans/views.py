"""The two wide views: rows ready to send, and the history of every process."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.functions import cleanse as c
from claimflow.operators import relational as r
from claimflow.operators import summaries as m

Tables = dict[str, DataFrame]

VIEW_NAMES = {"ready": "vw_processos_prontos_envio", "history": "vw_historico_geral_processos"}


def dispatchable(queue: DataFrame) -> DataFrame:
    """Pending and failed rows that are active."""
    return queue.filter(F.col("status").isin(1, 3) & (F.col("active") == 1))


def _labelled_process(process: DataFrame, user: DataFrame, t: Tables, user_columns: dict[str, str]) -> DataFrame:
    """One row per process with its labels and current user (process, user_id, left_at), before anything multiplies it."""
    user = user.withColumnsRenamed({"process": "id", "user_id": "_user", "left_at": "_left_at"})
    return r.with_labels(
        process.join(user, "id", "left"),
        (t["file_type"], "code", "file_type", {"_sigla": "sigla", "_file_label": "label"}),
        (t["portal_status"], "code", "portal_status", {
            "_status_label": "label", "_context": "context", "_operator_code": "operator_status"}),
        (t["operator_status"].withColumn("_code", F.col("code")), "code", "_operator_code", {
            "_operator_label": "label", "_operator_status": "_code"}),
        (t["robot_user"], "id", "_user", user_columns),
    ).withColumnRenamed("id", "_process")


ROLES = {"insured": (1, 2), "broker": (3,), "analyst": (4,)}


def _parties(t: Tables, keys: DataFrame, contact_tie: tuple[str, ...], cut: bool = True) -> dict[str, DataFrame]:
    """Parties by role with their best e-mail and phone; at least one row per process of ``keys``.

    With ``cut``, parties and contacts are cut down to the given processes before they are aggregated. A contact
    belongs to a party by process and party, so no hash has to tell processes apart. Parties are read and
    joined once; each role's rows are taken out of that.
    """
    wanted = keys.withColumnRenamed("_process", "process")
    party, contact = t["party"], t["contact"]
    if cut:
        party, contact = party.join(wanted, "process", "left_semi"), contact.join(wanted, "process", "left_semi")
    best = r.best_contact(contact, {"email": 3, "phone": 2}, ("process", "party"), tie=contact_tie).withColumnRenamed("party", "id")
    reached = ("email_value", "phone_area", "phone_value")
    # as the join needs it, and written once for all roles: in one column, as a role that needs fewer would have others written
    best = best.select("process", "id", F.array(*[F.col(n).cast("string") for n in reached]).alias("_best")).repartition("process", "id")
    people = party.join(best, ["process", "id"], "left").withColumnRenamed("process", "_process")
    people = people.select("*", *[F.col("_best")[i].cast(best_type).alias(n) for i, (n, best_type) in enumerate(zip(reached, ("string", "int", "string")))])

    def role(prefix: str, types: tuple[int, ...]) -> DataFrame:
        names = ("id", "type", "name", "tax_id", *reached)
        rows = r.party_of_type(people, *types).select("_process", *[F.col(n).alias(f"{prefix}_{n}") for n in names])
        present = r.party_of_type(party, *types).select(F.col("process").alias("_process"))
        return r.with_every_key(rows, keys, "_process", present)

    return {name: role(name, types) for name, types in ROLES.items()}


def _vehicle(vehicle: DataFrame) -> DataFrame:
    names = ("id", "plate", "chassis", "brand", "model", "submodel", "year", "encumbered", "value")
    return _prefixed(vehicle, "vehicle", names)


def _vehicle_columns() -> list:
    return [
        F.col("vehicle_plate").alias("placa_veiculo"), F.col("vehicle_chassis").alias("chassi_veiculo"),
        F.col("vehicle_brand").alias("marca_veiculo"), F.col("vehicle_model").alias("modelo_veiculo"),
        F.col("vehicle_submodel").alias("sub_modelo_veiculo"), F.col("vehicle_year").alias("ano_fabricacao"),
        F.col("vehicle_encumbered").alias("veiculo_alienado"), F.col("vehicle_value").alias("valor_fipe"),
    ]


def _prefixed(table: DataFrame, prefix: str, names: tuple[str, ...]) -> DataFrame:
    return table.select(F.col("process").alias("_process"), *[F.col(n).alias(f"{prefix}_{n}") for n in names])


def _of(table: DataFrame, keys: DataFrame, name: str = "process") -> DataFrame:
    """The table's rows of the given processes."""
    return table.join(keys.withColumnRenamed("_process", name), name, "left_semi")


def ready_keys(t: Tables) -> DataFrame:
    """The processes (_process) that the ready view has rows of."""
    queue = dispatchable(t["queue"]).select(F.col("process").alias("_process")).distinct()
    return _of(t["process"], queue, "id").select(F.col("id").alias("_process"))


def ready_queue(
    t: Tables, contact_tie: tuple[str, ...] = ("id",), summary: DataFrame | None = None, keys: DataFrame | None = None,
) -> DataFrame:
    """Dispatchable queue rows, 37 columns. Several parties of a role multiply a row, as they should.

    The queue is filtered first, and every other table is cut down to its processes; a job passes ``keys``, the
    ``ready_keys`` written once. With the kept ``summary`` of processes the user history is not read.
    """
    queue = _prefixed(dispatchable(t["queue"]), "queue", ("id", "slot"))
    keys = ready_keys(t) if keys is None else keys
    user = r.current_user(_of(t["user_history"], keys)) if summary is None else m.current_user(_of(summary, keys))
    process = _labelled_process(_of(t["process"], keys, "id"), user, t, {"_user_name": "name", "_user_email": "email"})
    rows = process.join(queue, "_process").join(_vehicle(_of(t["vehicle"], keys)), "_process", "left")
    for role in _parties(t, keys, contact_tie).values():
        rows = rows.join(role, "_process")
    return rows.select(
        F.col("queue_id").alias("id_fila"),
        F.col("_process").alias("id_processo"),
        F.col("company").alias("cia"),
        F.col("uf").alias("uf_processo"),
        c.treated_claim(F.col("_sigla"), F.col("claim")).alias("sinistro_tratado"),
        F.col("phase").alias("fase_processo_site"),
        F.col("_operator_status").alias("id_status_operadora"),
        F.col("_operator_label").alias("desc_status_oficial_operadora"),
        F.col("portal_status").alias("id_status_portal_original"),
        F.col("_status_label").alias("desc_status_portal_original"),
        F.col("_context").alias("contexto_portal"),
        F.col("alert").alias("alerta_processo"),
        F.col("insured_type").alias("tipo_envolvido_id"),
        c.squash_spaces(F.col("insured_name")).alias("nome_segurado"),
        c.default_email(F.col("insured_email_value")).alias("email_segurado"),
        F.col("insured_phone_area").alias("ddd_segurado"),
        F.col("insured_phone_value").alias("tel_segurado"),
        c.tax_id_type(F.col("insured_tax_id")).alias("tipo_doc_id"),
        c.format_tax_id(F.col("insured_tax_id")).alias("doc_formatado"),
        F.col("broker_name").alias("nome_corretor"),
        F.col("broker_email_value").alias("email_corretor"),
        F.col("broker_phone_value").alias("tel_corretor"),
        F.col("analyst_name").alias("nome_analista_seguradora"),
        F.col("analyst_email_value").alias("email_analista_seguradora"),
        F.col("_user_name").alias("nome_analista_operadora"),
        F.col("_user_email").alias("email_analista_operadora"),
        F.col("occurred").alias("dt_sinistro"),
        F.col("opened").alias("data_portal"),
        *_vehicle_columns(),
        F.col("queue_slot").alias("data_agendada"),
    )


def history(t: Tables, contact_tie: tuple[str, ...] = ("id",), summary: DataFrame | None = None) -> DataFrame:
    """Every process with its queue, SLA, people and vehicle, 37 columns.

    With the kept ``summary`` of processes neither events nor steps nor the user history are read.
    """
    keys = t["process"].select(F.col("id").alias("_process"))
    parties = _parties(t, keys, contact_tie, cut=False)
    insured = r.with_labels(parties["insured"], (t["party_type"], "code", "insured_type", {"insured_role": "label"}))
    queue = r.with_labels(
        _prefixed(t["queue"], "queue", ("id", "status", "message")),
        (t["queue_status"], "code", "queue_status", {"queue_sigla": "sigla"}),
    )
    if summary is None:
        user, changes = r.current_user(t["user_history"]), r.last_change(t["process"], t["event"], t["step"])
    else:
        user, changes = m.current_user(summary), m.last_change(t["process"], summary)
    rows = _labelled_process(t["process"], user, t, {"_user_name": "name"}).join(changes.withColumnRenamed("id", "_process"), "_process", "left")
    for satellite in (queue, _prefixed(t["sla"], "sla", ("id", "captured", "sent")), _vehicle(t["vehicle"])):
        rows = rows.join(satellite, "_process", "left")
    for role in (insured, parties["broker"], parties["analyst"]):
        rows = rows.join(role, "_process")
    return rows.select(
        F.col("_process").alias("id_processo"),
        c.treated_claim(F.col("_sigla"), F.col("claim")).alias("sinistro_tratado"),
        F.col("claim").alias("numero_sinistro_original"),
        F.col("company").alias("cia"),
        F.col("uf").alias("uf_processo"),
        F.col("_file_label").alias("tipo_expediente"),
        F.col("phase").alias("fase_processo_site"),
        F.col("alert").alias("alerta_processo"),
        F.col("_operator_label").alias("status_oficial_operadora"),
        F.col("_status_label").alias("status_portal_original"),
        F.col("queue_sigla").alias("status_robo"),
        F.col("queue_message").alias("mensagem_robo_api"),
        F.col("opened").alias("data_abertura_sinistro"),
        F.col("occurred").alias("data_ocorrencia_sinistro"),
        F.col("sla_captured").alias("data_capturado_site"),
        F.col("sla_sent").alias("data_cadastrado_plataforma"),
        F.col("_left_at").alias("data_saida_fila_portal"),
        F.col("last_change").alias("data_ultima_mudanca_site"),
        F.col("_user_name").alias("analista_operadora"),
        F.col("analyst_name").alias("analista_seguradora"),
        F.col("analyst_email_value").alias("email_analista_seguradora"),
        F.col("insured_role").alias("papel_envolvido"),
        c.squash_spaces(F.col("insured_name")).alias("nome_segurado_terceiro"),
        c.format_tax_id(F.col("insured_tax_id")).alias("documento_segurado_terceiro"),
        F.col("insured_email_value").alias("email_segurado_terceiro"),
        c.join_phone(F.col("insured_phone_area"), F.col("insured_phone_value")).alias("telefone_segurado_terceiro"),
        F.col("broker_name").alias("nome_corretor"),
        F.col("broker_email_value").alias("email_corretor"),
        c.join_phone(F.col("broker_phone_area"), F.col("broker_phone_value")).alias("telefone_corretor"),
        *_vehicle_columns(),
    )


def ready_claims(t: Tables) -> DataFrame:
    """Process and treated claim of the ready rows: enough to reconcile them.

    People and vehicles only repeat these rows, so they are not joined.
    """
    process = r.with_labels(t["process"], (t["file_type"], "code", "file_type", {"_sigla": "sigla"}))
    ready = r.exists_in(process, dispatchable(t["queue"]).withColumn("id", F.col("process")), ["id"])
    return ready.select(
        F.col("id").alias("id_processo"), c.treated_claim(F.col("_sigla"), F.col("claim")).alias("sinistro_tratado"))


def pending_queue(view: DataFrame) -> DataFrame:
    """The ready rows by portal date, missing dates first."""
    return view.orderBy(F.col("data_portal").asc_nulls_first(), "id_fila")


def register_views(spark: SparkSession, t: Tables, summary: DataFrame | None = None) -> None:
    """Both views under the names BI queries use."""
    ready_queue(t, summary=summary).createOrReplaceTempView(VIEW_NAMES["ready"])
    history(t, summary=summary).createOrReplaceTempView(VIEW_NAMES["history"])
