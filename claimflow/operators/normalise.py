"""Record merge, key standardisation and nested lists of a portal record."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions import cleanse as c
from claimflow.operators.relational import top1
from claimflow.schemas import RECORD
from claimflow.sources.records import to_raw_json

# Fixed values.
DEFAULT_PHASE = "PROCESSO RECEPCIONADO"
LOCAL_SHIFT_SECONDS = 3 * 3600
EMPTY_RESPONSE = "Sucesso sem conteúdo"
CONNECTION_ERROR = "Erro de conexão com PlataformaGestao: "

# Output key <- portal keys in order of preference.
ALIASES = {
    "insured_name": ("nmBeneficiario", "nomeSegurado"),
    "tax_id": ("cpfCnpj", "cpfSegurado"),
    "insured_email": ("emailBeneficiario", "emailSegurado"),
    "plate": ("placaVeiculo", "placa"),
    "brand": ("nmMarca", "dsMarca", "marca"),
    "model": ("nmModelo", "dsModelo", "modelo"),
    "chassis": ("chassi", "nrChassi"),
    "value_text": ("vrFipe", "valorFipe", "valorMercado"),
    "submodel": ("subModeloVeiculo", "subModelo"),
    "year_text": ("anoVeiculo", "nrAnoFabricacao", "anoFabricacao", "ano"),
    "occurred_text": ("dtSinistro", "dtAberturaSinistro"),
    "analyst_name": ("nmAnalista",),
    "analyst_email": ("emailAnalistaTw",),
    "financing": ("dsTpFinanciamento",),
}
DEFAULT_EMPTY = ("brand", "model", "chassis", "submodel", "occurred_text", "analyst_name", "analyst_email", "financing")
DOCUMENT_LISTS = ("documentos", "listaDocumentos", "documentosProcesso")


def overlay(*layers: str, fields: list[str]) -> list[Column]:
    """Merge struct columns field by field; a later non-null value wins."""
    return [
        F.coalesce(*[F.col(f"{layer}.{field}") for layer in reversed(layers)]).alias(field) for field in fields
    ]


def overlay_json(*layers: Column) -> Column:
    """Merge JSON objects key by key; a later *present* key wins, null included."""
    maps = [F.coalesce(F.from_json(layer, "map<string,string>"), F.from_json(F.lit("{}"), "map<string,string>"))
            for layer in layers]

    def put(lower: Column, upper: Column) -> Column:
        kept = F.map_filter(lower, lambda key, _: ~F.map_contains_key(upper, key))
        return F.map_concat(kept, upper)

    return reduce(put, maps)


# What only the listing says, or the run itself.
LISTING_ONLY = ("nmAnalista", "emailAnalistaTw", "dtAberturaSinistro", "usuario_origem", "idUsuario")


def merge_layers(listing: DataFrame, by_id: DataFrame | None = None, follow_up: DataFrame | None = None) -> DataFrame:
    """Listed records with their landed details: the follow-up before the detail by id before the listing.

    A layer with ``_keys`` (``read_detail_records``) wins with every key that it has, null included; of one
    without, values that are not NULL win. Of several details of a record the last in ``_order`` counts, where there is
    one. The phase comes from the listing, else from the detail by id. Analyst, opening date and user come from the
    listing alone. Details of records that are not listed, or without id, are left out.
    """
    names = RECORD.fieldNames()
    order = ["_order"] if "_order" in listing.columns else []
    rows, layers = listing.select("idProcesso", F.struct(*names).alias("listing"), *order), []
    for name, layer in (("by_id", by_id), ("follow_up", follow_up)):
        if layer is None:
            continue
        last = [F.col("_order").desc()] if "_order" in layer.columns else []
        held = [*names, *[column for column in ("_keys",) if column in layer.columns]]
        one = top1(with_id(layer), ["idProcesso"], [*last, F.xxhash64(*held)])
        rows = rows.join(one.select("idProcesso", F.struct(*held).alias(name)), "idProcesso", "left")
        layers.append((name, "_keys" in held))
    phase = [F.col(f"listing.{key}") for key in ("status_processo", "dsStatusCorrenteProcesso", "dsStatus")]
    if by_id is not None:
        phase.append(F.col("by_id.status_processo"))

    def field(name: str) -> Column:
        value = F.col(f"listing.{name}")
        for layer, keyed in layers:
            own = F.col(f"{layer}.{name}")
            has = F.array_contains(f"{layer}._keys", name) if keyed else own.isNotNull()
            value = F.when(has, own).otherwise(value)
        return value.alias(name)

    merged = [field(name) for name in names if name not in LISTING_ONLY and name != "status_processo"]
    return rows.select(
        *merged, *[F.col(f"listing.{name}") for name in LISTING_ONLY], resolve_phase(*phase).alias("status_processo"), *order,
    ).select(*names, *order)


def with_id(records: DataFrame, key: str = "idProcesso") -> DataFrame:
    return records.filter(F.col(key).isNotNull() & (F.col(key) != 0))


def resolve_phase(*candidates: Column, default: str = DEFAULT_PHASE) -> Column:
    """First candidate that is neither NULL nor empty."""
    return F.coalesce(*[F.when(col != "", col) for col in candidates], F.lit(default))


def event_stamp(millis: Column) -> Column:
    """Local time (whole seconds) of an epoch-milliseconds text; NULL if unusable."""
    number = F.coalesce(millis.try_cast("long"), F.floor(c.to_number(millis)).try_cast("long"))
    usable = (number != 0) & number.between(-9223372036854, 9223372036854)
    seconds = F.floor(F.when(usable, number) / 1000).cast("long") - LOCAL_SHIFT_SECONDS
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_add("SECOND", seconds, origin)


def normalise_events(log: Column) -> Column:
    """array<struct<event_id, text, happened_at>> without the entries that have no usable date."""
    entries = F.transform(
        log,
        lambda e: F.struct(
            F.coalesce(e["idEvento"], F.lit(0)).cast("long").alias("event_id"),
            F.coalesce(e["evento"], e["statusProcesso"], e["observacao"], F.lit("")).alias("text"),
            event_stamp(e["dataHoraEvento"]).alias("happened_at"),
        ),
    )
    return F.coalesce(F.filter(entries, lambda e: e["happened_at"].isNotNull()), F.array().cast(
        "array<struct<event_id: bigint, text: string, happened_at: timestamp_ntz>>"))


def min_event_date(events: Column) -> Column:
    return F.array_min(events["happened_at"])


def normalise_documents(*lists: Column) -> Column:
    """array<struct<name, status>> of the first list that exists, nameless entries dropped."""
    entries = F.transform(
        F.coalesce(*lists),
        lambda d: F.struct(
            c.text_or_null(F.coalesce(d["dsDocumento"], d["nomeDocumento"], d["descricao"]), 200).alias("name"),
            F.coalesce(
                c.text_or_null(F.coalesce(d["dsStatus"], d["statusDocumento"], d["status"]), 50), F.lit("")
            ).alias("status"),
        ),
    )
    return F.coalesce(F.filter(entries, lambda d: d["name"].isNotNull()), F.array().cast(
        "array<struct<name: string, status: string>>"))


def _aliased(name: str) -> Column:
    sources = [F.col(key) for key in ALIASES[name]]
    if name in DEFAULT_EMPTY:
        sources.append(F.lit(""))
    return F.coalesce(*sources).alias(name)


def standardise(records: DataFrame) -> DataFrame:
    """One typed row per portal record, under one name per value."""
    phase = resolve_phase(F.col("status_processo"), F.col("dsStatusCorrenteProcesso"), F.col("dsStatus"))
    present = [name for name in RECORD.fieldNames() if name in records.columns]
    order = [F.col("_order")] if "_order" in records.columns else []
    rows = with_id(records).select(
        F.col("idProcesso").alias("id"),
        F.col("noSinistro").alias("claim"),
        F.upper(c.strip(F.coalesce(F.col("tpExpediente"), F.lit("")))).alias("file_type_text"),
        c.parse_int(F.col("idStatusCorrente")).alias("portal_status"),
        phase.alias("phase"),
        c.strip(F.coalesce(F.col("dsStatusCorrenteProcesso"), F.lit(""))).alias("task_name"),
        c.strip(F.coalesce(F.col("dsStatus"), F.lit(""))).alias("task_status"),
        c.parse_int(F.col("idCicloCorrente")).cast("long").alias("cycle"),
        c.flag01(F.col("flAlerta")).alias("alert"),
        c.flag01(F.col("flBaixaGravame")).alias("encumbered"),
        F.col("dsUF").alias("uf_text"),
        F.col("ddd"),
        F.col("telefoneBeneficiario").alias("insured_phone"),
        F.col("nmCorretor").alias("broker_name"),
        F.col("emailCorretor").alias("broker_email"),
        F.col("telefoneCorretor").alias("broker_phone"),
        F.col("dddCorr").alias("broker_ddd"),
        *[_aliased(name) for name in ALIASES],
        normalise_events(F.col("logWorkFlow")).alias("events"),
        normalise_documents(*[F.col(name) for name in DOCUMENT_LISTS]).alias("documents"),
        F.col("idUsuario").alias("user_id"),
        F.coalesce(F.col("usuario_origem"), F.lit("SISTEMA")).alias("user_name"),
        to_raw_json(*present).alias("raw_json"),
        *order,
    )
    # a second step, so that the events are built once
    return rows.withColumn("opened", min_event_date(F.col("events")))


def explode_events(records: DataFrame) -> DataFrame:
    """(id, position, event_id, text, happened_at), one row per dated workflow entry."""
    return records.select("id", F.posexplode("events").alias("position", "entry")).select(
        "id", "position", "entry.event_id", "entry.text", "entry.happened_at"
    )


def explode_documents(records: DataFrame) -> DataFrame:
    return records.select("id", F.posexplode("documents").alias("position", "entry")).select(
        "id", "position", "entry.name", "entry.status"
    )


def explode_emails(records: DataFrame, column: str) -> DataFrame:
    return records.select("id", F.posexplode(c.email_parts(F.col(column))).alias("position", "email"))


def valid_events(events: DataFrame, need_id: bool) -> DataFrame:
    """Dated events; with ``need_id`` only those that name a known kind of event."""
    keep = F.col("happened_at").isNotNull()
    return events.filter(keep & (F.col("event_id") > 0) if need_id else keep)


def normalise_response(responses: DataFrame, keys: Sequence[str] = ("process",)) -> DataFrame:
    """(keys, status_code, body, error) -> (keys, status_code, request_id, message)."""
    body = F.when(F.col("status_code") == 204, F.lit(None)).otherwise(F.col("body"))

    def key(name: str) -> Column:
        value = F.get_json_object(body, f"$.{name}")
        return F.when(~value.isin("", "0", "false"), value)

    failed = F.col("status_code").isNull()
    return responses.select(
        *keys,
        F.coalesce(F.col("status_code"), F.lit(500)).alias("status_code"),
        F.when(~failed, F.coalesce(key("id"), key("acionamentoId"))).alias("request_id"),
        F.when(failed, F.concat(F.lit(CONNECTION_ERROR), F.coalesce(F.col("error"), F.lit(""))))
        .when(F.col("status_code") == 204, F.lit(EMPTY_RESPONSE))
        .otherwise(F.coalesce(key("message"), F.col("body"))).alias("message"),
    )
