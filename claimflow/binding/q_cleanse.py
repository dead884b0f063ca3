"""Cleansing and record normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.binding import sql as s
from claimflow.binding import warehouse as w
from claimflow.binding.catalog import query
from claimflow.functions import cleanse as c
from claimflow.operators import normalise as n
from claimflow.operators import relational as r
from claimflow.sources.dictionaries import dictionaries, load_area_map
from claimflow.sources.tables import load

PHONE = s.phone("insured_phone", "ddd")


def _std(spark, sf):
    return n.standardise(w.records(spark, sf))


STANDARDISED = """
    SELECT s.id, claim, file_type_text, portal_status, phase, task_name, task_status, cycle, alert, encumbered, uf_text, ddd,
           insured_name, tax_id, insured_email, insured_phone, broker_name, broker_email, broker_phone, broker_ddd, analyst_name,
           analyst_email, plate, brand, model, chassis, submodel, value_text, year_text, occurred_text, user_id, user_name, o.opened,
           '' AS financing, claim AS raw_claim, CAST(o_orderpriority = '5-LOW' AS INTEGER) AS raw_user_null, coalesce(e.entries, '') AS entries, coalesce(d.papers, '') AS papers
    FROM std s LEFT JOIN std_opened o ON o.id = s.id
    LEFT JOIN (SELECT id, string_agg(event_id || text || strftime(happened_at, '%Y-%m-%d %H:%M:%S'), '|' ORDER BY position) AS entries FROM std_event GROUP BY 1) e
        ON e.id = s.id
    LEFT JOIN (SELECT id, string_agg(name || ':' || status, '|' ORDER BY position) AS papers FROM std_document GROUP BY 1) d ON d.id = s.id"""


@query("standardise", STANDARDISED)
def standardise(spark, sf):
    return flat(_std(spark, sf))


def flat(std):
    """The standardised columns, nested lists as text; of the raw record a key with a value and one with null."""
    entries = F.transform("events", lambda e: F.concat(e["event_id"].cast("string"), e["text"], e["happened_at"].cast("string")))
    papers = F.transform("documents", lambda d: F.concat_ws(":", d["name"], d["status"]))
    own = F.concat(F.lit('"noSinistro":"'), F.col("claim"), F.lit('"'))
    return std.withColumns({
        "entries": F.array_join(entries, "|"), "papers": F.array_join(papers, "|"), "raw_claim": F.when(F.col("raw_json").contains(own), F.col("claim")),
        "raw_user_null": F.col("raw_json").contains('"usuario_origem":null').cast("int"),
    }).drop("events", "documents", "raw_json", "_order")


@query("resolve_phase", "SELECT id, phase FROM std")
def resolve_phase(spark, sf):
    return n.with_id(w.records(spark, sf)).select(
        F.col("idProcesso").alias("id"),
        n.resolve_phase(F.col("status_processo"), F.col("dsStatusCorrenteProcesso"), F.col("dsStatus")).alias("phase"))


@query("explode_events", "SELECT id, position, event_id, text, happened_at FROM std_event")
def explode_events(spark, sf):
    return n.explode_events(_std(spark, sf))


@query("valid_events", "SELECT id, position, event_id, text, happened_at FROM std_event WHERE event_id > 0")
def valid_events(spark, sf):
    return n.valid_events(n.explode_events(_std(spark, sf)), need_id=True)


@query("min_event_date", "SELECT s.id, opened FROM std s LEFT JOIN std_opened o ON o.id = s.id")
def min_event_date(spark, sf):
    return n.with_id(w.records(spark, sf)).select(
        F.col("idProcesso").alias("id"), n.min_event_date(n.normalise_events(F.col("logWorkFlow"))).alias("opened"))


@query("explode_documents", "SELECT id, position, name, status FROM std_document")
def explode_documents(spark, sf):
    return n.explode_documents(_std(spark, sf))


@query("explode_emails", """
    SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS INTEGER) AS position, left(trim(parts[i]), 150) AS email
    FROM (SELECT id, regexp_split_to_array(insured_email, '[;,]') AS parts FROM std) t, unnest(generate_series(1, len(parts))) AS g(i)
    WHERE contains(parts[i], '@')""")
def explode_emails(spark, sf):
    return n.explode_emails(_std(spark, sf), "insured_email")


@query("overlay", """
    SELECT o_orderkey, coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN c_name END, o_orderstatus) AS a,
           coalesce(CASE WHEN o_totalprice > 250000 THEN 'high' END, c_mktsegment, o_orderpriority) AS b
    FROM cases""")
def overlay(spark, sf):
    layers = w.cases(spark, sf).select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("a"), F.col("o_orderpriority").alias("b")).alias("listing"),
        F.struct(F.lit(None).cast("string").alias("a"), F.col("c_mktsegment").alias("b")).alias("by_id"),
        F.struct(F.when(F.col("o_orderpriority") != w.LOW, F.col("c_name")).alias("a"),
                 F.when(F.col("o_totalprice") > 250000, "high").alias("b")).alias("follow_up"))
    return layers.select("o_orderkey", *n.overlay("listing", "by_id", "follow_up", fields=["a", "b"]))


@query("overlay_json", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS a, c_name AS b, CAST(o_custkey AS VARCHAR) AS c,
           3 AS n
    FROM cases""")
def overlay_json(spark, sf):
    keep_null = {"ignoreNullFields": "false"}
    listing = F.to_json(F.struct(F.col("o_orderpriority").alias("a"), F.lit("x").alias("b")))
    # the key is present and null unless the order is finished, when it is absent
    detail = F.when(F.col("o_orderstatus") == "F", F.to_json(F.struct(F.col("c_name").alias("b")))).otherwise(
        F.to_json(F.struct(F.lit(None).cast("string").alias("a"), F.col("c_name").alias("b")), keep_null))
    follow_up = F.to_json(F.struct(F.col("o_custkey").alias("c")))
    merged = w.cases(spark, sf).withColumn("m", n.overlay_json(listing, detail, follow_up))
    return merged.select("o_orderkey", F.col("m.a").alias("a"), F.col("m.b").alias("b"), F.col("m.c").alias("c"),
                         F.size("m").alias("n"))


@query("flags", f"""
    SELECT id, {s.flag('alert_raw')} AS alert, {s.flag('encumbered_raw')} AS encumbered,
           CASE upper(trim(file_raw)) WHEN 'DPA' THEN 1 WHEN 'TRC' THEN 2 ELSE 0 END AS file_type,
           CASE upper(trim(file_raw)) WHEN 'DPA' THEN 1 WHEN 'TRC' THEN 2 ELSE 1 END AS party_type
    FROM rec""")
def flags(spark, sf):
    return w.records(spark, sf).select(
        F.col("idProcesso").alias("id"), c.flag01(F.col("flAlerta")).alias("alert"),
        c.flag01(F.col("flBaixaGravame")).alias("encumbered"),
        c.file_type_code(F.col("tpExpediente")).alias("file_type"), c.party_type_code(F.col("tpExpediente")).alias("party_type"))


@query("nullify_clamp", f"""
    SELECT doc_id, {s.nullify('lang', 'fr', 'de')} AS lang, left(text, 200) AS head, left({s.nullify('trim(source)')}, 4) AS source
    FROM documents""")
def nullify_clamp(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", c.nullify(F.col("lang"), ("fr", "de")).alias("lang"), c.clamp(F.col("text"), 200).alias("head"),
        c.text_or_null(F.col("source"), 4).alias("source"))


@query("clean_phone", f"SELECT id, {PHONE[0]} AS area, {PHONE[1]} AS number FROM rec")
def clean_phone(spark, sf):
    return w.records(spark, sf).select(
        F.col("idProcesso").alias("id"), c.clean_phone(F.col("telefoneBeneficiario"), F.col("ddd")).alias("p")
    ).select("id", "p.area", "p.number")


_TEXT_PHONE = s.phone("text", "lang")


@query("clean_phone_text", f"SELECT doc_id, {_TEXT_PHONE[0]} AS area, {_TEXT_PHONE[1]} AS number FROM documents")
def clean_phone_text(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", c.clean_phone(F.col("text"), F.col("lang")).alias("p")).select("doc_id", "p.area", "p.number")


@query("parse_money", f"""
    SELECT id, {s.money('value_text')} AS value, CAST(CAST({s.money('value_text')} AS DECIMAL(18,2)) AS DOUBLE) AS rounded FROM rec""")
def parse_money(spark, sf):
    value = c.parse_money(F.coalesce("vrFipe", "valorFipe", "valorMercado"))
    return w.records(spark, sf).select(
        F.col("idProcesso").alias("id"), value.alias("value"), c.to_money(value).cast("double").alias("rounded"))


@query("parse_year", f"SELECT id, {s.whole('year_text')} AS year FROM rec")
def parse_year(spark, sf):
    return w.records(spark, sf).select(
        F.col("idProcesso").alias("id"), c.parse_year(F.coalesce("anoVeiculo", "nrAnoFabricacao", "anoFabricacao", "ano")).alias("year"))


@query("clean_plate", f"SELECT id, coalesce({s.nullify('upper(trim(plate))')}, 'AVI0000') AS plate FROM rec")
def clean_plate(spark, sf):
    return w.records(spark, sf).select(
        F.col("idProcesso").alias("id"), c.clean_plate(F.coalesce("placaVeiculo", "placa")).alias("plate"))


@query("clean_email_first", f"SELECT doc_id, {s.first_email('text')} AS email FROM documents")
def clean_email_first(spark, sf):
    return load(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", c.first_email(F.col("text")).alias("email"))


@query("clean_email_dedupe", f"SELECT doc_id, {s.dedupe_emails('text')} AS emails FROM documents")
def clean_email_dedupe(spark, sf):
    return load(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", c.dedupe_emails(F.col("text")).alias("emails"))


@query("email_list_dedupe", f"""
    SELECT id, {s.dedupe_emails("insured_email || ' ' || insured_email")} AS emails, {s.first_email('insured_email')} AS first FROM rec""")
def email_list_dedupe(spark, sf):
    text = F.coalesce("emailBeneficiario", "emailSegurado")
    return w.records(spark, sf).select(
        F.col("idProcesso").alias("id"), c.dedupe_emails(F.concat(text, F.lit(" "), text)).alias("emails"),
        c.first_email(text).alias("first"))


@query("tax_id", f"SELECT id, process, {s.tax_type('tax_id')} AS kind, {s.tax_text('tax_id')} AS tax_id FROM party")
def tax_id(spark, sf):
    return w.party(spark, sf).select(
        "id", "process", c.tax_id_type(F.col("tax_id")).alias("kind"), c.format_tax_id(F.col("tax_id")).alias("tax_id"))


@query("squash_spaces", f"SELECT id, {s.squash('name')} AS name FROM party")
def squash_spaces(spark, sf):
    return w.party(spark, sf).select("id", c.squash_spaces(F.col("name")).alias("name"))


@query("treated_claim", """
    SELECT id, CASE WHEN sigla = 'TRC' THEN claim || 'T' ELSE claim END AS claim
    FROM process LEFT JOIN file_type ON code = file_type""")
def treated_claim(spark, sf):
    tables = w.claims(spark, sf)
    labelled = r.with_labels(tables["process"], (tables["file_type"], "code", "file_type", {"sigla": "sigla"}))
    return labelled.select("id", c.treated_claim(F.col("sigla"), F.col("claim")).alias("claim"))


@query("contact_text", """
    SELECT party, type, CASE WHEN rtrim(value) <> '' THEN value ELSE 'nao_informado@segurado.com' END AS email,
           CAST(area AS VARCHAR) || left(value, 30) AS phone
    FROM contact""")
def contact_text(spark, sf):
    return w.contact(spark, sf).select(
        "party", "type", c.default_email(F.col("value")).alias("email"), c.join_phone(F.col("area"), F.col("value")).alias("phone"))


@query("uf_lookup", """
    SELECT id, uf FROM load_process_rows""")
def uf_lookup(spark, sf):
    return r.resolve_uf(_std(spark, sf), load_area_map(dictionaries(spark)["area_code"])).select("id", "uf")


@query("uf_repair", f"""
    SELECT id, coalesce(a.uf, {s.nullify('upper(trim(uf_text))', '', 'nan', 'none', 'nat', '<na>')}, 'SP') AS uf
    FROM std LEFT JOIN areas a ON a.code = {s.area('ddd')}""")
def uf_repair(spark, sf):
    return r.repair_uf(_std(spark, sf), load_area_map(dictionaries(spark)["area_code"])).select("id", "uf")


@query("iso_timestamps", f"""
    SELECT id, {s.iso('occurred')} AS occurred, {s.iso("coalesce(opened, TIMESTAMP '2001-08-16 12:00:00')")} AS opened,
           left(replace(strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f'), ' ', 'T'), 19) AS loaded
    FROM process""")
def iso_timestamps(spark, sf):
    return w.process(spark, sf).select(
        "id", c.iso_ts(F.col("occurred")).alias("occurred"),
        c.iso_ts(F.col("opened"), F.expr("timestamp_ntz'2001-08-16 12:00:00'")).alias("opened"),
        c.iso_text(F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss.SSS")).alias("loaded"))


@query("dictionary_label", f"""
    SELECT id, coalesce({s.text_or_null('phase', 100)}, 'Status ID: ' || portal_status) AS label,
           CAST(starts_with(coalesce({s.text_or_null('phase', 100)}, 'Status ID: ' || portal_status), 'Status ID:') AS INTEGER) AS waiting
    FROM (SELECT id, portal_status, phase3 AS phase FROM std WHERE portal_status IS NOT NULL) t""")
def dictionary_label(spark, sf):
    rows = _std(spark, sf).filter(F.col("portal_status").isNotNull()).join(
        w.records(spark, sf).select(F.col("idProcesso").alias("id"), "dsStatus"), "id")
    label = c.label_or_placeholder(F.col("dsStatus"), "Status ID:", F.col("portal_status"))
    return rows.select("id", label.alias("label"), c.is_placeholder(label, "Status ID:").cast("int").alias("waiting"))
