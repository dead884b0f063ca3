"""Claims tables derived from the benchmark tables, for queries and tests.

Every table is an expression over whole input tables: orders are processes, lineitem
rows are contacts, events and users of a process, customers are the insured, suppliers
the brokers, analysts and portal users, parts the vehicles. ``binding.sql`` states the
same derivation in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.schemas import RECORD, TABLES
from claimflow.sources.dictionaries import dictionaries
from claimflow.sources.tables import load

URGENT, HIGH, MEDIUM, UNSPECIFIED, LOW = "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"


def lines(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Narrow lines, those of an order together. A table may be one row group: dealt out before, no task aggregates all of them."""
    rows = load(spark, sf, "lineitem", ["l_orderkey", *columns])
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")


def _table(df: DataFrame, name: str, columns: dict[str, str], text_id: bool = False) -> DataFrame:
    """A table in its schema from one expression per column; absent columns are NULL."""
    return df.selectExpr(*[
        f"{columns['id']} AS id" if text_id and f.name == "id"
        else f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in TABLES[name].fields
    ])


def cases(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer."""
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")


def process(spark: SparkSession, sf: str) -> DataFrame:
    return _table(cases(spark, sf), "process", {
        "id": "o_orderkey", "claim": "concat('C', o_orderkey)",
        "file_type": f"CASE o_orderpriority WHEN '{URGENT}' THEN 2 WHEN '{HIGH}' THEN 1 ELSE 0 END",
        "portal_status": f"CASE WHEN o_orderpriority <> '{LOW}' THEN c_nationkey END",
        "uf": "lpad(CAST(c_nationkey AS STRING), 2, '0')", "company": "'SEGURADORA CLIENTE'",
        "opened": f"CASE WHEN NOT (o_orderpriority = '{UNSPECIFIED}' AND o_orderstatus = 'O') THEN o_orderdate END",
        "occurred": "o_orderdate - INTERVAL 1 DAY", "phase": "concat('FASE ', o_orderstatus)",
        "alert": "o_totalprice > 250000", "loaded_at": "o_orderdate + INTERVAL 2 HOURS", "active": "1",
    })


def queue(spark: SparkSession, sf: str) -> DataFrame:
    return _table(load(spark, sf, "orders"), "queue", {
        "id": "o_orderkey", "process": "o_orderkey", "status": "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 3 ELSE 2 END",
        "attempts": "CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END",
        "slot": "CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 9 HOURS END",
        "message": "CASE WHEN o_orderstatus = 'P' THEN 'HTTP 500' END", "loaded_at": "o_orderdate",
        "active": f"o_orderpriority <> '{UNSPECIFIED}'",
    })


def vehicle(spark: SparkSession, sf: str) -> DataFrame:
    first = lines(spark, sf, "l_partkey").groupBy("l_orderkey").agg(F.min("l_partkey").alias("p_partkey"))
    return _table(first.join(load(spark, sf, "part"), "p_partkey"), "vehicle", {
        "id": "l_orderkey", "process": "l_orderkey", "plate": "concat('P', p_partkey)", "chassis": "concat('CH', p_partkey)",
        "brand": "p_brand", "model": "p_name", "submodel": "p_type", "year": "p_size + 1990", "value": "p_retailprice",
        "encumbered": "p_size > 25",
    })


def party(spark: SparkSession, sf: str) -> DataFrame:
    """One insured per order; its returned and accepted lines name brokers and analysts."""
    insured = _table(cases(spark, sf), "party", {
        "id": "concat(o_orderkey, ':I')", "process": "o_orderkey", "type": f"CASE WHEN o_orderpriority = '{URGENT}' THEN 2 ELSE 1 END",
        "name": "concat('  ', replace(c_name, '#', '   '), ' ')",
        "tax_id": """CASE c_mktsegment WHEN 'BUILDING' THEN concat(c_custkey, '.0') WHEN 'MACHINERY' THEN concat('123456789012', c_custkey)
                     WHEN 'HOUSEHOLD' THEN NULL ELSE concat('123.045', c_custkey) END""",
    }, text_id=True)
    named = lines(spark, sf, "l_suppkey", "l_returnflag").filter("l_returnflag IN ('R', 'A')").distinct()
    others = named.join(load(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return insured.unionByName(_table(others, "party", {
        "id": "concat(l_orderkey, CASE WHEN l_returnflag = 'R' THEN ':B:' ELSE ':A:' END, l_suppkey)", "process": "l_orderkey",
        "type": "CASE WHEN l_returnflag = 'R' THEN 3 ELSE 4 END",
        "name": "CASE WHEN l_returnflag = 'R' THEN s_name ELSE concat('Analyst ', l_suppkey) END",
    }, text_id=True))


def contact(spark: SparkSession, sf: str) -> DataFrame:
    """Each line is a contact of the insured, and of its broker or analyst."""
    listed = load(spark, sf, "lineitem", ["l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_quantity"])
    other = "CASE l_returnflag WHEN 'R' THEN concat(l_orderkey, ':B:', l_suppkey) WHEN 'A' THEN concat(l_orderkey, ':A:', l_suppkey) END"
    return listed.selectExpr(
        f"explode(array_compact(array(concat(l_orderkey, ':I'), {other}))) AS party", "l_orderkey AS process",
        "CASE WHEN l_linenumber IN (2, 4, 6) THEN 2 ELSE 3 END AS type",
        "CASE WHEN l_linenumber IN (2, 4, 6) THEN l_linenumber + 10 END AS area",
        """CASE WHEN l_linenumber IN (2, 4, 6) THEN concat('9', lpad(CAST(l_partkey AS STRING), 8, '0'))
                WHEN l_quantity > 45 THEN '' ELSE concat('p', l_partkey, '@mail.com') END AS value""",
        "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS principal",
    )


CONTACT_TIE = ("value", "area")


def user_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines(spark, sf, "l_suppkey", "l_shipdate", "l_returnflag").groupBy("l_orderkey", "l_suppkey").agg(
        F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), (F.max("l_returnflag") == "R").alias("ended"))
    return _table(rows, "user_history", {
        "process": "l_orderkey", "user_id": "l_suppkey", "entered_at": "first", "left_at": "CASE WHEN ended THEN last END",
        "is_current": "NOT ended",
    })


def robot_user(spark: SparkSession, sf: str) -> DataFrame:
    return _table(load(spark, sf, "supplier", ["s_suppkey", "s_name"]), "robot_user", {
        "id": "s_suppkey", "name": "s_name", "login": "concat('user', s_suppkey)", "email": "concat('s', s_suppkey, '@op.com')"})


def event(spark: SparkSession, sf: str) -> DataFrame:
    return _table(load(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"]), "event", {
        "process": "l_orderkey", "event": "l_linenumber",
        "text": "CASE WHEN l_returnflag = 'N' THEN '' ELSE concat('Event ', l_returnflag) END",
        "happened_at": "l_shipdate", "loaded_at": "l_shipdate + INTERVAL 2 HOURS"})


def step(spark: SparkSession, sf: str) -> DataFrame:
    return _table(load(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_linestatus", "l_returnflag", "l_shipdate"]), "step", {
        "process": "l_orderkey", "task": "l_partkey", "name": "concat('Task ', l_linestatus)", "status": "l_returnflag",
        "happened_at": "l_shipdate", "loaded_at": "l_shipdate + INTERVAL 3 HOURS"})


def document(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines(spark, sf, "l_linenumber", "l_linestatus").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_linestatus").alias("status"))
    return _table(rows, "document", {"process": "l_orderkey", "name": "concat('Doc ', l_linenumber)", "status": "status"})


def sla(spark: SparkSession, sf: str) -> DataFrame:
    return _table(load(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus"]), "sla", {
        "id": "o_orderkey", "process": "o_orderkey", "received": "o_orderdate",
        "captured": "o_orderdate + INTERVAL '10:00:59' HOUR TO SECOND",
        "sent": "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END", "status": "'PENDENTE_ENVIO'"})


def portal_status(spark: SparkSession, sf: str) -> DataFrame:
    return _table(load(spark, sf, "nation"), "portal_status", {
        "code": "n_nationkey", "label": "n_name", "context": "concat('CTX ', n_regionkey)", "operator_status": "n_regionkey",
        "final": "0", "active": "1"})


def operator_status(spark: SparkSession, sf: str) -> DataFrame:
    return _table(load(spark, sf, "region"), "operator_status", {"code": "r_regionkey", "label": "r_name", "active": "1"})


_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        process, queue, vehicle, party, contact, user_history, robot_user, event, step, document, sla, portal_status, operator_status)
}


class Claims(dict):
    """The state tables of the binding, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf: str):
        super().__init__()
        self.spark, self.sf = spark, sf

    def __missing__(self, name: str) -> DataFrame:
        if name in _BUILDERS:
            self[name] = _BUILDERS[name](self.spark, self.sf)
        else:
            self[name] = dictionaries(self.spark, name)[name]
        return self[name]


def claims(spark: SparkSession, sf: str) -> Claims:
    return Claims(spark, sf)


# --- portal records ---------------------------------------------------------


def _case(column: str, values: dict[str, str]) -> str:
    """CASE over the content of a column, NULL for anything else."""
    return f"CASE {column} " + " ".join(f"WHEN '{key}' THEN {value}" for key, value in values.items()) + " END"


def _priority(*values: str | None) -> str:
    names = (URGENT, HIGH, MEDIUM, UNSPECIFIED, LOW)
    return _case("o_orderpriority", {name: value for name, value in zip(names, values) if value is not None})


def _status(**values: str) -> str:
    return _case("o_orderstatus", values)


_AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
_N = "CAST(left(o_orderpriority, 1) AS INT)"
_MILLIS = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', o_orderdate) * 1000"


def _workflow(i: int) -> str:
    """Workflow entry i: the second has no date, the fourth no event id."""
    return (
        "named_struct("
        f"'dataHoraEvento', {f'CAST({_MILLIS} + {i * 3600000 + 789} AS STRING)' if i != 2 else 'CAST(NULL AS STRING)'}, "
        f"'idEvento', {f'CAST({i - 1} AS BIGINT)' if i != 4 else 'CAST(NULL AS BIGINT)'}, "
        f"'evento', {f"' Event {i}'" if i < 3 else 'CAST(NULL AS STRING)'}, "
        f"'statusProcesso', {"concat('Status ', o_orderstatus)" if i == 3 else 'CAST(NULL AS STRING)'}, 'observacao', 'nan')"
    )


def _paper(i: int) -> str:
    return (
        f"named_struct('dsDocumento', {"' Report '" if i == 1 else 'CAST(NULL AS STRING)'}, "
        f"'nomeDocumento', {"'nan'" if i <= 2 else 'CAST(NULL AS STRING)'}, 'descricao', 'Doc {i % 2}', 'dsStatus', CAST(NULL AS STRING), "
        f"'statusDocumento', {"'none'" if i == 3 else 'CAST(NULL AS STRING)'}, 'status', 'S{i}')"
    )


_LOG = f"slice(array({', '.join(_workflow(i) for i in range(1, 5))}), 1, {_N} - 1)"
_PAPERS = f"slice(array({', '.join(_paper(i) for i in range(1, 6))}), 1, {_N})"

_RECORD = {
    "idProcesso": "o_orderkey",
    "idStatusCorrente": _status(O="concat(c_nationkey, '.0')", P="CAST(c_nationkey AS STRING)", F="'nan'"),
    "idCicloCorrente": _priority("CAST(o_custkey AS STRING)", "CAST(o_custkey AS STRING)", "concat(o_custkey, '.0')", "'0'"),
    "idUsuario": "c_nationkey + 1",
    "noSinistro": "concat('C', o_orderkey)",
    "tpExpediente": _priority("' trc '", "'DPA'", "'XYZ'"),
    "status_processo": _status(O="''", P="' EM ANALISE '"),
    "dsStatusCorrenteProcesso": _priority("''", "'FINALIZADO'", "'CANCELADO'"),
    "dsStatus": _priority("'DS URGENT'", None, None, None, "'null'"),
    "flAlerta": _priority("'S'", "'true'", "' sim '", "'N'"),
    "flBaixaGravame": _status(O="'1'", P="'SIM'", F="'nao'"),
    "dsUF": _status(O="' rjx'", F="'nan'"),
    "ddd": _case("c_mktsegment", {"BUILDING": "'11'", "MACHINERY": "'21.0'", "FURNITURE": "'x1'", "AUTOMOBILE": "''"}),
    "nmBeneficiario": _status(O="c_name", P="c_name"),
    "nomeSegurado": "concat('  ', c_name, '  ')",
    "cpfCnpj": _priority("concat(o_custkey, '.0')", "concat('12345678901', o_custkey)"),
    "cpfSegurado": "lpad(CAST(o_custkey AS STRING), 11, '7')",
    "emailBeneficiario": _case("c_mktsegment", {
        "BUILDING": "concat('a', o_custkey, '@x.com; b', o_custkey, '@y.com.br , bad')", "MACHINERY": "concat('solo', o_custkey, '@x.com')",
        "FURNITURE": "'none'"}),
    "emailSegurado": "concat('s', o_custkey, '@z.com,s', o_custkey, '@z.com')",
    "telefoneBeneficiario": _priority(
        "concat('(11) 9', lpad(CAST(o_custkey AS STRING), 8, '0'))", "lpad(CAST(o_custkey AS STRING), 8, '3')", "'123-4567'", "'None'"),
    "nmCorretor": _status(O="concat('Broker ', o_custkey)", P="' nan '"),
    "emailCorretor": _priority("concat(' br', o_custkey, '@b.com ')", "'no mail'"),
    "telefoneCorretor": "concat('21', lpad(CAST(o_custkey AS STRING), 9, '9'))",
    "dddCorr": _priority("'0'", "'31'", "'nan'"),
    "nmAnalista": _priority("concat('Ana ', o_custkey)", "'None'", "concat('Ana ', o_custkey)"),
    "emailAnalistaTw": _priority("concat('ana', o_custkey, '@t.com')", "'x@t.com'"),
    "placaVeiculo": _status(O="concat(' abc', o_custkey, ' ')", F="'nan'"),
    "placa": _status(P="''"),
    "nmMarca": _status(O="'BRAND O'"),
    "marca": "' Marca '",
    "dsModelo": _status(P="'MODEL P'"),
    "nrChassi": "concat('CH', o_orderkey)",
    "subModelo": _priority("' SUB '"),
    "vrFipe": _priority(f"replace({_AMOUNT}, '.', ',')", f"concat('1.', replace({_AMOUNT}, '.', ','))", _AMOUNT, "'R$ 10,00'"),
    "valorMercado": "'nan'",
    "anoVeiculo": _priority("'2019.0'", "'nan'", "'2020'", "'abc'"),
    "ano": "'1999'",
    "dtSinistro": _priority("date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')", "'nan'"),
    "dtAberturaSinistro": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "usuario_origem": f"CASE WHEN o_orderpriority <> '{LOW}' THEN concat('user', c_nationkey + 1) END",
    "logWorkFlow": _LOG,
    "documentos": f"CASE WHEN o_orderstatus = 'O' THEN {_PAPERS} END",
    "listaDocumentos": f"CASE WHEN o_orderstatus <> 'F' THEN {_PAPERS} END",
}


def _as_records(rows: DataFrame) -> DataFrame:
    """Records of orders with their customer. A table may be one row group, and a record takes long to make: the narrow rows are dealt out before."""
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    columns = [f"CAST({_RECORD.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in RECORD.fields]
    return rows.selectExpr(*columns, "o_orderkey AS _order")


def records(spark: SparkSession, sf: str) -> DataFrame:
    """One dirty portal record per order, in the landed schema, with its reading order."""
    return _as_records(cases(spark, sf))


def batch_records(spark: SparkSession, sf: str) -> DataFrame:
    """What the portal shows now: orders that are not finished."""
    return _as_records(cases(spark, sf).filter("o_orderstatus <> 'F'"))


def known(table: DataFrame, spark: SparkSession, sf: str, key: str = "process") -> DataFrame:
    """Rows of the processes stored before the batch: orders that are not open."""
    ids = load(spark, sf, "orders", ["o_orderkey", "o_orderstatus"]).filter("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias(key))
    return table.join(ids, key, "left_semi").select(*table.columns)
