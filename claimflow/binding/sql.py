"""The binding and the cleansing rules stated in SQL, as an independent check.

``compose(body)`` puts the named table expressions a query needs in front of it.
"""

from __future__ import annotations

import re

NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
EMAIL = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"


def words(*items: str) -> str:
    return ", ".join(f"'{item}'" for item in items)


def nullify(x: str, *sentinels: str) -> str:
    return f"CASE WHEN lower(trim({x})) NOT IN ({words(*(sentinels or ('', 'nan', 'none')))}) THEN {x} END"


def text_or_null(x: str, n: int) -> str:
    return f"left({nullify(f'trim({x})')}, {n})"


def number(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '{NUMBER}') THEN try_cast(trim({x}) AS DOUBLE) END"


def whole(x: str, kind: str = "INTEGER") -> str:
    return f"try_cast(trunc({number(nullify(x))}) AS {kind})"


def flag(x: str) -> str:
    return f"coalesce(CAST(upper(trim({x})) IN ('S', 'SIM', 'TRUE', '1') AS INTEGER), 0)"


def money(x: str) -> str:
    t = f"upper(trim({x}))"
    plain = f"CASE WHEN contains({t}, ',') THEN replace(replace({t}, '.', ''), ',', '.') ELSE {t} END"
    return number(nullify(f"({plain})", "", "nan", "none", "<na>"))


def area(x: str) -> str:
    t = f"trim(replace({x}, '.0', ''))"
    return f"CASE WHEN regexp_full_match({t}, '[0-9]+') THEN try_cast({t} AS INTEGER) END"


def phone(x: str, ddd: str) -> tuple[str, str]:
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    good = f"(lower({x}) NOT IN ('', 'nan', 'none') AND length({digits}) >= 8)"
    split = f"(length({digits}) IN (10, 11) AND coalesce({ddd}, '') IN ('', '0', '0.0'))"
    code = f"CASE WHEN {good} THEN CASE WHEN {split} THEN CAST(left({digits}, 2) AS INTEGER) ELSE {area(ddd)} END END"
    rest = f"CASE WHEN {good} THEN CASE WHEN {split} THEN substr({digits}, 3) ELSE {digits} END END"
    return code, rest


def tax_type(x: str) -> str:
    return f"CASE WHEN length(rtrim(replace({x}, '.0', ''))) <= 11 THEN 1 ELSE 2 END"


def tax_text(x: str) -> str:
    t = f"replace({x}, '.0', '')"
    return f"CASE WHEN length(rtrim({t})) <= 11 THEN right('00000000000' || {t}, 11) ELSE right('00000000000000' || {t}, 14) END"


def squash(x: str) -> str:
    return f"trim(regexp_replace({x}, ' {{2,}}', ' ', 'g'))"


def first_email(x: str) -> str:
    return f"coalesce(regexp_extract_all({x}, '{EMAIL}')[1], '')"


def dedupe_emails(x: str) -> str:
    found = f"regexp_extract_all({x}, '{EMAIL}')"
    once = f"list_filter({found}, lambda e, i: list_position({found}, e) = i)"
    return (
        f"CASE WHEN coalesce({x}, '') IN ('', 'Não informado') THEN 'Não informado' "
        f"WHEN len({found}) > 0 THEN array_to_string({once}, ', ') ELSE {x} END"
    )


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S')"


_PARTY_TYPE = "CASE file_type_text WHEN 'DPA' THEN 1 WHEN 'TRC' THEN 2 ELSE 1 END"
_PHONE = phone("insured_phone", "ddd")
_BROKER_PHONE = phone("broker_phone", "broker_ddd")

TABLES = {
    "cases": "SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    # --- state ---
    "process": """
        SELECT o_orderkey AS id, 'C' || o_orderkey AS claim,
               CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 ELSE 0 END AS file_type,
               CASE WHEN o_orderpriority <> '5-LOW' THEN c_nationkey END AS portal_status,
               lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS uf, 'SEGURADORA CLIENTE' AS company,
               CASE WHEN NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O') THEN o_orderdate END AS opened,
               o_orderdate - INTERVAL 1 DAY AS occurred, 'FASE ' || o_orderstatus AS phase,
               CAST(o_totalprice > 250000 AS INTEGER) AS alert, o_orderdate + INTERVAL 2 HOUR AS loaded_at, o_orderstatus
        FROM cases""",
    "queue": """
        SELECT o_orderkey AS id, o_orderkey AS process, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 3 ELSE 2 END AS status,
               CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS attempts,
               CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 9 HOUR END AS slot,
               CAST(NULL AS TIMESTAMP) AS last_attempt, CASE WHEN o_orderstatus = 'P' THEN 'HTTP 500' END AS message,
               CAST(o_orderpriority <> '4-NOT SPECIFIED' AS INTEGER) AS active
        FROM orders""",
    "vehicle": """
        SELECT l_orderkey AS process, 'P' || p_partkey AS plate, 'CH' || p_partkey AS chassis, p_brand AS brand, p_name AS model,
               p_type AS submodel, p_size + 1990 AS year, CAST(p_retailprice AS DECIMAL(18,2)) AS value,
               CAST(p_size > 25 AS INTEGER) AS encumbered
        FROM (SELECT l_orderkey, min(l_partkey) AS k FROM lineitem GROUP BY 1) JOIN part ON p_partkey = k""",
    "roles": "SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem WHERE l_returnflag IN ('R', 'A')",
    "party": """
        SELECT o_orderkey || ':I' AS id, o_orderkey AS process, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS type,
               '  ' || replace(c_name, '#', '   ') || ' ' AS name,
               CASE c_mktsegment WHEN 'BUILDING' THEN c_custkey || '.0' WHEN 'MACHINERY' THEN '123456789012' || c_custkey
                    WHEN 'HOUSEHOLD' THEN NULL ELSE '123.045' || c_custkey END AS tax_id
        FROM cases
        UNION ALL
        SELECT l_orderkey || ':B:' || l_suppkey, l_orderkey, 3, s_name, NULL
        FROM roles LEFT JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag = 'R'
        UNION ALL
        SELECT l_orderkey || ':A:' || l_suppkey, l_orderkey, 4, 'Analyst ' || l_suppkey, NULL FROM roles WHERE l_returnflag = 'A'""",
    "line_contact": """
        SELECT l_orderkey, l_suppkey, l_returnflag, CASE WHEN l_linenumber IN (2, 4, 6) THEN 2 ELSE 3 END AS type,
               CASE WHEN l_linenumber IN (2, 4, 6) THEN l_linenumber + 10 END AS area,
               CASE WHEN l_linenumber IN (2, 4, 6) THEN '9' || lpad(CAST(l_partkey AS VARCHAR), 8, '0')
                    WHEN l_quantity > 45 THEN '' ELSE 'p' || l_partkey || '@mail.com' END AS value,
               CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS principal
        FROM lineitem""",
    "contact": """
        SELECT l_orderkey || ':I' AS party, type, area, value, principal FROM line_contact
        UNION ALL
        SELECT l_orderkey || CASE l_returnflag WHEN 'R' THEN ':B:' ELSE ':A:' END || l_suppkey, type, area, value, principal
        FROM line_contact WHERE l_returnflag IN ('R', 'A')""",
    "ranked_contact": """
        SELECT *, row_number() OVER (PARTITION BY party, type ORDER BY principal DESC NULLS LAST, value, area NULLS FIRST) AS place
        FROM contact""",
    "email": "SELECT party, value FROM ranked_contact WHERE type = 3 AND place = 1",
    "phone": "SELECT party, area, value FROM ranked_contact WHERE type = 2 AND place = 1",
    "reach": """
        SELECT p.*, e.value AS email, t.area, t.value AS phone
        FROM party p LEFT JOIN email e ON e.party = p.id LEFT JOIN phone t ON t.party = p.id""",
    "user_history": """
        SELECT l_orderkey AS process, CAST(l_suppkey AS INTEGER) AS user_id, min(l_shipdate) AS entered_at,
               CASE WHEN max(l_returnflag) = 'R' THEN max(l_shipdate) END AS left_at,
               CASE WHEN max(l_returnflag) = 'R' THEN 0 ELSE 1 END AS is_current
        FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "robot_user": """
        SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, 'user' || s_suppkey AS login, 's' || s_suppkey || '@op.com' AS email
        FROM supplier""",
    "event": """
        SELECT l_orderkey AS process, CAST(l_linenumber AS BIGINT) AS event,
               CASE WHEN l_returnflag = 'N' THEN '' ELSE 'Event ' || l_returnflag END AS text,
               l_shipdate AS happened_at, l_shipdate + INTERVAL 2 HOUR AS loaded_at
        FROM lineitem""",
    "step": """
        SELECT l_orderkey AS process, l_partkey AS task, 'Task ' || l_linestatus AS name, l_returnflag AS status,
               l_shipdate AS happened_at, l_shipdate + INTERVAL 3 HOUR AS loaded_at
        FROM lineitem""",
    "document": """
        SELECT l_orderkey AS process, 'Doc ' || l_linenumber AS name, max(l_linestatus) AS status FROM lineitem GROUP BY 1, 2""",
    "sla": """
        SELECT o_orderkey AS process, o_orderdate AS received, o_orderdate + INTERVAL '10 hours 59 seconds' AS captured,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS sent,
               CAST(NULL AS INTEGER) AS queue_minutes, 'PENDENTE_ENVIO' AS status
        FROM orders""",
    "portal_status": """
        SELECT n_nationkey AS code, n_name AS label, 'CTX ' || n_regionkey AS context, n_regionkey AS operator_status FROM nation""",
    "file_type": """
        SELECT * FROM (VALUES (1, 'DPA', 'Segurado DPA'), (2, 'TRC', 'Terceiro TRC'), (0, 'N/D', 'Não Identificado/Outros'))
        AS t(code, sigla, label)""",
    "changes": """
        SELECT id, greatest(loaded_at, e.at, s.at) AS last_change
        FROM process
        LEFT JOIN (SELECT process, max(loaded_at) AS at FROM event GROUP BY 1) e ON e.process = id
        LEFT JOIN (SELECT process, max(loaded_at) AS at FROM step GROUP BY 1) s ON s.process = id""",
    "owner": "SELECT process, max(user_id) AS user_id, max(left_at) AS left_at FROM user_history GROUP BY 1",
    # --- portal records as landed ---
    "rec": """
        SELECT o_orderkey AS id, 'C' || o_orderkey AS claim, o_orderstatus, o_orderpriority, o_orderdate, o_custkey,
               CAST(left(o_orderpriority, 1) AS INTEGER) AS n,
               CASE o_orderstatus WHEN 'O' THEN c_nationkey || '.0' WHEN 'P' THEN CAST(c_nationkey AS VARCHAR) WHEN 'F' THEN 'nan' END AS status_raw,
               CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_custkey AS VARCHAR) WHEN '2-HIGH' THEN CAST(o_custkey AS VARCHAR)
                    WHEN '3-MEDIUM' THEN o_custkey || '.0' WHEN '4-NOT SPECIFIED' THEN '0' END AS cycle_raw,
               c_nationkey + 1 AS user_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN ' trc ' WHEN '2-HIGH' THEN 'DPA' WHEN '3-MEDIUM' THEN 'XYZ' END AS file_raw,
               CASE o_orderstatus WHEN 'O' THEN '' WHEN 'P' THEN ' EM ANALISE ' END AS phase1,
               CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'FINALIZADO' WHEN '3-MEDIUM' THEN 'CANCELADO' END AS phase2,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'DS URGENT' WHEN '5-LOW' THEN 'null' END AS phase3,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'S' WHEN '2-HIGH' THEN 'true' WHEN '3-MEDIUM' THEN ' sim '
                    WHEN '4-NOT SPECIFIED' THEN 'N' END AS alert_raw,
               CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'P' THEN 'SIM' ELSE 'nao' END AS encumbered_raw,
               CASE o_orderstatus WHEN 'O' THEN ' rjx' WHEN 'F' THEN 'nan' END AS uf_text,
               CASE c_mktsegment WHEN 'BUILDING' THEN '11' WHEN 'MACHINERY' THEN '21.0' WHEN 'FURNITURE' THEN 'x1' WHEN 'AUTOMOBILE' THEN '' END AS ddd,
               coalesce(CASE WHEN o_orderstatus <> 'F' THEN c_name END, '  ' || c_name || '  ') AS insured_name,
               coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN o_custkey || '.0' WHEN '2-HIGH' THEN '12345678901' || o_custkey END,
                        lpad(CAST(o_custkey AS VARCHAR), 11, '7')) AS tax_id,
               coalesce(CASE c_mktsegment WHEN 'BUILDING' THEN 'a' || o_custkey || '@x.com; b' || o_custkey || '@y.com.br , bad'
                             WHEN 'MACHINERY' THEN 'solo' || o_custkey || '@x.com' WHEN 'FURNITURE' THEN 'none' END,
                        's' || o_custkey || '@z.com,s' || o_custkey || '@z.com') AS insured_email,
               CASE o_orderpriority WHEN '1-URGENT' THEN '(11) 9' || lpad(CAST(o_custkey AS VARCHAR), 8, '0')
                    WHEN '2-HIGH' THEN lpad(CAST(o_custkey AS VARCHAR), 8, '3') WHEN '3-MEDIUM' THEN '123-4567'
                    WHEN '4-NOT SPECIFIED' THEN 'None' END AS insured_phone,
               CASE o_orderstatus WHEN 'O' THEN 'Broker ' || o_custkey WHEN 'P' THEN ' nan ' END AS broker_name,
               CASE o_orderpriority WHEN '1-URGENT' THEN ' br' || o_custkey || '@b.com ' WHEN '2-HIGH' THEN 'no mail' END AS broker_email,
               '21' || lpad(CAST(o_custkey AS VARCHAR), 9, '9') AS broker_phone,
               CASE o_orderpriority WHEN '1-URGENT' THEN '0' WHEN '2-HIGH' THEN '31' WHEN '3-MEDIUM' THEN 'nan' END AS broker_ddd,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Ana ' || o_custkey WHEN '2-HIGH' THEN 'None' WHEN '3-MEDIUM' THEN 'Ana ' || o_custkey ELSE '' END AS analyst_name,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'ana' || o_custkey || '@t.com' WHEN '2-HIGH' THEN 'x@t.com' ELSE '' END AS analyst_email,
               CASE o_orderstatus WHEN 'O' THEN ' abc' || o_custkey || ' ' WHEN 'F' THEN 'nan' WHEN 'P' THEN '' END AS plate,
               CASE WHEN o_orderstatus = 'O' THEN 'BRAND O' ELSE ' Marca ' END AS brand,
               CASE WHEN o_orderstatus = 'P' THEN 'MODEL P' ELSE '' END AS model, 'CH' || o_orderkey AS chassis,
               CASE WHEN o_orderpriority = '1-URGENT' THEN ' SUB ' ELSE '' END AS submodel,
               CASE o_orderpriority WHEN '1-URGENT' THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
                    WHEN '2-HIGH' THEN '1.' || replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
                    WHEN '3-MEDIUM' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
                    WHEN '4-NOT SPECIFIED' THEN 'R$ 10,00' ELSE 'nan' END AS value_text,
               CASE o_orderpriority WHEN '1-URGENT' THEN '2019.0' WHEN '2-HIGH' THEN 'nan' WHEN '3-MEDIUM' THEN '2020'
                    WHEN '4-NOT SPECIFIED' THEN 'abc' ELSE '1999' END AS year_text,
               CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN '2-HIGH' THEN 'nan'
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS occurred_text,
               CASE WHEN o_orderpriority <> '5-LOW' THEN 'user' || (c_nationkey + 1) ELSE 'SISTEMA' END AS user_name
        FROM cases""",
    # --- standardised ---
    "std": f"""
        SELECT *, upper(trim(coalesce(file_raw, ''))) AS file_type_text, {whole('status_raw')} AS portal_status,
               coalesce(nullif(phase1, ''), nullif(phase2, ''), nullif(phase3, ''), 'PROCESSO RECEPCIONADO') AS phase,
               trim(coalesce(phase2, '')) AS task_name, trim(coalesce(phase3, '')) AS task_status,
               {whole('cycle_raw', 'BIGINT')} AS cycle, {flag('alert_raw')} AS alert, {flag('encumbered_raw')} AS encumbered
        FROM rec WHERE id <> 0""",
    "std_event": """
        SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS INTEGER) AS position,
               CAST(CASE WHEN i = 4 THEN 0 ELSE i - 1 END AS BIGINT) AS event_id,
               CASE WHEN i < 3 THEN ' Event ' || i WHEN i = 3 THEN 'Status ' || o_orderstatus ELSE 'nan' END AS text,
               o_orderdate + i * INTERVAL 1 HOUR - INTERVAL 3 HOUR AS happened_at, o_orderstatus
        FROM rec, unnest(generate_series(1, n - 1)) AS g(i) WHERE i <> 2 AND id <> 0""",
    "std_opened": "SELECT id, min(happened_at) AS opened FROM std_event GROUP BY 1",
    "std_document": """
        SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS INTEGER) AS position,
               CASE WHEN i = 1 THEN 'Report' ELSE 'Doc ' || (i % 2) END AS name,
               CASE WHEN i = 3 THEN '' ELSE 'S' || i END AS status
        FROM rec, unnest(generate_series(1, n)) AS g(i) WHERE o_orderstatus <> 'F' AND i <> 2 AND id <> 0""",
    # --- rows of the initial load ---
    "areas": """
        SELECT * FROM (VALUES (11, 'SP'), (21, 'RJ')) AS t(code, uf)""",
    "load_process_rows": f"""
        SELECT s.id, claim, CASE file_type_text WHEN 'DPA' THEN 1 WHEN 'TRC' THEN 2 ELSE 0 END AS file_type, portal_status,
               coalesce(a.uf, upper(left(trim(coalesce({nullify('uf_text', '', 'nan', 'none', 'nat', '<na>')}, 'SP')), 2))) AS uf,
               'SEGURADORA CLIENTE' AS company, o.opened, try_cast({nullify('occurred_text', '', 'nan', 'none', 'nat')} AS TIMESTAMP) AS occurred,
               left(trim(phase), 150) AS phase, alert, o_orderstatus
        FROM std s LEFT JOIN areas a ON a.code = {area('ddd')} LEFT JOIN std_opened o ON o.id = s.id""",
    "load_vehicle_rows": f"""
        SELECT id AS process, left(coalesce({nullify('upper(trim(plate))')}, 'AVI0000'), 10) AS plate, chassis,
               nullif(left(trim(brand), 50), '') AS brand, nullif(left(trim(model), 100), '') AS model,
               nullif(left(trim(submodel), 150), '') AS submodel, {whole('year_text')} AS year,
               CAST({money('value_text')} AS DECIMAL(18,2)) AS value, encumbered, o_orderstatus
        FROM std""",
    "load_party_rows": f"""
        SELECT id AS process, {_PARTY_TYPE} AS type, left(trim(insured_name), 150) AS name, left(trim(tax_id), 20) AS tax_id, o_orderstatus FROM std
        UNION ALL
        SELECT id, 3, left(trim(broker_name), 150), NULL, o_orderstatus FROM std WHERE {nullify('broker_name')} IS NOT NULL
        UNION ALL
        SELECT id, 4, left(trim(analyst_name), 150), NULL, o_orderstatus FROM std WHERE {nullify('analyst_name')} IS NOT NULL""",
    "load_contact_rows": f"""
        SELECT id AS process, {_PARTY_TYPE} AS kind, 3 AS type, CAST(NULL AS INTEGER) AS area, left(trim(part), 150) AS value, o_orderstatus
        FROM std, unnest(regexp_split_to_array(insured_email, '[;,]')) AS u(part) WHERE contains(part, '@')
        UNION ALL
        SELECT id, {_PARTY_TYPE}, 2, {_PHONE[0]}, left({_PHONE[1]}, 150), o_orderstatus FROM std WHERE {_PHONE[1]} IS NOT NULL
        UNION ALL
        SELECT id, 3, 3, NULL, left(trim(broker_email), 150), o_orderstatus FROM std
        WHERE {nullify('broker_name')} IS NOT NULL AND contains(broker_email, '@')
        UNION ALL
        SELECT id, 3, 2, {_BROKER_PHONE[0]}, left({_BROKER_PHONE[1]}, 150), o_orderstatus FROM std
        WHERE {nullify('broker_name')} IS NOT NULL AND {_BROKER_PHONE[1]} IS NOT NULL
        UNION ALL
        SELECT id, 4, 3, NULL, left(trim(analyst_email), 150), o_orderstatus FROM std
        WHERE {nullify('analyst_name')} IS NOT NULL AND contains(analyst_email, '@')""",
}


def compose(body: str) -> str:
    """``body`` behind the table expressions it uses, in the order they need each other."""
    needed: list[str] = []

    own = re.findall(r"(\w+) AS \(", body) if body.startswith("WITH") else []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and name not in own and re.search(rf"(FROM|JOIN|,)\s+{name}\b", text):
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name]})" for name in needed)
    # the wide views are put as the recursive queries are, whose expressions are the same
    opening = "WITH RECURSIVE " if "reach" in needed or body.startswith("WITH RECURSIVE ") else "WITH "
    own_part = body.removeprefix("WITH ").removeprefix("RECURSIVE ") if body.startswith("WITH ") else None
    return f"{opening}{ctes}\n{body}" if own_part is None else f"{opening}{ctes},\n{own_part}"
