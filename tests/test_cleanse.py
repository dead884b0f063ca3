"""Cleansing rules against literal truth tables."""

import math

import pytest
from pyspark.sql import functions as F

from claimflow.functions import cleanse as c
from claimflow.operators import normalise as n


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row.y for row in df.orderBy("i").select(build(F.col("x")).alias("y")).collect()]


PHONES = [
    (None, "11", None, None), ("nan", "11", None, None), ("None", None, None, None), ("", "11", None, None),
    ("1234567", "11", None, None), ("(11) 98765-4321", None, 11, "987654321"), ("(11) 98765-4321", "", 11, "987654321"),
    ("(11) 98765-4321", "0", 11, "987654321"), ("12345678", None, None, "12345678"), ("98765-4321", "11", 11, "987654321"),
    ("98765-4321", "11.0", 11, "987654321"), ("11987654321", "11", 11, "11987654321"), ("11987654321", "NaN", None, "11987654321"),
    ("98765432", "x1", None, "98765432"), ("5511987654321", None, None, "5511987654321"), ("98765432", " 11 ", 11, "98765432"),
]


def test_phone(spark):
    df = spark.createDataFrame([(i, p, a) for i, (p, a, _, _) in enumerate(PHONES)], "i int, p string, a string")
    got = df.orderBy("i").select(c.clean_phone(F.col("p"), F.col("a")).alias("r")).select("r.*").collect()
    assert [(row.area, row.number) for row in got] == [(area, number) for _, _, area, number in PHONES]


MONEY = [
    (None, None), ("NaN", None), ("45000", 45000.0), ("1.200,50", 1200.5), ("1200,5", 1200.5), ("1.200", 1.2), ("1,200.50", 1.2005),
    ("", None), ("nan", None), ("<NA>", None), ("abc", None), ("R$ 1.200,50", None), (" 10 ", 10.0), ("1e3", 1000.0), ("inf", None),
    ("1_000", 1000.0), ("1.5d", None), ("-3,5", -3.5), ("1e400", None), (".5", 0.5), ("1.2.3", None),
]


def test_money(spark):
    assert column(spark, [m[0] for m in MONEY], c.parse_money) == [m[1] for m in MONEY]
    assert column(spark, ["R$ 1.200,50"], lambda x: c.parse_money(x, strip_currency=True)) == [1200.5]


def test_year(spark):
    values = ["2019", "2019.0", "2019.9", "nan", "None", "", None, "abc", "1e3", "inf", "99999999999"]
    assert column(spark, values, c.parse_year) == [2019, 2019, 2019, None, None, None, None, None, 1000, None, None]


def test_flags(spark):
    values = ["S", " sim ", "true", "1", "N", "0", "", None, "yes"]
    assert column(spark, values, c.flag01) == [1, 1, 1, 1, 0, 0, 0, 0, 0]
    assert column(spark, [True, False, None], c.flag01, "boolean") == [1, 0, 0]
    types = ["DPA", " trc ", "x", None]
    assert column(spark, types, c.file_type_code) == [1, 2, 0, 0]
    assert column(spark, types, c.party_type_code) == [1, 2, 1, 1]


def test_tax_id(spark):
    values = [None, "", "12345678901", "12345678000199", "123.045", "12345678901.0", "123456789012345", "12345  "]
    assert column(spark, values, c.tax_id_type) == [2, 1, 1, 2, 1, 1, 2, 1]
    assert column(spark, values, c.format_tax_id) == [
        None, "00000000000", "12345678901", "12345678000199", "00000012345", "12345678901", "23456789012345", "000012345  "]


def test_emails(spark):
    values = [None, "", "none", "a@x.com", "x a@x.com;b@y.org, a@x.com", "Não informado", "bad@", "a@x.com.br."]
    assert column(spark, values, c.first_email) == ["", "", "", "a@x.com", "a@x.com", "", "", "a@x.com.br."]
    assert column(spark, values, c.dedupe_emails) == [
        "Não informado", "Não informado", "none", "a@x.com", "a@x.com, b@y.org", "Não informado", "bad@", "a@x.com.br."]
    assert column(spark, ["a@x.com, b@x.com; no ;c@x.com", "no"], c.email_parts) == [["a@x.com", "b@x.com", "c@x.com"], []]


def test_texts(spark):
    assert column(spark, ["  ANA   LIMA  ", "a\t b", "x    y"], c.squash_spaces) == ["ANA LIMA", "a\t b", "x y"]
    assert column(spark, [" abc1d23 ", "nan", "", None, "None"], c.clean_plate) == ["ABC1D23"] + [c.PLATE_PLACEHOLDER] * 4
    assert column(spark, ["", "  ", None, "a@b.c"], c.default_email) == [c.EMAIL_PLACEHOLDER] * 3 + ["a@b.c"]
    assert column(spark, ["nan", " NaT ", "x", None], lambda x: c.nullify(x, c.BLANK_DATE)) == [None, None, "x", None]
    assert column(spark, [" abcdef ", "none"], lambda x: c.text_or_null(x, 3)) == ["abc", None]
    assert column(spark, ["2026-01-02 03:04:05.678", None], c.iso_text) == ["2026-01-02T03:04:05", None]
    assert column(spark, ["2026-01-02 03:04:05", "nan", "31/12", None], c.to_timestamp)[1:] == [None, None, None]


def test_joined_phone(spark):
    df = spark.createDataFrame([(11, "9" * 40), (None, "1"), (11, None)], "a int, n string")
    assert [r.p for r in df.select(c.join_phone(F.col("a"), F.col("n")).alias("p")).collect()] == ["11" + "9" * 30, None, None]


@pytest.mark.parametrize("start,end,minutes", [
    ("10:00:59", "10:01:00", 1), ("10:00:00", "10:00:59", 0), ("10:00:00", "11:00:00", 60), ("10:01:00", "10:00:59", -1)])
def test_minute_boundaries(spark, start, end, minutes):
    df = spark.range(1).select(*[F.lit(f"2026-01-01 {t}").cast("timestamp_ntz").alias(n) for t, n in ((start, "a"), (end, "b"))])
    assert df.select(c.minute_boundaries(F.col("a"), F.col("b")).alias("m")).first().m == minutes


def test_event_stamp(spark):
    values = ["1767272400000", "1767272400999", "0", "", "abc", None, "1.7672724E12", "9e18"]
    got = column(spark, values, n.event_stamp)
    assert [str(v) for v in got] == ["2026-01-01 10:00:00", "2026-01-01 10:00:00"] + ["None"] * 4 + ["2026-01-01 10:00:00", "None"]


def test_overlay_json_keeps_present_nulls(spark):
    df = spark.createDataFrame([('{"a":1,"b":2,"c":{"d":[1]}}', '{"b":null}', None)], "x string, y string, z string")
    merged = df.select(n.overlay_json(F.col("x"), F.col("y"), F.col("z")).alias("m")).first().m
    assert merged == {"a": "1", "b": None, "c": '{"d":[1]}'}


def test_response(spark):
    rows = [(1, 201, '{"id":7,"message":"ok"}', None), (2, 200, '{"acionamentoId":"x"}', None), (3, 204, None, None),
            (4, 409, '{"message":""}', None), (5, None, None, "timeout")]
    df = spark.createDataFrame(rows, "process long, status_code int, body string, error string")
    got = {r.process: (r.status_code, r.request_id, r.message) for r in n.normalise_response(df).collect()}
    assert got == {
        1: (201, "7", "ok"), 2: (200, "x", '{"acionamentoId":"x"}'), 3: (204, None, n.EMPTY_RESPONSE),
        4: (409, None, '{"message":""}'), 5: (500, None, n.CONNECTION_ERROR + "timeout")}


def test_no_nan_survives(spark):
    assert not any(v is not None and math.isnan(v) for v in column(spark, ["NaN", "nan", "1"], c.to_number))
