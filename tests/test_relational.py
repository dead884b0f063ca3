"""Joins and aggregates against plain Python."""

import random

from pyspark.sql import functions as F

from claimflow.operators import quality as q
from claimflow.operators import relational as r
from claimflow.operators import transitions as t


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


def none_first(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def test_with_every_key_is_a_left_join(spark):
    satellite = spark.createDataFrame([(1, i) for i in range(40)] + [(3, 7), (9, 8), (None, 9)], "k long, v long")
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    out = r.with_every_key(satellite, keys, "k")
    assert none_first(tuple(row) for row in out.collect()) == none_first([(1, i) for i in range(40)] + [(2, None), (3, 7)])


def test_small_batches_do_not_shuffle_the_state(spark):
    state = spark.range(1000).withColumnRenamed("id", "k")
    batch = spark.createDataFrame([(1, "a")], "k long, v string").limit(1)
    for guard in (r.exists_in, r.missing_in):
        plan = guard(batch, state, ["k"])._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" in plan
    assert rows_of(r.exists_in(batch, state, ["k"])) == [(1, "a")]


def test_best_contact(spark):
    rows = [
        (1, 10, 3, None, "b@x", 0), (2, 10, 3, None, "a@x", 1), (3, 10, 3, None, "c@x", 1), (4, 10, 2, 11, "99", None),
        (5, 11, 2, None, "77", None), (6, 11, 2, 21, "88", 0), (7, 12, 1, 1, "ignored", 1), (8, 13, 3, None, None, 1)]
    df = spark.createDataFrame(rows, "id long, party long, type int, area int, value string, principal int")
    got = {row.party: row for row in r.best_contact(df, {"email": 3, "phone": 2}).collect()}
    assert set(got) == {10, 11, 13}
    assert (got[10].email_value, got[10].phone_area, got[10].phone_value) == ("a@x", 11, "99")
    assert (got[11].email_value, got[11].phone_area, got[11].phone_value) == (None, 21, "88")
    assert got[13].email_value is None


def test_guards(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id long, v string")
    state = spark.createDataFrame([(1,), (1,), (3,)], "id long")
    assert rows_of(r.missing_in(batch, state, ["id"]).select("v")) == [("c",), ("d",)]
    assert rows_of(r.exists_in(batch, state, ["id"]).select("v")) == [("a",), ("b",)]
    assert rows_of(r.missing_from(state, batch, ["id"])) == [(3,)]


def test_ties_do_not_depend_on_row_order(spark):
    rows = [(1, "b", 5), (1, "a", 5), (2, None, 1), (2, "z", 1)]
    for given in (rows, rows[::-1]):
        df = spark.createDataFrame(given, "k long, v string, o long").coalesce(1)
        assert rows_of(r.first_per_key(df.filter("k = 1"), "k", "o")) == [(1, "a", 5)]
        assert r.last_per_key(df, "k", "o").filter("k = 2").first().v == r.first_per_key(df, "k", "o").filter("k = 2").first().v


def test_first_and_last_per_key(spark):
    rows = [(1, "x", 3), (1, None, 2), (2, "z", 1)]
    df = spark.createDataFrame(rows, "k int, v string, o int")
    assert none_first(tuple(x) for x in r.first_per_key(df, "k", "o").collect()) == none_first([(1, None, 2), (2, "z", 1)])
    assert rows_of(r.last_per_key(df, "k", "o")) == [(1, "x", 3), (2, "z", 1)]


def test_last_change_skips_missing_facts(spark):
    def ts(*rows):
        return spark.createDataFrame(rows, "process long, loaded_at string").withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))

    process = ts((1, "2026-01-01"), (2, "2026-01-05"), (3, None)).withColumnRenamed("process", "id")
    event, step = ts((1, "2026-01-03"), (1, "2026-01-02")), ts((2, "2026-01-04"))
    got = {row.id: str(row.last_change)[:10] for row in r.last_change(process, event, step).collect()}
    assert got == {1: "2026-01-03", 2: "2026-01-05", 3: "None"}


def test_uf(spark):
    areas = spark.createDataFrame([(11, "SP"), (21, "RJ")], "code int, uf string")
    rows = [(1, "11", "mg"), (2, "21.0", None), (3, "99", " minas"), (4, None, "nan"), (5, "x", None)]
    df = spark.createDataFrame(rows, "id int, ddd string, uf_text string")
    assert rows_of(r.resolve_uf(df, areas).select("id", "uf")) == [(1, "SP"), (2, "RJ"), (3, "MI"), (4, "SP"), (5, "SP")]
    assert rows_of(r.repair_uf(df, areas).select("id", "uf")) == [(1, "SP"), (2, "RJ"), (3, "MINAS"), (4, "SP"), (5, "SP")]


def test_numbered_ids(spark):
    rng = random.Random(2)
    values = [(rng.randrange(1000), i) for i in range(500)]
    df = spark.createDataFrame(values, "a int, b int").repartition(7)
    got = {(row.a, row.b): row.n for row in t.numbered_ids(df, ["a", "b"], "n", offset=10).collect()}
    assert got == {pair: i for i, pair in enumerate(sorted(values), 11)}


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "bb", "x"), (2, "ccc", "y"), (None, "d", "z")], "id long, name string, note string")
    assert rows_of(q.duplicate_keys(df, ["id"])) == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "pid long")
    assert rows_of(q.orphans(df, parent, "id", "pid")) == [(2, 1)]
    bad = q.constraint_violations(df.filter("id IS NOT NULL"), "id", {"note": None, "name": 2})
    assert none_first(tuple(x) for x in bad.collect()) == none_first([(1, "note", "missing", None), (2, "name", "too long", 3)])


def test_contacts_are_shuffled_once(spark):
    """Both kinds of a party go through one exchange, which all roles of a view read; ties and unknown principals as before."""
    from claimflow.binding import warehouse as w
    from claimflow.plans import views as v

    shape = "id long, party long, type int, value string, area int, principal int"
    df = spark.createDataFrame([
        (1, 1, 3, "b@x", None, 1), (2, 1, 3, "a@x", None, 1), (3, 1, 3, None, None, 0), (4, 1, 2, "99", 11, None), (5, 1, 2, "98", None, 0),
        (6, None, 2, "97", 21, None), (7, 2, 1, "other", None, 1)], shape)
    best = r.best_contact(df, {"email": 3, "phone": 2})
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert text(best).count("Exchange") == 1
    assert sorted(map(tuple, best.collect()), key=str) == [(1, None, "b@x", None, "98"), (None, None, None, 21, "97")]
    tables = w.claims(spark, "/root/testdata/sf0.001")
    keys = tables["process"].select(tables["process"]["id"].alias("_process"))
    whole = v._parties(tables, keys, w.CONTACT_TIE, cut=False)
    # a role that needs fewer columns writes no exchange of its own
    for role in ("insured", "analyst"):
        narrow = whole[role].select("_process", f"{role}_email_value")._jdf.queryExecution().optimizedPlan().toString()
        assert "phone" in narrow
