"""Slots against an independent datetime fold, for every way of cutting a queue into chunks."""

import random
from datetime import datetime, time, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimflow.operators import slots as s

EPOCH = datetime(1970, 1, 1)


def base_of(at):
    if at.weekday() >= 5:
        return datetime.combine(at.date() + timedelta(days=7 - at.weekday()), time(8, 15))
    if at.time() < time(8, 15):
        return datetime.combine(at.date(), time(8, 15))
    if at.time() >= time(18):
        day = at.date() + timedelta(days=3 if at.weekday() == 4 else 1)
        return datetime.combine(day, time(8, 15))
    return at


def fold(times, last=None):
    out = []
    for at in times:
        base = base_of(at)
        if last is not None and base <= last:
            later = last + timedelta(minutes=5)
            last = base if later.time() >= time(18) and later.date() == base.date() else later
        else:
            last = base
        out.append(last)
    return out


def us(at):
    return (at - EPOCH) // timedelta(microseconds=1)


def at(minutes):
    return datetime(2024, 1, 5) + timedelta(minutes=minutes)


stamps = st.lists(
    st.integers(0, 60 * 24 * 5).map(at) | st.sampled_from([at(1000), at(1077), at(1079), at(500)]), min_size=1, max_size=400
)


@settings(max_examples=150, deadline=None)
@given(stamps, st.booleans(), st.lists(st.integers(-3000, 12000), min_size=1, max_size=8))
def test_transfer_equals_fold(times, ordered, starts):
    times = sorted(times) if ordered else times
    transfer = s.Transfer()
    for moment in times:
        transfer.step(us(base_of(moment)))
    pieces = transfer.pieces()
    for start in [None, *starts]:
        last = None if start is None else at(start)
        expected = fold(times, last)[-1]
        assert s.apply_pieces(None if last is None else us(last), *pieces) == us(expected)


def test_transfer_stays_small():
    transfer = s.Transfer()
    rng = random.Random(1)
    for minute in sorted(rng.randrange(495, 1080) + 1440 * rng.randrange(3, 6) for _ in range(20000)):
        transfer.step(us(at(minute)))
    assert len(transfer.pieces()[0]) < 2000


EDGES = [
    datetime(2024, 1, 5, 18, 0), datetime(2024, 1, 6, 10, 0), datetime(2024, 1, 7, 23, 59, 59),
    datetime(2024, 1, 8, 8, 14, 59), datetime(2024, 1, 8, 17, 58), datetime(2024, 1, 8, 17, 57),
    datetime(2024, 1, 8, 17, 59, 59, 999999), datetime(2024, 1, 9, 12, 0),
]


def test_business_base(spark):
    df = spark.createDataFrame([(e,) for e in EDGES], "t timestamp_ntz")
    rows = df.select("t", s.from_micros(s.business_base(s.micros(F.col("t")))).alias("b")).collect()
    assert all(row.b == base_of(row.t) for row in rows)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_assign_slots(spark, partitions):
    rng = random.Random(partitions)
    rows = []
    for number in range(3000):
        queue = "hot" if number % 3 else rng.choice(["a", "b", "c", "", None])
        rows.append((number, queue, at(rng.randrange(0, 60 * 24 * 9)), rng.choice([None, 2**60 + number]), [number]))
    schema = "id long, q string, t timestamp_ntz, big long, items array<int>"
    df = spark.createDataFrame(rows, schema)
    out = s.assign_slots(df, F.col("q"), "t", ["t", "id"], partitions=partitions)
    got = {row.id: row for row in out.collect()}
    assert len(got) == len(rows)
    for queue in {row[1] for row in rows}:
        chain = sorted((row for row in rows if row[1] == queue), key=lambda row: (row[2], row[0]))
        for row, slot in zip(chain, fold([row[2] for row in chain])):
            assert got[row[0]].slot == slot
            assert got[row[0]].slot >= row[2]
            assert got[row[0]].big == row[3] and got[row[0]]["items"] == row[4]


def test_one_queue_with_one_moment(spark):
    rows = [(number, at(600)) for number in range(1500)]
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz")
    out = s.assign_slots(df, None, "t", ["t", "id"], partitions=6).orderBy("id").collect()
    assert [row.slot for row in out] == fold([row[1] for row in rows])


def test_carry_continues_queues(spark):
    rng = random.Random(5)
    rows = [(n, rng.choice("xyz"), at(rng.randrange(0, 9000))) for n in range(900)]
    chain = sorted(rows, key=lambda row: (row[2], row[0]))
    first, second = (spark.createDataFrame(part, "id long, q string, t timestamp_ntz") for part in (chain[:500], chain[500:]))
    one = s.assign_slots(first, F.col("q"), "t", ["t", "id"], partitions=4)
    two = s.assign_slots(second, F.col("q"), "t", ["t", "id"], carry=s.last_slots(one, "q", ["t", "id"]), partitions=4)
    got = {row.id: row.slot for row in one.unionByName(two).collect()}
    for queue in "xyz":
        mine = [row for row in chain if row[1] == queue]
        assert [got[row[0]] for row in mine] == fold([row[2] for row in mine])


def test_fresh_or_now(spark):
    now = datetime(2026, 3, 10, 12, 0)
    rows = [(1, None), (2, datetime(2026, 3, 5, 11, 59)), (3, datetime(2026, 3, 5, 12, 0)), (4, datetime(2026, 3, 9))]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz")
    got = [r.f for r in df.orderBy("id").select(s.fresh_or_now(F.col("t"), F.lit(now).cast("timestamp_ntz")).alias("f")).collect()]
    assert got == [now, now, datetime(2026, 3, 5, 12, 0), datetime(2026, 3, 9)]
