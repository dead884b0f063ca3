"""Divergence audit against all pairs in plain Python, and against the SQL."""

import random
import re
from collections import Counter, defaultdict

import compare
import pytest
from pyspark.sql import functions as F

from claimflow.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string"


def plain(rows, least, top):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for _, text, lang, source in rows]
    frequency, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        frequency[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in frequency[lang].items() if n >= least]
        sources = sorted({s for l, s, _ in docs if l == lang}, key=lambda s: s.encode())

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(own[s][t] - own[o][t]) for t in kept), o) for o in sources if o != s]
            over = [(own[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", over, top)):
                ranked = sorted(items, key=lambda i: (-i[0], i[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def corpus(seed, docs, sources, words):
    rng = random.Random(seed)
    names = [f"S{i}" for i in range(sources)] + [None, "é"]
    terms = ["".join(rng.choices("abcXYZéß", k=rng.randint(1, 4))) for _ in range(words)]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(terms) + rng.choice([" ", "_", "1", ".\n", "[", "\x7f", "  "]) for _ in range(rng.randint(0, 60)))
        rows.append((i % 50, text, rng.choice(["en", "de", None]), names[min(int(rng.expovariate(0.3)), len(names) - 1)]))
    return rows + [(1, None, "en", "no words"), (2, "", "xx", "alone"), (3, "12 34", "yy", "a"), (3, "12 34", "yy", "b"), (None, None, None, None)] + rows[:5] * 2


@pytest.mark.parametrize("seed, docs, sources, words", [(1, 300, 5, 40), (2, 400, 30, 25), (3, 200, 3, 400), (4, 0, 0, 1)])
def test_brute_force(spark, monkeypatch, seed, docs, sources, words):
    # several blocks, several slices, counts passed on early
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", 100)
    monkeypatch.setattr(divergence, "ROW_PLACES", 50)
    monkeypatch.setattr(divergence, "HELD_COUNTS", 20)
    rows = corpus(seed, docs, sources, words)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for extra in ("term", "count", "docs", "whole", "no", "p", "q", "group", "block", "rank"):
        df = df.withColumn(extra, F.lit("kept"))
    for least, top in ((10, 5), (1, 50)):
        assert sorted(tuple(r) for r in divergence.audit(df, least, top).collect()) == plain(rows, least, top)


def test_large_counts(spark):
    """Shares stay exact where the counts times a billion go beyond 64 bits."""
    df = spark.createDataFrame([(40_000_000_000, 90_000_000_000, 7)], "count bigint, total bigint, terms bigint")
    found = df.select(divergence.share(F.col("count"), F.col("total"), F.col("terms")).alias("p")).first().p
    assert found == 1 + 10**9 * 40_000_000_005 // (90_000_000_000 + 35)


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert compare.differences(divergence.query(spark, sf), compare.connect(sf), divergence.SQL) == []
