"""Operators against SQL, brute force and held-out labels."""

import random
import re
from collections import defaultdict
from itertools import combinations

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from claimflow.llm import decontaminate, jaccard_join, mixing, paragraphs, quality, queries, toxicity, vectors

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
compare.KINDS["boolean"] = "BOOLEAN"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(nodes, edges):
    name = {n: n for n in nodes}

    def find(n):
        while name[n] != n:
            n = name[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        name[b] = a
    return {n: find(n) for n in nodes}


def jaccard_components(texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    by_shingle = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            by_shingle[g].add(i)
    pairs = {p for ids in by_shingle.values() for p in combinations(sorted(ids), 2)}
    return components(texts, [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])])


def prose(rng, n):
    return ["".join(rng.choices("abcdefgh", k=rng.randint(3, 6))) for _ in range(n)]


def test_registered():
    assert set(queries.ORACLES) <= set(queries.QUERIES) <= set(entry.queries())
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES} == set(range(1, 14))
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", queries.ORACLES)
def test_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SMALL), compare.connect(SMALL), queries.ORACLES[name]) == []


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_jaccard_join(spark, k, percent):
    rng = random.Random(k)
    texts = []
    for size in (3, 5, 8, 12, 15, 18, 21, 24, 30, 45, 90, 200, 400):
        base = prose(rng, size)
        for edits in [0] * 3 + [1] * 14 + [2] * 14 + [3] * 8 + [6] * 4:
            copy = list(base)
            for _ in range(edits if size > 12 else min(edits, 1)):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], ["new"], prose(rng, 1), copy[at:at + 1] + prose(rng, 1)])
            texts.append(" ".join(copy[rng.choice([0, 0, 0, 1]):]))
        texts.append(" ".join(base[:len(base) // 2] + prose(rng, size)))
    given = dict(enumerate(texts))
    docs = spark.createDataFrame(list(given.items()), "doc_id bigint, text string").repartition(3)
    found = jaccard_join.jaccard_groups(docs, k, percent).collect()
    expected = jaccard_components(given, k, percent)
    assert {row.doc_id: row.component_id for row in found} == expected
    assert {row.doc_id: row.n_shingles for row in found} == {i: len(shingles(t, k)) for i, t in given.items()}
    assert len(set(expected.values())) < 0.8 * len(given)


def test_paragraphs(spark):
    rng = random.Random(3)
    clean = {i: " ".join(prose(rng, 150)) + "\nA short line that all of them share.\n" + " ".join(prose(rng, 80)) for i in range(30)}
    passages = [prose(rng, n) for n in (55, 60, 75, 120)]
    held = {}
    for i in range(30, 60):
        before, passage, after = prose(rng, rng.randint(5, 90)), passages[i % 4], prose(rng, rng.randint(5, 90))
        held[i] = " ".join(before + passage + after)
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in {**clean, **held}.items()], "doc_id bigint, text string, n_chars bigint").repartition(4)
    left = {row.doc_id: row for row in paragraphs.remove_repeated(docs).collect()}
    assert all(left[i].text == text and left[i].n_chars == len(text) for i, text in clean.items())
    assert all(row.n_chars == len(row.text) for row in left.values())
    for number, passage in enumerate(passages):
        text = " ".join(passage)
        assert [i for i in held if text in left[i].text] == [30 + (number - 30) % 4]
    for i, text in held.items():
        passage = set(passages[i % 4])
        others = [w for w in text.split() if w not in passage]
        # a piece at the edge goes as a whole if it is similar enough
        assert len(others) - 3 <= len([w for w in left[i].text.split() if w not in passage]) <= len(others)


def test_similar_paragraphs(spark):
    rng = random.Random(12)
    lines, held = {}, {}
    for size, edits in ((30, 0), (60, 1), (100, 1), (100, 2), (150, 2), (200, 3), (300, 5), (300, 6)) * 4:
        base = prose(rng, size)
        for number in range(4):
            copy = list(base)
            for at in rng.sample(range(size), edits if number else 0):
                copy[at:at + 1] = rng.choice([[], prose(rng, 1), prose(rng, 2)])
            i = len(lines)
            lines[i] = " ".join(copy)
            held[i] = "\n".join([" ".join(prose(rng, rng.randint(5, 60))), lines[i], " ".join(prose(rng, rng.randint(5, 60)))])
    docs = spark.createDataFrame(list(held.items()), "doc_id bigint, text string").repartition(4)
    left = {row.doc_id: row.text for row in paragraphs.remove_repeated(docs).collect()}
    expected = jaccard_components(lines, 5, 80)
    gone = {i for i in lines if expected[i] != i}
    whole = {i for i, line in lines.items() if left[i].split() == held[i].replace(line, "").split()}
    # the bands find 95 % of the pairs at the limit on average
    assert whole <= gone and len(whole) >= 0.9 * len(gone) and len(gone) > 60
    assert all(lines[i] in left[i] for i in lines if i in set(expected.values()) and list(expected.values()).count(i) > 1)


def test_bands():
    for rows in (1, 2, 3, 4):
        b = paragraphs.bands(rows)
        assert 1 - (1 - 0.8**rows) ** b >= 0.95 > 1 - (1 - 0.8**rows) ** (b - 1)


def test_decontaminate(spark):
    item = "A train leaves Boston at 40 km per hour and Maria waits for 3 hours before the second train follows at 60 km per hour, so when does Maria arrive?"
    changed = item.replace("Boston", "Denver").replace("40", "70").replace("60", "95").replace("3 hours", "seven hours").replace("Maria", "Susan")
    mixed = changed.replace("does Susan", "does Peter").replace("and Susan", "and Laura").replace("95 km", "95 miles")
    docs = spark.createDataFrame([
        (1, f"some words before {item} and after"), (2, f"Other text here.\n{changed}\nMore text."), (3, " ".join(item.split()[:8]) + " nothing else of it follows here"),
        (4, "a wholly different text about other things in other places"), (5, mixed.replace("Boston", "x")),
    ], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    found = {row.key: row for row in decontaminate.contaminated(docs, benchmark, consistent=1.0).collect()}
    assert set(found) == {"1", "2"}
    assert found["2"].slots >= 4
    assert {row.doc_id for row in decontaminate.remove_contaminated(docs, benchmark).collect()} >= {3, 4}


def test_decontaminate_several_occurrences(spark):
    item = "A train leaves Boston at 40 km per hour and Maria waits for 3 hours before the second train follows at 60 km per hour, so when does Maria arrive?"
    one = item.replace("Boston", "Denver").replace("40", "70").replace("60", "95").replace("3 hours", "7 hours").replace("Maria", "Susan")
    two = item.replace("Boston", "Lima").replace("40", "31").replace("60", "88").replace("3 hours", "2 hours").replace("Maria", "Peter")
    longer = two.replace("Lima", "Santa Cruz").replace("the second train", "the very second train")
    mixed = one.replace("does Susan", "does Peter").replace("and Susan", "and Laura").replace("95 km", "96 miles").replace("70", "x")
    other = two.replace("does Peter", "does Laura").replace("and Peter", "and Mary").replace("31", "x")
    docs = spark.createDataFrame([
        (1, f"1) {one}\n2) {two}"), (2, f"{item} {one}"), (3, "\n".join([one, two, item, two, one])), (4, f"{one}\n{longer}\n{mixed}"),
        (5, f"{mixed}\n{other}"), (6, f"see {one}"), (6, f"see {two}"), (7, f"{longer} {longer.replace('Peter', 'Laura')}"),
    ], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    found = {row.key: row for row in decontaminate.contaminated(docs, benchmark, consistent=1.0).collect()}
    assert set(found) == {"1", "2", "3", "4", "6", "7"}
    assert all(row.consistent == 1 for row in found.values()) and found["3"].share == 1
    # an item whose sentences are alike meets itself at several places
    alike = "Tom gave 5 red apples and 3 green pears to Ann, then Ben gave 4 red apples and 2 green pears to Eve, then Max gave 9 red apples and 8 green pears to Zoe."
    docs = spark.createDataFrame([(1, f"x\n{alike}")], "doc_id bigint, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame([(1, alike)], "item_id bigint, text string")).collect()
    assert [(row.share, row.consistent) for row in found] == [(1.0, 1.0)]


def test_decontaminate_names_that_begin_sentences(spark):
    item = "Tom has 5 apples in a basket. Anna gives him 3 more apples. Tom then eats 2 of them. How many apples are left in the basket?"
    changed = item.replace("Tom", "Ben").replace("Anna", "Lena").replace("5", "9").replace("3", "4").replace("2", "6")
    docs = spark.createDataFrame([
        (1, changed), (2, f"Here, {changed}"), (3, f"{item}\n{changed}"), (4, changed.replace("Ben then", "Max then")),
        (5, "How many people live here? Most of them have 2 cars. Anna says that there are more."),
    ], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    found = {row.key: row for row in decontaminate.contaminated(docs, benchmark, consistent=1.0).collect()}
    assert set(found) == {"1", "2", "3"}
    assert all(row.share == 1 and row.consistent == 1 for row in found.values())


def test_decontaminate_whole_tables(spark):
    con = compare.connect(MEDIUM)
    items = dict(con.sql("SELECT item_id, text FROM benchmark").fetchall())
    found = {(row.doc_id, row.item_id) for row in queries.QUERIES["op4_decontaminate"](spark, MEDIUM).collect()}
    runs = lambda text: {tuple(w[i:i + 6]) for w in [re.findall(r"[^\W_]+", (text or "").lower())] for i in range(len(w) - 5)}
    listed = {i: runs(text) for i, text in items.items()}
    expected = set()
    for doc_id, text in con.sql("SELECT doc_id, text FROM documents").fetchall():
        own = runs(text)
        expected |= {(doc_id, i) for i, wanted in listed.items() if wanted and len(own & wanted) >= 0.6 * len(wanted)}
    assert expected and found == expected


def test_classifiers_held_out(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    for name, label, threshold in (("op8_quality", "quality", 0.3), ("op5_toxicity", "toxic", 0.5)):
        scored = queries.QUERIES[name](spark, MEDIUM)
        assert scored.count() == 1000
        assert scored.filter((F.col("score") >= threshold).cast("int") != F.col("predicted")).count() == 0
        kept = scored.filter("held_out").join(labels, "doc_id").select((F.col(label) == F.col("predicted")).cast("double").alias("right"))
        assert kept.agg(F.avg("right")).first()[0] >= 0.95


def test_held_out_labels_are_not_learned(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = quality.fit(docs, labels), quality.fit(docs, turned)
    assert (one[0] == other[0]).all() and one[1] == other[1]


def test_lexicon_ignores_copies(spark):
    rng = random.Random(8)
    copied = " ".join(prose(rng, 40))
    rows = [(i, copied if i % 2 else " ".join(prose(rng, 20) + ["zzblorp"] + prose(rng, 20)), 1) for i in range(60)]
    rows += [(i, " ".join(prose(rng, 40)), 0) for i in range(60, 400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    (entry_, _), _, _, _ = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    known = set(entry_.tolist())
    assert set(toxicity._hashes("zzblorp").tolist()) <= known
    assert not any(set(toxicity._hashes(w).tolist()) <= known for w in copied.split()[:20])


def test_vectors(spark):
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24))
    x = np.concatenate([rng.normal(size=(400, 24)), *[c + rng.normal(size=(n, 24)) * s for c, n, s in zip(centres, rng.integers(2, 60, 40), rng.uniform(0.02, 0.4, 40))]])
    docs = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(3)
    found = {row.vec_id: row for row in vectors.near_duplicates(docs).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    got = sum(row.n_links for row in found.values())
    assert 0.99 * linked.sum() <= got <= linked.sum()
    assert all(row.n_links <= linked[i].sum() for i, row in found.items())
    expected = components(range(len(x)), zip(*np.nonzero(linked)))
    assert sum(found[i].component_id == expected[i] for i in found) >= 0.99 * len(x)


def test_mixing(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    plan = mixing.mix_sources(docs)
    for row in plan.groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("taken"), F.max("size").alias("most")).collect():
        assert abs(row.taken - row.t) <= row.most / 2 + 1
    longer = mixing.mix_sources(docs, share=0.5, importance=F.when(F.length("text") > 2000, 3.0).otherwise(1.0)).join(docs.select("doc_id", "text"), "doc_id")
    rate = {row.long: row.rate for row in longer.groupBy((F.length("text") > 2000).alias("long")).agg((F.sum("taken") / F.sum("size")).alias("rate")).collect()}
    assert 2 < rate[True] / rate[False] < 4
    repeated = mixing.repeat_copies(docs, plan)
    assert repeated.count() == plan.agg(F.sum("copies")).first()[0]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept, states = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, SMALL).collect(), docs.schema)
        states.append({row.doc_id: row.text for row in kept.collect()})
    good, single, cut, clean = states
    # one document of each group
    groups = jaccard_components(good, 5, 80)
    assert set(single) == set(groups.values())
    # no passage of 50 words in two documents
    seen = defaultdict(set)
    for i, text in cut.items():
        w = words(text)
        for j in range(len(w) - 49):
            seen[tuple(w[j:j + 50])].add(i)
    assert all(len(ids) == 1 for ids in seen.values())
    # no benchmark item, and nothing else went
    items = [" ".join(words(row.text)) for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    holding = {i for i, text in cut.items() if any(item in " ".join(words(text)) for item in items)}
    assert set(clean) == set(cut) - holding
    mix = {row.doc_id: row for row in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(mix) == set(clean) and all(mix[i].size == len(words(text)) for i, text in clean.items())
    assert {i: r.taken for i, r in mix.items()} == {r.doc_id: r.taken for r in mixing.mix_sources(kept).collect()}
