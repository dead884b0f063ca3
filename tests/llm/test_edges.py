"""Every operator on NULLs, empty and long texts, repeated rows, empty tables and columns with its own helpers' names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimflow.llm import decontaminate, jaccard_join, licenses, mixing, paragraphs, quality, quotations, toxicity, url_rules, vectors

TEXT = " ".join(f"word{i}" for i in range(60))
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ROWS = [
    (1, TEXT, "en", "a", 1), (2, TEXT, None, None, None), (2, TEXT, None, None, None), (3, None, "en", "a", 0), (4, "", "en", "b", 0),
    (5, " \n\t ", "en", "b", 4), (None, TEXT, "en", "b", 9), (None, None, None, None, None), (6, "Idiot you " * 30_000, "en", "a", 300_000),
    (7, "one two", "en", "c", 7), (8, "ONE  two", "en", "c", 8), (9, "x" * 200_000, "en", "c", 200_000),
]
CLASHES = ["n", "m", "node", "token", "tokens", "score", "size", "key", "row", "group", "features", "raw", "prediction", "probability", "spans",
           "left_text", "quality_score", "component", "label", "order", "all", "target", "item_id", "start", "value"]


def clashing(df):
    return df.select("*", *[F.lit("kept").alias(name) for name in CLASHES if name not in df.columns])


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ROWS, DOCS)).cache()


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 0, 1), (7, 1, None), (None, 1, 1), (9, None, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return clashing(spark.createDataFrame([(1, " ".join(TEXT.split()[10:30])), (2, None), (3, ""), (None, "too short")], "item_id bigint, text string"))


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_jaccard_join(docs, none):
    found = rows(jaccard_join.jaccard_groups(docs))
    expected = [(1, 57, 1), (2, 57, 1), (2, 57, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (None, 57, None), (None, 0, None), (6, 2, 6), (7, 1, 7), (8, 1, 7), (9, 1, 9)]
    # the last words of the long text make a third shingle, as it ends in a space only
    assert found == sorted(expected, key=str)
    assert rows(jaccard_join.jaccard_groups(none)) == []


def test_keep_one(docs, none):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(row.doc_id) for row in kept.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 7, 9, None, None]))
    assert jaccard_join.keep_one(none).count() == 0


def test_quotations(spark):
    given = spark.createDataFrame(
        [(1, 0, "a", "Hello  there"), (1, 1, "b", "> hello there\nfine"), (1, 1, "b", "> hello there\nfine"), (1, 2, None, None), (None, 0, "a", "> Hello there\nq"),
         (1, None, "a", ""), (2, 0, "a", "> " + "long " * 50_000 + "\nend")], "conv_id bigint, turn bigint, role string, text string")
    found = {(row.conv_id, row.position): (row.turn, row.text, row.reply_to, row.quotes) for row in quotations.reply_order(clashing(given)).collect()}
    assert found == {
        (1, 0): (None, "", None, 0), (1, 1): (0, "Hello  there", None, 0), (1, 2): (1, "fine", 0, 1), (1, 3): (1, "fine", 0, 1), (1, 4): (2, None, None, 0),
        (None, 0): (0, "q", None, 1), (2, 0): (0, "end", None, 1),
    }
    assert quotations.reply_order(given.limit(0)).count() == 0


def test_paragraphs(docs, none):
    assert rows(paragraphs.repeated_passages(docs).drop("copy")) == [(2, 0, 60, 1)]
    left = paragraphs.remove_repeated(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    assert sorted(str(row.doc_id) for row in left.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 7, 8, 9, None, None]))
    assert left.filter("doc_id IS NOT NULL AND spans <> 'kept'").count() == 0
    assert paragraphs.remove_repeated(none).count() == 0


def test_decontaminate(docs, none, benchmark):
    found = sorted((row.key[:5], row.item_id, row.windows, row.of) for row in decontaminate.contaminated(docs, benchmark).collect())
    assert found == [("1", 1, 15, 15), ("2", 1, 15, 15), ("text ", 1, 15, 15)]
    left = decontaminate.remove_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(str(row.doc_id) for row in left.collect()) == sorted(map(str, [3, 4, 5, 6, 7, 8, 9, None]))
    assert decontaminate.contaminated(none, benchmark).count() == 0
    assert decontaminate.remove_contaminated(docs, benchmark.limit(0)).count() == len(ROWS)


def test_toxicity(docs, none, labels):
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model)
    assert scored.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert all(0 <= row.score <= 1 for row in scored.collect()) and scored.count() == len(ROWS)
    assert toxicity.score(none, model).count() == 0
    untrained = toxicity.fit(none, labels.limit(0))
    assert {row.score for row in toxicity.score(docs, untrained).collect()} == {0.5}


def test_quality(docs, none, labels):
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model)
    assert scored.columns == [c for c in docs.columns if c != "score"] + ["score"]
    values = [(row.text, row.score) for row in scored.collect()]
    assert len(values) == len(ROWS) and all(0 <= score <= 1 for _, score in values)
    assert len({score for text, score in values if not (text or "").strip()}) == 1
    assert quality.reject_low_quality(docs, labels).columns == docs.columns
    assert quality.score(none, quality.fit(none, labels.limit(0))).count() == 0


def test_licenses(spark, docs, none):
    known = licenses.templates_table(spark)
    some = spark.createDataFrame([(1, "Released under the MIT license!"), (1, "Released under the MIT license!"), (None, "x\nLicensed under CC BY-NC 4.0."),
                                  (2, "Released under MIT"), (3, None), (4, "")], "doc_id bigint, text string")
    found = licenses.scan(clashing(some), known)
    assert [row[:3] for row in rows(found)] == [(1, "MIT", 1.0), (1, "MIT", 1.0), (None, "CC-BY-NC-4.0", 1.0)]
    assert licenses.scan(none, known).count() == 0
    assert licenses.scan(docs, known.limit(0)).count() == 0


def test_urls(spark):
    rules = url_rules.rules_table(spark)
    pages = spark.createDataFrame([
        (1, "http://A.Example.ORG/en/12?x"), (2, "https://example.org/es"), (3, "https://example.org"), (4, None), (5, "no scheme/org/"), (None, "http://b.com/de/x#y"),
        (6, "http://notexample.org/es/"), (6, "http://notexample.org/es/"), (7, "://org/"), (8, "http:///com/de/"), (9, "http://com/fr/" + "z" * 100_000),
    ], "page_id bigint, url string")
    found = {(row.page_id, row.rule, row.verdict) for row in url_rules.judge(clashing(pages), rules).collect()}
    assert found == {(1, "example.org/en/1", "block"), (2, "org/", "allow"), (3, None, "allow"), (4, None, "allow"), (5, None, "allow"), (None, "com/de/", "block"),
                     (6, "org/", "allow"), (7, "org/", "allow"), (8, None, "allow"), (9, "com/fr/", "allow")}
    assert url_rules.judge(pages, rules).count() == 11
    assert url_rules.judge(pages.limit(0), rules).count() == 0
    assert {row.verdict for row in url_rules.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_vectors(spark):
    given = spark.createDataFrame([
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, [float("nan"), 1.0, 0.0]), (6, [1.0, None, 0.0]),
        (7, []), (8, [float("inf"), 0.0, 0.0]), (None, [1.0, 0.1, 0.0]), (9, [1.0, 0.0]), (10, [0.0, 1e300, 0.0]), (11, [0.0, 1e-300, 0.0]),
    ], "vec_id bigint, embedding array<double>")
    found = rows(vectors.near_duplicates(clashing(given)).select("vec_id", "n_links", "component_id", "kept"))
    assert found == sorted([
        (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True),
        (None, 3, 1, False), (9, 0, 9, True), (10, 1, 10, True), (11, 1, 10, False)], key=str)
    assert vectors.near_duplicates(given.limit(0)).count() == 0
    assert vectors.near_duplicates(given.filter("vec_id = 4")).count() == 1


def test_mixing(docs, none):
    found = mixing.mix_sources(docs)
    by_source = {row.source: row for row in found.groupBy("source").agg(
        F.max("source_size").alias("size"), F.max("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    assert {s: row.size for s, row in by_source.items()} == {"a": 60_060, "b": 60, "c": 5, None: 120}
    assert by_source["b"].target == 120 and by_source["b"].taken == 120
    assert all(row.taken <= 2 * row["size"] and row["size"] >= 0 for row in found.collect())
    assert found.count() == len(ROWS) and mixing.mix_sources(none).count() == 0


def test_stages(spark, docs, none, tmp_path, labels, benchmark):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        nothing = stage(spark, none, str(tmp_path))
        assert nothing.columns == docs.columns and nothing.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(ROWS)
    assert corpus_pipeline.STAGES[-1][1](spark, none, str(tmp_path)).count() == 0
