"""Cases in which something could be lost, cut wrongly or mixed up."""

import random

import compare
import pytest
from pyspark.sql import functions as F

from claimflow.llm import decontaminate, jaccard_join, licenses, mixing, paragraphs, quotations, toxicity


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 6))) for _ in range(n))


def test_texts_of_one_id_are_cut_apart(spark):
    rng = random.Random(5)
    passage, other = prose(rng, 60), prose(rng, 80)
    docs = spark.createDataFrame([(1, passage), (2, f"{passage} and three more"), (2, other), (2, other)], "doc_id bigint, text string")
    left = sorted((row.doc_id, row.text) for row in paragraphs.remove_repeated(docs).collect())
    assert (1, passage) in left and left.count((2, other)) == 2 and len(left) <= 4
    assert all(passage not in text for doc, text in left if doc == 2)


def test_texts_of_one_id_are_judged_apart(spark):
    rng = random.Random(6)
    passage, other = prose(rng, 60), prose(rng, 80)
    rows = [(1, passage, "x"), (2, f"{passage} more", "y"), (2, other, "y"), (2, other, "y"), (3, passage, "z"), (4, other, "w"), (5, None, "n"), (5, "", "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for parts in (1, 4):
        kept = [(row.doc_id, row.text) for row in jaccard_join.keep_one(docs.repartition(parts)).collect()]
        texts = [text for _, text in kept]
        assert texts.count(other) == 1 and sum(bool(text) and text.startswith(passage) for text in texts) == 1
        assert (5, None) in kept and (5, "") in kept and len(kept) == 4


def test_items_of_few_literals_and_few_words(spark):
    rng = random.Random(7)
    items = {1: "Add 5 7 9 11 13 15 17 and 19 21 23 25 27 to get 4 8 16 32", 2: "What is six times seven?", 3: "Paris", 4: "1 2 3 4 5 6 7 8"}
    docs = {10 + i: f"{prose(rng, 20)}. {text} {prose(rng, 20)}" for i, text in items.items()}
    docs |= {20: "Add 6 7 9 11 13 15 17 and 19 22 23 25 28 to get 4 8 17 32", 21: "What is nine times seven?", 22: "1 2 3 4 9 6 7 8", 23: prose(rng, 60)}
    found = decontaminate.contaminated(
        spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), spark.createDataFrame(list(items.items()), "item_id bigint, text string"))
    assert {(int(row.key), row.item_id) for row in found.collect()} == {(10 + i, i) for i in items}


@pytest.mark.parametrize("size", [6, 7, 12, 40])
def test_every_verbatim_item_is_found(spark, size):
    rng = random.Random(size)
    pool = ["Anna", "Tom", "5", "12", "seven", "km", "3.", "and", "the", "apples", "give", "to", "Boston.", "kg", "how", "many"]
    items = [(i, " ".join(rng.choice(pool) for _ in range(size))) for i in range(60)]
    docs = [(i, f"{prose(rng, rng.randint(0, 30))}{rng.choice([' ', '. ', chr(10), ''])} {text} {prose(rng, 5)}") for i, text in items]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(i, i) for i, _ in items} <= {(int(row.key), row.item_id) for row in found.collect()}


def test_templates_of_any_length(spark):
    rng = random.Random(9)
    known = [("Long", prose(rng, 300)), ("Longer", prose(rng, 1500)), ("Five", "one two three four five")]
    texts = [(i, f"{prose(rng, 40)} {text.upper()} {prose(rng, 40)}") for i, (_, text) in enumerate(known)]
    found = licenses.scan(spark.createDataFrame(texts, "doc_id bigint, text string"), licenses.templates_table(spark, known))
    assert {(row.doc_id, row.license) for row in found.collect()} == {(0, "Long"), (1, "Longer"), (2, "Five")}
    with pytest.raises(ValueError, match="fewer than"):
        licenses.templates_table(spark, [("Short", "only four words here")])


def test_capped_source_has_no_order(spark):
    """A source whose target is its cap is taken whole twice, and none of it goes through the window."""
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), "abc"[(i > 500) + (i > 560)]) for i in range(600)], "doc_id bigint, text string, source string")
    plan = mixing.mix_sources(docs, weights=(1, 30, 1))
    capped = {row.source for row in plan.groupBy("source").agg(F.sum("taken").alias("t"), F.max("source_size").alias("s")).collect() if row.t == 2 * row.s}
    assert "b" in capped
    text = plan._jdf.queryExecution().analyzed().toString()
    ranked, _, other = text.partition("Filter isnull(rank")
    assert "Filter isnotnull(rank" in ranked and "bucket" in ranked and "Window" not in other.split("Relation")[0].split("Aggregate")[0]


def test_planted_quotes(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for conv in range(40):
        said = []
        for turn in range(rng.randint(2, 9)):
            lines = [prose(rng, rng.randint(2, 8)) for _ in range(rng.randint(1, 3))]
            if said and rng.random() < 0.8:
                quoted = rng.choice(said)
                lines = [f"{rng.choice(['> ', '>', '>  '])}{line}" for line in quoted.split("\n")] + lines
            said.append("\n".join(lines))
            rows.append((conv, turn, rng.choice(["user", "assistant"]), said[-1]))
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = quotations.query(spark, str(tmp_path))
    assert compare.differences(found, con, quotations.SQL) == []
    assert sum(">" in row[3] for row in rows) > 80


def test_held_out_toxic_labels_are_not_learned(spark):
    small = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted((row.doc_id, row.score) for row in toxicity.score(docs, toxicity.fit(docs, given)).select("doc_id", "score").collect()) for given in (labels, turned)]
    assert scores[0] == scores[1]
