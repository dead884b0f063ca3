"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Every source gets a target of words: its share by weight of ``share`` times all words, at most
``max_copies`` times its own size, the excess going to the other sources by weight. A document's
expected copies are the target over the source's size, scaled by its importance if there is
one. Whole copies are certain. What is left of the target goes to documents in the order of
(random odds) / (inclusion odds), until their words reach it.

The running sum along that order is split in two: sums of a fixed number of rank buckets per
source, and a running sum inside each bucket. No source meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.scratch import save

WORD = r"[^\x20\x09-\x0D]+"
#: Rank buckets per source.
BUCKETS = 4096


def uniform(key: Column, seed: str = "") -> Column:
    """A number in (0, 1) that depends on the key alone: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") + F.lit(0.5)) / F.lit(2.0**52)


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, max_copies: float) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    Sources take the weights in turn, by code point, NULL last. A source is full once the
    words per weight that remain for it and all later ones, in the order of capacity per
    weight, reach its own capacity per weight. The table has one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(max_copies))
    ranked = totals.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    )
    filled = ranked.withColumn("level", level).withColumn("full", F.col("level") >= F.col("ratio"))
    rest = F.min(F.when(~F.col("full"), F.struct("ratio", "level"))).over(everything)["level"]
    return filled.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * rest).alias("target"))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_copies: int = 2,
    importance: Column | None = None, seed: str = "",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken = copies * size.

    docs has doc_id, text and source; other columns are ignored, whatever their names.
    ``importance`` (a positive Column over docs) makes copies proportional to it within a source;
    without it all documents of a source are alike. The words taken from a source differ from its
    target by at most half of the document at the boundary, as long as no importance pushes
    documents to ``max_copies``. Equal input gives equal output.

    NULL or empty texts have size 0 and take nothing. NULL sources form one source. A repeated row
    counts as often as it occurs; rows with equal doc_id are ranked by size. An empty table gives
    an empty table, a source without words a target of 0.
    """
    weight = F.lit(1.0) if importance is None else F.coalesce(importance.cast("double"), F.lit(0.0))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    sized = save(docs.select("doc_id", "source", size.alias("size"), weight.alias("weight")), "sized")
    targets = source_targets(sized.select("source", "size"), weights, share, max_copies)
    mean = sized.groupBy("source").agg((F.sum(F.col("weight") * F.col("size")) / F.sum("size")).alias("mean"))
    per_source = targets.alias("t").join(mean.alias("m"), F.col("t.source").eqNullSafe(F.col("m.source"))).select("t.*", "m.mean")
    expected = F.least(
        F.lit(float(max_copies)),
        F.when((F.col("source_size") > 0) & (F.col("mean") > 0), F.col("target") / F.col("source_size") * (F.col("weight") / F.col("mean"))).otherwise(0.0),
    )
    odds = F.col("part") / (1 - F.col("part"))
    draw = F.col("u") / (1 - F.col("u"))
    usual = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    usual = F.greatest(F.least(usual - F.floor(usual), F.lit(1 - 1e-9)), F.lit(1e-9))
    spread = F.col("rank") * usual / (1 - usual)
    ranked = (
        sized.alias("d").join(per_source.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.*", "s.source_size", "s.target", "s.mean")
        .withColumn("expected", expected)
        .withColumn("whole", F.floor("expected"))
        .withColumn("part", F.col("expected") - F.col("whole"))
        .withColumn("u", uniform(F.col("doc_id"), seed))
        .withColumn("rank", F.when(F.col("part") > 0, draw / odds))
        .withColumn("bucket", F.least(F.floor(F.coalesce(spread / (1 + spread), F.lit(1.0)) * BUCKETS), F.lit(BUCKETS)).cast("int"))
    )
    # per bucket: words of the documents in rank order, and the certain words of all
    sums = ranked.groupBy("source", "bucket").agg(
        F.sum(F.when(F.col("rank").isNotNull(), F.col("size")).otherwise(0)).alias("words"),
        F.sum(F.col("whole") * F.col("size")).alias("certain"),
    )
    source = Window.partitionBy("source")
    sums = sums.select(
        "source", "bucket",
        F.coalesce(F.sum("words").over(source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("certain").over(source).alias("certain"),
    )
    inside = Window.partitionBy("source", "bucket").orderBy("rank", "u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    # documents without a rank need no order
    listed = ranked.filter("rank IS NOT NULL").withColumn("earlier", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    listed = listed.union(ranked.filter("rank IS NULL").withColumn("earlier", F.lit(0).cast("bigint")))
    middle = F.col("before") + F.col("earlier") + F.col("size") / 2
    more = F.col("rank").isNotNull() & (middle <= F.col("target") - F.col("certain"))
    return (
        listed.alias("l").join(sums.alias("b"), F.col("l.source").eqNullSafe(F.col("b.source")) & (F.col("l.bucket") == F.col("b.bucket")))
        .select("l.*", "b.before", "b.certain")
        .withColumn("copies", F.col("whole") + F.when(more, 1).otherwise(0))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def repeat_copies(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents of a mix, each as often as the plan of ``mix_sources`` says. doc_id must be unique."""
    copies = plan.filter("copies > 0").select("doc_id", "copies")
    return docs.join(copies, "doc_id").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


#: The same mix, with one running sum per source.
SQL = r"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM totals),
ranked AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio FROM weighed),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ranked WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, level >= ratio AS full_ FROM levels),
targets AS MATERIALIZED (
  SELECT source, source_size, CASE WHEN full_ THEN cap
    ELSE weight * (SELECT level FROM filled WHERE NOT full_ ORDER BY ratio, level LIMIT 1) END AS target FROM filled),
expected AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN least(2.0::DOUBLE, t.target / t.source_size) ELSE 0 END AS copies,
    substr(md5(coalesce(d.doc_id::VARCHAR, 'null')), 1, 13) AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
ordered AS (
  SELECT *, floor(copies)::BIGINT AS whole, coalesce(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM expected)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN copies > whole
  AND earlier + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken FROM ordered
"""
