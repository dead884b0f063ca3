"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

A hash is the coordinate of largest size, with its sign, after three rounds of random signs and a
Hadamard transform; a table joins ``k`` of them. A vector is entered in its bucket of each
table and in those where one coordinate is the second largest. ``k`` grows with the logarithm of
the rows, so that buckets stay small; the number of tables follows from the recall wanted
at the threshold, measured on random pairs.

Vectors of one bucket are tied to its first vector if they are within half the threshold's
angle of it: all such vectors link with each other, without a comparison. These balls are then
compared by their centres and radii, and only where that leaves it open by vectors. All cosines
are taken in double precision.
"""

from __future__ import annotations

from math import acos, ceil, cos, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.components import components
from claimflow.llm.scratch import drop, save
from claimflow.llm.words import mix

THRESHOLD = 0.95
#: Share of the pairs at the threshold that hashing should find; closer pairs are found more often.
RECALL = 0.995
#: Angles closer to a limit than this are decided by the cosine of the pair.
_MARGIN = 1e-7


def _rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform of the rows of x (a power of 2 wide)."""
    width = x.shape[1]
    signs = 1.0 - 2.0 * (mix(np.arange(3 * width, dtype=np.uint64) + np.uint64(seed * 1_000_003 + 1)) & np.uint64(1)).astype(float)
    for turn in range(3):
        x = x * signs[turn * width:(turn + 1) * width]
        step = 1
        while step < width:
            x = x.reshape(len(x), -1, 2, step)
            x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), width)
            step *= 2
        x = x / np.sqrt(width)
    return x


def entries(x: np.ndarray, k: int, tables: int) -> np.ndarray:
    """(rows, tables * (1 + k)) bucket ids of unit vectors."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rows, out = np.arange(len(x)), []
    for table in range(tables):
        best, second = [], []
        for i in range(k):
            y = _rotate(x, table * k + i)
            size = np.abs(y)
            one = size.argmax(axis=1)
            size[rows, one] = -1
            two = size.argmax(axis=1)
            best.append(2 * one + (y[rows, one] < 0))
            second.append(2 * two + (y[rows, two] < 0))
        for changed in range(-1, k):
            bucket = np.full(len(x), table * 64 + width, np.uint64)
            for i in range(k):
                bucket = mix(bucket + (second[i] if i == changed else best[i]).astype(np.uint64))
            out.append(bucket)
    return np.stack(out, axis=1).view(np.int64)


def plan(n: int, width: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(hashes per table, tables): buckets of about one vector, and the recall at the threshold."""
    k = max(2, ceil(log(max(n, 2)) / log(2 * max(width, 2))))
    random = np.random.default_rng(5)
    a = random.normal(size=(1000, max(width, 2)))
    b = random.normal(size=a.shape)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = threshold * a + np.sqrt(1 - threshold**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    trial = 4
    x, y = entries(a, k, trial).reshape(1000 * trial, -1), entries(b, k, trial).reshape(1000 * trial, -1)
    met = (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean()
    return k, ceil(log(1 - recall) / log(1 - min(max(met, 1e-3), 0.999)))


def _hashed(k: int, tables: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                vectors = part.column("x").to_pylist()
                found = [None] * len(vectors)
                for width in {len(v) for v in vectors}:
                    rows = [i for i, v in enumerate(vectors) if len(v) == width]
                    x = np.array([vectors[i] for i in rows], float)
                    for i, buckets in zip(rows, entries(x / np.linalg.norm(x, axis=1, keepdims=True), k, tables)):
                        found[i] = np.unique(buckets)
                yield pa.RecordBatch.from_pydict({"node": part.column("node"), "buckets": pa.array(found, pa.list_(pa.int64()))})

    return run


def _cosine(x: str, y: str) -> Column:
    """Of two unit vectors. Rounding may leave it just above 1."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)


def _angle(cosine: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept (vec_id = component_id).

    vectors has vec_id and embedding (an array of floats or doubles); other columns are ignored.
    A component is named by the smallest vec_id that links reach. Vectors that are NULL, empty or
    zero, or hold a NULL or a value that is not finite, link with nothing; vectors of different
    lengths don't link. Repeated rows are vectors of their own and link with each other. A row
    without vec_id counts as a link of others; its own component is NULL if no id is reached,
    and it is not kept. An empty table gives an empty table.
    """
    given = save(vectors.select(F.monotonically_increasing_id().alias("node"), "vec_id", F.col("embedding").cast("array<double>").alias("v")), "vectors")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    largest = F.array_max(F.transform("v", lambda c: F.abs(c)))  # scaled first, so that squares don't overflow
    scaled = given.filter(finite & (F.size("v") > 0) & (largest > 0)).select("node", F.transform("v", lambda c: c / largest).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, c: total + c * c))
    unit = save(scaled.withColumn("norm", norm).select("node", F.transform("v", lambda c: c / F.col("norm")).alias("x")), "unit")
    widths = unit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count")).first()
    k, tables = plan(widths["count"], widths["width"], threshold, recall) if widths else (2, 1)
    listed = unit.mapInArrow(_hashed(k, tables), "node bigint, buckets array<bigint>").select("node", F.explode("buckets").alias("bucket"))
    listed = save(listed, "listed")
    # buckets of one vector end here; counted before the shuffle, then joined
    shared = listed.join(listed.groupBy("bucket").count().filter("count > 1").select("bucket"), "bucket", "left_semi")
    shared = save(shared.select("node", "bucket"), "buckets")
    drop(listed)
    balls = _balls(unit, shared, threshold)
    counts, ties = _between(unit, shared, balls, threshold)
    sizes = save(balls.groupBy("ball").agg((F.count("*") - 1).alias("others")), "sizes")
    links = balls.join(sizes, "ball").select("node", F.col("others").alias("n")).union(counts).groupBy("node").agg(F.sum("n").alias("n_links"))
    edges = balls.select(F.col("node").alias("a"), F.col("ball").alias("b")).union(ties)
    found = save(components(edges), "components")
    smallest = save(found.join(given, "node").groupBy("component").agg(F.min("vec_id").alias("component_id")), "smallest")
    named = found.join(smallest, "component").select("node", "component_id")
    component = F.coalesce("component_id", "vec_id")
    return given.select("node", "vec_id").join(links, "node", "left").join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _balls(unit: DataFrame, shared: DataFrame, threshold: float) -> DataFrame:
    """(node, ball, angle) of the vectors in buckets: the first centre within half the angle, or the vector itself."""
    first = save(shared.groupBy("bucket").agg(F.min("node").alias("ball")), "first")
    tried = shared.join(first, "bucket").filter("node <> ball").select("node", "ball").distinct()
    x, c = unit.select("node", "x"), unit.select(F.col("node").alias("ball"), F.col("x").alias("c"))
    half = cos(acos(threshold) / 2 - _MARGIN)
    near = tried.join(x, "node").join(c, "ball").filter(F.size("x") == F.size("c")).withColumn("cosine", _cosine("x", "c")).filter(F.col("cosine") >= half)
    chosen = near.groupBy("node").agg(F.min(F.struct("ball", "cosine")).alias("chosen")).select("node", "chosen.ball", "chosen.cosine")
    members = shared.select("node").distinct().join(chosen, "node", "left")
    return save(members.select("node", F.coalesce("ball", "node").alias("ball"), _angle(F.coalesce("cosine", F.lit(1.0))).alias("angle")), "balls")


def _between(unit: DataFrame, shared: DataFrame, balls: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links between different balls that share a bucket: (node, n) counts, and (a, b) ties of balls."""
    limit = acos(threshold)
    about = save(balls.groupBy("ball").agg(F.count("*").alias("many"), F.max("angle").alias("radius")).join(
        unit.select(F.col("node").alias("ball"), "x"), "ball"), "about")
    met = save(shared.join(balls.select("node", "ball"), "node").select("bucket", "ball").distinct(), "met")
    pairs = met.join(met.select("bucket", F.col("ball").alias("other")), "bucket").filter("ball < other").select("ball", "other").distinct()
    other = about.select(F.col("ball").alias("other"), F.col("many").alias("other_many"), F.col("radius").alias("other_radius"), F.col("x").alias("y"))
    both = pairs.join(about, "ball").join(other, "other").filter(F.size("x") == F.size("y")).withColumn("angle", _angle(_cosine("x", "y")))
    both = both.filter(F.col("angle") - F.col("radius") - F.col("other_radius") <= limit + _MARGIN)
    sure = F.col("angle") + F.col("radius") + F.col("other_radius") <= limit - _MARGIN
    both = save(both.select("ball", "other", "many", "radius", "other_many", "other_radius", sure.alias("sure")), "pairs")
    # either way round: each vector of a ball against the other ball
    turned = both.select("ball", "other", F.col("other_many").alias("n"), F.col("other_radius").alias("radius"), "sure").union(
        both.select(F.col("other").alias("ball"), F.col("ball").alias("other"), F.col("many").alias("n"), "radius", "sure"))
    single = turned.join(balls.select("ball", "node"), "ball")
    certain = single.filter("sure").select("node", "n")
    centre = unit.select(F.col("node").alias("other"), F.col("x").alias("y"))
    vectors = unit.select("node", "x")
    open_ = single.filter("not sure").join(vectors, "node").join(centre, "other").withColumn("angle", _angle(_cosine("x", "y")))
    open_ = open_.filter(F.col("angle") - F.col("radius") <= limit + _MARGIN)
    open_ = save(open_.select("node", "ball", "other", "n", (F.col("angle") + F.col("radius") <= limit - _MARGIN).alias("sure")), "open")
    members = balls.select(F.col("ball").alias("other"), F.col("node").alias("partner"))
    compared = open_.filter("not sure").join(members, "other").filter("node <> partner")
    compared = compared.join(vectors, "node").join(unit.select(F.col("node").alias("partner"), F.col("x").alias("y")), "partner")
    compared = compared.filter(_cosine("x", "y") >= threshold)
    compared = save(compared.groupBy("node", "ball", "other").agg(F.count("*").alias("n")), "compared")
    counts = certain.union(open_.filter("sure").select("node", "n")).union(compared.select("node", "n"))
    ties = both.filter("sure").select("ball", "other").union(open_.filter("sure").select("ball", "other")).union(compared.select("ball", "other"))
    drop(met)
    return counts, ties.select(F.col("ball").alias("a"), F.col("other").alias("b")).distinct()


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All pairs.
SQL = """
WITH RECURSIVE given AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)),
usable AS MATERIALIZED (SELECT * FROM given WHERE norm > 0 AND isfinite(norm)),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id
  WHERE list_inner_product(x.v, y.v) / (x.norm * y.norm) >= 0.95),
reach(a, b) AS (SELECT DISTINCT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS component FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, e.vec_id) AS component_id, coalesce(component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts ON counts.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id
"""
