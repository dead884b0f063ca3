"""Merkle manifest of a dataset: a digest tree per source, one over the sources, and a proof for every document.

Leaves are digests of documents. Sixteen consecutive ones become the digest of their concatenation, level by level,
until one is left per source, and the same goes for the sources. Every node has a link to its parent and, as
segment, the digests beside it. Links are joined with themselves: each round a node takes over the link of the
ancestor it points to and appends that one's segment, so its distance doubles until all point to the root.

A run of up to sixteen leaves is one row, from the first grouping on: leaves share the links of their run,
and only the nodes above them, a fifteenth of the rows, are in the self-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.lookups import numbered, split_lookup
from claimflow.llm.scratch import save

FAN_OUT = 16
#: The fields of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SEGMENT = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """A value as it goes into a digest: its bytes behind their number, '-' for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[field(text if name == "text" else F.col(name)) for name in FIELDS]), 256)


def _beside(digests: str, place: str) -> tuple[Column, Column]:
    """What stands before and behind a place of a run."""
    left = F.array_join(F.slice(digests, F.lit(1), F.col(place)), "").alias("left")
    return left, F.array_join(F.slice(digests, F.col(place) + 2, F.lit(FAN_OUT)), "").alias("right")


def _levels(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """All levels from ``nodes`` (tree, source, idx, n, id, digest) up, and the links (id, up, segment, child) between them.

    ``n`` is the number of nodes of the tree on the level, ``most`` the largest; a tree ends where it is 1.
    """
    levels, links = [nodes], []
    while most > 1:
        most = -(-most // FAN_OUT)
        run = F.floor(F.col("idx") / FAN_OUT).alias("idx")
        parents = levels[-1].filter("n > 1").groupBy("tree", "source", "n", run).agg(
            F.sort_array(F.collect_list(F.struct(F.col("idx").alias("place"), "id", "digest"))).alias("run"))
        parents = parents.withColumn("digests", F.col("run.digest"))
        parents = save(parents.select(
            "tree", "source", "idx", F.ceil(F.col("n") / FAN_OUT).alias("n"),
            F.concat(F.lit(f"{name}/{len(levels)}/"), F.col("idx").cast("string"), F.lit("/"), F.col("tree")).alias("id"),
            F.sha2(F.array_join("digests", ""), 256).alias("digest"), "run", "digests"), "level")
        levels.append(parents.select("tree", "source", "idx", "n", "id", "digest"))
        children = parents.select(F.col("id").alias("up"), "digests", F.posexplode("run").alias("place", "child"))
        links.append(children.select("child.id", "up", F.array(F.struct(*_beside("digests", "place"))).alias("segment"), "child.digest"))
    return levels, links


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def jump(links: DataFrame) -> DataFrame:
    """Every link extended by the link of the node it points to; links to the root stay."""
    beyond = links.select(F.col("id").alias("up"), F.col("up").alias("further"), F.col("segment").alias("more"), F.col("subroot").alias("passed"))
    met = split_lookup(links, beyond, "up", F.col("id"))
    segment = F.concat("segment", F.coalesce("more", F.array().cast(_SEGMENT)))
    return met.select("id", F.coalesce("further", "up").alias("up"), segment.alias("segment"), F.coalesce("subroot", "passed").alias("subroot"))


def manifest(docs: DataFrame, presented: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, source, leaf, subroot, root, proof, proof_sha256, folded_root, verified.

    docs has doc_id, source, lang, n_chars and text; other columns are ignored, whatever their names.
    ``proof`` lists, from the leaf to the root, the joined digests left and right of the way. ``presented`` is the
    text that is checked against the manifest, by default the document's own: ``folded_root`` is what its leaf
    gives with the proof, and ``verified`` whether that is the root.

    Any column may be NULL, which is told from empty text. NULL sources are one source, the first. Rows without
    doc_id are the first leaves of their source; rows of one doc_id follow by their leaf, and a repeated row is a
    leaf of its own, with a proof of its own. An empty table gives an empty table. Long texts are hashed as a whole.
    """
    own = leaf(F.col("text"))
    shown = F.lit(None).cast("string") if presented is None else F.when(~presented.eqNullSafe(F.col("text")), leaf(presented))
    leaves = save(docs.select(
        "doc_id", "source", field(F.col("source")).alias("tree"), own.alias("leaf"), shown.alias("shown"),
        F.monotonically_increasing_id().alias("row")), "leaves")
    placed = numbered(leaves, "tree", ["doc_id", "leaf", "row"])
    run = F.floor(F.col("idx") / FAN_OUT).alias("idx")
    runs = placed.groupBy("tree", "source", F.col("n").alias("leaves"), run).agg(
        F.sort_array(F.collect_list(F.struct(F.col("idx").alias("place"), "doc_id", "leaf", "shown"))).alias("run"))
    runs = runs.withColumn("digests", F.col("run.leaf"))
    runs = save(runs.select(
        "tree", "source", "idx", F.ceil(F.col("leaves") / FAN_OUT).alias("n"),
        F.concat(F.lit("run/"), F.col("idx").cast("string"), F.lit("/"), F.col("tree")).alias("id"), "run", "digests",
        (F.col("leaves") == 1).alias("lone"),  # a lone leaf is its source's digest itself
        F.when(F.col("leaves") == 1, F.col("digests")[0]).otherwise(F.sha2(F.array_join("digests", ""), 256)).alias("digest")), "runs")
    levels, links = _levels(runs.select("tree", "source", "idx", "n", "id", "digest"), runs.agg(F.max("n")).first()[0] or 0, "node")
    subroots = _union([level.filter("n = 1") for level in levels])
    subroots = subroots.select(F.lit("all").alias("tree"), "source", F.col("source").isNotNull().alias("named"), "id", "digest")
    sources = numbered(subroots, "tree", ["named", "source"]).select(
        "tree", F.lit(None).cast("string").alias("source"), "idx", "n", "id", "digest")
    sources = save(sources, "subroots")
    tops, over = _levels(sources, sources.agg(F.max("n")).first()[0] or 0, "top")
    last = tops[-1].select("digest").first()  # one row, or none
    root = F.lit(last["digest"] if last else None).cast("string")
    nothing = F.lit(None).cast("string").alias("subroot")
    steps = [link.select("id", "up", "segment", nothing) for link in links]
    steps += [link.select("id", "up", "segment", F.col("digest").alias("subroot") if number == 0 else nothing) for number, link in enumerate(over)]
    described = runs.withColumn("segment", F.array().cast(_SEGMENT)).withColumn("subroot", root)
    if steps:
        reached, distance = save(_union(steps), "links"), 1
        while distance < len(steps):
            reached, distance = save(jump(reached), "links"), distance * 2
        described = runs.join(reached, "id", "left").withColumn("segment", F.coalesce("segment", F.array().cast(_SEGMENT)))
        described = described.withColumn("subroot", F.coalesce("subroot", root))
    each = described.select("source", "subroot", "segment", "digests", "lone", F.posexplode("run").alias("place", "l"))
    beside = F.when(F.col("lone"), F.array().cast(_SEGMENT)).otherwise(F.array(F.struct(*_beside("digests", "place"))))
    each = each.select("l.doc_id", "source", "l.leaf", "subroot", root.alias("root"), F.concat(beside, "segment").alias("proof"), "l.shown")
    return each.select(
        "doc_id", "source", "leaf", "subroot", "root", "proof",
        F.sha2(F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"),
        fold(F.coalesce("shown", "leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest gives with a proof."""
    return F.aggregate(proof, digest, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def tampered() -> Column:
    """The text as it is presented in the registered query: every fifth document by CRC-32 of its id is in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return F.when(chosen, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))


def query(spark, sf_dir: str) -> DataFrame:
    found = manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"), tampered())
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: Level by level, then every leaf up along its siblings. CRC-32 is taken bit by bit.
SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT DISTINCT doc_id, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda s, c: list_reduce(list_prepend(xor(s, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda b, z: CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384::BIGINT) ELSE b // 2 END))) % 5 = 0 AS tampered
  FROM documents WHERE doc_id IS NOT NULL),
texts AS (
  SELECT d.*, CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown
  FROM documents d LEFT JOIN crc USING (doc_id)),
fields AS (
  SELECT doc_id, source, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    coalesce(strlen(text) || ':' || text, '-') AS own, coalesce(strlen(shown) || ':' || shown, '-') AS shown FROM texts),
leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, source, sha256(head || own) AS leaf, sha256(head || shown) AS shown,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, sha256(head || own)) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM fields),
nodes(source, level, idx, n, digest) AS (
  SELECT source, 0, idx, n, leaf FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY source, level, idx // 16, n),
subroots AS MATERIALIZED (SELECT source, level, digest FROM nodes WHERE n = 1),
sources AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM subroots),
tops(level, idx, n, digest) AS (
  SELECT 0, idx, n, digest FROM sources
  UNION ALL
  SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 16, n),
top AS (SELECT digest AS root FROM tops WHERE n = 1),
runs AS MATERIALIZED (
  SELECT source, FALSE AS high, level, idx // 16 AS run, list(digest ORDER BY idx) AS digests FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT NULL, TRUE, level, idx // 16, list(digest ORDER BY idx) FROM tops WHERE n > 1 GROUP BY ALL),
way(row, source, high, level, idx, now, beside) AS (
  SELECT row, source, FALSE, 0, idx, shown, '' FROM leaves
  UNION ALL
  SELECT w.row, w.source, w.high OR r.digests IS NULL, CASE WHEN r.digests IS NULL THEN 0 ELSE w.level + 1 END,
    CASE WHEN r.digests IS NULL THEN s.idx ELSE w.idx // 16 END,
    CASE WHEN r.digests IS NULL THEN w.now ELSE sha256(array_to_string(r.digests[:w.idx % 16], '') || w.now || array_to_string(r.digests[w.idx % 16 + 2:], '')) END,
    CASE WHEN r.digests IS NULL THEN w.beside ELSE concat(w.beside, array_to_string(r.digests[:w.idx % 16], ''), array_to_string(r.digests[w.idx % 16 + 2:], '')) END
  FROM way w JOIN sources s ON s.source IS NOT DISTINCT FROM w.source
  LEFT JOIN runs r ON r.high = w.high AND r.level = w.level AND r.run = w.idx // 16 AND (w.high OR r.source IS NOT DISTINCT FROM w.source)
  WHERE r.digests IS NOT NULL OR NOT w.high),
ends AS (SELECT row, arg_max(now, (high, level)) AS folded, arg_max(beside, (high, level)) AS beside FROM way GROUP BY row)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(beside) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves l JOIN ends USING (row) JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source CROSS JOIN top
"""
