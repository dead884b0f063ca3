"""N-gram Jaccard join of whole texts: size-aware, with subsets for light sets and inverted lists for heavy ones.

Two sets link when 100 * |A n B| >= percent * |A u B|. Nothing is estimated; each step only
leaves out what cannot link.

1. Equal sets are one class.
2. A set needs partners for ``percent`` of its shingles. Of the first tokens by hash, a few more than
   may differ, a fixed share must occur in other classes. Few classes are left, and their whole
   sets are counted the same way.
3. Light classes (size <= x) list the subsets of the size that two sets must share: equal subsets
   are links. Heavy classes are found by the inverted lists of their rarest tokens. x minimises
   the cost, subsets listed plus list entries scanned.
4. Members of a list are compared with its most typical one. Only those that stay apart are compared
   with each other, where what each has in common with it leaves that open. Pairs are confirmed
   on whole sets, and components closed over links.
"""

from __future__ import annotations

from itertools import combinations
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.columns import fresh_name
from claimflow.llm.components import components
from claimflow.llm.scratch import drop, release, save
from claimflow.llm.words import chunks, mix, shingle_sets, words_of

#: Share of a set, beyond what may differ, whose tokens are listed in the first step.
EXTRA_PERCENT = 15
#: Sizes that can be light; beyond it there are too many subsets at any boundary.
MOST_LIGHT = 40


def _ceil(n, percent: int):
    return (n * percent + 99) // 100


def _ceil_column(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100).cast("int")


def _sets(part: pa.RecordBatch, k: int):
    """(sizes, first token of each set, tokens, fingerprints) of the texts of a batch."""
    text, value = shingle_sets(words_of(part.column("text")), k)
    sizes = np.bincount(text, minlength=part.num_rows)
    first = np.concatenate([[0], np.cumsum(sizes)])
    prints = [_total(mix(value + np.uint64(seed)), first) for seed in (17, 9973)]
    return sizes, first, value.view(np.int64), prints


def _total(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix(sums[first[1:]] - sums[first[:-1]]).view(np.int64)


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                sizes, _, _, (one, two) = _sets(part, k)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n": sizes, "p1": one, "p2": two})

    return run


def _first_tokens(k: int, percent: int):
    """(token, p1) of the first tokens of each set; equal sets of a batch give them once."""
    def run(batches):
        for batch in batches:
            done: set[int] = set()
            for part in chunks(batch, "text"):
                sizes, first, tokens, (one, _) = _sets(part, k)
                new = [i for i, p in enumerate(one.tolist()) if p not in done and not done.add(p)]
                wanted = np.zeros(len(sizes), np.int64)
                wanted[new] = (sizes - _ceil(sizes, percent) + _ceil(sizes, EXTRA_PERCENT))[new]
                keep = np.arange(len(tokens)) - np.repeat(first[:-1], sizes) < np.repeat(wanted, sizes)
                yield pa.RecordBatch.from_pydict({"token": tokens[keep], "p1": np.repeat(one, sizes)[keep]})

    return run


def _whole_sets(k: int):
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                sizes, first, tokens, (one, two) = _sets(part, k)
                same = (one == part.column("p1").to_numpy()) & (two == part.column("p2").to_numpy())
                lists = pa.LargeListArray.from_arrays(first, tokens).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({"node": part.column("node"), "tokens": lists}).filter(pa.array(same))

    return run


def _subsets(percent: int):
    """(key, node, low) of every subset that a light set must share with a partner of some size."""
    def run(batches):
        for batch in batches:
            keys, nodes, lows = [], [], []
            for node, tokens in zip(batch.column("node").to_pylist(), batch.column("tokens").to_pylist()):
                s = len(tokens)
                for t in range(_ceil(s, percent), s * 100 // percent + 1):
                    low, high = min(s, t), max(s, t)
                    for chosen in combinations(tokens, _overlap(s, t, percent)):
                        keys.append(hash((low, high, chosen)))
                        nodes.append(node)
                        lows.append(s <= t)
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(keys, pa.int64()), "node": pa.array(nodes, pa.int64()), "low": pa.array(lows, pa.bool_()),
            })

    return run


def _overlap(s: int, t: int, percent: int) -> int:
    return -(-percent * (s + t) // (100 + percent))


def _subset_count(s: int, percent: int) -> int:
    return sum(comb(s, _overlap(s, t, percent)) for t in range(_ceil(s, percent), s * 100 // percent + 1) if _overlap(s, t, percent) <= s)


def set_classes(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, p1, p2): size and fingerprints of the shingle set of every row."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(k), "doc_id bigint, n bigint, p1 bigint, p2 bigint")


def _survivors(docs: DataFrame, base: DataFrame, k: int, percent: int) -> DataFrame:
    """Classes whose first tokens occur often enough in other classes: node, rep, n, p1, p2, shared.

    ``shared`` lists the first tokens with a partner, rarest first: the last six bits of a token
    give way to its frequency, in quarter powers of 2, and lists are sorted by them.
    """
    classes = base.filter("doc_id IS NOT NULL AND n > 0").groupBy("p1", "p2", "n").agg(F.min("doc_id").alias("rep"))
    first = docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(_first_tokens(k, percent), "token bigint, p1 bigint")
    # counted before the shuffle, then joined: a token of very many texts is in no single task
    counted = first.groupBy("token").agg(F.count("*").alias("df"), F.min("p1").alias("low"), F.max("p1").alias("high")).filter("low <> high")
    level = F.least(F.lit(63), F.floor(F.log2("df") * 4)).cast("bigint")
    common = save(counted.select("token", F.col("token").bitwiseAND(F.lit(-64)).bitwiseOR(level).alias("packed")), "common")
    release(docs.sparkSession)
    packed = first.join(common, "token").select("p1", F.col("packed").alias("token"))
    lists = packed.groupBy("p1").agg(F.collect_set("token").alias("shared"))
    # of the first tokens, so many are shared with any partner
    needed = _ceil_column(_ceil_column(F.col("n"), percent), EXTRA_PERCENT)
    left = lists.join(classes, "p1").filter(F.size("shared") >= needed)
    return save(left.select(F.monotonically_increasing_id().alias("node"), "rep", "n", "p1", "p2", "shared", needed.alias("needed")), "survivors")


def shared_tokens(sets: DataFrame) -> DataFrame:
    """(node, token) of the tokens that are in several sets. Counted before the shuffle, then joined, which splits at frequent tokens."""
    tokens = sets.select("node", F.explode("tokens").alias("token"))
    common = save(tokens.groupBy("token").count().filter("count > 1").select("token"), "common")
    release(sets.sparkSession)
    return tokens.join(common, "token", "left_semi")


def _typical(sets: DataFrame, survivors: DataFrame, percent: int) -> DataFrame:
    """Survivors with enough shared tokens in the whole set, and their number m."""
    m = shared_tokens(sets).groupBy("node").agg(F.count("*").cast("int").alias("m"))
    return save(survivors.join(m, "node").filter(F.col("m") >= _ceil_column(F.col("n"), percent)), "typical")


def _lists(typical: DataFrame, percent: int) -> DataFrame:
    """(token, band, node, n, m): inverted lists by token and by a band of sizes, in which partners meet."""
    rank = F.transform("shared", lambda t: F.struct(t.bitwiseAND(F.lit(63)).alias("level"), t.alias("token")))
    length = F.size("shared") - F.col("needed") + 1
    band = F.floor(F.log(F.col("n")) / F.lit(log(100 / percent))).cast("int")
    return typical.select(
        "node", "n", "m", F.explode(F.slice(F.array_sort(rank), F.lit(1), length)).alias("ranked"), band.alias("first"),
    ).select("node", "n", "m", F.col("ranked.token").alias("token"), F.explode(F.array(F.col("first"), F.col("first") + 1)).alias("band"))


def _links(both: Column | str, an: str, bn: str, percent: int) -> Column:
    """Sets of an and bn elements with so many in common link."""
    return (F.col(both) if isinstance(both, str) else both) * (100 + percent) >= (F.col(an) + F.col(bn)) * percent


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b, ..) with ``an``, ``bn`` and the number of elements in ``both``, on whole sets."""
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    found = pairs.join(a, "a").join(b, "b")
    both = F.size(F.array_intersect("left", "right")).alias("both")
    return found.select(*[F.col(c) for c in pairs.columns], F.size("left").alias("an"), F.size("right").alias("bn"), both)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that link, compared on whole sets."""
    return _overlaps(pairs, sets).filter(_links("both", "an", "bn", percent)).select("a", "b")


def _light_boundary(lists: DataFrame, typical: DataFrame, percent: int) -> int:
    """The largest light size: the one with the least cost, from counts per size (at most MOST_LIGHT rows)."""
    entries = lists.filter(f"n <= {MOST_LIGHT}").groupBy("token", "band", "n").agg(F.count("*").alias("many"))
    lengths = entries.groupBy("token", "band").agg(F.sum("many").alias("length"))
    scanned = entries.join(lengths, ["token", "band"]).groupBy("n").agg(F.sum(F.col("many") * F.col("length")).alias("scans"))
    sizes = typical.filter(f"n <= {MOST_LIGHT}").groupBy("n").count()
    found = {row["n"]: (row["count"], row["scans"] or 0) for row in sizes.join(scanned, "n", "left").collect()}
    best, least, listed = 0, sum(scans for _, scans in found.values()), 0
    rest = least
    for n in range(1, MOST_LIGHT + 1):
        count, scans = found.get(n, (0, 0))
        listed, rest = listed + count * _subset_count(n, percent), rest - scans
        if listed + rest <= least:
            best, least = n, listed + rest
    return best


def _light_pairs(sets: DataFrame, typical: DataFrame, x: int, percent: int) -> DataFrame:
    """Pairs of light classes that share a subset; per subset one side's smallest node stands for all."""
    light = typical.filter(F.col("n") <= x).select("node").join(sets, "node").select("node", F.array_sort("tokens").alias("tokens"))
    subsets = light.mapInArrow(_subsets(percent), "key bigint, node bigint, low boolean")
    smallest = subsets.groupBy("key").agg(
        F.min(F.when(F.col("low"), F.col("node"))).alias("first"), F.min(F.when(~F.col("low"), F.col("node"))).alias("second"))
    smallest = smallest.filter(F.col("first").isNotNull() & ((F.col("first") != F.col("second")) | F.col("second").isNull()))
    subsets = subsets.join(smallest, "key")
    low, high = F.col("first"), F.col("second")
    other = F.when(F.col("low"), F.coalesce(high, low)).otherwise(low)  # equal sizes are all low
    return subsets.select(F.col("node").alias("a"), other.alias("b")).filter("a <> b").distinct()


def links(docs: DataFrame, base: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(classes, edges): surviving classes, and (a, b) links of their nodes that connect all that link."""
    survivors = _survivors(docs, base, k, percent)
    release(docs.sparkSession)
    wanted = survivors.select(F.col("rep").alias("doc_id"), "node", "p1", "p2")
    texts = docs.select("doc_id", "text").join(wanted, "doc_id").dropDuplicates(["doc_id", "text", "node"])
    sets = save(texts.select("text", "node", "p1", "p2").mapInArrow(_whole_sets(k), "node bigint, tokens array<bigint>"), "sets")
    release(docs.sparkSession)
    typical = _typical(sets, survivors, percent)
    lists = save(_lists(typical, percent), "lists")
    x = _light_boundary(lists, typical, percent)
    edges = link_lists(lists.filter(F.col("n") >= _ceil(x + 1, percent)), sets, percent, _light_pairs(sets, typical, x, percent), x)
    drop(sets, lists, typical)
    return survivors, edges


def link_lists(lists: DataFrame, sets: DataFrame, percent: int, pairs: DataFrame | None = None, light: int = 0) -> DataFrame:
    """(a, b) links that connect all sets that link and meet in a list.

    lists has (token, band, node, n, m): n the size of the node's set and m the elements it shares
    with any other set; sets has (node, tokens). ``pairs`` are more candidates; two sets of at most
    ``light`` elements are left to them.

    Members are first compared with their list's most typical one, the leader: o elements in common. Two
    members of one leader then have at most min(o, o') + min(m - o, m' - o') in common. Those that
    stay outside the largest group of their leader are compared with all of its members for which
    that is enough. Copies of one text with few changes each so need no comparison among each other.
    """
    best = F.max(F.struct((F.col("m") / F.col("n")).alias("share"), (-F.col("node")).alias("node"), "n", "m"))
    leaders = lists.groupBy("token", "band").agg(best.alias("best"), F.count("*").alias("length")).filter("length > 1")
    leaders = save(leaders.select("token", "band", (-F.col("best.node")).alias("leader")), "leaders")
    star = lists.join(leaders, ["token", "band"]).select("leader", "node", "n", "m").distinct()
    star = save(_overlaps(star.withColumnRenamed("leader", "a").withColumnRenamed("node", "b"), sets), "star")
    linked = star.filter((F.col("a") != F.col("b")) & _links("both", "an", "bn", percent)).select("a", "b")
    if pairs is not None:
        linked = linked.union(_confirmed(pairs, sets, percent))
    first = save(linked, "links")
    labels = save(components(first), "labels")
    members = star.select(F.col("a").alias("leader"), F.col("b").alias("node"), F.col("bn").alias("n"), "m", F.col("both").alias("o"))
    named = members.join(labels.withColumnRenamed("component", "group"), "node", "left").withColumn("group", F.coalesce("group", "node"))
    named = save(named, "named")
    groups = named.groupBy("leader", "group").agg(F.count("*").alias("many"))
    main = groups.groupBy("leader").agg(F.max(F.struct("many", "group")).alias("main"), F.count("*").alias("groups"))
    main = save(main.filter("groups > 1").select("leader", F.col("main.group").alias("main")), "main")
    side = lambda p: [F.col(c).alias(f"{p}{c}") for c in ("node", "n", "m", "o", "group")]
    apart = named.join(main, "leader").filter("group <> main").select("leader", *side("a"))
    shared = F.least("ao", "bo") + F.least(F.col("am") - F.col("ao"), F.col("bm") - F.col("bo"))
    rest = apart.join(named.select("leader", *side("b")), "leader").filter(
        (F.col("agroup") != F.col("bgroup")) & _links(shared, "an", "bn", percent) & ((F.col("an") > light) | (F.col("bn") > light)))
    rest = rest.select(F.least("anode", "bnode").alias("a"), F.greatest("anode", "bnode").alias("b")).distinct()
    second = save(_confirmed(rest, sets, percent), "links")
    drop(leaders, star, labels, named, main)
    return first.union(second)


def jaccard_groups(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    docs has a bigint doc_id and text; other columns are ignored. A component is named by the
    smallest doc_id that links reach. Texts without words and NULL texts have an empty set and
    link with nothing; texts of fewer than k words are one shingle. A row without doc_id keeps its
    n_shingles, links with nothing and has component NULL. Repeated rows are equal sets, each
    with its own row; different texts under one doc_id are one document in a component. An empty
    table gives an empty table.
    """
    base = save(set_classes(docs, k), "base")
    survivors, edges = links(docs, base, k, percent)
    reps = survivors.select("node", "rep")
    ends = edges.join(reps.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a").join(
        reps.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    found = components(ends).select(F.col("node").alias("rep"), "component")
    # equal sets: the smallest id of the class, or of its component
    classes = base.filter("doc_id IS NOT NULL AND n > 0").groupBy("p1", "p2", "n").agg(F.min("doc_id").alias("rep"))
    named = save(classes.join(found, "rep", "left").select("p1", "p2", "n", F.coalesce("component", "rep").alias("component")), "classes")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return base.join(named, ["p1", "p2", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents of docs that name their component, each once, with their own columns.

    Documents that link with nothing stay, rows without doc_id as well. Texts are judged: of rows with one doc_id, different
    texts each are a document of their own, under a number made of id and text. Of rows equal in both the one with
    the smallest hash of the other columns stays. NULL and empty texts link with nothing. An empty table stays empty.
    """
    key, twice, turn = (fresh_name(docs, name) for name in ("key", "twice", "turn"))
    digest = F.xxhash64("text")
    several = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    several = several.filter("low <> high").select("doc_id", F.lit(True).alias(twice))
    several = save(several, "several")  # few, as a rule: no shuffle of the texts then
    named = F.when(F.col(twice), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id"))
    keyed = docs.join(several, "doc_id", "left").withColumn(key, named).select(*docs.columns, key)
    groups = jaccard_groups(keyed.select(F.col(key).alias("doc_id"), "text"), k, percent).filter("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    rest = [name for name in docs.columns if name not in ("doc_id", "text")]
    order = Window.partitionBy(key).orderBy(F.xxhash64(*rest) if rest else F.lit(0))
    kept = keyed.join(groups, key, "left_semi").withColumn(turn, F.row_number().over(order)).filter(F.col(turn) == 1)
    return kept.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def query(spark, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 85)


#: All pairs that share a shingle, and what each document reaches.
SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
either AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT DISTINCT a, a FROM either UNION SELECT reach.a, either.b FROM reach JOIN either ON reach.b = either.a),
least AS (SELECT a, min(b) AS component FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""
