"""Divergence audit of sources: how far the word shares of every two sources of a language are apart, and which words a source overuses.

Shares are smoothed, so a source also has one for words it never uses, its baseline. With baselines a and b, the
distance of two sources is |a - b| for every word kept, and then corrections: for the words of one source the other's
baseline is compared, and for the words both use the difference itself. The last is a product of a sparse matrix with its
transpose, accumulated by rows: a source goes through its words, and the term-major index tells for each
which peers use it, and adds what it finds to a dense row with a place per peer. No pair of postings is ever emitted.

The index is dealt to blocks of words, of which each gives one dense row per source; the rows are summed up.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.lookups import split_lookup
from claimflow.llm.scratch import save

#: A word is kept in a language if so many of its documents have it.
LEAST_DOCUMENTS = 30
#: Added to each count, and the whole that shares are parts of.
SMOOTHING, WHOLE = 5, 1_000_000_000
TOP_TERMS = 50
#: Postings of a block of the index at least, and places of the dense rows that are held at once.
BLOCK_POSTINGS, ROW_PLACES = 50_000, 2_000_000
#: Counts that a task holds before it passes them on.
HELD_COUNTS = 500_000

_TERM = re.compile(rb"[a-z\x80-\xff]+")  # letters and all beyond ASCII, as bytes


def _counts(most: int):
    def run(batches):
        """(lang, source, term, count, docs) of many documents at once; every group has a row with term NULL."""
        held: dict[tuple, dict] = {}  # count and number of documents in one integer

        def flush():
            groups = [group for group, terms in held.items() for _ in range(len(terms) + 1)]
            found = [term for terms in held.values() for term in (None, *terms)]
            values = np.array([value for terms in held.values() for value in (0, *terms.values())], np.int64)
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([lang for lang, _ in groups], pa.string()), "source": pa.array([source for _, source in groups], pa.string()),
                "term": pa.array(found, pa.binary()).cast(pa.string()), "count": values >> 31, "docs": values & ((1 << 31) - 1),
            })

        size = 0
        for batch in batches:
            langs, sources, texts = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                terms = held.setdefault((langs[i].as_py(), sources[i].as_py()), {})
                before = len(terms)
                # only A to Z change in bytes
                for term, count in Counter(_TERM.findall(texts[i].as_py().encode().lower())).items():
                    terms[term] = terms.get(term, 0) + ((count << 31) | 1)
                size += len(terms) - before
                if size >= most:
                    yield flush()
                    held.clear()
                    size = 0
        yield flush()

    return run


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a word in billionths, rounded down, plus 1; decimals keep it exact."""
    part = lambda c, digits: c.cast(f"decimal({digits},0)")
    above = part(count + SMOOTHING, 19) * part(F.lit(WHOLE), 10)
    below = part(total, 19) + part(terms, 18) * part(F.lit(SMOOTHING), 1)
    return F.call_function("div", above, below) + 1


def _block_rows(key: tuple, entries: pa.Table, groups: pa.Table) -> pa.Table:
    """Dense rows of one block: for each source of the slice what the block's words correct, per peer.

    entries has (no, term, p): the shares of the words that sources use; groups (no, base) all sources of the language.
    """
    slice_, slices = key[2].as_py(), key[3].as_py()
    base = np.zeros(groups.num_rows, np.int64)
    base[groups["no"].to_numpy()] = groups["base"].to_numpy()
    size = len(base)
    no, p = entries["no"].to_numpy(), entries["p"].to_numpy()
    # term-major: postings of a word lie together
    term = entries["term"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.lexsort((no, term))
    index_no, index_p, index_term = no[order], p[order], term[order]
    starts = np.searchsorted(index_term, np.arange(term.max(initial=-1) + 2))
    # source-major: the words of a source by share, with running sums
    order = np.lexsort((p, no))
    row_no, row_p, row_term = no[order], p[order], term[order]
    first = np.searchsorted(row_no, np.arange(size + 1))
    sums = np.concatenate([[0], np.cumsum(row_p)])
    levels, level = np.unique(row_p, return_inverse=True)
    place = row_no * (len(levels) + 1) + level  # ascends by source and share

    def distance(rows, against):
        """Sum over the words of ``rows`` of |p - against|, for two aligned arrays of sources and values."""
        lo, hi = first[rows], first[rows + 1]
        below = np.searchsorted(place, rows * (len(levels) + 1) + np.searchsorted(levels, against))
        below = np.clip(below, lo, hi)
        return (sums[hi] - sums[below]) - (hi - below) * against + (below - lo) * against - (sums[below] - sums[lo])

    words, everyone = np.diff(first), np.arange(size)
    mine = np.arange(slice_, size, slices)
    out = np.zeros((len(mine), size), np.int64)
    for at, g in enumerate(mine):
        apart = np.abs(base - base[g])
        row = out[at]
        row += distance(np.full(size, g), base) - words[g] * apart  # words of g against the peers' baselines
        row += distance(everyone, np.full(size, base[g])) - words * apart  # words of the peers against g's
        terms, shares = row_term[first[g]:first[g + 1]], row_p[first[g]:first[g + 1]]
        lengths = starts[terms + 1] - starts[terms]
        hit = np.repeat(starts[terms] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum()) if len(terms) else lengths
        peer, own = index_no[hit], np.repeat(shares, lengths)
        both = np.abs(own - index_p[hit]) - np.abs(own - base[peer]) - np.abs(index_p[hit] - base[g]) + apart[peer]
        np.add.at(row, peer, both)
    offsets = pa.array(np.arange(len(mine) + 1, dtype=np.int32) * size)
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(mine), pa.string()), "no": pa.array(mine, pa.int64()),
        "row": pa.ListArray.from_arrays(offsets, pa.array(out.ravel())),
    })


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): per source of a language its distance to each other, and its overused words.

    Part ``pair``: item is another source of the language, value the sum over the language's kept words of the
    differences of both shares. Part ``term``: item is a kept word that the source uses more than the language, value by how
    much, the ``top`` largest. Ranks start at 1, by value descending and item.

    docs has text, lang and source; other columns are ignored, whatever their names. NULL in any of them is ''. Sources
    without words have the baseline alone. A repeated row counts each time. A language without kept words
    has distances of 0 and no terms. Ties rank by item. An empty table gives an empty table. Long texts are
    counted as a whole.

    Shares are integers and all sums stay below 2**53 for fewer than 10**15 words, so results are exact.
    """
    filled = docs.select(*[F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("lang", "source", "text")])
    counted = filled.mapInArrow(_counts(HELD_COUNTS), "lang string, source string, term string, count bigint, docs bigint")
    counted = save(counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "counted")
    kept = counted.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("whole"))
    kept = save(kept.filter(F.col("docs") >= least_documents).select("lang", "term", "whole"), "kept")
    posted = save(counted.filter("term IS NOT NULL").join(kept, ["lang", "term"]).select("lang", "source", "term", "count", "whole"), "posted")
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("whole").alias("lang_total"))
    totals = posted.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("posted"))
    everyone = counted.filter("term IS NULL").select("lang", "source")
    by_lang = Window.partitionBy("lang")  # one row per source
    groups = everyone.join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left").fillna(0, ["total", "posted", "terms", "lang_total"])
    groups = groups.select(
        "lang", "source", "total", "terms", "lang_total", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("bigint").alias("no"),
        F.count("*").over(by_lang).alias("many"), F.sum("posted").over(by_lang).alias("postings"))
    # a block has more postings than its dense rows have places
    blocks = F.ceil(F.col("postings") / F.greatest(F.lit(BLOCK_POSTINGS), F.col("many") * F.col("many")))
    groups = groups.withColumn("blocks", F.greatest(blocks, F.lit(1)).cast("bigint"))
    base = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(0).cast("bigint"))
    groups = save(groups.withColumn("base", base), "groups")
    lang_source = F.struct("lang", "source").alias("group")
    described = groups.select(lang_source, "no", "total", "terms", "lang_total", "many", "blocks")
    entries = split_lookup(posted.withColumn("group", lang_source), described, "group", F.col("term"))
    entries = save(entries.select(
        "lang", "source", "term", "no", "many", "blocks", share(F.col("count"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("whole"), F.col("lang_total"), F.col("terms")).alias("q")), "entries")
    # so many slices that a task holds ROW_PLACES places at most
    slices = F.least(F.col("many"), F.ceil(F.col("many") * F.col("many") / ROW_PLACES))
    sliced = F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)).alias("slice")
    key = ["lang", "block", "slice", "slices"]
    mine = entries.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), sliced, slices.alias("slices"), "no", "term", "p")
    bases = groups.select("lang", "no", "base", "many", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    bases = bases.select("lang", "block", sliced, slices.alias("slices"), "no", "base")
    rows = mine.groupBy(*key).cogroup(bases.groupBy(*key)).applyInArrow(_block_rows, "lang string, no bigint, row array<bigint>")
    corrections = rows.select("lang", "no", F.posexplode("row").alias("peer", "x")).filter(F.col("no") != F.col("peer"))
    corrections = corrections.groupBy("lang", "no", "peer").agg(F.sum("x").alias("x"))
    own = groups.select("lang", "no", "source", "base", "terms")
    peer = groups.select("lang", F.col("no").alias("peer"), F.col("source").alias("item"), F.col("base").alias("peer_base"))
    pairs = corrections.join(own, ["lang", "no"]).join(peer, ["lang", "peer"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", (F.col("terms") * F.abs(F.col("base") - F.col("peer_base")) + F.col("x")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    over = entries.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pairs.withColumn("rank", rank).union(over.withColumn("rank", rank).filter(F.col("rank") <= top))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All pairs of sources over all kept words.
SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
tokens AS MATERIALIZED (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
kept AS MATERIALIZED (SELECT lang, term, count(*)::HUGEINT AS whole FROM tokens GROUP BY ALL HAVING count(DISTINCT row) >= 30),
vocabulary AS (SELECT lang, count(*)::HUGEINT AS v, sum(whole)::HUGEINT AS n FROM kept GROUP BY lang),
counts AS MATERIALIZED (SELECT t.lang, source, t.term, count(*)::HUGEINT AS c FROM tokens t JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
totals AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM counts GROUP BY ALL),
groups AS MATERIALIZED (SELECT g.lang, g.source, coalesce(t.n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (g.n + 5 * v.v) AS p,
    1 + (1000000000::HUGEINT * (k.whole + 5)) // (v.n + 5 * v.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN vocabulary v ON v.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM items)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
