"""Substring dedup: paragraphs meet by MinHash bands, pieces of them exactly; what is repeated is cut from all documents but one.

A paragraph is a line. Lines with equal words are one class. Classes that share a band of MinHash values and
are similar enough by exact Jaccard on their shingles are joined, and components of them are closed.
For exact passages inside a line, pieces start at words whose hash is the smallest of REACH words
on either side: a passage has the same pieces wherever it stands, but for its first and last words.
Pieces with equal words are one class.

In every component the document with the smallest id keeps its lines and pieces. In others they go, a similar line
as a whole, where they follow one another over at least LEAST_WORDS words, so a short line that many
documents share stays.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.columns import fresh_name
from claimflow.llm.components import components
from claimflow.llm.jaccard_join import _ceil_column, link_lists, shared_tokens
from claimflow.llm.scratch import drop, release, save
from claimflow.llm.words import Words, chunks, group_hashes, mix, windows, words_of

REACH = 5
#: A repeated run of pieces is cut if it has so many words.
LEAST_WORDS = 20
SHINGLE, PERCENT = 5, 80
#: Share of the lines at the similarity limit that bands should bring together.
RECALL = 0.95
ROWS = 2


def bands(rows: int = ROWS, percent: int = PERCENT, recall: float = RECALL) -> int:
    """The fewest bands of ``rows`` values that reach the recall at the limit."""
    b = 1
    while 1 - (1 - (percent / 100) ** rows) ** b < recall:
        b += 1
    return b


def _line_starts(words: Words) -> np.ndarray:
    breaks = np.concatenate([[0], np.cumsum(words.raw == 0x0A)])
    line = np.ones(len(words.start), bool)
    line[1:] = (words.text[1:] != words.text[:-1]) | (breaks[words.start[1:]] > breaks[words.end[:-1]])
    return line


def _units(words: Words, starts: np.ndarray) -> Words:
    first = np.append(np.flatnonzero(starts), len(starts))
    return replace(words, first=first, text=np.repeat(np.arange(len(first) - 1), np.diff(first)))


def lines(words: Words) -> Words:
    """The words with a line as their unit: ``first`` has the bounds of lines, ``text`` the line of each word."""
    return _units(words, _line_starts(words))


def cut(words: Words) -> Words:
    """The words with a piece as their unit: ``first`` has the bounds of pieces, ``text`` the piece of each word."""
    n, line = len(words.start), _line_starts(words)
    number, value = np.cumsum(line), mix(words.hash)
    lowest = np.ones(n, bool)
    for j in range(1, min(REACH, n - 1) + 1):
        same = number[j:] == number[:-j]
        lowest[j:] &= ~same | (value[j:] < value[:-j])
        lowest[:-j] &= ~same | (value[:-j] <= value[j:])
    return _units(words, line | lowest)


def _lines(column: pa.Array):
    """(words by line, contents) of a column of texts; a content is the hash of a line's words."""
    units = lines(words_of(column))
    return units, group_hashes(units.hash, units.first)


def _checks(units: Words) -> np.ndarray:
    """32 bits of a second hash of the words of each unit, independent of the first."""
    return (group_hashes(mix(units.hash ^ np.uint64(0xA5A5A5A55A5A5A5A)), units.first) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _keys(batches):
    """(key, content): the bands of each line content of a chunk."""
    many = bands()
    for batch in batches:
        for part in chunks(batch, "text"):
            units, content = _lines(part.column("text"))
            line, _, shingle = windows(units, SHINGLE)
            start = np.searchsorted(line, np.arange(len(content)))
            _, once = np.unique(content, return_index=True)
            for band in range(many if len(content) else 0):
                key = np.full(len(content), band, np.uint64)
                for row in range(ROWS):
                    key = mix(key + np.minimum.reduceat(mix(shingle + np.uint64(977 * (band * ROWS + row) + 1)), start))
                yield pa.RecordBatch.from_pydict({"key": key[once].view(np.int64), "content": content[once].view(np.int64)})


def _sets(batches):
    """(node, check, tokens): the distinct shingles of each line content of a chunk."""
    for batch in batches:
        for part in chunks(batch, "text"):
            units, content = _lines(part.column("text"))
            _, once = np.unique(content, return_index=True)
            wanted = np.zeros(len(content), bool)
            wanted[once] = True
            line, _, shingle = windows(units, SHINGLE)
            order = np.lexsort((shingle, line))
            line, shingle = line[order], shingle[order]
            keep = wanted[line]
            keep[1:] &= (line[1:] != line[:-1]) | (shingle[1:] != shingle[:-1])
            line, shingle = line[keep], shingle[keep]
            offsets = np.append(np.searchsorted(line, np.flatnonzero(wanted)), len(line)).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "node": content[wanted].view(np.int64), "check": _checks(units)[wanted], "tokens": pa.ListArray.from_arrays(offsets, pa.array(shingle.view(np.int64))),
            })


def _occurrences(batches):
    """(content, check, doc_id, copy, start, words) of every piece and every line of several pieces; start counts words."""
    for batch in batches:
        for part in chunks(batch, "text"):
            words = words_of(part.column("text"))
            pieces, whole = cut(words), lines(words)
            several = np.diff(np.searchsorted(pieces.first, whole.first)) > 1
            for units, wanted in ((pieces, slice(None)), (whole, several)):
                content, first = group_hashes(units.hash, units.first)[wanted], units.first[:-1][wanted]
                text = pa.array(words.text[first])
                yield pa.RecordBatch.from_pydict({
                    "content": content.view(np.int64), "check": _checks(units)[wanted],
                    "doc_id": part.column("doc_id").take(text), "copy": part.column("copy").take(text),
                    "start": (first - words.first[words.text[first]]).astype(np.int32), "words": np.diff(units.first)[wanted].astype(np.int32),
                })


def _similar(texts: DataFrame) -> DataFrame:
    """(content, check, component) of the line contents that are similar to another one."""
    # counted before the shuffle, then joined: no band or word that very many lines share is in one task
    keys = texts.mapInArrow(_keys, "key bigint, content bigint")
    met = keys.groupBy("key").agg(F.min("content").alias("low"), F.max("content").alias("high")).filter("low <> high").select("key")
    met = save(met, "met")
    release(texts.sparkSession)
    near = save(keys.join(met, "key", "left_semi").distinct(), "near")
    drop(met)
    release(texts.sparkSession)
    wanted = near.select(F.col("content").alias("node")).distinct()
    sets = texts.mapInArrow(_sets, "node bigint, check int, tokens array<bigint>").join(wanted, "node", "left_semi")
    sets = save(sets.dropDuplicates(["node"]), "lines")
    release(texts.sparkSession)
    # a line with too few shingles of others cannot be similar to any
    m = shared_tokens(sets).groupBy("node").agg(F.count("*").cast("int").alias("m"))
    typical = sets.select("node", F.size("tokens").alias("n")).join(m, "node").filter(F.col("m") >= _ceil_column(F.col("n"), PERCENT))
    typical = save(typical, "typical")
    lists = save(near.withColumnRenamed("content", "node").join(typical, "node").select(
        F.col("key").alias("token"), F.lit(0).alias("band"), "node", "n", "m"), "lists")
    found = components(link_lists(lists, sets.select("node", "tokens"), PERCENT))
    found = save(found.join(sets.select("node", "check"), "node").withColumnRenamed("node", "content"), "similar")
    drop(near, sets, typical, lists)
    return found


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per passage to cut: doc_id, first_word, n_words, kept_doc_id (the document that keeps its beginning), copy.

    docs has a bigint doc_id and text; other columns are ignored. Words count from 0 within the
    text. NULL and empty texts have no passages. Rows without doc_id take no part. Repeated
    rows are one document, and a passage repeated within one document alone stays. Different
    texts under one doc_id are one document, too, each with passages of its own: ``copy``, a hash of the text, tells
    them apart. An empty table gives an empty table.

    Words count as equal by 96 bits of two hashes.
    """
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", _copy().alias("copy"))
    similar = _similar(texts.select("text"))
    pieces = texts.mapInArrow(_occurrences, "content bigint, check int, doc_id bigint, copy bigint, start int, words int")
    shared = pieces.groupBy("content").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low <> high").select("content")
    groups = shared.join(similar.withColumnRenamed("check", "like"), "content", "full").select("content", "like", "component")
    groups = save(groups, "groups")
    release(docs.sparkSession)
    similar_too = F.coalesce(F.col("check") == F.col("like"), F.lit(False))
    pieces = save(pieces.join(groups, "content").select(
        "doc_id", "copy", "start", "words", F.when(similar_too, F.col("component")).otherwise(F.col("content")).alias("group"),
        F.when(similar_too, F.lit(None)).otherwise(F.col("check")).alias("check")), "repeated")
    release(docs.sparkSession)
    pieces = pieces.withColumn("check", F.coalesce(F.col("check").cast("bigint"), F.lit(1 << 32)))  # components have none
    keepers = pieces.groupBy("group", "check").agg(F.min("doc_id").alias("kept"), F.max("doc_id").alias("last")).filter("kept <> last")
    keepers = save(keepers.select("group", "check", "kept"), "keepers")
    extra = pieces.join(keepers, ["group", "check"]).filter("doc_id <> kept").select("doc_id", "copy", "start", "words", "kept").distinct()
    # lines and pieces of them overlap: a run ends where none reaches on
    order = Window.partitionBy("doc_id", "copy").orderBy("start", F.desc("words"), "kept")
    extra = extra.withColumn("end", F.col("start") + F.col("words"))
    fresh = (F.col("start") > F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))).cast("int")
    runs = extra.withColumn("fresh", F.coalesce(fresh, F.lit(1))).withColumn("run", F.sum("fresh").over(order))
    runs = runs.groupBy("doc_id", "copy", "run").agg(
        F.min("start").alias("first_word"), (F.max("end") - F.min("start")).cast("bigint").alias("n_words"),
        F.min(F.struct("start", -F.col("words"), "kept"))["kept"].alias("kept_doc_id"))
    return runs.filter(F.col("n_words") >= least_words).select("doc_id", "first_word", "n_words", "kept_doc_id", "copy")


def _copy():
    return F.xxhash64("text")


def _without(text: str, spans: str):
    def run(batches):
        for batch in batches:
            at, of = batch.schema.get_field_index(text), batch.schema.get_field_index(spans)
            for part in chunks(batch, text):
                texts, words = part.column(at).to_pylist(), words_of(part.column(at))
                for i, cuts in enumerate(part.column(of).to_pylist()):
                    if cuts and texts[i] is not None:
                        starts = words.start[words.first[i]:words.first[i + 1]] - words.base[i]
                        texts[i] = _cut(texts[i].encode(), starts, sorted((c["first_word"], c["n_words"]) for c in cuts))
                columns = [pa.array(texts, pa.string()) if c == at else part.column(c) for c in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return run


def _cut(data: bytes, starts: np.ndarray, spans: list[tuple[int, int]]) -> str:
    kept, done = [], 0
    for first, many in spans:
        if first < len(starts):
            kept.append(data[done:starts[first]])
            done = int(starts[first + many]) if first + many < len(starts) else len(data)
    return (b"".join(kept) + data[done:]).decode()


def cut_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs without the passages, in their own columns; n_chars, if there, is the length of what is left.

    A document of which no word is left goes; one that had no passage is unchanged. Rows without doc_id
    or text are unchanged.
    """
    text, spans, copy = fresh_name(docs, "left_text"), fresh_name(docs, "spans"), fresh_name(docs, "copy")
    cuts = passages.groupBy("doc_id", F.col("copy").alias(copy)).agg(F.collect_list(F.struct("first_word", "n_words")).alias(spans))
    joined = docs.withColumn(text, F.col("text")).withColumn(copy, _copy()).join(cuts, ["doc_id", copy], "left").select(*docs.columns, text, spans)
    left = joined.mapInArrow(_without(text, spans), joined.schema)
    left = left.filter(F.col(spans).isNull() | F.col(text).rlike(r"[^\x20\x09-\x0D]"))

    def column(name: str, kind: str):
        if name == "text":
            return F.col(text).alias(name)
        if name == "n_chars":
            return F.when(F.col(spans).isNull(), F.col(name)).otherwise(F.length(text)).cast(kind).alias(name)
        return F.col(name)

    return left.select(*[column(name, kind) for name, kind in docs.dtypes])


def remove_repeated(docs: DataFrame) -> DataFrame:
    """docs with every repeated passage in one document alone."""
    return cut_passages(docs, repeated_passages(docs))


def query(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
