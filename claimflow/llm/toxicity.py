"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Words are compared as letters only, with digits that stand for letters read as these. The
lexicon is a short fixed list and the words and word beginnings that a bounded sample of
labelled rows shows mainly in toxic texts; occurrences count once per pair of neighbours, so
that copies of one text teach nothing twice. Features per text: lexicon densities and counts,
hits near a word for "you", shares of capitals, punctuation and disguised words, and length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.columns import fresh_name
from claimflow.llm.labelled import held_out, training_rows
from claimflow.llm.scratch import save
from claimflow.llm.words import Words, chunks, mix, span_hashes, words_of

#: At most so many labelled rows are learned from.
TRAIN_ROWS = 12_000
#: At most so many learned lexicon entries.
ENTRIES = 4_000
#: An entry needs so many different neighbourhoods in toxic texts, and this log odds ratio.
LEAST_SEEN, LEAST_ODDS = 6, 2.0
BEGINNINGS = (4, 5, 6)
NEAR = 5
INSULTS = (
    "clown disgusting dumb fool idiot idiotic jerk loser moron moronic pathetic scum stupid trash worthless "
    "abschaum dumm dummkopf idiotisch trottel versager wertlos con connard débile minable nul ordure "
    "basura estúpido imbécil inútil patético tonto"
)
SECOND_PERSON = "you your yours yourself ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes eres vosotros"

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[0x41:0x5B] += 0x20
for _from, _to in zip(b"013457@", b"oieasta"):  # digits that stand for letters
    _LETTERS[_from] = _to
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[ord("a"):ord("z") + 1] = True
_IS_LETTER[0x80:] = True
_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 other
_KIND[:] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = 1


def _plain(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters of all words in a row, start, end)."""
    data = _LETTERS[words.raw]
    keep = _IS_LETTER[data]
    place = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], place[words.start], place[words.end]


def _entries(words: Words) -> list[np.ndarray]:
    """Per word: the hash of its letters and of its beginnings, 0 where it is too short."""
    data, start, end = _plain(words)
    if not len(start):
        return [words.hash] * (1 + len(BEGINNINGS))
    out = [np.where(end - start > 1, span_hashes(data, start, end), 0)]
    for n in BEGINNINGS:
        out.append(np.where(end - start >= n, mix(span_hashes(data, start, np.minimum(start + n, end)) + np.uint64(n)), 0))
    return out


def _hashes(listed: str) -> np.ndarray:
    found = np.unique(_entries(words_of(pa.array([listed])))[0])
    return found[found != 0]  # 0 stands for words that are too short


def _neighbours(words: Words) -> np.ndarray:
    before, after = np.zeros_like(words.hash), np.zeros_like(words.hash)
    before[1:] = np.where(words.text[1:] == words.text[:-1], words.hash[:-1], 0)
    after[:-1] = np.where(words.text[1:] == words.text[:-1], words.hash[1:], 0)
    return mix(before * np.uint64(3) + after)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bounded sample gives (entry, weight) rows: entries of toxic texts first, then their other occurrences."""
    parts = [part for batch in batches for part in chunks(batch, "text")]
    wanted = np.zeros(0, np.uint64)
    seen, totals = {}, {}
    for label in (1, 0):
        pairs, total = [np.zeros((0, 2), np.uint64)], 0
        for part in parts:
            rows = part.filter(pa.compute.equal(part.column("label"), label))
            words = words_of(rows.column("text"))
            around = _neighbours(words)
            total += len(around)
            for value in _entries(words):
                ok = value != 0
                if label == 0:
                    ok &= _member(value, wanted)[0]
                pairs.append(np.unique(np.stack([value[ok], around[ok]], axis=1), axis=0))
        found = np.unique(np.concatenate(pairs), axis=0)[:, 0]
        value, count = np.unique(found, return_counts=True)
        if label:
            wanted, count = value[count >= LEAST_SEEN], count[count >= LEAST_SEEN]
            value = wanted
        seen[label], totals[label] = dict(zip(value.tolist(), count.tolist())), total
    odds = [
        (np.log((n + 0.5) / (totals[1] + 1)) - np.log((seen[0].get(value, 0) + 0.5) / (totals[0] + 1)), value) for value, n in seen[1].items()
    ]
    best = sorted(((w, value) for w, value in odds if w >= LEAST_ODDS), reverse=True)[:ENTRIES]
    yield pa.RecordBatch.from_pydict({
        "entry": pa.array(np.array([value for _, value in best], np.uint64).view(np.int64)), "weight": pa.array([float(w) for w, _ in best], pa.float64()),
    })


def _member(value: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is known, where) for sorted known values."""
    if not len(known):
        return np.zeros(len(value), bool), np.zeros(len(value), np.int64)
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    return known[at] == value, at


FEATURES = (
    "fixed density", "fixed hits", "learned density", "learned hits", "learned weight", "largest weight", "beginning density",
    "beginning hits", "hits near you", "you density", "capitals", "exclamations", "punctuation", "disguised", "disguised hits", "length",
)


def _features(column: pa.Array, entry: np.ndarray, weight: np.ndarray) -> np.ndarray:
    words = words_of(column)
    n, many = len(column), np.maximum(words.counts, 1).astype(float)

    def per_text(values):
        return np.bincount(words.text, weights=values, minlength=n)

    forms = _entries(words)
    fixed = _member(forms[0], _FIXED)[0]
    weights = []
    for value in forms:
        known, at = _member(value, entry)
        weights.append(np.where(known, weight[at] if len(weight) else 0.0, 0.0))
    whole, begun = weights[0], np.max(weights[1:], axis=0)
    any_weight = np.maximum(whole, begun)
    hit = fixed | (any_weight > 0)
    you = _member(forms[0], _YOU)[0]
    at_you = np.flatnonzero(you)
    near = np.zeros(len(hit), bool)
    if len(at_you) and hit.any():
        place = np.flatnonzero(hit)
        for side in (0, 1):
            other = at_you[np.clip(np.searchsorted(at_you, place) - side, 0, len(at_you) - 1)]
            near[place] |= (np.abs(other - place) <= NEAR) & (words.text[other] == words.text[place])
    largest = np.zeros(n)
    np.maximum.at(largest, words.text[any_weight > 0], any_weight[any_weight > 0])
    # disguised: a digit or symbol between letters
    kind = _KIND[words.raw]
    between = np.zeros(len(kind) + 1, np.int64)
    if len(kind) > 2:
        inner = np.zeros(len(kind), bool)
        inner[1:-1] = (kind[1:-1] != 1) & (kind[:-2] == 1) & (kind[2:] == 1) & ~np.isin(words.raw[1:-1], _JOINERS)
        between[1:] = np.cumsum(inner)
    disguised = (between[np.maximum(words.end - 1, 0)] - between[np.minimum(words.start + 1, len(kind))]) > 0

    def bytes_share(mark):
        total = np.concatenate([[0], np.cumsum(mark)])
        ends = np.append(words.base, len(words.raw))
        return (total[ends[1:]] - total[ends[:-1]]) / np.maximum(np.diff(ends), 1)

    upper = (words.raw >= 0x41) & (words.raw <= 0x5A)
    return np.stack([
        per_text(fixed) / many, per_text(fixed), per_text(whole > 0) / many, per_text(whole > 0), per_text(any_weight) / many, largest,
        per_text(begun > 0) / many, per_text(begun > 0), per_text(near), per_text(you) / many, bytes_share(upper), bytes_share(words.raw == 0x21),
        bytes_share((words.raw < 0x80) & (kind == 3) & (words.raw > 0x20)), per_text(disguised) / many, per_text(disguised & hit), np.log1p(words.counts),
    ], axis=1)


_JOINERS = np.frombuffer(b" \t\n\r\x0b\x0c-'./_,", np.uint8)
_FIXED, _YOU = _hashes(INSULTS), _hashes(SECOND_PERSON)


def dense_features(docs: DataFrame, lexicon: tuple[np.ndarray, np.ndarray], name: str = "features") -> DataFrame:
    """docs (with text) and one more column, a vector of FEATURES. NULL texts count as empty."""
    entry, weight = lexicon
    schema = docs.select("*", F.lit(None).cast("array<double>").alias(name)).schema
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in chunks(named, f"c{at}"):
                table = _features(part.column(at), entry, weight)
                lists = pa.ListArray.from_arrays(np.arange(0, table.size + 1, len(FEATURES), dtype=np.int32), table.ravel())
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=schema.names)

    return docs.mapInArrow(run, schema).withColumn(name, array_to_vector(name))


Model = tuple[tuple[np.ndarray, np.ndarray], GBTClassificationModel | None, IsotonicRegressionModel | None, float]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = TRAIN_ROWS) -> Model:
    """Lexicon, trees and calibration from at most ``bound`` labelled rows; a quarter of them calibrates.

    With fewer than two classes there are no trees: the score is the share of label 1, or 0.5
    without any labelled row.
    """
    sample = save(training_rows(docs, labels, label, bound), "toxic-sample")
    learned = sample.repartition(1).mapInArrow(_learn, "entry bigint, weight double").collect()  # at most ENTRIES rows
    entry = np.array([row["entry"] for row in learned], np.int64).view(np.uint64)
    order = np.argsort(entry)
    lexicon = entry[order], np.array([row["weight"] for row in learned], float)[order]
    rows = save(
        dense_features(sample.select("order", "label", "text"), lexicon).select("order", "label", vector_to_array("features").alias("array")),
        "toxic-features",
    )
    counts = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return lexicon, None, None, float(next(iter(counts))) if counts else 0.5
    rows = rows.repartition(1).sortWithinPartitions("order").withColumn("features", array_to_vector("array"))
    calibrating = F.substring("order", 1, 1).isin("0", "1", "2", "3")  # a quarter, by hash of the id
    learning = rows.filter(~calibrating)
    if learning.select("label").distinct().count() < 2:
        learning = rows
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3, seed=1, maxBins=64).fit(learning)
    raw = trees.transform(rows.filter(calibrating)).select("label", vector_to_array("probability")[1].alias("raw"))
    steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw) if raw.head(1) else None
    return lexicon, trees, steps, 0.0


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with one more column, the calibrated probability of label 1, from 0 to 1.

    docs must have text; NULL and empty texts have all features 0 and are scored. Repeated rows
    get equal scores; an empty table stays empty. A column called ``name`` is replaced.
    """
    lexicon, trees, steps, constant = model
    kept = docs.drop(name)
    if trees is None:
        return kept.withColumn(name, F.lit(constant))
    features, margin, parts, raw, label, value = (fresh_name(kept, n) for n in ("features", "margin", "parts", "raw", "label", "value"))
    trees = trees.copy().setFeaturesCol(features).setRawPredictionCol(margin).setProbabilityCol(parts).setPredictionCol(label)
    scored = trees.transform(dense_features(kept, lexicon, features)).withColumn(raw, vector_to_array(parts)[1])
    if steps is None:
        value = raw
    else:
        scored = steps.copy().setFeaturesCol(raw).setPredictionCol(value).transform(scored)
    return scored.select(*kept.columns, F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)).alias(name))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
