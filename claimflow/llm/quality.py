"""Quality classifier: logistic regression on hashed word n-grams, learned by follow-the-regularised-leader.

A token is a word with its punctuation. Its form keeps upper case, lower case, digits and symbols
as classes with repeats collapsed, and says whether the token repeats the one before. Features
are word 1- and 2-grams and form 1- to 3-grams, hashed into DIMENSION weights; a value is the
feature's share of the text's tokens. So the score is a sum of weights over the tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.columns import fresh_name
from claimflow.llm.labelled import held_out, training_rows
from claimflow.llm.words import Words, chunks, mix, span_hashes, words_of

DIMENSION = 1 << 18
#: At most so many labelled rows are learned from.
TRAIN_ROWS = 12_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.4, 0.1, 0.002, 0.002
#: Decision threshold of the registered query.
THRESHOLD = 0.3
_SCALE = 8.0

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x41:0x5B] = ord("A")
_CLASS[0x61:0x7B] = ord("a")
_CLASS[0x30:0x3A] = ord("0")
_CLASS[0x80:] = ord("a")


def _forms(words: Words) -> np.ndarray:
    """Hash of the form of each token."""
    kind = _CLASS[words.raw]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[words.start] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    form = span_hashes(kind[keep], place[words.start], place[words.end]) if len(words.start) else words.hash
    again = np.zeros(len(form), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    return form + again.astype(np.uint64)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, weight index) of every occurrence of a feature."""
    texts, index = [], []

    def add(kind: int, value: np.ndarray, n: int) -> None:
        total = np.full(max(len(value) - n + 1, 0), kind, np.uint64)
        for i in range(n):
            total = mix(total + value[i:len(value) - n + 1 + i])
        inside = words.text[:len(total)] == words.text[n - 1:n - 1 + len(total)]
        texts.append(words.text[:len(total)][inside])
        index.append((total[inside] & np.uint64(DIMENSION - 1)).astype(np.int64))

    form = _forms(words)
    for n in (1, 2):
        add(n, words.hash, n)
    for n in (1, 2, 3):
        add(10 + n, form, n)
    return np.concatenate(texts), np.concatenate(index)


def _scores(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    words = words_of(column)
    text, index = features(words)
    total = np.bincount(text, weights=weights[index], minlength=len(column))
    return 1 / (1 + np.exp(-np.clip(bias + _SCALE * total / np.maximum(words.counts, 1), -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias after EPOCHS passes of FTRL-proximal over (indices, values) rows."""
    z, n = np.zeros(DIMENSION + 1), np.zeros(DIMENSION + 1)

    def weight(i):
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for (i, x), y in zip(rows, labels):
            w = weight(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    w = weight(np.arange(DIMENSION + 1))
    return w[:-1], float(w[-1])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bounded sample, in the order of its hash, gives one row of weights."""
    found = []
    for batch in batches:
        for part in chunks(batch, "text"):
            words = words_of(part.column("text"))
            text, index = features(words)
            cell, count = np.unique(text * DIMENSION + index, return_counts=True)
            cut = np.searchsorted(cell, np.arange(part.num_rows + 1) * DIMENSION)
            for r, (order, label) in enumerate(zip(part.column("order").to_pylist(), part.column("label").to_pylist())):
                span = slice(cut[r], cut[r + 1])
                i = np.append(cell[span] % DIMENSION, DIMENSION)
                x = np.append(_SCALE * count[span] / max(words.counts[r], 1), 1.0)
                found.append((order, label, i.astype(np.int32), x.astype(np.float32)))
    found.sort(key=lambda row: (row[0], row[1], len(row[2]), row[2].tobytes()))
    weights, bias = ftrl([row[2:] for row in found], np.array([row[1] for row in found], float))
    kept = np.flatnonzero(weights)
    yield pa.RecordBatch.from_pydict({"bias": [bias], "index": [kept], "weight": [weights[kept]]}, schema=_MODEL)


_MODEL = pa.schema([("bias", pa.float64()), ("index", pa.list_(pa.int64())), ("weight", pa.list_(pa.float64()))])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights (DIMENSION of them) and bias, learned in one task from at most ``bound`` labelled rows.

    Without labelled rows all weights are 0, and every score is 0.5.
    """
    rows = training_rows(docs, labels, label, bound).repartition(1)
    model = rows.mapInArrow(_fit, "bias double, index array<bigint>, weight array<double>").collect()
    weights = np.zeros(DIMENSION)
    for row in model:
        weights[row["index"]] = row["weight"]
    return weights, model[0]["bias"] if model else 0.0


def score(docs: DataFrame, model: tuple[np.ndarray, float], name: str = "score") -> DataFrame:
    """docs with one more column: the probability of label 1. NULL and empty texts get the bias alone.

    docs must have text; every other column is passed on, and a column called ``name`` is replaced.
    Repeated rows get equal scores; an empty table stays empty.
    """
    weights, bias = model[0].astype(np.float32), model[1]
    kept = docs.drop(name)
    schema = kept.select("*", F.lit(0.0).alias(name)).schema
    at = [c.lower() for c in kept.columns].index("text")

    def run(batches):
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])  # names may repeat
            for part in chunks(named, f"c{at}"):
                values = _scores(part.column(at), weights, bias)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], names=schema.names)

    return kept.mapInArrow(run, schema)


def reject_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = TRAIN_ROWS) -> DataFrame:
    """The documents with a score of ``threshold`` or more, with their own columns."""
    name = fresh_name(docs, "quality_score")
    return score(docs, fit(docs, labels, bound=bound), name).filter(F.col(name) >= threshold).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
