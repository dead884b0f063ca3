"""Words and shingles of whole Arrow text batches as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than space and the five controls 0x09 to 0x0D; only A to Z are
lower-cased. The hash of a word is a polynomial over random byte values modulo 2**64, taken
from prefix sums over the batch, and mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer single text is one chunk of its own. Several numbers
#: are held per byte, so this bounds what a Python worker needs beside its Arrow batch.
CHUNK_BYTES = 256 << 10

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One random odd value per byte.
_VALUE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        steps = np.full(size, _BASE if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * CHUNK_BYTES:
            _powers[kind] = have
    return have[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end)."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUE[data] * _power("up", len(data)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power("down", len(data) + 1)[start])


@dataclass
class Words:
    """Words of a chunk of texts. Text i has words first[i] to first[i + 1]; null texts have none."""

    data: np.ndarray  # bytes, lower-cased if asked for
    raw: np.ndarray  # bytes as they are
    base: np.ndarray  # start byte of each text
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # text number of each word
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = True, hashed: bool = True) -> Words:
    """All words of the texts of a column; their hashes are left 0 if not asked for."""
    raw, offsets = _bytes(column)
    data = _LOWER[raw] if lower else raw
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    if len(inside):
        before[0] = False
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False  # texts don't run into each other
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    if len(inside):
        after[-1] = False
        after[:-1] = inside[1:]
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    value = span_hashes(data, start, end) if hashed and len(start) else np.zeros(len(start), np.uint64)
    return Words(data, raw, offsets[:-1], start, end, text, first, value)


def chunks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most CHUNK_BYTES of text, or a single row."""
    column = batch.column(batch.schema.get_field_index(text))
    _, offsets = _bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        yield batch.slice(row, min(upto, rows) - row)
        row = upto
    pa.default_memory_pool().release_unused()


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, hash) of every run of k words; a text of fewer words is one run of them all."""
    counts = words.counts
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), runs)
    at = np.repeat(words.first[:-1], runs) + _within(runs)
    last = np.minimum(at + k, words.first[1:][text])
    parts = []
    for i in range(k if len(at) else 0):
        here = at + i
        parts.append(np.where(here < last, words.hash[np.minimum(here, len(words.hash) - 1)], np.uint64(i + 1)))
    return text, at, run_hash(parts, len(at))


def run_hash(parts: list[np.ndarray], n: int) -> np.ndarray:
    """One hash per run of n runs; ``parts`` has the hashes of their first words, of their second ones and so on."""
    total = np.zeros(n, np.uint64)
    for part in parts:
        total = total * np.uint64(0xD6E8FEB86659FD93) + part
        total ^= total >> np.uint64(29)
    return mix(total)


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each group of the given sizes."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts)


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct k-word shingles of each text, sorted by both."""
    text, _, value = windows(words, k)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[keep], value[keep]


def group_hashes(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash per run first[i] to first[i + 1] of hashes, that depends on their order."""
    if not len(values):
        return np.zeros(0, np.uint64)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((mix(values) | np.uint64(1)) * _power("up", len(values)), out=sums[1:])
    return mix((sums[first[1:]] - sums[first[:-1]]) * _power("down", len(values) + 1)[first[:-1]] + np.diff(first).astype(np.uint64))
