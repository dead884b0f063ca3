"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Windows of WINDOW template words meet the windows of benchmark items by hash, and are compared
word by word. What stands in the placeholders must then agree: within an occurrence of the item, each
value of the item has one counterpart, as in a question that was only given other numbers and names.
A document is contaminated by an item if enough of the item's windows are in it. A document may hold
an item several times, each time with other values, so occurrences are told apart by position.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.scratch import save
from claimflow.llm.words import Words, chunks, group_hashes, mix, run_hash, span_hashes, windows, words_of

WINDOW = 6
#: A window needs so many words that are no placeholders.
LEAST_LITERALS = 3
#: Share of an item's windows, and of its slot values that have one counterpart.
LEAST_SHARE, LEAST_CONSISTENT = 0.5, 0.8
#: Bits of the fixed-size filter through which a document's windows go before they are shuffled.
FILTER_BITS = 1 << 23

NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
)
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces pound pounds "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes min hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees volt volts watt watts meter meters metre metres kilometers kilometres centimeters"
)
_LITERAL, _NUMBER, _NAME, _UNIT = 0, 1, 2, 3
#: A capitalised word that begins a sentence, read as a name.
_START = 4
#: How a window is looked for, and the sizes of items that have no full one.
_PATTERN, _EXACT, SHORT = 0, 1, tuple(range(1, WINDOW))

_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWERCASE = np.zeros(256, bool)
_LOWERCASE[0x61:0x7B] = True
_LOWERCASE[0x80:] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?:;")] = True


#: Digits and lower-case letters of a byte, as two counts in one number; capitals apart.
_COUNTED = _DIGIT.astype(np.int64) + (_LOWERCASE.astype(np.int64) << 32)
_CAPITALS = _UPPER.astype(np.int64)
#: What can be read as names of a window's capitalised words at the start of sentences: the non-empty parts of each set.
_READINGS = [[part for part in range(1, 1 << WINDOW) if part & whole == part] for whole in range(1 << WINDOW)]
_READING_COUNT = np.array([len(parts) for parts in _READINGS])
_READING_START = np.concatenate([[0], np.cumsum(_READING_COUNT)[:-1]])
_READING_LIST = np.array([part for parts in _READINGS for part in parts], np.int64)
_ONES = np.array([part.bit_count() for part in range(1 << WINDOW)])


def _literal_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the letters and digits of each word, their number)."""
    keep = _DIGIT[words.data] | _LOWERCASE[words.data]
    place = np.concatenate([[0], np.cumsum(keep)])
    start, end = place[words.start], place[words.end]
    return (span_hashes(words.data[keep], start, end) if len(start) else words.hash), end - start


def _known(listed: str) -> np.ndarray:
    return np.sort(_literal_hashes(words_of(pa.array([listed]), hashed=False))[0])


def _in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def template(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words with template hashes, literal hashes, types, whether it may also be a name). Words of symbols alone are left out."""
    words = words_of(column, hashed=False)
    literal, size = _literal_hashes(words)
    kind, either = np.full(len(literal), _LITERAL, np.int64), np.zeros(len(literal), bool)
    if len(literal):
        def count(values):
            sums = np.concatenate([[0], np.cumsum(values[words.raw])])
            return sums[words.end] - sums[words.start]

        digits, small = np.divmod(count(_COUNTED), 1 << 32)[::-1]
        number = ((digits > 0) & (size - digits <= 3)) | _in(literal, _NUMBERS)
        capital = _UPPER[words.raw[words.start]] & (small > 0) & (count(_CAPITALS) == 1)
        follows = np.zeros(len(literal), bool)  # inside a sentence
        breaks = np.searchsorted(np.flatnonzero(words.raw == 0x0A), words.start)
        follows[1:] = (words.text[1:] == words.text[:-1]) & ~_ENDS[words.raw[words.end[:-1] - 1]] & (breaks[1:] == breaks[:-1])
        kind[capital & follows] = _NAME
        kind[number] = _NUMBER
        after = np.zeros(len(literal), bool)
        after[1:] = number[:-1] & (words.text[1:] == words.text[:-1])
        kind[after & ~number & _in(literal, _UNITS)] = _UNIT
        either = capital & (kind == _LITERAL)
    keep = size > 0
    literal, kind, either, text = literal[keep], kind[keep], either[keep], words.text[keep]
    first = np.searchsorted(text, np.arange(len(column) + 1))
    hashes = np.where(kind == _LITERAL, literal, mix(kind.astype(np.uint64)))
    return replace(words, start=words.start[keep], end=words.end[keep], text=text, first=first, hash=hashes), literal, kind, either


_NUMBERS, _UNITS = _known(NUMBERS), _known(UNITS)
_AS_NAME = mix(np.array([_NAME], np.uint64))[0]


def _windows(column: pa.Array, short: tuple[int, ...] = (), passes=None, item: bool = False):
    """(text, place in the text, hash, literals, types, size, text digests) of the windows of texts, one row per window and reading.

    A full window with enough literals is there by its template. A capitalised word that begins a sentence may be a name,
    so the window is there under every reading of these words. A full window with fewer literals is there by its own words, and so is
    every run of one of the ``short`` sizes. A window of an ``item`` is there by its own words, too, if names may leave it with fewer literals:
    what begins the item may stand inside a sentence elsewhere. literals and types have WINDOW columns, beyond the size of a run zeros.
    ``passes`` tells by the hashes which windows are wanted at all.
    """
    words, literal, kind, either = template(column)
    text, at, value = windows(words, WINDOW)
    full = words.counts[text] >= WINDOW
    text, at, value = text[full], at[full], value[full]
    literals = np.concatenate([[0], np.cumsum(kind == _LITERAL)])
    spare = literals[at + WINDOW] - literals[at] - LEAST_LITERALS
    enough = np.flatnonzero(spare >= 0)
    found = [(WINDOW, _PATTERN, text[enough], at[enough], value[enough], np.zeros(len(enough), np.int64))]
    open_ = np.zeros(len(at), np.int64)
    if either.any():
        for i in range(WINDOW if len(at) else 0):
            open_ |= either[at + i].astype(np.int64) << i
        some = np.flatnonzero((open_ > 0) & (spare > 0))
        many = _READING_COUNT[open_[some]]
        row = np.repeat(some, many)
        reading = _READING_LIST[np.repeat(_READING_START[open_[some]] - np.concatenate([[0], np.cumsum(many)])[:-1], many) + np.arange(len(row))]
        right = spare[row] >= _ONES[reading]
        row, reading = row[right], reading[right]
        parts = [np.where((reading >> i) & 1 == 1, _AS_NAME, words.hash[at[row] + i]) for i in range(WINDOW if len(row) else 0)]
        found.append((WINDOW, _PATTERN, text[row], at[row], run_hash(parts, len(row)), reading))
    few = spare < (_ONES[open_] if item else 0)
    found.append((WINDOW, _EXACT, *_exact(literal, text[few], at[few], WINDOW)))
    for size in short:
        run, start, _ = windows(words, size)
        whole = words.counts[run] >= size
        found.append((size, _EXACT, *_exact(literal, run[whole], start[whole], size)))
    if passes is not None:
        wanted = [passes(one[4]) for one in found]
        found = [(size, how, *(part[keep] for part in parts)) for (size, how, *parts), keep in zip(found, wanted)]
    size, how = (np.repeat([one[i] for one in found], [len(one[2]) for one in found]) for i in (0, 1))
    text, at, value, reading = (np.concatenate([one[i] for one in found]) for i in (2, 3, 4, 5))
    inside = np.minimum(at[:, None] + np.arange(WINDOW), max(len(literal) - 1, 0))
    here = np.arange(WINDOW) < size[:, None]
    nothing = np.zeros((0, WINDOW), np.int64)
    taken = np.where(here, literal[inside], np.uint64(0)) if len(at) else nothing.astype(np.uint64)
    types = np.where((reading[:, None] >> np.arange(WINDOW)) & 1 == 1, _START, kind[inside]) if len(at) else nothing
    types = np.where((how == _PATTERN)[:, None], types, _LITERAL)
    return text, at - words.first[text], value, taken, types, np.where(how == _PATTERN, 0, size), words.counts, _digests(literal, words)


def _exact(literal: np.ndarray, text: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(text, first word, hash, no reading) of runs of ``size`` words, by the words themselves."""
    value = run_hash([literal[at + i] for i in range(size if len(at) else 0)], len(at))
    return text, at, mix(value + np.uint64(size)), np.zeros(len(at), np.int64)


def _digests(literal: np.ndarray, words: Words) -> np.ndarray:
    return group_hashes(literal, words.first) if len(literal) else np.zeros(len(words.first) - 1, np.uint64)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, WINDOW, dtype=np.int32), pa.array(values.ravel().view(np.int64)))


def _item_windows(batches):
    """The windows of items: by template; for an item without any of these by its own words; for a short one as a whole."""
    for batch in batches:
        for part in chunks(batch, "text"):
            text, place, value, taken, types, size, counts, _ = _windows(part.column("text"), SHORT, item=True)
            by_template = np.bincount(text[size == 0], minlength=len(counts)) > 0
            spot = text * (1 << 32) + place
            own = (size == np.minimum(counts, WINDOW)[text]) & (~by_template[text] | np.isin(spot, spot[size == 0]))
            keep = (size == 0) | own
            yield pa.RecordBatch.from_pydict({
                "item_id": part.column("item_id").take(pa.array(text[keep])), "place": place[keep], "hash": value[keep].view(np.int64),
                "words": _lists(taken[keep]), "types": _lists(types[keep]), "size": size[keep],
            })


def _document_windows(bits: np.ndarray, short: tuple[int, ...]):
    def passes(value: np.ndarray) -> np.ndarray:
        bit = (value & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        return (bits[bit >> 6] >> (bit & 63)) & 1 == 1

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                text, place, value, taken, types, _, _, digest = _windows(part.column("text"), short, passes)
                yield pa.RecordBatch.from_pydict({
                    "key": part.column("key").take(pa.array(text)), "copy": digest[text].view(np.int64), "at": place,
                    "hash": value.view(np.int64), "found": _lists(taken), "plain": pa.array((types != _START).all(axis=1)),
                })

    return run


def _key(docs: DataFrame):
    """What names a document: its id, or for rows without one the digest of the text."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5("text")))


def _occurrences(covered: DataFrame) -> DataFrame:
    """The windows of a document and item by what may be an occurrence, a struct: the whole document, a diagonal or a pass.

    On a diagonal, places of document and item differ by a constant, so it has each of the item's
    windows once at most. A pass follows a text as long as the item's places grow: it also holds
    occurrences with words more or less than the item, of which several diagonals have a part.
    """
    def named(windows: DataFrame, kind: str, copy, number):
        group = F.struct(F.lit(kind).alias("kind"), copy.alias("copy"), number.cast("bigint").alias("number"))
        return windows.select("key", "item_id", group.alias("occurrence"), "place", "slots")

    text = ["key", "copy", "item_id"]
    placed = covered.withColumn("diagonal", F.col("at") - F.col("place"))
    # of several places that a window has in the item, the one on the longest diagonal
    counted = placed.withColumn("together", F.count("*").over(Window.partitionBy(*text, "diagonal")))
    best = Window.partitionBy(*text, "at").orderBy(F.desc("together"), "place")
    single = counted.withColumn("turn", F.row_number().over(best)).filter("turn = 1")
    order = Window.partitionBy(*text).orderBy("at")
    back = F.coalesce((F.col("place") <= F.lag("place").over(order)).cast("int"), F.lit(0))
    passes = single.withColumn("back", back).withColumn("pass", F.sum("back").over(order))
    whole = named(covered, "document", F.lit(0).cast("bigint"), F.lit(0))
    return whole.union(named(placed, "diagonal", F.col("copy"), F.col("diagonal"))).union(named(passes, "pass", F.col("copy"), F.col("pass")))


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = LEAST_SHARE, consistent: float = LEAST_CONSISTENT) -> DataFrame:
    """(key, item_id, windows, of, share, slots, consistent) per document and item that contaminates it.

    docs has doc_id and text, benchmark a bigint item_id and text; other columns are ignored. ``of``
    counts the item's windows, ``windows`` those in an occurrence, ``slots`` the item's different
    slot values in them and ``consistent`` the share of these with a single counterpart (1 without
    slots). The whole document is judged as one occurrence, and so is each occurrence in it by its
    position (``_occurrences``); one that passes is enough, and the figures are those of the one
    with most windows. An item of which no window has LEAST_LITERALS words that are no placeholders is looked for by its own words,
    and one of fewer than WINDOW words as a whole. NULL or empty texts contaminate nothing. Rows of docs with one doc_id are one document. Empty tables give an empty table.

    A document's windows pass a filter of FILTER_BITS bits made of the items' hashes (its size
    is fixed, whatever the benchmark's), so few are shuffled. The join then has no hint.
    """
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    listed = save(items.mapInArrow(
        _item_windows, "item_id bigint, place bigint, hash bigint, words array<bigint>, types array<bigint>, size bigint"), "items")
    short = tuple(sorted(row["size"] for row in listed.filter(F.col("size").between(1, WINDOW - 1)).select("size").distinct().collect()))  # some of SHORT
    low = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1))
    masks = listed.select(F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("mask"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for row in masks.groupBy("word").agg(F.bit_or("mask").alias("mask")).collect():  # at most FILTER_BITS / 64 rows
        bits[row["word"]] = row["mask"]
    texts = docs.select(_key(docs).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    seen = texts.mapInArrow(_document_windows(bits, short), "key string, copy bigint, at bigint, hash bigint, found array<bigint>, plain boolean")
    seen = save(seen.dropDuplicates(["key", "copy", "at", "hash", "plain"]), "seen")
    place = F.arrays_zip("words", "found", "types")
    # the words outside the placeholders are the same, not just their hash
    same = F.forall(place, lambda w: (w["types"] != _LITERAL) | (w["words"] == w["found"]))
    of = listed.groupBy("item_id").agg(F.countDistinct("place").alias("of"))
    # no occurrence has more windows than its document: only documents with enough are looked at by position
    pairs = seen.select("key", "hash", "found").distinct().join(listed, "hash").filter(same)
    counted = pairs.groupBy("key", "item_id").agg(F.countDistinct("place").alias("windows")).join(of, "item_id")
    enough = save(counted.filter(F.col("windows") / F.col("of") >= share).select("key", "item_id"), "enough")
    slots = F.transform(F.filter(place, lambda w: w["types"] != _LITERAL), lambda w: F.struct(
        w["words"].alias("item"), w["found"].alias("text"), ((w["types"] != _START) | (w["words"] != w["found"])).alias("sure")))
    held = seen.join(listed, "hash").filter(same).join(enough, ["key", "item_id"], "left_semi")
    plain = F.col("plain") & F.forall("types", lambda t: t != _START)
    covered = save(held.select("key", "copy", "item_id", "at", "place", slots.alias("slots"), plain.alias("plain")), "covered")
    one = ["key", "item_id", "occurrence"]
    # a window without a name at the start of a sentence counts by itself, too: further readings only add to what is found
    every, only = _occurrences(covered), _occurrences(covered.filter("plain"))
    occurrences = every.withColumn("occurrence", F.struct(F.lit("all").alias("readings"), "occurrence")).union(
        only.withColumn("occurrence", F.struct(F.lit("plain").alias("readings"), "occurrence")))
    counted = occurrences.groupBy(*one).agg(F.countDistinct("place").alias("windows"))
    values = occurrences.select(*one, F.explode("slots").alias("slot")).groupBy(*one, "slot.item").agg(
        F.countDistinct("slot.text").alias("count"), F.max("slot.sure").alias("sure"))
    # a word that only begins sentences and is the same in both is no slot
    values = values.filter("sure")
    values = values.groupBy(*one).agg(F.count("*").alias("slots"), F.avg((F.col("count") == 1).cast("double")).alias("consistent"))
    found = counted.join(of, "item_id").withColumn("share", F.col("windows") / F.col("of")).filter(F.col("share") >= share)
    judged = found.join(values, one, "left").fillna({"slots": 0, "consistent": 1.0}).filter(F.col("consistent") >= consistent)
    best = judged.groupBy("key", "item_id").agg(F.max(F.struct("share", "consistent", "slots", "windows", "of")).alias("best"))
    return best.select("key", "item_id", "best.windows", "best.of", "best.share", "best.slots", "best.consistent")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no benchmark item contaminates, with their own columns."""
    bad = contaminated(docs, benchmark).select("key").distinct()
    return docs.join(bad, _key(docs) == bad.key, "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(docs, benchmark)
    return found.select(F.expr("try_cast(key AS bigint)").alias("doc_id"), "item_id", "windows", "of", "share", "slots", "consistent")
