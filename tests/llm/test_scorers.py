"""The classifiers' features, learning steps and scores against plain Python, a text and a word at a time."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from claimflow.llm import quality, toxicity
from claimflow.llm.words import words_of

MASK = (1 << 64) - 1


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(word):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in word)


def hashed(data):
    """The hash of one word by itself."""
    return int(words_of(pa.array([data]), lower=False).hash[0])


def form(word, again):
    kinds = ["A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 or b >= 128 else "0" if 48 <= b <= 57 else chr(b) for b in word.encode()]
    kept = "".join(k for i, k in enumerate(kinds) if not i or k != kinds[i - 1])
    return (hashed(kept) + again) & MASK


def feature_counts(text):
    """weight index -> times, as the quality classifier reads a text."""
    raw = words(text)
    own = [hashed(lower(w)) for w in raw]
    forms = [form(w, int(i > 0 and lower(w) == lower(raw[i - 1]))) for i, w in enumerate(raw)]
    found = {}
    for kind, values, n in ((1, own, 1), (2, own, 2), (11, forms, 1), (12, forms, 2), (13, forms, 3)):
        for i in range(len(values) - n + 1):
            total = kind
            for value in values[i:i + n]:
                total = mix((total + value) & MASK)
            index = total & (quality.DIMENSION - 1)
            found[index] = found.get(index, 0) + 1
    return found, max(len(raw), 1)


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["Good", "good", "words!", "HERE", "12,5", "x1", "straße", "a-b", "!!!", "YOU", "you", "idiot", "id1ot", "i.d.i.o.t", "loser,", "tú", "the", "of"]
    made = [rng.choice([" ", "  ", "\n"]).join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return made + ["", " \n", "one", "one one one"]


def test_quality_scores():
    rng = np.random.default_rng(3)
    weights, bias = rng.normal(size=quality.DIMENSION), 0.25
    given = [*texts(1, 40), None]
    found = quality._scores(pa.array(given, pa.string()), weights, bias)
    for text, score in zip(given, found):
        counts, n = feature_counts(text)
        assert score == pytest.approx(sigmoid(bias + 8.0 * sum(weights[i] * c for i, c in counts.items()) / n), abs=1e-12)


def test_quality_learning(spark):
    given = texts(2, 60)
    rows = [(i, text, int("good" in text.lower().split())) for i, text in enumerate(given)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    found, bias = quality.fit(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    # one coordinate at a time
    import hashlib
    import zlib

    learned = sorted((hashlib.md5(str(i).encode()).hexdigest(), text, y) for i, text, y in rows if zlib.crc32(str(i).encode()) % 5)
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    examples = []
    for _, text, y in learned:
        counts, many = feature_counts(text)
        examples.append(({**{i: float(np.float32(8.0 * c / many)) for i, c in counts.items()}, quality.DIMENSION: 1.0}, y))
    for _ in range(quality.EPOCHS):
        for x, y in examples:
            p = sigmoid(sum(weight(i) * v for i, v in x.items()))
            for i, v in [(i, v, ) for i, v in x.items()]:
                w, g = weight(i), (p - y) * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality.ALPHA * w
                n[i] = n.get(i, 0.0) + g * g
    expected = {i: weight(i) for i in z if weight(i)}
    assert bias == pytest.approx(expected.pop(quality.DIMENSION, 0.0), abs=1e-3)
    assert {i for i, w in expected.items() if abs(w) > 1e-2} <= set(np.flatnonzero(found).tolist())
    assert all(found[i] == pytest.approx(w, abs=1e-3) for i, w in expected.items())


def letters(word):
    swap = dict(zip("013457@", "oieasta"))
    return "".join(swap.get(c, c) for c in lower(word) if "a" <= swap.get(c, c) <= "z" or ord(c) >= 128)


def test_toxicity_features():
    given = texts(4, 60)
    learned = ["loser", "words"]
    entry = np.concatenate([toxicity._hashes(w) for w in learned])
    weight = np.array([3.0, 2.5])
    order = np.argsort(entry)
    table = toxicity._features(pa.array(given), entry[order], weight[order])
    known = {h: w for h, w in zip(entry.tolist(), weight.tolist())}
    assert len(known) == 2
    listed, you = set(toxicity.INSULTS.split()), set(toxicity.SECOND_PERSON.split())
    for text, row in zip(given, table):
        raw = words(text)
        plain, n = [letters(w) for w in raw], max(len(raw), 1)
        fixed = [p in listed and len(p) > 1 for p in plain]
        whole = [dict(zip(learned, weight)).get(p, 0.0) for p in plain]
        hit = [f or w > 0 for f, w in zip(fixed, whole)]
        yours = [i for i, p in enumerate(plain) if p in you and len(p) > 1]
        near = [h and any(abs(i - j) <= toxicity.NEAR for j in yours) for i, h in enumerate(hit)]
        size = max(len(text.encode()), 1)
        expected = {
            "fixed density": sum(fixed) / n, "fixed hits": sum(fixed), "learned density": sum(w > 0 for w in whole) / n, "learned hits": sum(w > 0 for w in whole),
            "learned weight": sum(whole) / n, "largest weight": max([0.0, *whole]), "beginning density": 0, "beginning hits": 0, "hits near you": sum(near),
            "you density": len(yours) / n, "capitals": sum("A" <= c <= "Z" for c in text) / size, "exclamations": text.count("!") / size,
            "punctuation": sum(32 < ord(c) < 127 and not c.isalnum() for c in text) / size, "length": math.log1p(len(raw)),
        }
        for name, value in expected.items():
            assert row[toxicity.FEATURES.index(name)] == pytest.approx(value, abs=1e-12), (name, text)
