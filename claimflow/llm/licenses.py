"""License scans: MinHash bands over overlapping text windows find templates, exact containment confirms them.

DataFrame functions only. Words are runs of a-z and 0-9 after lower-casing A to Z; a shingle is SHINGLE of
them. A template of T words belongs to the smallest window size W >= 2 T. Windows of W words start
every W / 2 words, so that a template's text lies in one of them as a whole. Windows and templates
of one size meet on any of BANDS minimum hashes; ``chance`` gives the probability. A template is
in a text if one window holds LEAST of its shingles.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.scratch import save

SHINGLE = 5
BANDS = 32
LEAST = 0.8
#: Bits of the fixed-size filter that keeps texts without any template shingle out of the windows.
FILTER_BITS = 1 << 20

#: Notices and characteristic sentences of public licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)


_LOWER = {code: code + 32 for code in range(65, 91)}


def sizes(words: int) -> list[int]:
    """Window sizes up to one for a template of so many words, about a factor of the root of 2 apart."""
    found = [10, 14]
    while found[-1] < 2 * words:
        found.append(2 * found[-2])
    return found


def chance(words: int) -> float:
    """The probability that a window with LEAST of the shingles of a template of so many words meets it."""
    size = next(s for s in sizes(words) if s >= 2 * words)
    own, window = words - SHINGLE + 1, size - SHINGLE + 1
    held = -(-own * LEAST // 1)
    return 1 - (1 - held / (own + window - held)) ** BANDS


def _shingles(text: Column) -> Column:
    """Hashes of the shingles of a text, one per place; none with fewer than SHINGLE words."""
    plain = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.transform(F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), F.lit(0)), lambda w: F.xxhash64(w))
    # a lambda binds the words once per text
    each = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))
    found = F.transform(F.array(words), lambda w: F.when(F.size(w) >= SHINGLE, each(w)).otherwise(F.array().cast("array<bigint>")))
    return F.get(found, F.lit(0))


def _keys(shingles: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda band: F.xxhash64(band, F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, band)))))


def templates_table(spark, templates=TEMPLATES) -> DataFrame:
    """(template, license, size, shingles, keys) per template, however long. One of fewer than SHINGLE words has no shingle and is refused."""
    lengths = [len(re.findall("[a-z0-9]+", text.translate(_LOWER))) for _, text in templates]
    if short := [text for (_, text), length in zip(templates, lengths) if length < SHINGLE]:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    listed = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text")) for i, (name, text) in enumerate(templates)])
    rows = spark.range(1).select(F.inline(listed)).withColumn("all", _shingles(F.col("text"))).filter(F.size("all") > 0)
    room = 2 * (F.size("all") + SHINGLE - 1)
    size = F.array_min(F.filter(F.array(*[F.lit(s) for s in sizes(max(lengths, default=0))]), lambda s: s >= room))
    rows = rows.withColumn("size", size).withColumn("shingles", F.array_distinct("all"))
    return rows.select("template", "license", "size", "shingles", _keys(F.col("shingles")).alias("keys"))


def _filter(known: DataFrame) -> tuple[Column, list[int]]:
    """(bits as an array of longs, the sizes in use) of the template shingles: two bits for each."""
    bits = known.select(F.explode("shingles").alias("s")).select(F.explode(F.array(*_bits(F.col("s")))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
    masks = [0] * (FILTER_BITS // 64)
    for row in words.collect():  # at most FILTER_BITS / 64 rows
        masks[row["word"]] = row["mask"]
    used = sorted(row["size"] for row in known.select("size").distinct().collect())  # about two for each doubling of the longest template
    # one literal, which Spark folds into an array
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>"), used


def _bits(shingle: Column) -> list[Column]:
    return [_right(shingle, F.lit(shift)).bitwiseAND(F.lit(FILTER_BITS - 1)) for shift in (0, 32)]


def _right(value: Column, by: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, by)


def scan(docs: DataFrame, known: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per document row and license in it: doc_id, license, containment, first_word, windows.

    docs has doc_id and text; other columns are ignored. ``containment`` is the largest share of a
    template's shingles in one window, ``first_word`` the start of the first such window, ``windows`` their number.
    Only texts with a license have rows. NULL, empty and short texts have no shingles and no rows.
    Rows with one doc_id each have their own result; a NULL doc_id stays NULL. Empty tables give
    an empty table.
    """
    bits, used = _filter(known)

    def passes(s: Column) -> Column:
        word = lambda bit: F.get(bits, F.shiftright(bit, 6).cast("int"))
        tests = [_right(word(bit), bit.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1 for bit in _bits(s)]
        return F.coalesce(tests[0] & tests[1], F.lit(False))

    texts = docs.select("doc_id", "text", _shingles(F.col("text")).alias("all"))
    places = F.filter(F.transform("all", lambda s, i: F.when(passes(s), i)), lambda i: i.isNotNull())
    held = texts.select("doc_id", "all", places.alias("places")).filter(F.size("places") > 0)

    def windows(size: int) -> Column:
        step = size // 2
        near = F.array_distinct(F.flatten(F.transform("places", lambda p: F.array(F.floor(p / step), F.floor(p / step) - 1))))
        inside = F.filter(near, lambda i: i >= 0)
        return F.transform(inside, lambda i: F.struct(
            F.lit(size).alias("size"), (i * step).cast("bigint").alias("start"),
            F.array_distinct(F.slice("all", (i * step + 1).cast("int"), F.lit(size - SHINGLE + 1))).alias("held")))

    listed = F.concat(*[windows(size) for size in used]) if used else F.array().cast("array<struct<size:int,start:bigint,held:array<bigint>>>")
    numbered = held.select(F.monotonically_increasing_id().alias("row"), "doc_id", listed.alias("listed"))
    found = numbered.select("row", "doc_id", F.explode("listed").alias("w")).select("row", "doc_id", "w.*")
    found = save(found.filter(F.size("held") > 0).withColumn("keys", _keys(F.col("held"))), "windows")
    meeting = found.select("row", "start", "size", F.explode("keys").alias("key")).join(
        known.select("template", "size", F.explode("keys").alias("key")), ["size", "key"]).select("row", "start", "size", "template").distinct()
    share = F.size(F.array_intersect("shingles", "held")) / F.size("shingles")
    confirmed = meeting.join(found.select("row", "start", "size", "doc_id", "held"), ["row", "start", "size"]).join(
        known.select("template", "license", "shingles"), "template").withColumn("share", share).filter(F.col("share") >= least)
    return confirmed.groupBy("row", "doc_id", "license").agg(
        F.max("share").alias("containment"), F.min("start").alias("first_word"), F.countDistinct("start", "size").alias("windows"),
    ).select("doc_id", "license", "containment", "first_word", "windows")


def query(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), templates_table(spark))
    return found.select("doc_id", "license", "containment")


#: Every window against every template.
SQL = r"""
WITH templates AS (SELECT * FROM (VALUES %s) t(template, license, text)),
words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS w
  FROM documents),
known AS (
  SELECT template, license, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS w FROM templates),
sized AS (
  SELECT *, list_min(list_filter([10, 14, 20, 28, 40, 56, 80, 112, 160, 224, 320, 448], lambda s: s >= 2 * len(w))) AS size FROM known WHERE len(w) >= 5),
theirs AS MATERIALIZED (
  SELECT DISTINCT template, license, size, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM sized),
counts AS (SELECT template, count(*) AS n FROM theirs GROUP BY template),
ours AS MATERIALIZED (
  SELECT doc_id, unnest(range(0, len(w) - 4)) AS p, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM words WHERE len(w) >= 5),
hits AS MATERIALIZED (SELECT doc_id, p, template, license, size, g FROM ours JOIN theirs USING (g)),
placed AS (
  SELECT *, unnest([p // (size // 2), p // (size // 2) - 1]) AS i FROM hits),
held AS (
  SELECT doc_id, template, license, i, count(DISTINCT g) AS c FROM placed
  WHERE i >= 0 AND p >= i * (size // 2) AND p + 5 <= i * (size // 2) + size GROUP BY ALL)
SELECT doc_id, license, max(c / n) AS containment FROM held JOIN counts USING (template) WHERE c / n >= 0.8 GROUP BY doc_id, license
""" % ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))
