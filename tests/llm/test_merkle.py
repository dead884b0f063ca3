"""Manifest and proofs against a plain tree, and against the SQL on rows with all that is odd."""

import hashlib
import zlib
from itertools import groupby

import compare
import pytest
from pyspark.sql import functions as F

from claimflow.llm import merkle

compare.KINDS["boolean"] = "BOOLEAN"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(*[field(v) for v in (row[0], row[3], row[2], row[4], text)])


def tree(digests):
    """(root, proofs as (left, right) lists) of a list of digests."""
    level, proofs, at = list(digests), [[] for _ in digests], list(range(len(digests)))
    while len(level) > 1:
        for i, place in enumerate(at):
            first = place // 16 * 16
            proofs[i].append(("".join(level[first:place]), "".join(level[place + 1:first + 16])))
            at[i] = place // 16
        level = [h(*level[i:i + 16]) for i in range(0, len(level), 16)]
    return level[0], proofs


def plain(rows):
    """The result rows by brute force."""
    name = lambda r: (r[3] is not None, (r[3] or "").encode())
    groups = []
    for _, members in groupby(sorted(rows, key=name), key=name):
        members = sorted(members, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        groups.append((members, *tree([leaf(r, r[1]) for r in members])))
    root, tops = tree([subroot for _, subroot, _ in groups])
    out = []
    for (members, subroot, proofs), top in zip(groups, tops):
        for row, proof in zip(members, proofs):
            text, way = row[1], proof + top
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf(row, text)
            for left, right in way:
                now = h(left, now, right)
            out.append((row[0], leaf(row, row[1]), subroot, root, h(*[left + right for left, right in way]), now, now == root))
    return sorted(out, key=str)


def found(df):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(row) for row in merkle.manifest(df, merkle.tampered()).select(*columns).collect()), key=str)


def cases():
    odd = [(None, "Ä B", "en", "a", 3), (None, None, None, None, None), (7, None, None, "", 1), (7, "", "de", "", 1), (7, "", "de", "", 1),
           (-3, "Zwölf ß", "de", "ü", None), (2**62, "X" * 100_000, "en", "z", 100_000)]
    sources = [None, "a", "é", "Z"]
    return {
        "empty": [], "one": [(5, "Only ONE", "en", None, 8)], "one source": [(i, f"Text {i}", "en", "s", i) for i in range(40)],
        "lone leaves": [(i, f"T{i}", "en", f"s{i:03}", 2) for i in range(20)], "sixteen": [(i, "A", None, "s", i) for i in range(16)],
        "seventeen": [(i, "A", None, "s", i) for i in range(17)], "odd": odd * 2 + [(i, f"Word {i}", "en", sources[i % 4], i) for i in range(1200)],
    }


@pytest.mark.parametrize("name", list(cases()))
def test_brute_force(spark, name):
    rows = cases()[name]
    df = spark.createDataFrame(rows, SCHEMA)
    for extra in ("tree", "idx", "id", "digest", "row", "n", "segment", "up", "leaves"):
        df = df.withColumn(extra, F.lit("kept"))
    assert found(df) == (plain(rows) if rows else [])


def test_sql_on_odd_rows(spark, tmp_path):
    spark.createDataFrame(cases()["odd"], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare.differences(merkle.query(spark, str(tmp_path)), con, merkle.SQL) == []


def test_jumps_double(spark):
    links = spark.createDataFrame(
        [(str(i), str(i + 1), [(f"l{i}", f"r{i}")], "s" if i == 3 else None) for i in range(9)],
        "id string, up string, segment array<struct<left: string, right: string>>, subroot string")
    for rounds, reach in ((1, 2), (2, 4), (3, 8), (4, 9)):
        links = merkle.jump(links)
        for row in links.collect():
            first = int(row.id)
            assert [s["left"] for s in row.segment] == [f"l{i}" for i in range(first, min(first + 2**rounds, 9))]
            assert row.up == str(min(first + reach, 9)) and (row.subroot == "s") == (first <= 3 < min(first + 2**rounds, 9))


def test_every_change_shows(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(100)], SCHEMA)
    changed = F.when(F.col("doc_id") == 57, F.lit("other")).otherwise(F.col("text"))
    rows = merkle.manifest(docs, changed).filter("NOT verified").collect()
    assert [row.doc_id for row in rows] == [57]
    assert merkle.manifest(docs).filter("NOT verified").count() == 0
