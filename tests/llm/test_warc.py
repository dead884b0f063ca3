"""Archives: exact round trips, segments, framing, revisits and faults."""

import gzip
import hashlib
import random

import compare
import pytest
from pyspark.sql import functions as F

from claimflow.llm import warc

PAGES = "page_id bigint, url string, html string"
TRICKY = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n0\r\n\r\n" * 5


def index(spark, pages, path, **sizes):
    warc.write_archives(pages, path, "2026-01-01T00:00:00Z", **sizes)
    return sorted((tuple(row) for row in warc.page_index(warc.read_archives(spark, path)).collect()), key=str)


def expected(rows):
    firsts = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(page, firsts.get(html, page))
    text = lambda v: None if v is None else str(v)
    out = []
    for page, _, html in rows:
        data, first = (html or "").encode(), firsts.get(html)
        again = first is not None and first != page
        out.append((text(page), len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", text(first) if again else None, None))
    return sorted(out, key=str)


def test_framing():
    rng = random.Random(4)
    for n in (0, 1, 7, 8, 9, 1000):
        data = rng.randbytes(n)
        assert warc.unchunked(warc.chunked(data, 8)) == data
        assert warc.payload_of(warc.HTTP_HEAD + warc.chunked(data, 8)) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\nabc\r\n", b"3\r\nabcX\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


@pytest.mark.parametrize("sizes", [{}, {"segment_bytes": 64, "archive_bytes": 4096}, {"segment_bytes": 1001, "archive_bytes": 20_000}])
def test_round_trip(spark, tmp_path, sizes):
    rng = random.Random(1)
    rows = [(i, f"http://x.org/{i}", "".join(rng.choices("aé\n\r€😀<> ", k=rng.randint(0, 900)))) for i in range(60)]
    rows += [(i, f"http://y.org/ä b\r\n{i}", TRICKY) for i in (5, 102, 101, 103)] + [(200, None, None), (201, "", ""), (202, "u", "x" * 99), (203, "u", "x" * 99)]
    rows += [(None, "u", TRICKY), (None, None, "only without an id " * 9), (None, None, "only without an id " * 9), (101, "again", TRICKY), (5, "again", TRICKY)]
    rows += [(300, "long", "ü" * 300_000), (301, "long", "ü" * 300_000)] * 2
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    for extra in ("digest", "serial", "first", "payload", "block", "record", "one"):
        pages = pages.withColumn(extra, F.lit("kept"))
    assert index(spark, pages, str(tmp_path / "a"), **sizes) == expected(rows)


def test_empty(spark, tmp_path):
    assert index(spark, spark.createDataFrame([], PAGES), str(tmp_path / "a")) == []


def test_archives_are_plain_warc(spark, tmp_path):
    """Every archive reads as records of the declared length, each followed by two line ends, of about the wanted size."""
    rows = [(i, "u", chr(97 + i % 26) * 5000 + str(i)) for i in range(200)]
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path / "a"), "2026-01-01T00:00:00Z", 1000, 100_000)
    files = list((tmp_path / "a").glob("*.gz"))
    assert len(files) >= 8
    seen = 0
    for file in files:
        data = gzip.decompress(file.read_bytes())
        assert len(data) < 200_000
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            length = int(head.rsplit(b"Content-Length: ")[1])
            assert rest[length:length + 4] == b"\r\n\r\n" and length <= 1000
            data, seen = rest[length + 4:], seen + 1
    assert seen == 200 * 6


def parts(block, size, total=None):
    pieces = [block[i:i + size] for i in range(0, len(block), size)]
    base = {"record_id": "r", "record_type": "response", "page_id": "1", "target_uri": None, "refers_to": None, "declared": None, "origin": "o", "fault": None}
    return [{**base, "segment": n, "body": piece, "total": (len(block) if total is None else total) if n == len(pieces) else None} for n, piece in enumerate(pieces, 1)]


def test_assembly():
    block = warc.HTTP_HEAD + warc.chunked(b"payload of many bytes" * 20, 16)
    whole = parts(block, 50)
    random.Random(2).shuffle(whole)
    assert warc.assembled(whole)["body"] == b"payload of many bytes" * 20
    assert warc.assembled(whole + whole[:3])["body"] == b"payload of many bytes" * 20  # read twice
    fault = lambda p: warc.assembled(p)["fault"]
    assert fault([p for p in whole if p["segment"] != 1]) == "first segment missing"
    assert fault([p for p in whole if p["segment"] != 3]) == "segments missing or different"
    assert fault([p for p in whole if p["total"] is None]) == "segments missing or different"
    assert fault(whole + [{**whole[0], "body": b"other"}]) == "segments missing or different"
    assert fault(parts(block, 50, 7)) == "total length differs"
    assert fault([{**p, "fault": "truncated"} if p["segment"] == 2 else p for p in whole]) == "truncated"


def test_faults(spark, tmp_path):
    """Broken archives are reported; what does not follow the break is still read."""
    good = warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1:0>"), ("Page-ID", 1)], warc.HTTP_HEAD + warc.chunked(b"good")) + warc.END
    bad = warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:2:0>"), ("Page-ID", 2)], warc.HTTP_HEAD + b"5\r\nab") + warc.END
    lost = warc._record([("WARC-Type", "revisit"), ("WARC-Record-ID", "<urn:page:3:0>"), ("Page-ID", 3), ("WARC-Refers-To", "<urn:page:9:9>")], warc.REVISIT_HEAD) + warc.END
    wrong = warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:4:0>"), ("Page-ID", 4), ("WARC-Payload-Digest", "sha256:00")],
                         warc.HTTP_HEAD + warc.chunked(b"other")) + warc.END
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc").write_bytes(good + bad + lost + wrong + good.replace(b"page:1", b"page:5").replace(b"Page-ID: 1", b"Page-ID: 5")[:-20])
    (tmp_path / "a" / "y.warc.gz").write_bytes(gzip.compress(good.replace(b"page:1", b"page:6").replace(b"Page-ID: 1", b"Page-ID: 6")) + gzip.compress(lost.replace(b"3", b"7")))
    (tmp_path / "a" / "z.warc").write_bytes(b"not an archive\r\n")
    rows = {row.page_id: row for row in warc.page_index(warc.read_archives(spark, str(tmp_path / "a"))).collect()}
    assert {page: row.fault for page, row in rows.items()} == {
        "1": None, "2": "chunk end missing", "3": "response missing or different", "4": "digest differs", "5": "truncated", "6": None,
        "7": "response missing or different"}
    assert rows["6"].payload_bytes == 4


def test_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert compare.differences(warc.query(spark, sf), compare.connect(sf), warc.SQL) == []
