"""WARC archives of web pages: written with segments, chunked transfer framing and revisits, and read back whole.

A page is an HTTP response in chunks. A payload that another page has, too, is written once, with the page of
the smallest id, and others revisit it. A record longer than a segment goes on in continuation records, which may
lie in any archive: reading groups them by the record they continue, orders them by segment number, verifies the
total length and then takes the chunk framing off.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.lookups import BLOCKS, split_lookup
from claimflow.llm.scratch import _fs, drop, save
from claimflow.session import fresh_path

#: Content of a record, and of an archive before compression, in bytes.
SEGMENT_BYTES, ARCHIVE_BYTES, CHUNK_BYTES = 256 << 10, 32 << 20, 8 << 10
#: Payloads of fewer bytes are written again each time.
REVISIT_BYTES = 100
#: Bytes that go from Python to Spark at once.
BATCH_BYTES = 4 << 20

# Fixed values of the format.
VERSION, END = b"WARC/1.1", b"\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = (
    "record_id string, record_type string, page_id string, target_uri string, refers_to string, declared string, "
    "origin string, segment int, total bigint, body binary, fault string"
)
_NAMES = [part.split()[0] for part in _RECORD.split(", ")]
_ARROW = pa.schema([(name, {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[kind])
                    for name, kind in (part.split() for part in _RECORD.split(", "))])


# --- framing ------------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk end missing")
        parts.append(body[at:at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response; ValueError if its framing is broken."""
    head, end, body = block.partition(END)
    if not end:
        raise ValueError("HTTP head does not end")
    fields = [line.lower().replace(b" ", b"") for line in head.split(b"\r\n")[1:]]
    return unchunked(body) if b"transfer-encoding:chunked" in fields else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{name}: {value}".encode() for name, value in [*fields, ("Content-Length", len(block))] if value is not None]
    return b"\r\n".join([VERSION, *lines]) + END + block


# --- writing ------------------------------------------------------------------


def _name(page_id, serial: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{serial}>"


def _page_records(row: dict, segment_bytes: int, date: str) -> Iterator[bytes]:
    own, uri = _name(row["page_id"], row["serial"]), row["url"]
    fields = [
        ("WARC-Date", date), ("WARC-Target-URI", None if uri is None else quote(uri, safe=";/?:@&=+$,%#[]!*'()-_.~")),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("Page-ID", row["page_id"]), ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["first"] is not None:
        yield _record([
            ("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To", _name(row["first"]["page_id"], row["first"]["serial"])),
            ("WARC-Profile", SAME_PAYLOAD), *fields], REVISIT_HEAD)
        return
    block = HTTP_HEAD + chunked(row["payload"])
    pieces = [block[at:at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    many = len(pieces) > 1
    yield _record([("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Segment-Number", 1 if many else None), *fields], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        yield _record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{number}>"), ("WARC-Date", date), ("WARC-Segment-Origin-ID", own),
            ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", len(block) if number == len(pieces) else None)], piece)


def _written(segment_bytes: int, date: str):
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                for record in _page_records(batch.slice(i, 1).to_pylist()[0], segment_bytes, date):
                    held.append(record)
                    size += len(record)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict({"record": pa.array(held, pa.binary())})
                        held, size = [], 0
        yield pa.RecordBatch.from_pydict({"record": pa.array(held, pa.binary())})

    return run


def write_archives(pages: DataFrame, path: str, date: str, segment_bytes: int = SEGMENT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record, in as many segments as it takes, per row of pages to compressed archives in the folder ``path``.

    pages has page_id, url and html; other columns are ignored. Of rows with equal payloads of at least
    REVISIT_BYTES those with the smallest page_id are responses, others revisit one of them; rows without page_id are
    responses only where no equal payload has one. NULL html is an empty payload, a NULL url is left out. Repeated
    rows are records of their own. An empty table gives archives without records.

    A record goes to a random place of its partition and archives end by the number of records, so that they
    have about ``archive_bytes``, however long single pages are.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    stored = pages.select(F.col("page_id"), F.col("url"), payload.alias("payload"), F.monotonically_increasing_id().alias("serial"))
    # the serial numbers stay as they are; whole payloads, so packed tightly
    stored = save(stored.withColumn("digest", F.sha2("payload", 256)), "pages", compression="zstd")
    block = F.pmod(F.xxhash64("serial"), F.lit(BLOCKS))
    large = stored.filter(F.octet_length("payload") >= REVISIT_BYTES).select("digest", F.when(F.col("page_id").isNotNull(), F.struct("page_id", "serial")).alias("one"))
    firsts = large.groupBy("digest").agg(F.min("one").alias("first"), F.count("*").alias("rows")).filter("rows > 1").select("digest", "first")
    told = split_lookup(stored, firsts, "digest", block)
    first = F.when(~F.col("first.page_id").eqNullSafe(F.col("page_id")), F.col("first")).alias("first")
    told = told.select("page_id", "url", "serial", "digest", first, F.when(first.isNull(), F.col("payload")).alias("payload"))
    records = told.mapInArrow(_written(segment_bytes, date), "record binary")
    length = F.octet_length("payload")
    sizes = stored.agg(F.sum(length).alias("bytes"), F.sum(F.floor(length / segment_bytes) + 1).alias("records")).first()
    most = max(1, int(archive_bytes * (sizes["records"] or 1) / ((sizes["bytes"] or 0) + 600 * (sizes["records"] or 1))))
    mixed = records.sortWithinPartitions(F.xxhash64(F.substring("record", 1, 512)))
    lines = mixed.select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", END.decode()).option("maxRecordsPerFile", most).option("compression", "gzip").text(path)
    drop(stored)


# --- reading ------------------------------------------------------------------


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(fields, block, fault) of every record of an archive, compressed or not. What follows a broken record is lost with it."""
    file = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    try:
        while line := file.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                yield {}, b"", "no WARC record"
                return
            fields = {}
            while (line := file.readline()).strip():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            if not fields.get("content-length", "").isdigit():
                yield fields, b"", "length missing"
                return
            length = int(fields["content-length"])
            block = file.read(length)
            yield fields, block, None if len(block) == length else "truncated"
    except (EOFError, OSError):
        yield {}, b"", "compression broken"


def _row(fields: dict[str, str], block: bytes, fault: str | None) -> dict:
    def number(name: str) -> int | None:
        return int(fields[name]) if fields.get(name, "").isdigit() else None

    row = {
        "record_id": fields.get("warc-record-id"), "record_type": fields.get("warc-type"), "page_id": fields.get("page-id"),
        "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
        "declared": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None, "origin": fields.get("warc-segment-origin-id"),
        "segment": number("warc-segment-number"), "total": number("warc-segment-total-length"), "body": block, "fault": fault,
    }
    if row["segment"] == 1 and row["origin"] is None:
        row["origin"] = row["record_id"]
    return row


def _payload(row: dict) -> dict:
    if row["record_type"] == "response" and row["fault"] is None:
        try:
            row["body"] = payload_of(row["body"])
        except ValueError as error:
            row["body"], row["fault"] = b"", str(error)
    return row


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["body"]) + 500
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, _ARROW)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, _ARROW)


def _parsed(segments: bool):
    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                for record in records_of(content.as_py()):
                    row = _row(*record)
                    if segments == (row["origin"] is not None):
                        yield row if segments else _payload(row)

    return lambda batches: _batches(rows(batches))


def assembled(parts: list[dict]) -> dict:
    """One record of its segments: a segment that is there twice counts once; missing or different ones are a fault."""
    parts = sorted(parts, key=lambda part: (part["segment"], part["body"]))
    head = parts[0]
    row = {**head, "body": b"".join(p["body"] for i, p in enumerate(parts) if not i or p["segment"] != parts[i - 1]["segment"])}
    numbers = {(p["segment"], p["body"]) for p in parts}
    totals = {p["total"] for p in parts if p["total"] is not None}
    fault = next((p["fault"] for p in parts if p["fault"]), None)
    if fault is None and head["segment"] != 1:
        fault = "first segment missing"
    if fault is None and (sorted(n for n, _ in numbers) != list(range(1, len(numbers) + 1)) or not totals):
        fault = "segments missing or different"
    if fault is None and totals != {len(row["body"])}:
        fault = "total length differs"
    if fault is not None:
        row["body"] = b""
    return _payload({**row, "record_id": head["origin"], "segment": None, "total": None, "fault": fault})


def _joined(batches):
    def rows():
        for batch in batches:
            for i in range(batch.num_rows):
                origin, parts = batch.slice(i, 1).to_pylist()[0].values()
                yield assembled([{**part, "origin": origin} for part in parts])

    return _batches(rows())


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``: record_id, record_type, page_id and refers_to as text, target_uri, payload, bytes, digest, fault.

    Segments are joined wherever they lie. payload is what the chunk framing held, digest its SHA-256; a revisit
    has neither. ``fault`` says what is wrong with a record, whose payload is then empty, and is NULL for sound ones; a
    payload that has not the digest declared is a fault, too. Archives may be compressed, of 2 GB at most.
    An archive is parsed in one task, as it holds no index. An empty folder gives an empty table.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    whole = files.mapInArrow(_parsed(False), _RECORD)
    part = F.struct(*[name for name in _NAMES if name != "origin"])
    parts = files.mapInArrow(_parsed(True), _RECORD).groupBy("origin").agg(F.collect_list(part).alias("parts"))
    found = whole.union(parts.mapInArrow(_joined, _RECORD))
    held = (F.col("record_type") != "revisit") & F.col("fault").isNull()
    found = found.withColumn("payload", F.when(held, F.col("body"))).withColumn("digest", F.sha2("payload", 256))
    fault = F.coalesce("fault", F.when(F.col("digest") != F.col("declared"), F.lit("digest differs")))
    return found.select(
        "record_id", "record_type", "page_id", "target_uri", "refers_to", "payload", F.octet_length("payload").cast("bigint").alias("bytes"),
        F.coalesce("digest", "declared").alias("digest"), fault.alias("fault"))


def page_index(records: DataFrame) -> DataFrame:
    """One row per record that is a page: page_id (text), payload_bytes, payload_digest, record_type, refers_to (page_id of the response), fault.

    Revisits take the length from the response they refer to; one that is not there is a fault.
    """
    known = save(records.drop("payload"), "records").filter(F.col("record_type").isin("response", "revisit"))
    held = known.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("first"), F.col("bytes").alias("first_bytes"), F.col("digest").alias("first_digest"))
    met = split_lookup(known, held.dropDuplicates(["refers_to"]), "refers_to", F.col("record_id"))
    lost = (F.col("record_type") == "revisit") & ~F.coalesce(F.col("first_digest") == F.col("digest"), F.lit(False))
    lost = F.when(lost, F.lit("response missing or different"))
    return met.select(
        "page_id", F.coalesce("bytes", "first_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.col("first").alias("refers_to"), F.coalesce("fault", lost).alias("fault"))


def query(spark, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "llm-archives")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, "2026-01-01T00:00:00Z")
    _fs(spark, path)[0].deleteOnExit(_fs(spark, path)[1])
    index = page_index(read_archives(spark, path))
    return index.select(
        F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"), "fault")


#: What the archives must say of each page.
SQL = """
WITH held AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
firsts AS (SELECT payload, min(page_id) AS first FROM held WHERE payload_bytes >= 100 GROUP BY payload)
SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to, NULL::VARCHAR AS fault
FROM held LEFT JOIN firsts USING (payload)
"""
