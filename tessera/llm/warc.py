"""WARC archives: writing, and reading with segment reassembly.

``write_archives`` turns pages into WARC 1.1 records. The payload of a
``response`` is an HTTP message body in chunked transfer framing. A block
longer than ``SEGMENT_BYTES`` is cut: the first segment is the response
record, the others are ``continuation`` records that name it as their origin
and carry a segment number; the last one states the total length. Pages whose
payload (SHA-1 and length) another page with a smaller id has already are
``revisit`` records without a body. Records go out through Spark's text writer
with the record separator as line separator, so a file is a gzipped WARC file; it holds at most ``RECORDS_PER_FILE`` records of bounded size.

``read_archives`` parses every file by its headers and content lengths,
groups segments by origin, orders them by segment number, verifies numbers and
total length, and decodes the chunks. Only segmented records are shuffled.

Defined cases: a NULL html is an empty payload; a NULL page_id is written
empty and read as NULL; repeated rows give a record each, all of them
responses if their id is the smallest; line breaks in a url are percent-coded;
extra columns are ignored. An archive that breaks the format raises an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT_BYTES = 8192
CHUNK_BYTES = 4096
RECORDS_PER_FILE = 2048
# The page tables have no fetch time.
RECORD_DATE = "2020-01-01T00:00:00Z"
SEPARATOR = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

PARSED = ("record_id string, page_id long, url string, record_type string, refers_to long, payload_digest string, "
          "payload_bytes long, segment long, total long, origin string, block binary")
PAYLOADS = ("page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, "
            "payload_digest string, segments long, whole boolean")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 5 hex digits are 4 base32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(records, payloads): one row per distinct page with its role and number
    of copies, and the payload by the same row key. Payload bytes take part in
    one shuffle only, that of ``payloads``."""
    payload = F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload")), "n": F.octet_length("payload").cast("long")})
    text_id = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    rows = rows.withColumn("row_key", F.concat_ws(":", text_id, F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 12),
                                                  F.isnull("url").cast("int").cast("string"), "digest", F.col("n").cast("string")))
    narrow = rows.groupBy("row_key", "page_id", "url", "digest", "n").agg(F.count("*").alias("copies"))
    first = narrow.groupBy("digest", "n").agg(F.min("page_id").alias("first_id"))
    records = narrow.join(first, ["digest", "n"]).withColumn("first", F.col("page_id").eqNullSafe(F.col("first_id")))
    return records, rows.select("row_key", "payload")


def _record(kind: str, record_id: str, block: bytes, fields: list[tuple[str, str | None]]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{record_id}>"), ("WARC-Date", RECORD_DATE), *fields,
            ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + n])
        at += n + 2


def _write_responses(segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                key, url, digest, copies, payload = (batch.column(j)[i].as_py() for j in range(5))
                block = HTTP_HEAD + chunked(payload)
                cuts = [block[j : j + segment_bytes] for j in range(0, len(block), segment_bytes)]
                for copy in range(copies):
                    origin = f"{key}:{copy}"
                    named = [("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"),
                             ("Content-Type", "application/http; msgtype=response"),
                             ("WARC-Segment-Number", "1" if len(cuts) > 1 else None)]
                    out.append(_record("response", origin, cuts[0], named))
                    for number, part in enumerate(cuts[1:], 2):
                        last = str(len(block)) if number == len(cuts) else None
                        out.append(_record("continuation", f"{origin}:{number}", part, [
                            ("WARC-Segment-Origin-ID", f"<urn:page:{origin}>"), ("WARC-Segment-Number", str(number)),
                            ("WARC-Segment-Total-Length", last)]))
                    if len(out) >= 512:
                        yield pa.record_batch([pa.array(out, pa.binary())], names=["record"])
                        out = []
            if out:
                yield pa.record_batch([pa.array(out, pa.binary())], names=["record"])

    return run


def _write_revisits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            key, url, digest, copies, n, first_id = (batch.column(j)[i].as_py() for j in range(6))
            block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
            for copy in range(copies):
                out.append(_record("revisit", f"{key}:{copy}", block, [
                    ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", f"<urn:page:{first_id}>"), ("Content-Type", "application/http; msgtype=response")]))
        yield pa.record_batch([pa.array(out, pa.binary())], names=["record"])


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, **columns) -> None:
    """Write ``pages(page_id, url, html)`` as WARC files under ``path``."""
    records, payloads = roles(pages, **columns)
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url")
    responses = (payloads.dropDuplicates(["row_key"]).join(records.filter("first"), "row_key")
                 .select("row_key", url, "digest", "copies", "payload").mapInArrow(_write_responses(segment_bytes), "record binary"))
    revisits = (records.filter("not first").select("row_key", url, "digest", "copies", "n", "first_id")
                .mapInArrow(_write_revisits, "record binary"))
    (responses.unionByName(revisits).select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", SEPARATOR).option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path))


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record of a file."""
    at = 0
    if content.startswith(b"\x1f\x8b"):
        content = gzip.decompress(content)
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if not content.startswith(b"WARC/1.", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start, n = end + 4, int(fields["content-length"])
        if content[start + n : start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, content[start : start + n]
        at = start + n + 4


def _page_of(urn: str | None) -> int | None:
    found = re.match(r"<urn:page:(-?\d+)", urn or "")
    return int(found[1]) if found else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in PARSED.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for i in range(batch.num_rows):
            rows, size = [], 0
            for f, block in parse_records(batch.column(0)[i].as_py()):
                stated = re.search(rb"\r\nContent-Length: (\d+)", block) if f["warc-type"] == "revisit" else None
                rows.append((f["warc-record-id"], _page_of(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-type"],
                             _page_of(f.get("warc-refers-to")), f.get("warc-payload-digest", "").removeprefix("sha1:"),
                             int(stated[1]) if stated else None, int(f["warc-segment-number"]) if "warc-segment-number" in f else None,
                             int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                             f.get("warc-segment-origin-id", f["warc-record-id"]), block))
                size += len(block)
                if size > 4_000_000:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in segment order -> the payload, its length and digest."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            page_id, url, kind, refers_to, stated, digest, parts = (batch.column(j)[i].as_py() for j in range(7))
            if kind == "revisit":
                out.append((page_id, url, kind, refers_to, None, stated, digest, 1, True))
                continue
            block = b"".join(p["block"] for p in parts)
            numbers = [p["segment"] for p in parts]
            totals = [p["total"] for p in parts if p["total"] is not None]
            whole = numbers in ([None], list(range(1, len(parts) + 1))) and (numbers == [None] or totals == [len(block)])
            head, _, body = block.partition(b"\r\n\r\n")
            payload = dechunk(body) if whole and b"\r\ntransfer-encoding: chunked" in head.lower() else body
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            out.append((page_id, url, kind, None, payload, len(payload), found, len(parts), whole and found == digest))
        names = [x.split()[0] for x in PAYLOADS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        yield pa.record_batch([pa.array([r[j] for r in out], kinds[j]) for j in range(9)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit: page_id, url, record_type, refers_to,
    payload (NULL for revisits), payload_bytes, payload_digest, segments, and
    whole: segment numbers, total length and digest are as stated."""
    parsed = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse, PARSED)
    part = F.struct("segment", "total", "block")
    alone = parsed.filter("segment is null").select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest",
                                                    F.array(part).alias("parts"))
    head = [F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")]
    joined = parsed.filter("segment is not null").groupBy("origin").agg(*head, F.sort_array(F.collect_list(part)).alias("parts")).drop("origin")
    return alone.unionByName(joined).mapInArrow(_payloads, PAYLOADS)
