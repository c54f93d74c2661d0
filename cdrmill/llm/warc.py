"""WARC archives: written one gzip member per record, read back in sequence.

Writing: equal payloads are found by their digest (a narrow shuffle of ids and
digests, no texts); the first page keeps the payload, later ones become revisit
records.  Archives go through Spark's committed writer (see
``write_binary_rows``): plain concatenations of gzip members that any WARC tool
reads, several records to a file of about ``ARCHIVE_BYTES``.

Reading: each archive streams through one decompressor after another, a piece at
a time.  A record is framed by its Content-Length, and its block and payload
digests are checked.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrmill.llm.common import checkpointed, table, write_binary_rows
from cdrmill.operators.lookup import sized_broadcast
from cdrmill.session import scratch_path

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 8 << 20
PIECE = 1 << 16
DATE = "2024-01-01T00:00:00Z"
BROADCAST_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- writing ------------------------------------------------------------------

def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int,
                digest: str, refers_to: int | None) -> bytes:
    """An uncompressed record; ``payload`` None makes a revisit of ``refers_to``."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % size)
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if url is not None:  # control characters and blanks can't stand in a header line
        safe = "".join(c if c.isprintable() and c != " " else
                       "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if payload is None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def ending_in_zero(members: bytes) -> bytes:
    """Members that end with a zero byte: a member ends with the high byte of its
    length, which is zero below 16 MB; beyond, an empty member follows."""
    return members if members.endswith(b"\0") else members + gzip_member(b"")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = bytearray()
    for batch in batches:
        for page_id, url, html, size, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
            payload = None if refers is not None else (html or "").encode("utf-8", "surrogatepass")
            held += gzip_member(page_record(page_id, url, payload, size, digest, refers))
            if len(held) >= ARCHIVE_BYTES:
                yield pa.RecordBatch.from_pydict(
                    {"archive": pa.array([ending_in_zero(bytes(held))], pa.binary())})
                held = bytearray()
    if held:
        yield pa.RecordBatch.from_pydict(
            {"archive": pa.array([ending_in_zero(bytes(held))], pa.binary())})


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record per row of ``pages`` (``page_id, url, html``).

    Of records with equal payloads of at least 100 bytes the one with the
    smallest ``page_id`` is the response and the others revisit it; repeated rows
    of that same page are responses too.  A NULL ``page_id`` comes after all
    others; where all are NULL, all are responses.  NULL html is an empty
    payload.  An empty table writes no archive.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", "html",
                        F.octet_length(html).cast("long").alias("size"),
                        F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"))
    shared = checkpointed(
        rows.where(F.col("size") >= MIN_REVISIT_BYTES).select("page_id", "digest")
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null").select("digest", "first"))
    shared, _ = sized_broadcast(shared, BROADCAST_BYTES)
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    records = (rows.join(shared, "digest", "left")
               .select("page_id", "url", F.when(~later, F.col("html")).alias("html"), "size",
                       "digest", F.when(later, F.col("first")).alias("refers_to")))
    packed = records.mapInArrow(_pack, "archive binary")
    spark = pages.sparkSession
    one_per_file = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1")
    try:
        write_binary_rows(packed, path, "archive")
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", one_per_file)


# -- reading ------------------------------------------------------------------

@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    problem: str | None = None

    def http_payload(self) -> tuple[dict[str, str], bytes]:
        head, _, body = self.block.partition(b"\r\n\r\n")
        return parse_headers(head), body


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def members(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The content of one gzip member after another, decompressed as pieces come."""
    d, out, open_member = zlib.decompressobj(31), [], False
    for piece in pieces:
        while piece:
            open_member = True
            out.append(d.decompress(piece))
            piece = d.unused_data
            if d.eof:
                yield b"".join(out)
                d, out, open_member = zlib.decompressobj(31), [], False
    if open_member:
        raise ValueError("archive ends inside a gzip member")


def read_records(pieces: Iterable[bytes]) -> Iterator[Record]:
    """The records of one archive in order; ``problem`` names what is wrong with
    a record's framing or digests.  Empty members hold no record."""
    for data in members(pieces):
        if not data:
            continue
        head, mark, rest = data.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        size = headers.get("content-length", "")
        record = Record(headers, rest)
        if not mark or not head.startswith(b"WARC/"):
            record.problem = "header"
        elif not size.isdigit() or len(rest) != int(size) + 4 or not rest.endswith(b"\r\n\r\n"):
            record.problem = "length"
        else:
            record.block = rest[:int(size)]
            told = headers.get("warc-block-digest")
            if told and told != f"sha256:{hashlib.sha256(record.block).hexdigest()}":
                record.problem = "block digest"
            elif headers.get("warc-type") == "response":
                body = record.http_payload()[1]
                told = headers.get("warc-payload-digest")
                if told and told != f"sha256:{hashlib.sha256(body).hexdigest()}":
                    record.problem = "payload digest"
        yield record


def _page_of(reference: str | None) -> int | None:
    digits = (reference or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("problem", pa.string()), ("html", pa.binary())])
    for batch in batches:
        for raw in batch.column(0):
            whole = raw.as_buffer()
            pieces = (whole[i:i + PIECE].to_pybytes() for i in range(0, whole.size, PIECE))
            rows, held = [], 0
            for r in read_records(pieces):
                http, body = r.http_payload()
                kind = r.headers.get("warc-type")
                rows.append({
                    "page_id": _page_of(r.headers.get("warc-record-id")),
                    "payload_bytes": int(http.get("content-length", len(body))),
                    "payload_digest": (r.headers.get("warc-payload-digest") or "")
                    .removeprefix("sha256:"),
                    "record_type": kind,
                    "refers_to": _page_of(r.headers.get("warc-refers-to")),
                    "problem": r.problem, "html": body if kind == "response" else None})
                held += len(body)
                if held > ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to, problem`` (NULL if framing and digests hold) and ``html`` (bytes of
    a response's payload, NULL for a revisit)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
            .select("content").mapInArrow(
                _unpack, "page_id long, payload_bytes long, payload_digest string, "
                         "record_type string, refers_to long, problem string, html binary"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).drop("html")
