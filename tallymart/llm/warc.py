"""WARC archives: a writer, and a sequential reader that checks what it reads.

One record is one gzip member.  The reader inflates an archive piece by piece, so
it holds one record at most; it frames blocks by their content length, asks
that every member ends where its record ends, and compares both digests.
Archives lie in the folder that all machines share.  A writer's file gets a new
name in each attempt, and only files of attempts that succeeded are listed in
the manifest, so a lost executor leaves no record twice.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.util import broadcast_if_small, file_system, shared_folder, stored, table, text_slices

#: An archive is closed after the record that takes it beyond this size.
ARCHIVE_BYTES = 256 * 1024 * 1024
#: Equal payloads below this size are written in full each time.
REVISIT_BYTES = 1000
READ_BYTES = 1 << 16
#: The tables hold no crawl time.
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:x-page:{}>"

RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, payload binary"
)


class WarcError(ValueError):
    """The archive is cut, not framed as stated, or differs from its digests."""


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


# ------------------------------------------------------------------ records


@dataclass
class Record:
    """Headers in lower case and the block of one record."""

    headers: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def write_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool
) -> bytes:
    """One gzip member.  A revisit's block ends after the HTTP headers of the full payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": RECORD_ID.format("" if page_id is None else page_id),
        "WARC-Date": DATE,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "WARC-Block-Digest": _digest(block),
        "WARC-Payload-Digest": _digest(payload),
    }
    if url is not None:
        # what a header line cannot hold is percent-encoded, and so is the sign itself
        head["WARC-Target-URI"] = "<" + quote(url, safe=":/?#[]@!$&'()*+,;=-._~") + ">"
    if revisit:
        head["WARC-Profile"] = REVISIT_PROFILE
        head["WARC-Refers-To"] = RECORD_ID.format(refers_to)
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items())
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


class _Member:
    """Bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, source, pending: bytes):
        self.source, self.pending = source, pending
        self.inflate = zlib.decompressobj(31)
        self.held = bytearray()

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.pending or self.source.read(READ_BYTES)
        self.pending = b""
        try:
            found = self.inflate.decompress(data, READ_BYTES)
        except zlib.error as error:
            raise WarcError(f"not a gzip member: {error}") from error
        if not data and not found and not self.inflate.eof:
            raise WarcError("the archive ends within a record")
        self.held += found
        return True

    def until(self, mark: bytes) -> bytes:
        while (at := self.held.find(mark)) < 0:
            if not self._more():
                raise WarcError("a header does not end")
        found = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return found

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self._more():
                raise WarcError("a block is shorter than its content length")
        found = bytes(self.held[:size])
        del self.held[:size]
        return found

    def close(self) -> bytes:
        """The bytes after the member; nothing may be left in it."""
        while self._more():
            pass
        if self.held:
            raise WarcError("a member is longer than its record")
        return self.inflate.unused_data


def _headers(text: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = text.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return first, {k.strip().lower(): v.strip() for k, _, v in pairs}


def read_records(source) -> Iterator[Record]:
    """Records of an open archive in their order, framed and verified; ``source`` has ``read(n)``."""
    pending = b""
    while True:
        pending = pending or source.read(READ_BYTES)
        if not pending:
            return
        member = _Member(source, pending)
        version, headers = _headers(member.until(b"\r\n\r\n"))
        if not version.startswith("WARC/"):
            raise WarcError("a record does not start with its version")
        length = headers.get("content-length", "")
        if not length.isdigit():
            raise WarcError("a record has no content length")
        block = member.take(int(length))
        if member.take(4) != b"\r\n\r\n":
            raise WarcError("a block is longer than its content length")
        pending = member.close()
        if headers.get("warc-block-digest", _digest(block)) != _digest(block):
            raise WarcError("a block differs from its digest")
        record = Record(headers, block)
        if headers.get("content-type", "").startswith("application/http"):
            head, _, record.payload = block.partition(b"\r\n\r\n")
            record.http = _headers(head)[1]
            stated = headers.get("warc-payload-digest")
            if stated and headers.get("warc-type") == "response" and stated != _digest(record.payload):
                raise WarcError("a payload differs from its digest")
        yield record


# ------------------------------------------------------------------ DataFrames


def plan_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): which record an equal payload's record points to.

    Of equal payloads of ``least_bytes`` or more the one with the largest
    page_id is written in full and the others refer to it; ``refers_to`` is null
    for records written in full.  Rows that repeat the largest page_id are all written in full; a
    null page_id refers to the largest one and is never referred to.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")
    )
    size = F.octet_length("html")
    keyed = named.withColumn("_key", F.when(size >= least_bytes, F.sha1(F.encode("html", "UTF-8"))))
    groups = (
        keyed.where("_key is not null").groupBy("_key")
        .agg(F.max("page_id").alias("_last"), F.count("*").alias("_n"))
        .where("_n > 1 and _last is not null").select("_key", "_last")
    )
    groups = broadcast_if_small(stored(groups, shared_folder(pages.sparkSession, "revisits"), "groups"))
    first = F.col("page_id").eqNullSafe(F.col("_last"))
    return keyed.join(groups, "_key", "left").select(
        "page_id", "url", "html", F.when(~first, F.col("_last")).alias("refers_to")
    )


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of (page_id, url, html, refers_to) below ``folder``; their manifest (path, records, bytes)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(folder)
        files.create_dir(base, recursive=True)
        path = out = None
        records = size = 0

        def listed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for batch in text_slices(batches, "html"):
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(file_system(path)[1], compression=None)
                    records = size = 0
                payload = (html or "").encode("utf-8", "surrogatepass")
                data = write_record(page_id, url, payload, refers_to, refers_to is not None)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    yield listed()
                    out = None
        if out is not None:
            yield listed()

    rows = planned.select("page_id", "url", "html", "refers_to")
    manifest = rows.mapInArrow(write, "path string, records long, bytes long")
    return stored(manifest, shared_folder(planned.sparkSession, "warc"), "manifest")


def _page(record_id: str | None) -> int | None:
    digits = (record_id or "").strip("<>").rpartition(":")[2]
    return int(digits) if digits.lstrip("-").isdigit() else None


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives in ``manifest.path``, one task an archive or more.

    ``payload_bytes`` and ``payload_digest`` (bare lower-case hex) are those of the
    full payload, of revisits too.  Without ``payloads`` the payload column is null.
    A damaged archive raises ``WarcError`` and fails the job.
    """
    from urllib.parse import unquote

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            files, at = file_system(path)
            rows, held = [], 0
            with files.open_input_stream(at, compression=None) as source:
                for record in read_records(source):
                    h = record.headers
                    digest = base64.b32decode(h["warc-payload-digest"].partition(":")[2]).hex()
                    url = h.get("warc-target-uri")
                    rows.append(
                        (_page(h["warc-record-id"]), None if url is None else unquote(url[1:-1]),
                         h["warc-type"], _page(h.get("warc-refers-to")),
                         int(record.http["content-length"]), digest,
                         record.payload if payloads and h["warc-type"] == "response" else None)
                    )
                    held += len(record.payload) if payloads else 200
                    if held >= 4 * 1024 * 1024:
                        yield _records(rows)
                        rows, held = [], 0
            if rows:
                yield _records(rows)

    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInArrow(read, RECORDS)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def warc_round_trip(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Every row of ``pages`` written as a record and read back.

    A null html is an empty payload; a null url has no target header and comes
    back null; a null page_id has an empty record name and comes back null;
    repeated rows are repeated records; an empty table gives no archive and no
    rows; other columns are ignored.
    """
    folder = f"{shared_folder(pages.sparkSession, 'archives')}/files"
    return read_archives(write_archives(plan_revisits(pages), folder), payloads)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP10_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS size, sha1(body) AS digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest, size) AS last FROM d)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN size >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
"""
