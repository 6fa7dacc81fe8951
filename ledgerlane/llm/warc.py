"""WARC archives: one gzip member per record, read back by tasks that each own a byte range.

Writing.  Each task writes its own files in the shared folder under fresh
names and reports them; only reported files count, so what a failed or
repeated attempt left behind is never read.

Reading.  Archives are cut into byte ranges.  A task looks for gzip's magic
from the start of its range, decodes the head of each candidate member, and
takes it for a record only if a WARC header comes out; it owns the records
that start inside its range and reads the last of them past the end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.common import staged
from ledgerlane.llm.files import located
from ledgerlane.session import scratch

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
FILE_BYTES = 1 << 30      # an archive is closed beyond this
SPLIT_BYTES = 16 << 20    # a reading task's byte range
DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool, digest: str, size: int) -> bytes:
    """One record as a gzip member: an HTTP response, or a revisit that has only its HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:x-page:{_id(page_id)}>",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:x-page:{_id(refers_to)}>"]
    head.append(f"Content-Length: {len(block)}")
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def _id(page_id) -> str:
    return "" if page_id is None else str(page_id)


def _write(batches: Iterator[pa.RecordBatch], root: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    where, base = located(root)
    out, path, size, count = None, "", 0, 0

    def closed():
        out.close()
        return pa.RecordBatch.from_arrays([pa.array([path.rpartition("/")[2]]), pa.array([size], pa.int64()), pa.array([count], pa.int64())],
                                          names=["file", "bytes", "records"])

    for batch in batches:
        for i in range(batch.num_rows):
            page_id, url, text, n, revisit, refers = (batch.column(c)[i].as_py() for c in ("id", "url", "text", "size", "revisit", "refers_to"))
            payload = text.encode() if text is not None else b""
            digest = base64.b32encode(bytes.fromhex(batch.column("sha1")[i].as_py())).decode()
            if out is None:
                path, size, count = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                out = where.open_output_stream(path, compression=None)
            raw = record(page_id, url, payload, refers, revisit, digest, n)
            out.write(raw)
            size, count = size + len(raw), count + 1
            if size >= file_bytes:
                yield closed()
                out = None
    if out is not None:
        yield closed()


def write_archives(df: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
                   min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row under ``root``; the manifest (file, bytes, records) as a written table.

    Of rows with equal payloads (SHA-1 and size) of ``min_bytes`` or more, those
    with the largest id are responses, the others revisits that refer to it;
    smaller ones are all responses.  The largest id per payload is a partial
    aggregate; a payload that a third of all rows share is split by the skew
    join, and a revisit's payload is dropped before the archive.

    Null text: an empty payload.  Null ids are below all others; rows that
    share the largest id (repeats, or nulls alone) are all responses.  Null
    URL: no target header.  An empty table writes no archive.  A payload of
    any length is one record, written by one task.  Other columns are not read.
    """
    payload = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("text"),
                     F.sha1(payload.cast("binary")).alias("sha1"), F.octet_length(payload).cast("long").alias("size"))
    top = staged(docs.filter(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(F.max("id").alias("top"), F.count("*").alias("n"))
                 .filter("n > 1"), "warc-payloads")
    marked = docs.join(top, ["sha1", "size"], "left")
    revisit = F.coalesce(F.col("n").isNotNull() & ~F.col("id").eqNullSafe(F.col("top")), F.lit(False))
    marked = marked.select("id", "url", F.when(~revisit, F.col("text")).alias("text"), "sha1", "size", revisit.alias("revisit"),
                           F.when(revisit, F.col("top")).alias("refers_to"))
    where, base = located(root)
    where.create_dir(base, recursive=True)
    done = marked.mapInArrow(lambda it: _write(it, root, file_bytes), "file string, bytes bigint, records bigint")
    return staged(done, "warc-manifest")


class _Range:
    """A file read forward in chunks from a position, with a window that can be dropped from the left."""

    def __init__(self, f, at: int):
        self.f, self.at, self.buf = f, at, b""
        f.seek(at)

    def more(self) -> bool:
        got = self.f.read(CHUNK)
        self.buf += got
        return bool(got)

    def drop(self, to: int) -> None:
        self.buf, self.at = self.buf[to - self.at:], to


def _member(r: _Range, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at``: its bytes decoded and its end; None if it isn't a whole WARC record."""
    z = zlib.decompressobj(31)
    out, fed, judged = [], at, False
    while True:
        piece = r.buf[fed - r.at:fed - r.at + CHUNK]
        if not piece:
            if not r.more():
                return None
            continue
        try:
            out.append(z.decompress(piece))
        except zlib.error:
            return None
        fed += len(piece)
        if not judged:
            head = b"".join(out)
            if not b"WARC/1.".startswith(head[:7]):
                return None
            judged = len(head) >= 7
        if z.eof:
            return b"".join(out), fed - len(z.unused_data)


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}


def read_range(f, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record that starts in start:end of an open archive."""
    r, at = _Range(f, start), start
    while at < end:
        i = r.buf.find(MAGIC, at - r.at)
        if i < 0:  # keep the last two bytes: a magic may straddle two chunks
            r.drop(max(at, r.at + len(r.buf) - 2))
            at = r.at
            if not r.more():
                return
            continue
        at = r.at + i
        if at >= end:
            return
        r.drop(at)
        if (got := _member(r, at)) is None:
            at += 1
            continue
        raw, at = got
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = _fields(head)
        n = int(fields["content-length"])
        if rest[n:] != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')}: its length is not the header's")
        yield fields, rest[:n]


def _read(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    where, base = located(root)
    for batch in batches:
        for row in batch.to_pylist():
            rows, held = [], 0
            with where.open_input_file(f"{base}/{row['file']}") as f:
                for fields, block in read_range(f, row["start"], row["end"]):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"record {fields['warc-record-id']}: its payload is not the digest's")
                    rows.append((_page(fields["warc-record-id"]), int(_fields(http)["content-length"]), digest, kind,
                                 _page(fields.get("warc-refers-to", "")), fields.get("warc-target-uri"),
                                 payload if kind == "response" else None))
                    held += len(block)
                    if held > CHUNK * 8:
                        yield _batch(rows)
                        rows, held = [], 0
            if rows:
                yield _batch(rows)


def _page(urn: str) -> str | None:
    return urn.removeprefix("<urn:x-page:").removesuffix(">") or None


SCHEMA = "id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, url string, payload binary"
_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=[x.split()[0] for x in SCHEMA.split(", ")])


def read_archives(spark: SparkSession, root: str, manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the manifest's archives: one task per byte range, whatever the sizes of files.

    Payload digests of responses are computed again and compared.  A payload
    that holds a whole gzipped WARC record, stored without compression, could
    be taken for a record where a range begins inside it; text cannot (the
    magic is no UTF-8).
    """
    ranges = manifest.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.withColumn("end", F.col("start") + split_bytes)
    n = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    return ranges.repartition(int(n)).mapInArrow(lambda it: _read(it, root), SCHEMA)


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write the rows to archives in the shared folder and read the records back."""
    root = f"{scratch(df.sparkSession, 'warc')}/archives"
    return read_archives(df.sparkSession, root, write_archives(df, root, id_col, url_col, text_col, min_bytes))
