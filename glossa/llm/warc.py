"""Operator 9, WARC: writes pages as gzip-per-record archives and reads them back in sequence.

Writer: each task streams its rows into archives of about ``ARCHIVE_BYTES`` in the shared
folder, one gzip member per record. An archive gets a fresh name per attempt, and only the
archives listed in the manifest of the finished job are read, so a task that runs again (or
twice) does no harm. Of records with equal payloads of at least ``min_bytes`` bytes, the one
with the smallest id is a response and the others are revisits without payload.

Reader: one pass per archive with incremental zlib decompression; a record is its header
block and as many bytes as Content-Length says; payload and block digests are verified.
A page is held in memory one at a time, an archive never.

Files go through ``pyarrow.fs`` (``file:``, ``hdfs:``, ``s3:``/``s3a:``, ``gs:``), in the folder of
``spark.checkpoint.dir``.

Defined results: a null html is an empty payload; a null url has no target header; a null id
counts as larger than all ids and refers to nothing itself; rows that share id and payload are
all responses if theirs is the smallest id; an empty table writes no archive; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm.storage import join_small, stored
from glossa.llm.texts import utf8_column
from glossa.session import scratch_path
from glossa.sources.io import filesystem_of

ARCHIVE_BYTES = 64 << 20
MIN_REVISIT_BYTES = 0
READ_TASKS = 10_000        # tasks of the reading stage, at most
# --- fixed values of the format ---------------------------------------------------
VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
# ----------------------------------------------------------------------------------


class FormatError(ValueError):
    """An archive that breaks framing or a digest."""


def sha1_base32(*parts) -> str:
    h = hashlib.sha1()
    for p in parts:
        h.update(p)
    return base64.b32encode(h.digest()).decode()


def record_name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload, digest: str, refers_to) -> bytes:
    """One WARC record, uncompressed. ``refers_to``: id of the response for a revisit, else None."""
    head = HTTP_HEAD % len(payload)
    body = b"" if refers_to is not None else payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    fields.append(("WARC-Payload-Digest", "sha1:" + digest))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_name(refers_to))]
    fields += [("WARC-Block-Digest", "sha1:" + sha1_base32(head, body)),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(head) + len(body))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return b"".join((VERSION, b"\r\n", lines, b"\r\n", head, body, b"\r\n\r\n"))


def member(data: bytes) -> bytes:
    """One gzip member, equal bytes for equal data."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes all rows and returns the manifest ``path, n_records``, stored."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    keyed = rows.withColumn("_sha1", F.sha1(F.col("html").cast("binary")))
    several = (keyed.where(F.octet_length("html") >= min_bytes).groupBy("_sha1")
               .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("_sha1", "first"))
    rows = join_small(keyed, stored(several, "payloads"), ["_sha1"])
    refers = F.when(F.col("id").isNull() | (F.col("id") != F.col("first")), F.col("first"))
    out = rows.select("id", "url", "html", refers.alias("refers_to")).mapInArrow(_write(folder), "path string, n_records long")
    return stored(out, "manifest")


def _write(folder: str):
    def run(batches):
        filesystem, base = filesystem_of(folder)
        filesystem.create_dir(base, recursive=True)
        out, n, size, path = None, 0, 0, None
        done = []
        for batch in batches:
            ids, urls, refs = (batch.column(c).to_pylist() for c in ("id", "url", "refers_to"))
            for page_id, url, payload, refers_to in zip(ids, urls, utf8_column(batch, "html"), refs):
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out, n, size = filesystem.open_output_stream(path, compression=None), 0, 0
                payload = bytes(payload)
                data = member(record(page_id, url, payload, sha1_base32(payload), refers_to))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((path, n))
        if out is not None:
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{p.rsplit('/', 1)[1]}" for p, _ in done], pa.string()),
                                          pa.array([k for _, k in done], pa.int64())], names=["path", "n_records"])
    return run


def read_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header fields, block)`` of each record of one archive, given its bytes in pieces."""
    z, plain, raw = None, bytearray(), b""
    while True:
        if not raw:
            raw = next(chunks, b"")
            if not raw:
                if z is not None:
                    raise FormatError("archive ends inside a record")
                return
        if z is None:
            z, plain = zlib.decompressobj(31), bytearray()
        try:
            plain += z.decompress(raw)
        except zlib.error as e:
            raise FormatError(f"broken gzip member: {e}") from e
        raw = z.unused_data
        if z.eof:
            z = None
            yield split_record(bytes(plain))


def split_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Frames one record by its Content-Length."""
    end = data.find(b"\r\n\r\n")
    lines = data[:end].split(b"\r\n")
    if end < 0 or not lines[0].startswith(b"WARC/1."):
        raise FormatError("no WARC header")
    fields = dict(x.decode().split(": ", 1) for x in lines[1:])
    try:
        length = int(fields["Content-Length"])
    except (KeyError, ValueError) as e:
        raise FormatError("no Content-Length") from e
    block = data[end + 4:end + 4 + length]
    if len(block) != length or data[end + 4 + length:] != b"\r\n\r\n":
        raise FormatError("Content-Length does not frame the record")
    return fields, block


def verified(fields: dict[str, str], block: bytes):
    """``(page_id, payload, payload_bytes, digest, type, refers_to)`` after checking the digests."""
    if fields["WARC-Block-Digest"] != "sha1:" + sha1_base32(block):
        raise FormatError(f"block digest of {fields['WARC-Record-ID']}")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(x.decode().split(": ", 1) for x in head.split(b"\r\n")[1:])
    length, digest = int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (length != len(payload) or digest != sha1_base32(payload)):
        raise FormatError(f"payload digest of {fields['WARC-Record-ID']}")

    def page(name):
        x = fields[name].removeprefix("<urn:page:").removesuffix(">") if name in fields else ""
        return int(x) if x else None
    return page("WARC-Record-ID"), payload, length, digest, fields["WARC-Type"], page("WARC-Refers-To")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the archives in ``manifest``: ``id, payload_bytes, payload_digest, record_type,
    refers_to`` and, if asked for, ``payload`` (null for revisits). One task reads an archive in sequence,
    and each archive has a task of its own up to ``READ_TASKS``: a small manifest would be merged into one."""
    def run(batches):
        for batch in batches:
            for path, n in zip(*(batch.column(c).to_pylist() for c in ("path", "n_records"))):
                yield from _read_one(path, n, payloads)
    schema = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    tasks = min(READ_TASKS, max(1, manifest.count()))
    return manifest.repartitionByRange(tasks, "path").mapInArrow(run, schema + (", payload binary" if payloads else ""))


def _read_one(path: str, n_records: int, payloads: bool):
    filesystem, inner = filesystem_of(path)
    rows, n = [], 0

    def batch():
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())[:5 + payloads]
        names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][:5 + payloads]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    with filesystem.open_input_stream(inner, compression=None) as f:
        for fields, block in read_records(iter(lambda: f.read(1 << 20), b"")):
            page_id, payload, length, digest, kind, refers_to = verified(fields, block)
            rows.append((page_id, length, digest, kind, refers_to, payload if kind == "response" else None))
            n += 1
            if len(rows) >= (64 if payloads else 2_000):
                yield batch()
                rows = []
    if n != n_records:
        raise FormatError(f"{path}: {n} of {n_records} records")
    yield batch()


def archive_pages(spark: SparkSession, pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes ``pages`` to the shared folder and reads the archives back."""
    return read_archives(write_archives(pages, scratch_path(spark, "warc"), min_bytes=min_bytes))


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    return result.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: DuckDB SQL of the query for tables whose ids are unique and known. Five hex digits are four letters of base32.
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS x, min(page_id) OVER (PARTITION BY b) AS least FROM p),
g AS (SELECT *, list_transform(range(0, 8), lambda k: CAST('0x' || substr(x, k * 5 + 1, 5) AS BIGINT)) AS words FROM h)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(words, lambda v: substr('{_BASE32}', 1 + (v >> 15), 1) || substr('{_BASE32}', 1 + (v >> 10) % 32, 1)
    || substr('{_BASE32}', 1 + (v >> 5) % 32, 1) || substr('{_BASE32}', 1 + v % 32, 1)), '') AS payload_digest,
  CASE WHEN least < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN least < page_id THEN least END AS refers_to FROM g"""
