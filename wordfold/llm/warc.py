"""Web archives: a WARC writer with revisit records and a splittable reader.

Every record is a gzip member of its own. A reading task gets a byte range of
an archive, looks for gzip magic in it, and checks each candidate by decoding
its beginning: only a member whose content starts with ``WARC/`` is
a record, however long its header is. Such a member that cannot be read to its end is an error, never passed over;
``short_archives`` compares what was read with what was written. A task owns the records that start inside its range and reads past
the range's end to finish the last one, so each record is read once whatever
the ranges are. After a record the search goes on behind its member.

Payloads are written once: of records with equal payloads, the one with the
smallest page id is a response and the others are revisits that refer to it.

Archives are written by tasks under the shared folder with names of their own;
the stored list of them holds what finished tasks wrote, so files of tasks that
were lost or ran twice are never read.

Ids may be of any type that can be cast to a string and back (``id_type`` of the reader).

Defined results: null html is an empty payload; null urls are left out of the
header; rows with a null page id are written without one (as responses only if
no row with an id has their payload); repeated rows are repeated records; an
empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordfold.llm.common import spread, stored, table, text_bytes, with_class_min
from wordfold.session import new_output_path

MIN_PAYLOAD = 0
FILE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
MAGIC = b"\x1f\x8b\x08"
_BEGIN = b"WARC/"
_CHUNK = 1 << 20
_ID = "urn:x-page"


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    scheme, sep, rest = path.partition(":")
    if not sep or scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + (rest if sep else path).lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_digests(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest`` of ``pages`` (``page_id, html``)."""
    slim = pages.select("page_id", text_bytes("html").alias("_payload"))
    kind = slim.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [x.as_py() for x in b.column(1)]
            cols = [pa.array([len(x) for x in data], pa.int64()), pa.array([payload_digest(x) for x in data], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["page_id", "payload_bytes", "payload_digest"])

    return slim.mapInArrow(run, f"page_id {kind}, payload_bytes bigint, payload_digest string")


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: a revisit if ``refers_to`` is given, else a response."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    # an empty id is not a null one
    name = lambda i: f"<{_ID}>" if i is None else f"<{_ID}:{urllib.parse.quote(str(i), safe='')}>"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~-._"))
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: {name(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, min_payload: int = MIN_PAYLOAD, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) as archives under the shared folder; the stored
    list of them as ``path, size, records``."""
    spark = pages.sparkSession
    digests = stored(page_digests(pages).distinct(), "warc-digests")
    # records below the least size are never revisits: they are classes of their own
    marked = digests.withColumn("_own", F.when(F.col("payload_bytes") < min_payload, F.col("page_id")))
    marked = stored(with_class_min(marked, ["payload_digest", "_own"], "page_id", "first", "warc-first"), "warc-marked")
    plan = marked.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "first")
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), text_bytes("html").alias("payload")
    ).withColumn("_sha", F.sha1("payload"))
    # the plan has one row per id and digest; hex and base32 are two spellings of one digest
    plan = plan.withColumn("_sha2", _hex_of("_digest"))
    joined = rows.join(plan, rows.page_id.eqNullSafe(plan["_id"]) & (rows["_sha"] == plan["_sha2"]))
    joined = joined.select("page_id", "url", "payload", F.col("_digest"), "first")
    folder = new_output_path(spark, "llm-warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        out, path, size, n = None, None, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            cols = [pa.array([f"{folder}/{path}"]), pa.array([size]), pa.array([n])]
            return pa.RecordBatch.from_arrays(cols, names=["path", "size", "records"])

        for b in batches:
            for page_id, url, payload, digest, first in zip(*(c for c in b.columns)):
                page_id, first = page_id.as_py(), first.as_py()
                if out is None:
                    fs.create_dir(base, recursive=True)
                    path, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{path}", compression=None)
                refers = None if first == page_id else first
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = z.compress(warc_record(page_id, url.as_py(), payload.as_py(), digest.as_py(), refers)) + z.flush()
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return stored(joined.mapInArrow(run, "path string, size bigint, records bigint"), "warc-files")


def _hex_of(digest: str):
    """Hex of a base32 SHA-1: eight characters are five bytes."""
    value = "0123456789"
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    as_digits = F.translate(F.col(digest), alphabet, value + "ABCDEFGHIJKLMNOPQRSTUV")
    parts = [F.lpad(F.lower(F.conv(F.substring(as_digits, 8 * i + 1, 8), 32, 16)), 10, "0") for i in range(4)]
    return F.concat(*parts)


class _Source:
    """Reads on from a place in a file, chunk by chunk."""

    def __init__(self, file, at: int) -> None:
        self.file, self.at = file, at

    def chunk(self) -> bytes:
        self.file.seek(self.at)
        data = self.file.read(_CHUNK)
        self.at += len(data)
        return data


def _member(file, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the record whose member starts at ``at``; none if there is none."""
    z, source = zlib.decompressobj(31), _Source(file, at)
    data, head, seen = bytearray(), None, 0
    headers: dict[str, str] = {}
    damaged = ValueError(f"damaged record at offset {at}")
    chunk = source.chunk()
    while not z.eof:
        begun = data.startswith(_BEGIN)
        try:
            # no more than its beginning, until that says that it is a record
            data += z.decompress(chunk) if begun else z.decompress(chunk, len(_BEGIN))
        except zlib.error as e:
            if begun:
                raise damaged from e
            return None
        if not (begun or _BEGIN.startswith(bytes(data)) or data.startswith(_BEGIN)):
            return None
        chunk = z.unconsumed_tail or (b"" if z.eof else source.chunk())
        if not chunk and not z.eof:
            if data.startswith(_BEGIN):
                raise damaged
            return None
        if head is None:
            end = data.find(b"\r\n\r\n", max(0, seen - 3))
            seen = len(data)
            if end >= 0:
                lines = bytes(data[:end]).decode("utf-8", "replace").split("\r\n")[1:]
                headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                head = end + 4
    if not data.startswith(_BEGIN):
        return None
    size = headers.get("content-length", "")
    if head is None or "warc-type" not in headers or not size.isdigit() or len(data) < head + int(size):
        raise damaged
    return headers, bytes(data[head : head + int(size)]), source.at - len(z.unused_data)


def scan_range(file, first: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, headers, block)`` of the records that start in ``[first, stop)``."""
    at, window, base = first, b"", first
    while at < stop:
        if at < base or at + len(MAGIC) > base + len(window):
            file.seek(at)
            base, window = at, file.read(min(_CHUNK, stop - at) + len(MAGIC) - 1)
            if len(window) < len(MAGIC):
                return
        hit = window.find(MAGIC, at - base)
        if hit < 0 or base + hit >= stop:
            at = base + len(window) - len(MAGIC) + 1
            if hit >= 0:
                return
            continue
        record = _member(file, base + hit)
        if record is None:
            at = base + hit + 1
        else:
            yield base + hit, record[0], record[1]
            at = record[2]


def _page(name: str | None) -> str | None:
    value = (name or "").strip("<>").removeprefix(_ID)
    return urllib.parse.unquote(value[1:]) if value.startswith(":") else None


def read_warc(files: DataFrame, range_bytes: int = RANGE_BYTES, id_type: str = "bigint") -> DataFrame:
    """Records of the archives in ``files`` (``path, size``): ``path, offset, page_id, url,
    payload, payload_bytes, payload_digest, record_type, refers_to``.

    A response's digest and size are those of the payload that was read (a record whose payload
    doesn't have the digest in its header is an error); a revisit has no payload, its digest
    and size are those of the payload it stands for.
    """
    step = F.lit(range_bytes).cast("bigint")
    ranges = files.where("size > 0").select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, step)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, inside = filesystem(path)
                with fs.open_input_file(inside) as file:
                    rows, held = [], 0
                    for offset, headers, block in scan_range(file, first, first + range_bytes):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                        kind, size = headers["warc-type"], len(payload)
                        if kind == "revisit":
                            size = int(head.rpartition(b"Content-Length: ")[2])
                        elif payload_digest(payload) != digest:
                            raise ValueError(f"damaged payload at {path}:{offset}")
                        page, refers = _page(headers.get("warc-record-id")), _page(headers.get("warc-refers-to"))
                        url = headers.get("warc-target-uri")
                        rows.append((path, offset, page, url, payload, size, digest, kind, refers))
                        held += len(payload)
                        if held > 16 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    names = ["path", "offset", "page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def batch(rows: list) -> pa.RecordBatch:
        cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(cols, names=names)

    schema = (
        "path string, offset bigint, page_id string, url string, payload binary, payload_bytes bigint, "
        "payload_digest string, record_type string, refers_to string"
    )
    found = spread(ranges, "path", "first").mapInArrow(run, schema)
    typed = {c: F.col(c).cast(id_type).alias(c) for c in ("page_id", "refers_to")}
    return found.select(*[typed.get(c, F.col(c)) for c in names])


def short_archives(files: DataFrame, records: DataFrame) -> DataFrame:
    """``path, records, found`` of the archives in ``files`` of which ``records`` (``path``) has another number of
    records than were written."""
    found = records.groupBy(F.col("path").alias("_path")).agg(F.count("*").alias("found"))
    both = files.join(found, F.col("path") == F.col("_path"), "left").select("path", "records", F.coalesce("found", F.lit(0).cast("bigint")).alias("found"))
    return both.where("records <> found")


def q_warc(spark: SparkSession, sf_dir: str):
    files = write_warc(table(spark, sf_dir, "pages"))
    return read_warc(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
