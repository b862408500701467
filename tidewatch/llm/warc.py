"""WARC archives: writing with revisit records, and a reader that salvages what it can.

The reader checks each record (compression, version line, length, digests). After a failed check it
looks for the next place where a whole record can be read, goes on there, and reports the bytes
in between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.flat import small_batches
from tidewatch.plans.staging import stage, staging_path

ROLL_BYTES = 16 << 20
CHUNK = 1 << 20
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def open_fs(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


# -- writing -------------------------------------------------------------------

def record(name: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record, uncompressed: a response, or a revisit that leaves the payload out. HTTP's Content-Length is that of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {url}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Block-Digest: sha1:{digest32(block)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _clean(url: str | None) -> str:
    return "".join(c for c in url or "" if c > " ") or "urn:unknown"


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0,
          compress: bool = True, roll: int = ROLL_BYTES) -> DataFrame:
    """Writes a record per row below ``folder`` and gives the list of archives: (path, bytes, records).

    Of equal payloads of ``least`` bytes or more the smallest page_id is the response and the others revisit it; a page
    without id, and every row that repeats the smallest id, is a response. Null payloads are empty. Tasks write files of their
    own names and list them in a written table, so what a lost or repeated attempt leaves behind is in no list.
    Payloads are looked up by digest; they are shuffled only if the list of repeated digests is too large to broadcast.
    """
    small_batches(pages)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    again = (rows.filter(F.octet_length("payload") >= least).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select(F.col("sha").alias("_sha"), "first"))
    again = stage(again, "again")
    rows = rows.join(again, (F.col("sha") == F.col("_sha")) & (F.octet_length("payload") >= least), "left")
    rows = rows.select("page_id", "url", "payload", F.when(F.col("first") != F.col("page_id"), F.col("first")).cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, written = None, []
        at = TaskContext.get().partitionId()
        for b in batches:
            for name, link, payload, refers in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    path = f"{folder}/part-{at:05d}-{uuid.uuid4().hex}.warc{'.gz' if compress else ''}"
                    fs, inner = open_fs(path)
                    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    out, size, n = fs.open_output_stream(inner, compression=None), 0, 0
                data = record(str(name), _clean(link), payload, digest32(payload), refers)
                data = _member(data) if compress else data
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= roll:
                    out.close()
                    written.append((path, size, n))
                    out = None
        if out is not None:
            out.close()
            written.append((path, size, n))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*written)) or [[]] * 3, (pa.string(), pa.int64(), pa.int64()))], ["path", "bytes", "records"])

    return stage(rows.mapInArrow(run, "path string, bytes long, records long"), "archives")


# -- reading -------------------------------------------------------------------

class Window:
    """The bytes of a stream from ``start`` on, read as they are asked for."""

    def __init__(self, stream):
        self.stream, self.data, self.start, self.done = stream, bytearray(), 0, False

    def need(self, n: int) -> bool:
        """Whether n bytes are there."""
        while len(self.data) < n and not self.done:
            more = self.stream.read(max(CHUNK, n - len(self.data)))
            if more:
                self.data += more
            else:
                self.done = True
        return len(self.data) >= n

    def skip(self, n: int) -> None:
        del self.data[:n]
        self.start += n

    def find(self, mark: bytes, at: int) -> int:
        """Position of the mark from ``at`` on, -1 if it never comes; what lies before is kept."""
        while True:
            k = self.data.find(mark, at)
            if k >= 0 or self.done:
                return k
            at = max(at, len(self.data) - len(mark) + 1)
            self.need(len(self.data) + CHUNK)


    def skip_to(self, marks: tuple[bytes, ...], at: int) -> None:
        """Skips to the first of the marks from ``at`` on, or to the end; what is passed is let go a chunk at a time."""
        keep = max(map(len, marks)) - 1
        while True:
            spots = [k for k in (self.data.find(m, at) for m in marks) if k >= 0]
            if spots:
                self.skip(min(spots))
                return
            if self.done:
                self.skip(len(self.data))
                return
            passed = max(0, len(self.data) - keep)
            self.skip(passed)
            at = max(0, at - passed)
            self.need(len(self.data) + CHUNK)


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        k, sep, v = line.partition(":")
        if sep:
            out.setdefault(k.strip().lower(), v.strip())
    return out


def _parse(data, whole: bool) -> tuple[dict, bytes, int] | str:
    """(headers, block, length) of the record at the start of ``data``, or what is wrong; ``whole``: nothing may follow."""
    if not data.startswith(VERSION):
        return "no version line"
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return "no end of headers"
    headers = _headers(bytes(data[:end]))
    size = headers.get("content-length", "")
    if not size.isdigit():
        return "no content length"
    total = end + 4 + int(size) + 4
    if len(data) < total:
        return "cut off"
    block = bytes(data[end + 4: total - 4])
    if data[total - 4: total] != b"\r\n\r\n" or whole and len(data) != total:
        return "wrong length"
    want = headers.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != digest32(block):
        return "wrong block digest"
    return headers, block, total


def _gzip_record(w: Window) -> tuple[dict, bytes, int] | str:
    """The record in the gzip member at the start of the window, its length there, or what is wrong."""
    z, out, at = zlib.decompressobj(31), [], 0
    try:
        while not z.eof:
            if not w.need(at + 1):
                return "cut off"
            part = bytes(w.data[at: at + CHUNK])
            out.append(z.decompress(part))
            at += len(part)
            if len(out) == 1 and not out[0][:7] == VERSION[: len(out[0][:7])]:
                return "no version line"
    except zlib.error:
        return "broken member"
    got = _parse(b"".join(out), True)
    return got if isinstance(got, str) else (*got[:2], at - len(z.unused_data))


def _plain_record(w: Window) -> tuple[dict, bytes, int] | str:
    end = w.find(b"\r\n\r\n", 0) if w.data.startswith(VERSION) else -1
    if end < 0:
        return "no version line" if not w.data.startswith(VERSION) else "no end of headers"
    size = _headers(bytes(w.data[:end])).get("content-length", "")
    if size.isdigit():
        # a false length may ask for more than there is, but not for more than the next version line allows
        if not w.need(end + 8 + int(size)):
            return "cut off"
    return _parse(w.data[: end + 8 + int(size)] if size.isdigit() else w.data, False)


def read_stream(stream) -> Iterator[tuple[str, int, int, dict, bytes]]:
    """("record", start, end, headers, block) and ("gap", start, end, {"reason"}, b"") in the order of the bytes, which they cover without holes."""
    w = Window(stream)
    gap, reason = None, ""
    while w.need(1):
        w.need(len(VERSION))
        packed = w.data.startswith(GZIP[:2])
        got = _gzip_record(w) if packed else _plain_record(w)
        if isinstance(got, str):
            if gap is None:
                gap, reason = w.start, got
            w.skip_to((GZIP, VERSION), 1)
            continue
        if gap is not None:
            yield "gap", gap, w.start, {"reason": reason}, b""
            gap = None
        start = w.start
        w.skip(got[2])
        yield "record", start, w.start, got[0], got[1]
    if gap is not None:
        yield "gap", gap, w.start, {"reason": reason}, b""


SCHEMA = ("path string, kind string, start long, end long, reason string, record_id string, record_type string, url string, refers_to string, "
          "payload_bytes long, payload_digest string, payload binary")


def _row(path: str, kind: str, start: int, end: int, headers: dict, block: bytes, payloads: bool) -> tuple:
    if kind == "gap":
        return path, kind, start, end, headers["reason"], None, None, None, None, None, None, None
    http = headers.get("content-type", "").startswith("application/http")
    head, sep, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    reason = None
    if headers.get("warc-type") == "revisit":
        size = _headers(head).get("content-length", "")
        size = int(size) if size.isdigit() else None
    else:
        own = digest32(payload)
        reason = "wrong payload digest" if digest and digest != own else None
        size, digest = len(payload), own
    return (path, kind, start, end, reason, headers.get("warc-record-id"), headers.get("warc-type"), headers.get("warc-target-uri"),
            headers.get("warc-refers-to"), size, digest or None, payload if payloads else None)


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archives in column ``path`` (plain, or gzip with a member per record, told apart at each place).

    A task streams one archive at a time and holds one record; a gap's bytes are scanned, not kept (a false length or a
    member without end may make it hold the rest of the archive). Of revisits payload_bytes
    and payload_digest are those of the full payload, as their headers give them. An empty archive gives no rows.
    """
    small_batches(archives)
    n = max(1, min(archives.count(), 4 * archives.sparkSession.sparkContext.defaultParallelism))
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary())
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(kinds), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, inner = open_fs(path)
                rows, held = [], 0
                with fs.open_input_stream(inner, compression=None) as stream:
                    for item in read_stream(stream):
                        rows.append(_row(path, *item, payloads))
                        held += len(rows[-1][-1] or b"") + 200
                        if held > CHUNK * 4:
                            yield batch(rows)
                            rows, held = [], 0
                yield batch(rows)

    return archives.select("path").repartition(n).mapInArrow(run, SCHEMA)


def read_content(files: DataFrame, payloads: bool = True) -> DataFrame:
    """``read`` for rows (path, content) of Spark's binaryFile source, for stores that only Spark reaches; a task holds a few whole files."""
    small_batches(files)
    import io

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary())
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = [_row(path, *item, payloads) for item in read_stream(io.BytesIO(content.as_py() or b""))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(kinds), kinds)], [c.split()[0] for c in SCHEMA.split(", ")])

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the pages and reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to per record."""
    archives = write(pages, staging_path(spark, "warc"), least=least)
    number = lambda c: F.nullif(F.regexp_extract(F.col(c), r"^<urn:page:(.*)>$", 1), F.lit("None")).cast("long")
    return (read(archives, payloads=False).filter("kind = 'record'")
            .select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.when(F.col("refers_to").isNotNull(), number("refers_to")).alias("refers_to")))
