"""WARC archives: a writer with revisit records and a splittable reader.

Archives are series of gzip members, one record each, so a reader may start anywhere: a task scans its byte
range for the gzip magic, takes a candidate for a member only if its head decodes to a WARC version line,
its length and checksum hold and a member or the end of the file follows, and owns the records that start
inside its range, reading past the end of the range for the last of them.

Files are written and read through ``pyarrow.fs``, so the folder may be on any store it knows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.session import stage

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 64 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("path string, offset long, warc_type string, record_id string, refers_to string, target_uri string, "
          "payload_digest string, digest_holds boolean, payload_bytes long, payload binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None = None, date: str = DATE,
                  level: int = 6) -> bytes:
    """One gzip member: a response, or a revisit of ``refers_to`` that keeps the HTTP head and not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if url is not None:  # control characters and spaces would end the header or the value
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: of equal payloads the largest page_id is kept, the others refer to it.

    Rows that tie on the largest page_id are all kept; a null page_id is smaller than any, and payloads that
    only rows without page_id have are all kept, as are payloads of fewer than ``min_bytes`` bytes. The groups
    are counted before the join, so a group that holds much of the table is one row of its side. Columns other than
    page_id, url and html are not read, a payload of any length is kept whole, and an empty table gives no row.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    groups = stage(rows.filter(F.octet_length("payload") >= min_bytes).groupBy("sha")
                   .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").select("sha", "top"), "warc-groups")
    return (rows.join(groups, "sha", "left")
            .select("page_id", "url", "payload",
                    F.when(~F.col("page_id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to")))


def _urn(page_id: int | None) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}"


def write_warc(records: DataFrame, folder: str, file_bytes: int = 1 << 30) -> DataFrame:
    """Writes ``page_id, url, payload, refers_to`` as archives; returns their manifest (``path, bytes, records``).

    Each task attempt writes files of its own and names them in the manifest, so what a lost or repeated
    attempt leaves behind is in no manifest and is never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        attempt = TaskContext.get().taskAttemptId()
        done: list[tuple[str, int, int]] = []
        out, size, count = None, 0, 0

        def close() -> None:
            nonlocal out, size, count
            if out is not None:
                out.close()
                done.append((f"{folder}/part-{attempt:010d}-{len(done):04d}.warc.gz", size, count))
            out, size, count = None, 0, 0

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
            for page_id, url, payload, refers in zip(*columns):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/part-{attempt:010d}-{len(done):04d}.warc.gz", compression=None)
                member = encode_record(_urn(page_id.as_py()), url.as_py(), payload.as_py(),
                                       None if refers.as_py() is None else _urn(refers.as_py()))
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    close()
        close()
        if done:
            paths, sizes, counts = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                                             ["path", "bytes", "records"])

    return stage(records.mapInArrow(write, "path string, bytes long, records long"), "warc-manifest")


class _Window:
    """Bytes of a file around a moving place, read in pieces."""

    def __init__(self, read_at: Callable[[int, int], bytes], size: int):
        self.read_at, self.size, self.base, self.data = read_at, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``; fewer only at the end of the file."""
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if not (self.base <= at and at + n <= self.base + len(self.data)):
            self.base, self.data = at, self.read_at(max(n, min(READ_BYTES, self.size - at)), at)
        return self.data[at - self.base:at - self.base + n]

    def find_magic(self, at: int, end: int) -> int:
        """Place of the first magic that starts in [at, end), or -1."""
        while at < end:
            piece = self.get(at, min(READ_BYTES, end - at + len(MAGIC) - 1))
            found = piece.find(MAGIC)
            if found >= 0:
                return at + found if at + found < end else -1
            if len(piece) < len(MAGIC):
                return -1
            at += len(piece) - len(MAGIC) + 1
        return -1


def _decode(window: _Window, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the record whose member starts at ``at``; None if there is none."""
    unpack, out, place = zlib.decompressobj(31), [], at
    try:
        piece = window.get(place, 1024)
        head = unpack.decompress(piece, 16)
        if not head.startswith(b"WARC/1."):
            return None
        out.append(head)
        place += len(piece)
        rest = unpack.unconsumed_tail
        while not unpack.eof:
            piece = rest or window.get(place, 65536)
            if not piece:
                return None
            if not rest:
                place += len(piece)
            out.append(unpack.decompress(piece))
            rest = b""
    except zlib.error:
        return None
    head, mark, body = b"".join(out).partition(b"\r\n\r\n")
    fields = [line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]]
    headers = {name.strip().lower(): value.strip() for name, _, value in fields}
    length = headers.get("content-length", "")
    if not mark or not length.isdigit() or len(body) != int(length) + 4:
        return None
    return headers, body[:-4], place - len(unpack.unused_data)


def scan_range(read_at: Callable[[int, int], bytes], size: int, start: int, end: int) -> Iterator[tuple[int, dict, bytes]]:
    """Offset, headers and block of each record that starts in [start, end)."""
    window, at, in_step = _Window(read_at, size), start, False
    while 0 <= (at := window.find_magic(at, min(end, size))):
        record = _decode(window, at)
        if record is not None and not in_step:  # inside a payload may lie a member, but no series that goes on
            in_step = record[2] == size or window.get(record[2], len(MAGIC)) == MAGIC
        if record is None or not in_step:
            at += 1
            continue
        yield at, record[0], record[1]
        at = record[2]


def _row(path: str, offset: int, headers: dict[str, str], block: bytes, payload: bool) -> tuple:
    http, mark, body = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http.replace(b"\r", b""))
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if headers.get("warc-type") == "revisit":
        n, holds, body = int(stated[1]) if stated else None, None, None
    else:
        found = base32_sha1(body)
        n, holds, digest = len(body), digest is None or digest == found, found
    bare = lambda name: headers[name].strip("<>") if name in headers else None
    return (path, offset, headers.get("warc-type"), bare("warc-record-id"), bare("warc-refers-to"),
            headers.get("warc-target-uri"), digest, holds, n, body if payload else None)


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Records of the archives in ``files`` (``path, bytes``), by byte ranges of ``split_bytes``.

    The digest of a response is that of the bytes read (``digest_holds`` says whether the header agrees),
    a revisit has the digest and length its headers state. Damaged members are passed over. A task holds one record
    of any length and a batch of rows; a manifest without files gives no row.
    """
    ranges = files.filter("bytes > 0").select("path", "bytes", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    names = [f.split()[0] for f in RECORD.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in RECORD.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, held
            columns = list(zip(*rows))
            rows, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for n, c in zip(names, columns)], schema=schema)

        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start"))):
                fs, name = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as f:
                    for offset, headers, block in scan_range(f.read_at, size, start, start + split_bytes):
                        rows.append(_row(path, offset, headers, block, payload))
                        held += 300 + (len(block) if payload else 0)
                        if held >= BATCH_BYTES:
                            yield flush()
        if rows:
            yield flush()

    n = max(1, min(ranges.count(), 100_000))
    return ranges.repartition(n, "path", "start").mapInArrow(read, RECORD)


def page_id_of(urn: str) -> Column:
    return F.when(F.col(urn) != _urn(None), F.regexp_extract(urn, r"^urn:x-page:(-?\d+)$", 1).cast("long"))
