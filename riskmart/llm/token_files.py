"""Token ids as binary files from which single documents can be read.

A file is a series of independent zstandard frames in the seekable format: data frames, one skippable frame with
the document index, and at the end the seek table (a skippable frame with the packed and unpacked size and the
checksum of every frame). Any zstandard tool unpacks such a file to its ids, and a reader unpacks only the frames
of the documents it is asked for. A document no longer than ``FRAME_BYTES`` lies in one frame; a longer one has
frames of its own. Ids take two bytes where the vocabulary allows it, else four, little-endian.

Files are written and read through ``pyarrow.fs``, so the folder may be on any store it knows.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import hashing, pieces
from riskmart.session import stage

FRAME_BYTES = 256 << 10
FILE_BYTES = 1 << 30
FILE_DOCS = 1 << 20
TEXT_BYTES = 16 << 20
READ_FRAMES = 256
LEVEL = 3

# Fixed values of the seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

_INDEX_MARK = b"TKIX"
_INDEX_HEAD = struct.Struct("<4sHHQ")  # mark, version, bytes of an id, documents
_FOOTER = struct.Struct("<IBI")  # frames, flags, magic


def checksum(data: bytes) -> int:
    """The low 32 bits of XXH64, as the format has it."""
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Writer:
    """Documents to one file; ``sink`` takes bytes."""

    def __init__(self, sink: Callable[[bytes], object], width: int, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.sink, self.width, self.frame_bytes = sink, width, frame_bytes - frame_bytes % width
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.bytes = 0

    def _frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.sink(packed)
        self.frames.append((len(packed), len(data), checksum(data)))
        self.bytes += len(packed)

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.held_bytes = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids) // self.width)
        if self.held_bytes + len(ids) > self.frame_bytes:
            self._flush()
        whole = len(ids) - len(ids) % self.frame_bytes if len(ids) > self.frame_bytes else 0
        for at in range(0, whole, self.frame_bytes):
            self._frame(ids[at:at + self.frame_bytes])
        if len(ids) > whole:
            self.held.append(ids[whole:])
            self.held_bytes += len(ids) - whole

    def close(self) -> None:
        self._flush()
        n = len(self.sizes)
        null = np.array([d is None for d in self.doc_ids], "u1")
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        body = _INDEX_HEAD.pack(_INDEX_MARK, 1, self.width, n) + ids.tobytes() + np.array(self.sizes, "<u8").tobytes() + null.tobytes()
        body += struct.pack("<I", checksum(body))
        index = struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body
        entries = [*self.frames, (len(index), 0, checksum(b""))]
        table = b"".join(struct.pack("<III", *e) for e in entries) + _FOOTER.pack(len(entries), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        tail = index + struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table
        self.sink(tail)
        self.bytes += len(tail)


class Reader:
    """One file, of which ``read_at(n, place)`` gives bytes; unpacks a frame when a document in it is asked for."""

    def __init__(self, read_at: Callable[[int, int], bytes], size: int):
        self.read_at, self.unpacker = read_at, zstandard.ZstdDecompressor()
        self.unpacked = 0  # frames
        frames, flags, magic = _FOOTER.unpack(read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = size - _FOOTER.size - 12 * frames
        entries = np.frombuffer(read_at(12 * frames, table), "<u4").reshape(frames, 3).astype(np.int64)
        packed = np.concatenate(([0], np.cumsum(entries[:, 0])))
        if packed[-1] != table - 8:
            raise ValueError("the seek table does not fit the file")
        body = read_at(int(entries[-1, 0]), int(packed[-2]))[8:]
        if checksum(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
            raise ValueError("the document index is damaged")
        mark, _, self.width, n = _INDEX_HEAD.unpack_from(body)
        if mark != _INDEX_MARK:
            raise ValueError("no document index before the seek table")
        at = _INDEX_HEAD.size
        self.doc_ids = np.frombuffer(body, "<i8", n, at)
        self.sizes = np.frombuffer(body, "<u8", n, at + 8 * n).astype(np.int64)
        self.null = np.frombuffer(body, "u1", n, at + 16 * n).astype(bool)
        self.packed, self.sums = packed[:-1], entries[:-1, 2]
        self.starts = np.concatenate(([0], np.cumsum(entries[:-1, 1])))  # of the data frames, unpacked
        self.docs = np.concatenate(([0], np.cumsum(self.sizes)))  # first id of each document in the file
        self.last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            data = self.unpacker.decompress(self.read_at(int(self.packed[k + 1] - self.packed[k]), int(self.packed[k])),
                                            max_output_size=int(self.starts[k + 1] - self.starts[k]))
            self.unpacked += 1
            if checksum(data) != self.sums[k]:
                raise ValueError(f"frame {k} is damaged")
            self.last = (k, data)
        return self.last[1]

    def ids(self, d: int) -> np.ndarray:
        """Ids of document ``d`` of the file."""
        start, end = (int(x) * self.width for x in self.docs[d:d + 2])
        out, k = [], int(np.searchsorted(self.starts, start, "right")) - 1
        while start < end:
            data, base = self.frame(k), int(self.starts[k])
            out.append(data[start - base:end - base])
            start, k = base + len(data), k + 1
        return np.frombuffer(b"".join(out), f"<u{self.width}")

    def documents(self, first: int, last: int) -> range:
        """Documents that start in the frames first to last - 1; those without ids at the end belong to the last frame."""
        lo, hi = self.starts[first], self.starts[min(last, len(self.starts) - 1)]
        from_, to = np.searchsorted(self.docs[:-1] * self.width, [lo, hi])
        return range(int(from_), len(self.sizes) if last >= len(self.starts) - 1 else int(to))


MANIFEST = "path string, part int, file int, bytes long, n_docs long, n_ids long, frames long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0, file_bytes: int = FILE_BYTES,
                 frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encodes ``text`` and writes the ids in ascending doc_id order; returns the manifest, a row per file.

    ``tokenizer`` is the path of a tokenizer file on every executor. ``end_id`` follows each document's ids (None:
    nothing does). A null text is empty. A null doc_id comes before all others, rows of one doc_id are in the order
    of a hash of their texts, and rows equal in both are each written. An empty table gives no file, and other columns
    are not read. A text of any length is encoded whole; a task holds one Arrow batch and the index of one file.
    Each task attempt writes files of its own, named in the manifest, so what a lost attempt leaves is never read.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("th"),
                       F.monotonically_increasing_id().alias("pos"))  # apart, so that equal rows may go to several tasks
    order = [F.col("id").asc_nulls_first(), F.col("th"), F.col("pos")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        bpe = pieces.byte_bpe(tokenizer)
        width = 2 if max(bpe.size - 1, end_id or 0) < 1 << 16 else 4
        end = b"" if end_id is None else end_id.to_bytes(width, "little")
        done: list[tuple] = []
        out = writer = None

        def close() -> None:
            nonlocal out, writer
            if writer is not None:
                writer.close()
                out.close()
                done.append((f"{folder}/{name()}", part, len(done), writer.bytes, len(writer.sizes), sum(writer.sizes), len(writer.frames)))
            out = writer = None

        def name() -> str:
            return f"part-{part:06d}-{len(done):04d}-{attempt:010d}.tok.zst"

        for batch in batches:
            ids = batch.column("id").to_pylist()
            for first, last, data, bounds in hashing.blocks(batch.column("text"), TEXT_BYTES):
                values, at = bpe.encode(data, bounds)
                values = values.astype(f"<u{width}")
                for k in range(last - first):
                    if writer is None:
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(f"{root}/{name()}", compression=None)
                        writer = Writer(out.write, width, frame_bytes)
                    writer.add(ids[first + k], values[at[k]:at[k + 1]].tobytes() + end)
                    if writer.bytes >= file_bytes or len(writer.sizes) >= FILE_DOCS:
                        close()
        close()
        if done:
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=[c.split()[0] for c in MANIFEST.split(", ")])

    return stage(rows.mapInArrow(write, MANIFEST), "token-manifest")


def with_base(files: DataFrame) -> DataFrame:
    """``base``: ids in all files before. The window is over files, of which there is one for about a gigabyte."""
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _open(path: str, size: int) -> tuple[pa.NativeFile, Reader]:
    fs, name = pyarrow.fs.FileSystem.from_uri(path)
    file = fs.open_input_file(name)
    return file, Reader(file.read_at, size)


TOKENS = "doc_id long, start long, n_tokens long, ids binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in TOKENS.split(", ")])


def _emit(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for row in found:
        rows.append(row)
        held += 64 + len(row[3])
        if held >= TEXT_BYTES:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def read_tokens(files: DataFrame, read_frames: int = READ_FRAMES) -> DataFrame:
    """All documents of a manifest: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``
    (little-endian unsigned 32-bit integers). A task reads the documents that start in its ``read_frames`` frames."""
    step = F.lit(read_frames).cast("long")
    ranges = with_base(files).select("path", "bytes", "base", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("frames") - 1, F.lit(0)), step)).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for path, size, base, first in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "base", "first"))):
                    file, reader = _open(path, size)
                    with file:
                        for d in reader.documents(first, first + read_frames):
                            ids = reader.ids(d).astype("<u4").tobytes()
                            yield (None if reader.null[d] else int(reader.doc_ids[d]), base + int(reader.docs[d]), len(ids) // 4, ids)

        yield from _emit(rows())

    n = max(1, min(ranges.count(), 100_000))
    return ranges.repartition(n, "path", "first").mapInArrow(read, TOKENS)


INDEX = "path string, bytes long, base long, place long, frame long, doc_id long"


def read_index(files: DataFrame) -> DataFrame:
    """A row per document: its file, place in it and first frame. No frame is unpacked."""
    listed = with_base(files).select("path", "bytes", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, base in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "base"))):
                file, reader = _open(path, size)
                with file:
                    n = len(reader.sizes)
                    frame = np.searchsorted(reader.starts, reader.docs[:-1] * reader.width, "right") - 1
                    for at in range(0, n, 65536):
                        k = min(65536, n - at)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * k), pa.array([size] * k, pa.int64()), pa.array([base] * k, pa.int64()),
                             pa.array(np.arange(at, at + k)), pa.array(frame[at:at + k]),
                             pa.array(reader.doc_ids[at:at + k].astype(np.int64), mask=reader.null[at:at + k])],
                            names=[c.split()[0] for c in INDEX.split(", ")])

    n = max(1, min(listed.count(), 100_000))
    return listed.repartition(n, "path").mapInArrow(read, INDEX)


def fetch(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents whose doc_id is among ``wanted.doc_id``, as :func:`read_tokens` gives them; only their frames are unpacked.

    A wanted id no document has gives no row, one that several have gives all of them; null finds nothing.
    """
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    places = read_index(files).join(ids, "doc_id", "left_semi").select("path", "bytes", "base", "place", "frame")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            opened, file, reader = None, None, None
            for batch in batches:
                for path, size, base, d in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "base", "place"))):
                    if path != opened:
                        if file is not None:
                            file.close()
                        opened, (file, reader) = path, _open(path, size)
                    got = reader.ids(d).astype("<u4").tobytes()
                    yield (None if reader.null[d] else int(reader.doc_ids[d]), base + int(reader.docs[d]), len(got) // 4, got)
            if file is not None:
                file.close()

        yield from _emit(rows())

    return places.repartition("path", F.floor(F.col("frame") / READ_FRAMES)).sortWithinPartitions("path", "place").mapInArrow(read, TOKENS)
