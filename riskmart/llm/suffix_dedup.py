"""Exact substring dedup by a logarithmic family of suffix arrays.

Bytes covered by a string of ``MATCH`` bytes that also starts earlier are removed. Which strings have to be
compared is decided by anchors: of the windows of ``MATCH`` bytes, each has as anchor the smallest hash of its
``ANCHOR``-byte pieces, so equal windows have equal anchors wherever they stand. A text falls into pieces,
runs of windows with one anchor; pieces whose anchor no other piece has cannot repeat anything, and equal
pieces are folded onto the first of them before anything is shuffled. The distinct pieces that share an
anchor go to the task of that anchor as bytes, anchor by anchor, each in document order, batch by batch: a batch
gets a suffix array (its suffixes in the order of their first ``MATCH`` bytes), is scanned against the arrays of
the levels before it, and becomes a level; levels of about equal size are merged, so there are never more than
logarithmically many. Levels end with their anchor, so a task's memory is that of one anchor and not of its rows.

Anchors that much of the corpus has (a stock line in every context) would gather there. They are found on a
sample and rank behind all others when anchors are chosen, so that a window around such a line is anchored
in its own surroundings. The sample moves the load and cannot change the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import hashing
from riskmart.llm.common import keyed
from riskmart.session import stage

MATCH = 100
ANCHOR = 32
# A piece holds at most so many windows (periodic text has one anchor throughout).
PIECE_WINDOWS = 128
FLUSH_PIECES = 1 << 20
# Suffixes in a batch of the index.
BATCH = 1 << 16
# One document in so many is looked at for anchors that are everywhere; one is if so many pieces have it there.
SAMPLE_EVERY, COMMON_IN_SAMPLE, MAX_COMMON = 64, 200, 50_000
_TOP = np.uint64(1 << 63)


class Common:
    """Set of anchor hashes, tested by a bit table before it is searched."""

    def __init__(self, values: np.ndarray):
        self.values = np.sort(values)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.values & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def lower(self, hashes: np.ndarray) -> np.ndarray:
        """The hashes without their top bit, but with it where they are in the set."""
        hashes &= ~_TOP
        if len(self.values):
            maybe = np.flatnonzero(self.bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
            hashes[maybe[self.values[at] == hashes[maybe]]] |= _TOP
        return hashes


def _sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        x = pick(x[:-reach], x[reach:])
        reach *= 2
    return pick(x[:len(x) - (width - reach)], x[width - reach:]) if reach < width else x


def pieces(data: np.ndarray, bounds: np.ndarray, hasher: hashing.RangeHash, common: Common) -> tuple[np.ndarray, ...]:
    """Start (in ``data``), number of windows, anchor, content hash of the pieces of the texts, and whether
    the anchor stands in the piece twice: only then can a piece repeat its own windows."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < MATCH:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    prefix = hasher.prefix(data)
    hashes = prefix[ANCHOR:] - prefix[:-ANCHOR]
    hashes *= hasher.inverse[:n - ANCHOR + 1]
    grams = common.lower(hashing.mix(hashes))
    width = MATCH - ANCHOR + 1
    least = _sliding(np.minimum, grams, width)
    edge = np.zeros(width - 1, np.uint64)
    anchors = np.flatnonzero(_sliding(np.maximum, np.concatenate((edge, least, edge)), width) == grams)
    windows = n - MATCH + 1
    across = np.zeros(n + 1, np.int32)
    edges = bounds[(bounds > 0) & (bounds < n)]
    edges = edges[np.concatenate(([True], np.diff(edges) > 0))] if len(edges) else edges
    np.add.at(across, np.maximum(edges - MATCH + 1, 0), 1)
    np.add.at(across, edges, -1)
    whole = np.cumsum(across)[:windows] == 0
    opens = whole.copy()
    opens[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
    start = np.flatnonzero(opens)
    closed = np.flatnonzero(opens | ~whole)  # a piece ends where the next begins or a window crosses texts
    end = np.append(closed, windows)[np.searchsorted(closed, start, "right")]
    parts = -(-(end - start) // PIECE_WINDOWS)
    if len(parts) and parts.max() > 1:
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, end = np.repeat(start, parts) + step * PIECE_WINDOWS, np.repeat(end, parts)
        end = np.minimum(end, start + PIECE_WINDOWS)
    # anchors that stand between two equal ones of a piece would be its anchor, so neighbours tell
    pair = np.flatnonzero(grams[anchors][1:] == grams[anchors][:-1])
    place = np.searchsorted(anchors[pair], start)
    near = np.append(anchors[pair + 1], np.iinfo(np.int64).max)[place]
    twice = (near <= end - 1 + width - 1) & (grams[np.minimum(near, len(grams) - 1)] == least[start])
    return start, end - start, least[start], hasher.ranges(prefix, start, end + MATCH - 1), twice


def _folded(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """The first of equal pieces under their hash, the others as repeats under a place of their own."""
    k, s, ids, tks, q, loops = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    order = np.argsort(s)
    twice = np.zeros(len(s), bool)
    same = s[order][1:] == s[order][:-1]
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    at = at[np.lexsort((q[at], tks[at], ids[at], s[at], k[at]))]
    head = np.maximum.accumulate(np.where(np.concatenate(([True], (k[at][1:] != k[at][:-1]) | (s[at][1:] != s[at][:-1])))
                                          if len(at) else np.zeros(0, bool), np.arange(len(at)), 0))
    again = np.zeros(len(s), bool)
    h = at[head]
    again[at] = (ids[at] != ids[h]) | (tks[at] != tks[h]) | (q[at] != q[h])
    k = np.where(again, hashing.mix(ids.astype(np.uint64) + q.astype(np.uint64) * hashing.constants(1, 43)[0]), k)
    s = np.where(again, np.uint64(0), s)
    for i in range(0, len(k), 1 << 17):
        part = slice(i, i + (1 << 17))
        yield pa.RecordBatch.from_arrays(
            [pa.array(k[part].view(np.int64)), pa.array(s[part].view(np.int64)), pa.array(again[part]),
             pa.array(loops[part]), pa.array(ids[part]), pa.array(tks[part]), pa.array(q[part])],
            ["k", "s", "again", "twice", "id", "tk", "q"])


def _sender(common: np.ndarray):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``k, s, again, twice, id, tk, q``: the first of the equal pieces held, and the others as repeats.

        ``q`` is the place in the text times 256 plus the number of windows less one.
        """
        hasher, known = hashing.RangeHash(), Common(common)
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            ids, tks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, _, data, bounds in hashing.blocks(batch.column(2)):
                start, count, k, s, twice = pieces(data, bounds, hasher, known)
                row = np.searchsorted(bounds, start, "right") - 1
                parts.append((k, s, ids[first + row], tks[first + row], (start - bounds[row]) * 256 + count - 1, twice))
                held += len(k)
                if held >= FLUSH_PIECES:  # folding is an economy, so what is held may leave at any time
                    yield from _folded(parts)
                    parts, held = [], 0
        if held:
            yield from _folded(parts)

    return send


SENT = "k long, s long, again boolean, twice boolean, id long, tk long, q long"


def common_anchors(rows: DataFrame) -> np.ndarray:
    """Anchors that many pieces of a sample of the documents have: at most ``MAX_COMMON``."""
    some = rows.filter(F.pmod(F.xxhash64(F.lit("anchors"), "id"), F.lit(SAMPLE_EVERY)) == 0)
    counts = some.mapInArrow(_sender(np.zeros(0, np.uint64)), SENT).filter(~F.col("again")).groupBy("k").count()
    found = counts.filter(F.col("count") >= COMMON_IN_SAMPLE).orderBy(F.desc("count"), "k").limit(MAX_COMMON).collect()
    return np.array([r["k"] for r in found], np.int64).view(np.uint64)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``k, id, tk, p, piece``: the bytes of the wanted pieces of each text."""
    for batch in batches:
        size, out = 0, []
        for i in range(batch.num_rows):
            text = batch.column(2)[i].as_py().encode()
            for k, q in zip(*(np.asarray(batch.column(3)[i].values.field(f)) for f in (0, 1))):
                p, count = int(q) >> 8, (int(q) & 255) + 1
                out.append((int(k), batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), p, text[p:p + count + MATCH - 1]))
                size += count + MATCH
            if size > 4 << 20 or (out and i == batch.num_rows - 1):
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    ["k", "id", "tk", "p", "piece"])
                size, out = 0, []


class SuffixLevels:
    """Suffix arrays of doubling sizes; each is the sorted distinct first ``MATCH`` bytes of its suffixes."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Which of the sorted ``keys`` a level holds: a merge scan with each."""
        found = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        """A new level of sorted keys; levels up to twice the size of the one after them are merged into it."""
        if len(keys):
            self.levels.append(keys)
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            last = self.levels.pop()
            self.levels[-1] = np.sort(np.concatenate((self.levels[-1], last)), kind="stable")


def suffix_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First ``MATCH`` bytes of the suffixes of the texts that have as many, with text and place of each.

    Bytes are raised by one, as UTF-8 has no byte 255 and the comparison of keys ends at zeros.
    """
    counts = np.array([len(t) - MATCH + 1 for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8) + np.uint8(1)
    starts = np.concatenate(([0], np.cumsum(counts + MATCH - 1)))[:-1]
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    grid = np.lib.stride_tricks.sliding_window_view(data, MATCH)[starts[owner] + place]
    return np.ascontiguousarray(grid).view(f"S{MATCH}").ravel(), owner, place


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, tk, first, last``: byte ranges of the suffix prefixes that started earlier.

    Rows come anchor by anchor, those of an anchor in document order. Equal strings have equal anchors, so the levels
    hold the strings of one anchor, the one that the next batch may go on with, whatever else the task has.
    """
    levels = SuffixLevels()
    held: list[tuple[int, int, int, int, bytes]] = []
    windows, before, anchor = 0, None, None

    def scan() -> pa.RecordBatch | None:
        nonlocal levels, held, windows, anchor
        if not held:
            return None
        keys, owner, place = suffix_keys([x[4] for x in held])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        heads = ranked[fresh]
        old = levels.holds(heads)
        repeat = np.zeros(len(keys), bool)
        repeat[order] = ~fresh | old[np.cumsum(fresh) - 1]
        ks, ids, tks, ps = (np.array([x[i] for x in held]) for i in range(4))
        if anchor != ks[-1]:
            levels, anchor = SuffixLevels(), ks[-1]
        levels.add(heads[~old & (ks[owner[order[fresh]]] == ks[-1])])
        at = np.flatnonzero(repeat)
        held, windows = [], 0
        if not len(at):
            return None
        run = np.concatenate(([True], (owner[at][1:] != owner[at][:-1]) | (place[at][1:] != place[at][:-1] + 1)))
        begin, end = at[run], at[np.append(np.flatnonzero(run)[1:] - 1, len(at) - 1)]
        who = owner[begin]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[who], pa.int64()), pa.array(tks[who], pa.int64()), pa.array(ps[who] + place[begin], pa.int64()),
             pa.array(ps[who] + place[end] + MATCH, pa.int64())], ["id", "tk", "first", "last"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("k", "id", "tk", "p", "piece"))):
            if row[:4] == before:  # a repeated row of the table
                continue
            before = row[:4]
            held.append(row)
            windows += len(row[4]) - MATCH + 1
            if windows >= BATCH:
                if (out := scan()) is not None:
                    yield out
    if (out := scan()) is not None:
        yield out


def covered(docs: DataFrame) -> DataFrame:
    """``id, tk, spans``: byte ranges (``first, last``) that strings of ``MATCH`` bytes cover which started earlier."""
    rows = keyed(docs).select("id", F.col("th").alias("tk"), "text")
    sent = rows.mapInArrow(_sender(common_anchors(rows)), SENT)
    me = F.struct("id", "tk", "q")
    piece, anchor = Window.partitionBy("k", "again", "s").orderBy("id", "tk", "q"), Window.partitionBy("k", "again")
    judged = (sent.withColumn("whole", F.col("again") | (F.first(me).over(piece) != me))
              .withColumn("several", F.col("twice") | (F.min("s").over(anchor) != F.max("s").over(anchor))))
    found = stage(judged.filter("whole or several").select("k", "id", "tk", "q", "whole"), "suffix-pieces")
    wanted = found.filter("not whole").groupBy("id", "tk").agg(F.collect_set(F.struct("k", "q")).alias("wanted"))
    apart = rows.join(wanted, ["id", "tk"]).mapInArrow(_cut, "k long, id long, tk long, p long, piece binary")
    indexed = stage(apart.repartition("k").sortWithinPartitions("k", "id", "tk", "p").mapInArrow(
        _index, "id long, tk long, first long, last long"), "suffix-matches")
    place = F.shiftright("q", 8)
    whole = found.filter("whole").select("id", "tk", place.alias("first"),
                                         (place + F.col("q").bitwiseAND(F.lit(255)) + 1 + MATCH - 1).alias("last"))
    return whole.unionByName(indexed).groupBy("id", "tk").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        for first, last, data, bounds in hashing.blocks(batch.column(1)):
            part = batch.column(2).slice(first, last - first)
            owner = np.repeat(np.arange(last - first), np.asarray(part.value_lengths().fill_null(0)))
            flat = part.flatten()
            change = np.zeros(len(data) + 1, np.int32)
            np.add.at(change, bounds[owner] + np.asarray(flat.field(0)), 1)
            np.add.at(change, bounds[owner] + np.asarray(flat.field(1)), -1)
            gone = np.cumsum(change[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = bounds[:-1][bounds[:-1] < len(data)]
            opens[inner] = gone[inner]
            total = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[bounds])  # noqa: E731, B023
            kept = data[~gone].tobytes()
            edges = np.concatenate(([0], np.cumsum(~gone)))[bounds]
            left = [kept[a:b] for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), pa.array(np.diff(bounds)), pa.array(total(gone), pa.int64()),
                 pa.array(total(opens), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
                 pa.array(left, pa.binary())], names)


def dedup(docs: DataFrame) -> DataFrame:
    """A row for each document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes left).

    Texts are UTF-8 bytes, null is empty; strings are judged on the input, and earlier means a smaller doc_id
    or, in one document, an earlier start. Documents that share a doc_id are in the order of a hash of their
    text; rows equal in both are one document. ``kept`` may end within a character, so it is binary. Columns
    other than doc_id and text play no part; an empty table gives an empty result, and texts of any length are
    searched whole.
    """
    marks = stage(covered(docs), "suffix-marks")
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id")).withColumnRenamed("th", "tk").join(marks, ["id", "tk"], "left")
    out = rows.select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<first:bigint,last:bigint>>")).alias("spans"))
    return out.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
