"""Substring dedup by sliding spans of sentences.

Every run of consecutive sentences, ``SPAN`` of them or as many more as make ``MIN_WORDS`` words, is hashed; the
hashes of all documents meet in one shuffle, and sentences covered by a span that has occurred before are removed.

Where a sentence ends depends on the words around that place and on nothing further away, so a passage is cut alike
whatever text it stands in: after a full stop, question or exclamation mark or the like, closing quotes and brackets
aside, at a line end, and, more than ``NEAR`` words away from those, before a word whose hash is the least of its
neighbours. A run of one word over and over, which has no least, is cut every ``MAX_SENTENCE`` words.

Each task finds the repeats within some millions of its spans first and sends one row for each that differs, so a
span that much of the corpus holds is a few rows per task where the spans meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm import hashing
from riskmart.llm.common import keyed
from riskmart.session import stage

SPAN = 3
# Spans of fewer words are too short to tell from chance.
MIN_WORDS = 12
NEAR, NEIGHBOURS = 4, 2
MAX_SENTENCE = 64
FLUSH_ROWS = 1 << 20
# Bytes of stops and of closing quotes and brackets.
STOPS = (".", "!", "?", "…", "。", "！", "？")
CLOSERS = ('"', "'", ")", "]", "}", "”", "’", "»", "›")


def _ends_with(data: np.ndarray, at: np.ndarray, starts: np.ndarray, mark: bytes) -> np.ndarray:
    """Whether ``mark`` ends at byte ``at`` of a word that begins at ``starts``."""
    found = at - len(mark) + 1 >= starts
    for back, byte in enumerate(reversed(mark)):
        found &= data[np.maximum(at - back, 0)] == byte
    return found


def _stops(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word ends with a stop, up to two closing marks after it aside."""
    at = ends - 1
    for _ in range(2):
        for mark in map(str.encode, CLOSERS):
            at = at - len(mark) * _ends_with(data, at, starts + 1, mark)
    stop = np.zeros(len(at), bool)
    for mark in map(str.encode, STOPS):
        stop |= _ends_with(data, at, starts, mark)
    return stop


def sentences(data: np.ndarray, bounds: np.ndarray, hasher: hashing.RangeHash) -> tuple[np.ndarray, ...]:
    """Of the texts: sentence starts (bytes), their hashes and words, and each text's first sentence."""
    words, at, starts, ends = hashing.word_ranges(hasher, data, bounds)
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    opens = np.zeros(n, bool)
    opens[at[:-1][at[:-1] < n]] = True
    lines = np.cumsum(np.concatenate(([0], data == 10)))
    opens[1:] |= _stops(data, starts[:-1], ends[:-1]) | (lines[starts[1:]] > lines[ends[:-1]])
    place = np.arange(n)
    since = place - np.maximum.accumulate(np.where(opens, place, 0))
    until = np.minimum.accumulate(np.where(np.append(opens[1:], True), place + 1, n)[::-1])[::-1] - place
    least = (since >= NEAR) & (until >= NEAR)  # so far from a text's edge that all neighbours are its own
    for k in range(1, NEIGHBOURS + 1):
        least[k:] &= words[k:] < words[:-k]
        least[:-k] &= words[:-k] <= words[k:]
    opens |= least
    since = place - np.maximum.accumulate(np.where(opens, place, 0))
    opens |= since % MAX_SENTENCE == 0
    first = np.flatnonzero(opens)
    order = (place - np.repeat(first, np.diff(np.append(first, n)))).astype(np.uint64) + np.uint64(1)
    hashes = np.add.reduceat(hashing.mix(words + order * hashing.constants(1, 31)[0]), first)
    return starts[first], hashing.mix(hashes), np.diff(np.append(first, n)), np.searchsorted(first, at)


def span_ends(n_words: np.ndarray) -> np.ndarray:
    """One past the last sentence of the span that starts at each; it may lie past a text's end."""
    total = np.concatenate(([0], np.cumsum(n_words)))
    return np.maximum(np.arange(len(n_words)) + SPAN, np.searchsorted(total, total[:-1] + MIN_WORDS))


def _spans(texts: pa.Array, hasher: hashing.RangeHash) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, sentence and hash of every span of the texts."""
    for first, _, data, bounds in hashing.blocks(texts):
        _, h, n_words, at = sentences(data, bounds, hasher)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
        end = span_ends(n_words)
        start = np.flatnonzero(end <= at[1:][row])
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * hasher.powers[:len(h)]))) if len(h) else np.zeros(1, np.uint64)
        value = (prefix[end[start]] - prefix[start]) * hasher.inverse[start]
        yield first + row[start], start - at[row[start]], hashing.mix(value)


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``k, again, id, tk, at``: the first row of each span among those held, and its later ones as repeats.

    First rows meet by the span's hash; repeats need no meeting and are spread by their place. What is held is sent
    on whenever it is ``FLUSH_ROWS``, which costs rows and not results.
    """
    hasher = hashing.RangeHash()
    parts: list[tuple[np.ndarray, ...]] = []
    held = 0
    for batch in batches:
        ids, tks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row, at, h in _spans(batch.column(2), hasher):
            parts.append((h, ids[row], tks[row], at.astype(np.int32)))
            held += len(h)
            if held >= FLUSH_ROWS:
                yield from _folded(parts)
                parts, held = [], 0
    if held:
        yield from _folded(parts)


def _folded(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    h, ids, tks, at = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((at, tks, ids, h))
    h, ids, tks, at = h[order], ids[order], tks[order], at[order]
    same_span = h[1:] == h[:-1]
    head = np.maximum.accumulate(np.where(np.concatenate(([True], ~same_span)), np.arange(len(h)), 0))
    again = (ids != ids[head]) | (tks != tks[head]) | (at != at[head])
    k = np.where(again, hashing.mix(ids.astype(np.uint64) + at.astype(np.uint64) * hashing.constants(1, 41)[0]), h)
    for i in range(0, len(k), 1 << 17):
        part = slice(i, i + (1 << 17))
        yield pa.RecordBatch.from_arrays([pa.array(k[part].view(np.int64)), pa.array(again[part]), pa.array(ids[part]),
                                          pa.array(tks[part]), pa.array(at[part])], ["k", "again", "id", "tk", "at"])


def repeated(docs: DataFrame) -> DataFrame:
    """``id, tk, spans``: the places of the sentences at which a span starts that occurred before.

    Occurrences are in the order of doc_id, then of the place in the text.
    """
    rows = keyed(docs).select("id", F.col("th").alias("tk"), "text")
    sent = rows.mapInArrow(_sent, "k long, again boolean, id long, tk long, at int")
    first = F.first(F.struct("id", "tk", "at")).over(Window.partitionBy("k", "again").orderBy("id", "tk", "at"))
    found = sent.withColumn("first", first).filter(F.col("again") | (F.col("first") != F.struct("id", "tk", "at")))
    return found.groupBy("id", "tk").agg(F.collect_list("at").alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = hashing.RangeHash()
    for batch in batches:
        spans = batch.column(2)
        for first, last, data, bounds in hashing.blocks(batch.column(1)):
            starts, _, n_words, at = sentences(data, bounds, hasher)
            cover = np.zeros(len(starts) + 1, np.int32)
            part = spans.slice(first, last - first)
            owner = np.repeat(np.arange(last - first), np.asarray(part.value_lengths().fill_null(0)))
            hit = at[owner] + part.flatten().to_numpy()
            np.add.at(cover, hit, 1)
            np.add.at(cover, span_ends(n_words)[hit], -1)
            gone = np.cumsum(cover[:-1]) > 0
            ends = np.append(starts[1:], len(data))
            ends[at[1:][np.diff(at) > 0] - 1] = bounds[1:][np.diff(at) > 0]  # the last sentence reaches to the text's end
            drop = np.zeros(len(data) + 1, np.int32)
            np.add.at(drop, starts[gone], 1)
            np.add.at(drop, ends[gone], -1)
            keep = np.cumsum(drop[:-1]) == 0
            left = np.concatenate(([0], np.cumsum(keep)))[bounds]
            texts = pa.LargeStringArray.from_buffers(last - first, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(data[keep].tobytes()))
            known = batch.column(1).slice(first, last - first).is_valid()
            removed = np.concatenate(([0], np.cumsum(gone)))[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), pa.compute.if_else(known, texts, None).cast(pa.string()),
                 pa.array(np.diff(at)), pa.array(np.diff(removed))], ["doc_id", "text", "n_sentences", "n_removed"])


def dedup(docs: DataFrame) -> DataFrame:
    """A row for each document: ``doc_id, text`` (what is left), ``n_sentences, n_removed``.

    The earliest document that holds a span keeps it. Null text stays null, with no sentences; a text whose
    sentences all go is empty; texts of any length are searched whole. Rows equal in doc_id and text are one
    document, so neither is the other's repeat; columns other than these play no part; an empty table gives an
    empty result.
    """
    marks = stage(repeated(docs), "spans")
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id")).withColumnRenamed("th", "tk").join(marks, ["id", "tk"], "left")
    return rows.select("doc_id", "text", F.coalesce("spans", F.array().cast("array<int>")).alias("spans")).mapInArrow(
        _cut, "doc_id long, text string, n_sentences long, n_removed long")
