"""Hashes of byte ranges and word runs of whole Arrow batches, without a Python object for each text.

A range's hash is that of a polynomial modulo 2**64 over a table of byte codes, so it follows from two
prefix sums; a final mix spreads it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd numbers that the seed decides."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class RangeHash:
    """Hashes of ranges of byte arrays; the powers grow with the longest array seen."""

    def __init__(self, seed: int = 1):
        self.codes = constants(256, seed)
        self.base = int(constants(1, seed + 1)[0])
        self.powers = self.inverse = np.ones(1, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(data):
            n = max(len(data) + 1, BLOCK_BYTES + 1)
            steps = np.full(n, self.base, np.uint64)
            back = np.full(n, pow(self.base, -1, 2**64), np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverse = np.multiply.accumulate(steps), np.multiply.accumulate(back)
        out = np.zeros(len(data) + 1, np.uint64)
        terms = self.codes[data]
        terms *= self.powers[:len(data)]
        np.cumsum(terms, out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = prefix[end] - prefix[start]
        x *= self.inverse[start]
        return mix(x)


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, data, bounds`` of runs of texts of about ``most`` bytes; a longer text is a run of its own.

    Text i of the run is ``data[bounds[i]:bounds[i + 1]]``, empty for null.
    """
    texts = pa.array(texts, pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


def word_ranges(hasher: RangeHash, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all words of the texts, in order: hashes; each text's first word (and the end); start and end bytes."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), none, none
    inside = ~_SPACE[data]
    fresh = np.ones(len(data), bool)
    fresh[1:] = ~inside[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    fresh[edges] = True
    starts = np.flatnonzero(inside & fresh)
    over = np.ones(len(data), bool)
    over[:-1] = ~inside[1:]
    over[edges - 1] = True
    ends = np.flatnonzero(inside & over) + 1
    hashes = hasher.ranges(hasher.prefix(data), starts, ends)
    return hashes, np.searchsorted(starts, bounds), starts, ends


def word_hashes(hasher: RangeHash, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_ranges(hasher, data, bounds)[:2]


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words of each text, and the place of each text's first run.

    A text of fewer words has one run, all of it; one without words has none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(runs)))
    place = np.repeat(first[:-1] - begin[:-1], runs) + np.arange(begin[-1])
    left = np.repeat(first[1:], runs) - place  # words of the text from the run's start
    padded = np.concatenate((words, np.zeros(n, np.uint64)))
    out = np.minimum(left, n).astype(np.uint64)
    for k, c in enumerate(constants(n, 77)):
        out += np.where(k < left, padded[place + k] * c, np.uint64(0))
    return mix(out), begin


def lists(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(values, pa.int64()))
