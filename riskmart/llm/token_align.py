"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids are linked.

Both token sequences of a text are cut where a token of each ends. The cuts are found by divide and conquer: of an
interval that starts and ends at shared cuts, a shared end near the middle is located by bisection, and both
halves are cut in turn; an interval without one is a group. The first cuts are known beforehand: at the places of
:func:`pieces.cuts` both tokenizers end a token, so the intervals between them repeat over the corpus like its
words do, and each distinct one is divided once per worker's memo.

Counts of pairs cover the corpus and are never held by one task: a task writes, for each block of documents, the
pairs of ids it saw with their counts and every document's links as places in that list. The lists are added up by
pair, joined back to their blocks, and meet the block's documents again.
"""

from __future__ import annotations

import functools
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import hashing, pieces
from riskmart.session import stage

BLOCK_BYTES = 4 << 20
B_BITS = 32


def _shared_end(a: list[int], b: list[int], a0: int, a1: int, b0: int, b1: int) -> tuple[int, int] | None:
    """Token counts before the shared end nearest the middle of A's tokens a0 to a1 - 1, or None."""
    if a1 - a0 < 2 or b1 - b0 < 2:
        return None
    middle = (a0 + a1) // 2 - 1
    for step in range(max(middle - a0, a1 - 2 - middle) + 1):
        for k in {middle - step, middle + step}:
            if a0 <= k < a1 - 1:
                j = bisect_left(b, a[k], b0, b1 - 1)
                if j < b1 - 1 and b[j] == a[k]:
                    return k + 1, j + 1
    return None


def align(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups of tokens between shared ends: first and last + 1 token of A, then of B, in order.

    Both lists ascend and end at the same byte. Tokens between the middle and the nearest shared end lie in one
    group, so looking outwards costs each token a few bisections.
    """
    groups, left = [], [(0, len(a_ends), 0, len(b_ends))] if a_ends else []
    while left:
        a0, a1, b0, b1 = left.pop()
        cut = _shared_end(a_ends, b_ends, a0, a1, b0, b1)
        if cut is None:
            groups.append((a0, a1, b0, b1))
        else:
            left += [(cut[0], a1, cut[1], b1), (a0, cut[0], b0, cut[1])]
    return groups


def links(a_ends: list[int], b_ends: list[int], group: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Places of A and B tokens of a group whose bytes overlap, by a walk over both."""
    i, a1, j, b1 = group
    found = []
    while i < a1 and j < b1:
        found.append((i, j))
        ends = a_ends[i], b_ends[j]
        i += ends[0] <= ends[1]
        j += ends[1] <= ends[0]
    return found


class _Aligner:
    """Alignments of pieces: counts of tokens, groups as text, and linked ids as ``a << 32 | b``."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = pieces.ByteBpe(a_path, plain_special=True), pieces.PieceBpe(b_path)
        self.whole = not (self.a.cuts and self.b.cuts)
        level, tokenizer = pieces.byte_level(), self.a.tokenizer
        entries = [tokenizer.id_to_token(i) or "" for i in range(self.a.size)]
        self.a_bytes = [bytes(level[c] for c in e) if all(c in level for c in e) else e.encode() for e in entries]
        self.memo = pieces.Memo()

    def _one(self, piece: bytes, a: list[int], b: list[int]) -> tuple:
        """``n_a, n_b, n_groups, groups, links``; n_a is -1 where the tokens do not give the piece back."""
        a_bytes, b_bytes = [self.a_bytes[i] for i in a], [self.b.bytes[i] for i in b]
        if b"".join(a_bytes) != piece or b"".join(b_bytes) != piece:
            return -1, 0, 0, b"", b""
        a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
        groups, pairs = align(a_ends, b_ends), []
        for g in groups:
            pairs += [a[i] << B_BITS | b[j] for i, j in links(a_ends, b_ends, g)]
        text = ";".join([f"{','.join(map(str, a[a0:a1]))}|{','.join(map(str, b[b0:b1]))}" for a0, a1, b0, b1 in groups])
        return len(a), len(b), len(groups), text.encode(), np.array(pairs, np.int64).tobytes()

    def known(self, found: list[bytes]) -> list[tuple]:
        fresh = [p for p in found if p not in self.memo]
        a = [np.frombuffer(ids, "<u4").tolist() for ids in self.a.pieces(fresh)]
        self.memo.update(zip(fresh, map(self._one, fresh, a, self.b.pieces(fresh))))
        out = [self.memo[p] for p in found]
        self.memo.trim(fresh)
        return out


@functools.cache
def _aligner(a_path: str, b_path: str) -> _Aligner:
    """One per worker, so that its memo outlives the task."""
    return _Aligner(a_path, b_path)


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def _binary(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """``values[begin[i]:begin[i + 1]]`` as bytes."""
    at = begin * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))])


FIRST = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
         "places binary, counts binary, pairs array<long>, pair_counts array<long>")
_KINDS = {"long": pa.int64(), "string": pa.large_string(), "binary": pa.large_binary(), "array<long>": pa.list_(pa.int64())}
_FIRST_SCHEMA = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in FIRST.split(", ")])


def _block(aligner: _Aligner, data: np.ndarray, bounds: np.ndarray, has_text: np.ndarray, keep_groups: bool) -> tuple[dict, np.ndarray, np.ndarray]:
    """Columns of the block's documents, the pairs in it and their counts."""
    block = pieces.Distinct(data, bounds, whole=aligner.whole)
    found = aligner.known(block.pieces)
    n_a, n_b, n_groups = (np.array([f[k] for f in found], np.int64) for k in range(3))
    broken = _per_text((n_a < 0)[block.index].astype(np.int64), block.first) > 0
    good = has_text & ~broken
    begin = np.concatenate(([0], np.cumsum(np.array([len(f[4]) for f in found], np.int64)))) // 8
    codes, place = np.unique(np.frombuffer(b"".join([f[4] for f in found]), np.int64), return_inverse=True)
    linked, at = pieces.gather(block.index, begin, place.astype(np.int64))
    at = at[block.first]
    n_links = np.where(good, np.diff(at), 0)
    # A document's links, equal ones together: their places in the block's list, and how many.
    text = np.repeat(np.arange(len(good)), np.diff(at))
    linked = (text * max(len(codes), 1) + linked)[good[text]]
    linked, counts = np.unique(linked, return_counts=True)
    text, linked = np.divmod(linked, max(len(codes), 1))
    doc_begin = np.searchsorted(text, np.arange(len(good) + 1))
    seen = np.bincount(linked, counts, minlength=len(codes)).astype(np.int64)
    index, names = block.index.tolist(), [f[3] for f in found]
    groups = [b";".join([names[i] for i in index[a:b]]) if ok else None
              for a, b, ok in zip(block.first[:-1].tolist(), block.first[1:].tolist(), good.tolist())]
    columns = {name: np.where(good, _per_text(np.maximum(n, 0)[block.index], block.first), 0) for name, n in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups))}
    columns |= {"n_links": n_links, "groups_sha256": ["" if g is None else hashlib.sha256(g).hexdigest() for g in groups],
                "groups": ["" if g is None else g.decode() for g in groups] if keep_groups else None,
                "places": _binary(linked.astype("<u4"), doc_begin), "counts": _binary(counts.astype("<u4"), doc_begin)}
    return columns, codes, seen


def _first_pass(docs: DataFrame, a_path: str, b_path: str, block_bytes: int, keep_groups: bool) -> DataFrame:
    """A row per document, and one per block with its pairs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32

        def batch_of(columns: dict, n: int) -> pa.RecordBatch:
            nulls = lambda f: pa.nulls(n, f.type)
            return pa.RecordBatch.from_arrays([nulls(f) if columns.get(f.name) is None else pa.array(columns[f.name], f.type)
                                               for f in _FIRST_SCHEMA], schema=_FIRST_SCHEMA)

        for batch in batches:
            ids, text = batch.column("doc_id"), batch.column("text").cast(pa.large_string())
            spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), text, pa.scalar(" ", pa.large_string()))
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
            for first, last, data, bounds in hashing.blocks(spaced, block_bytes):
                columns, codes, seen = _block(aligner, data, bounds, sizes[first:last] > 0, keep_groups)
                columns |= {"block": np.full(last - first, number), "doc_id": ids[first:last]}
                yield batch_of(columns, last - first)
                yield batch_of({"block": [number], "pairs": [codes], "pair_counts": [seen]}, 1)
                number += 1

    return stage(rows.mapInArrow(run, FIRST), "token-links")


def _seen(blocks: DataFrame) -> DataFrame:
    """``block, place, pair, n`` of the pairs of each block."""
    zipped = F.posexplode(F.arrays_zip("pairs", "pair_counts")).alias("place", "p")
    return (blocks.filter("pairs is not null").select("block", zipped)
            .select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.pair_counts").alias("n")).filter("n > 0"))


def _totals(seen: DataFrame) -> DataFrame:
    """``pair, a, b, links``; ``best``: no A id is linked more often with the B id."""
    totals = seen.groupBy("pair").agg(F.sum("n").alias("links")).select(
        "pair", F.shiftright("pair", B_BITS).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)).alias("b"), "links")
    top = totals.groupBy("b").agg(F.max("links").alias("top"))  # as many rows as B has ids
    return totals.join(top, "b").select("pair", "a", "b", "links", (F.col("links") == F.col("top")).alias("best"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """How many links of the corpus hold each pair of ids: ``a, b, links, best``. Texts as in :func:`align_documents`."""
    return _totals(_seen(_first_pass(docs, a_path, b_path, block_bytes, False))).drop("pair")


OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string")


def align_documents(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES, keep_groups: bool = False) -> DataFrame:
    """A row per row of ``docs``: tokens of both, groups and links of its text, and how common its links are.

    A is a byte-level tokenizer file, which gets a space and the text, B a sentencepiece model that adds the space;
    both paths must be there on every executor. ``n_best`` counts links whose pair is its B id's most common in all
    documents (ties included), ``count_sum`` adds up the corpus-wide counts of the links' pairs. ``groups`` writes the
    groups out (null unless ``keep_groups``). A null or empty text, and one whose tokens do not give its bytes
    back, has no tokens: zeros and '' as hash. Rows that share a doc_id, or have none, each count and are each
    returned. An empty table gives no row; other columns are not read. A text of any length is aligned whole; a task
    holds a block of about ``block_bytes``, or one longer text.
    """
    blocks = _first_pass(docs, a_path, b_path, block_bytes, keep_groups)
    seen = _seen(blocks)
    common = seen.join(_totals(seen), "pair").select(F.col("block").alias("of_block"), "place", "links", "best")
    rows = blocks.filter("pairs is null").drop("pairs", "pair_counts")

    def finish(rows: pa.Table, common: pa.Table) -> pa.Table:
        place = common.column("place").to_numpy()
        count, best = np.zeros((2, place.max() + 1 if len(place) else 0), np.int64)
        count[place], best[place] = common.column("links").to_numpy(), common.column("best").to_numpy()
        places = [np.frombuffer(x, "<u4") for x in rows.column("places").to_pylist()]
        counts = [np.frombuffer(x, "<u4") for x in rows.column("counts").to_pylist()]
        n_best = [int(best[p] @ c.astype(np.int64)) for p, c in zip(places, counts)]
        count_sum = [int(count[p] @ c.astype(np.int64)) for p, c in zip(places, counts)]
        rows = rows.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
        return rows.select([c.split()[0] for c in OUT.split(", ")])

    return rows.groupBy("block").cogroup(common.groupBy("of_block")).applyInArrow(finish, OUT)
