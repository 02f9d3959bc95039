"""N-gram Jaccard join by MinHash banding.

Texts are sets of runs of five words. Their MinHash signatures are cut into bands; how many bands of how
many rows follows from the recall wanted at the threshold. Documents meet where a band's hash is equal, and
pairs that share a band are verified on their full sets.

Equal texts are one node of the join. Nodes that meet are joined into candidate groups, a group is cut into
blocks, and for each two blocks that share a band one task verifies the pairs between them. What leaves the
task is a node's number of links and a forest that spans them, never the pairs, so the rows grow with the
nodes of a group although every pair that shares a band is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm import hashing
from riskmart.llm.common import id_out, keyed, with_key
from riskmart.llm.graph import components
from riskmart.session import stage

WORDS = 5
PERCENT = 80
RECALL = 0.9999
ROWS = 5
# A block holds about so many nodes and so many n-grams.
BLOCK_NODES = 512
BLOCK_NGRAMS = 1 << 20
COLUMNS = 4096


def choose_bands(percent: int = PERCENT, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of ``rows`` rows so that a pair at the threshold shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** rows))


def signatures(docs: DataFrame, words: int = WORDS, bands: int | None = None, rows: int = ROWS) -> DataFrame:
    """``id, th, w1, w2, n, bands``: key, hashes of the word sequence, number of runs, and the band hashes.

    Texts without a word have no run and no band.
    """
    bands = bands or choose_bands(rows=rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = hashing.RangeHash()
        multiply, flip = hashing.constants(bands * rows, 11), hashing.constants(bands * rows, 13)
        across, places = hashing.constants(rows, 17), hashing.constants(1, 19)[0]
        for batch in batches:
            for first, last, data, bounds in hashing.blocks(batch.column(2)):
                w, at = hashing.word_hashes(hasher, data, bounds)
                s, begin = hashing.shingle_hashes(w, at, words)
                n = np.diff(begin)
                full = np.flatnonzero(n)
                out = np.zeros((len(full), bands), np.uint64)
                if len(full):
                    for k in range(bands * rows):
                        v = s ^ flip[k]
                        v *= multiply[k]
                        out[:, k // rows] += np.minimum.reduceat(v, begin[full]) * across[k % rows]
                    out = hashing.mix(out + np.arange(bands, dtype=np.uint64) * places)
                order = np.arange(len(w)) - np.repeat(at[:-1], np.diff(at))
                seq = [np.zeros(len(n), np.uint64) for _ in range(2)]
                for k, c in enumerate(hashing.constants(2, 23)):
                    if len(w):
                        terms = hashing.mix(w + (order + 1).astype(np.uint64) * c)
                        seq[k][full] = np.add.reduceat(terms, at[full])
                ends = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                     *(pa.array(x.view(np.int64)) for x in seq), pa.array(n), hashing.lists(out.reshape(-1).view(np.int64), ends)],
                    ["id", "th", "w1", "w2", "n", "bands"])

    return keyed(docs).select("id", "th", "text").mapInArrow(
        run, "id long, th long, w1 long, w2 long, n long, bands array<long>")


def ngram_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``node, ngrams``: the sorted set of run hashes of each text, once for each ``id, th``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = hashing.RangeHash()
        for batch in batches:
            for first, last, data, bounds in hashing.blocks(batch.column(2)):
                s, begin = hashing.shingle_hashes(*hashing.word_hashes(hasher, data, bounds), words)
                sets = [np.unique(s[begin[i]:begin[i + 1]]) for i in range(last - first)]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
                values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                     hashing.lists(values.view(np.int64), ends)], ["id", "th", "ngrams"])

    return (docs.select("id", "th", "text").mapInArrow(run, "id long, th long, ngrams array<long>")
            .dropDuplicates(["id", "th"]).select(F.struct("id", "th").alias("node"), "ngrams"))


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``."""
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[inverse]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, (start, start + COLUMNS)))
        grid = np.zeros((len(sets), COLUMNS), np.float32)
        grid[owner[part], column[part] - start] = 1
        total += grid[left] @ grid[right].T
    return total


def _verify(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of the nodes of one block, or between two: number of linked documents and texts, and a forest."""
    rows = rows.sort_values(["id", "th"]).reset_index(drop=True)
    one_block = rows["left"].iloc[0] == rows["right"].iloc[0]
    blk = rows["blk"].to_numpy()
    left = np.flatnonzero(blk == rows["left"].iloc[0])
    right = left if one_block else np.flatnonzero(blk == rows["right"].iloc[0])
    names = ["id", "th", "documents", "texts", "root_id", "root_th"]
    if len(left) == 0 or len(right) == 0:
        return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
    bands = np.stack(rows["bands"].to_numpy())
    meet = np.zeros((len(left), len(right)), bool)
    for k in range(bands.shape[1]):
        meet |= bands[left, k][:, None] == bands[right, k]
    sets = [np.asarray(s) for s in rows["ngrams"]]
    size = np.array([len(s) for s in sets])
    common = _overlaps(sets, left, right)
    linked = meet & ((100 + PERCENT) * common >= PERCENT * (size[left][:, None] + size[right]))
    if one_block:
        np.fill_diagonal(linked, False)
    copies = rows["copies"].to_numpy()
    documents, texts = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    documents[left] += linked @ copies[right]
    texts[left] += linked.sum(axis=1)
    if not one_block:
        documents[right] += linked.T @ copies[left]
        texts[right] += linked.sum(axis=0)
    label = np.arange(len(rows))
    while True:  # the smallest place that each can reach
        new = label.copy()
        new[left] = np.minimum(new[left], np.where(linked, label[right], len(rows)).min(axis=1))
        new[right] = np.minimum(new[right], np.where(linked, new[left][:, None], len(rows)).min(axis=0))
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = texts > 0
    ids, ths = rows["id"].to_numpy(), rows["th"].to_numpy()
    return pd.DataFrame(dict(zip(names, (ids[keep], ths[keep], documents[keep], texts[keep], ids[label[keep]], ths[label[keep]]))))


def join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (``id, th, n, node, copies``) and linked nodes (``node, root, documents, texts``).

    ``node`` is the first of the documents of equal words, ``root`` the first of its class, ``documents``
    and ``texts`` what the node links to beside itself.
    """
    signed = stage(signatures(docs), "join-signatures")
    nodes = stage(signed.filter("n > 0").groupBy("w1", "w2", "n").agg(
        F.min(F.struct("id", "th")).alias("node"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "join-nodes")
    documents = signed.drop("bands").join(nodes.select("w1", "w2", "n", "node", "copies"), ["w1", "w2", "n"], "left")
    banded = nodes.select("node", F.explode("bands").alias("h"))
    buckets = stage(banded.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("leader"))
                    .filter("k > 1").select("h", "leader"), "join-buckets")
    met = stage(banded.join(buckets, "h"), "join-met")
    groups = stage(components(met.select(F.col("node").alias("a"), F.col("leader").alias("b"))), "join-groups")

    members = groups.join(nodes.select("node", "n", "copies", "bands"), "node")
    sizes = stage(members.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_NGRAMS)).cast("long").alias("blocks")), "join-sizes")
    placed = stage(members.join(sizes, "root").withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks"))), "join-members")
    several = stage(met.select("node", "h").join(placed.filter("blocks > 1").select("node", "root", "blk"), "node")
                    .select("h", "root", "blk").distinct(), "join-blocks")
    pairs = (several.select("h", "root", F.col("blk").alias("left"))
             .join(several.select("h", F.col("blk").alias("right")), "h").filter(F.col("left") <= F.col("right"))
             .select("root", "left", "right").distinct())
    pairs = stage(pairs, "join-pairs")
    roles = stage(pairs.select("root", F.col("left").alias("blk"), "left", "right").union(
        pairs.filter(F.col("left") != F.col("right")).select("root", F.col("right").alias("blk"), "left", "right")), "join-roles")
    work = (placed.filter("blocks = 1").withColumns({"left": F.lit(0).cast("long"), "right": F.lit(0).cast("long")})
            .unionByName(placed.filter("blocks > 1").join(roles, ["root", "blk"])))
    wanted = placed.select("node.id", "node.th")
    sets = stage(ngram_sets(keyed(docs).join(wanted, ["id", "th"], "left_semi")), "join-sets")
    found = (work.join(sets, "node")
             .select("root", "left", "right", "node.id", "node.th", "blk", "copies", "bands", "ngrams")
             .groupBy("root", "left", "right")
             .applyInPandas(_verify, "id long, th long, documents long, texts long, root_id long, root_th long"))
    found = stage(found, "join-links")
    links = found.groupBy(F.struct("id", "th").alias("node")).agg(
        F.sum("documents").alias("documents"), F.sum("texts").alias("texts"))
    classes = stage(components(found.select(F.struct("id", "th").alias("a"),
                                            F.struct(F.col("root_id").alias("id"), F.col("root_th").alias("th")).alias("b"))),
                    "join-classes")
    return documents, stage(classes.join(links, "node"), "join-linked")


def report(docs: DataFrame) -> DataFrame:
    """A row for each document: ``doc_id, class_id, n_links, n_texts``.

    The class is that of all documents linked with one another, directly or by others, named by its smallest
    doc_id; links are other documents of at least the threshold, texts the different texts among them. Texts
    without a word (null, empty) have no n-gram: no link, and a class of their own. A text of fewer than
    five words is one n-gram. Rows equal in doc_id and text are copies like any other; columns other than
    these play no part; an empty table gives an empty result.
    """
    documents, linked = join(docs)
    rows = documents.join(linked, "node", "left")
    return rows.select(
        id_out().alias("doc_id"), id_out(F.coalesce("root.id", "node.id", "id")).alias("class_id"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("documents", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_texts"))


def keep_first(docs: DataFrame) -> DataFrame:
    """Documents with their own columns, whatever their names: the first of each class, and all without a word.

    The first is the one of smallest doc_id, a null one before all, then of smallest text hash. Null and empty texts
    have no word and are nobody's copy; rows equal in doc_id and text are one document, of which one row is left. A
    text of any length is compared whole, and an empty table gives no row.
    """
    documents, linked = join(docs)
    kept = stage(documents.join(linked, "node", "left").filter(
        F.col("node").isNull() | F.struct("id", "th").eqNullSafe(F.coalesce("root", "node"))).select("id", "th").distinct(), "join-kept")
    return with_key(docs).join(kept, ["id", "th"], "left_semi").dropDuplicates(["id", "th"]).select("row.*")
