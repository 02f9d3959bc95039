"""Words of a corpus that differ by one inserted, deleted or replaced character, and the form each is a variant of.

Finite-state composition: the minimised acceptor of the vocabulary is composed with a one-edit transducer and with
the acceptor again, and the pairs the composition accepts are enumerated. The work is dealt out by initial state:
two words one edit apart agree outside a region that holds the edit, so a partition is what remains of the
vocabulary once all outside a region has been read. Regions are the two halves of the words first; the region of a
partition with too many words is halved again, and one of a single place holds no more words than there are
characters, so no partition stays large, whatever words share.

The transducer copies, replaces one character by a larger one, or drops one that does not equal the character
copied before it. Each pair therefore has one path, and is accepted in one partition only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.session import stage

MIN_LENGTH, MIN_COUNT = 5, 3
FORM_FACTOR = 2
GROUP_WORDS = 2000
KEY = ("size", "lo", "hi", "outer")


def document_words(docs: DataFrame, slip: int | None = 97) -> DataFrame:
    """``word`` of every run of Latin letters of the whole texts, A-Z lower-cased.

    A run whose crc32 of ``<doc_id>:<run>`` the number ``slip`` divides loses the character at crc32 % length. A null
    text has no words; a null doc_id is written as nothing before the colon.
    """
    text = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit("[a-zÀ-ÿ]+"), F.lit(0))).alias("word"))
    if slip is None:
        return runs.select("word")
    crc = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
    at = (crc % F.length("word")).cast("int")
    cut = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
    return runs.select(F.when(crc % slip == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words long and frequent enough; equal words are counted before the shuffle."""
    return (words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


class Acceptor:
    """The minimal acyclic acceptor of sorted distinct strings: ``arcs[state][character]`` and ``final[state]``."""

    def __init__(self, strings: Iterable[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]  # of the last string, not yet minimised
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                arcs, final = path.pop()
                key = (final[0], *arcs.items())
                state = known.setdefault(key, len(self.arcs))
                if state == len(self.arcs):
                    self.arcs.append(arcs)
                    self.final.append(final[0])
                path[-1][0][last[len(path) - 1]] = state

        for string in strings:
            depth = 0
            while depth < len(last) and depth < len(string) and last[depth] == string[depth]:
                depth += 1
            close(depth)
            path += [({}, [False]) for _ in range(len(string) - depth)]
            path[-1][1][0] = True
            last = string
        close(0)
        self.start = len(self.arcs)
        self.arcs.append(path[0][0])
        self.final.append(path[0][1][0])

    def after(self, state: int, other: Acceptor, there: int) -> Iterator[str]:
        """Strings that both accept, this from ``state`` and the other from ``there``."""
        left = [(state, there, "")]
        while left:
            p, q, read = left.pop()
            if self.final[p] and other.final[q]:
                yield read
            arcs, others = self.arcs[p], other.arcs[q]
            left += [(to, others[c], read + c) for c, to in arcs.items() if c in others]


def replaced(words: Acceptor) -> Iterator[tuple[str, str]]:
    """Pairs of accepted strings that differ in one character, the smaller first: acceptor, replacing transducer, acceptor."""
    left = [(words.start, "")]
    while left:
        state, read = left.pop()
        arcs = sorted(words.arcs[state].items())
        left += [(to, read + c) for c, to in arcs]
        for i, (c, to) in enumerate(arcs):
            for d, there in arcs[i + 1:]:
                for rest in words.after(to, words, there):
                    yield read + c + rest, read + d + rest


def dropped(longer: Acceptor, shorter: Acceptor, before: str) -> Iterator[tuple[str, str]]:
    """Pairs of a string of ``longer`` and one of ``shorter`` that lacks one of its characters.

    A character equal to the one copied just before it is never dropped; ``before`` is that character at the start.
    """
    left = [(longer.start, shorter.start, "")]
    while left:
        p, q, read = left.pop()
        arcs, others = longer.arcs[p], shorter.arcs[q]
        copied = read[-1] if read else before
        for c, to in arcs.items():
            if c != copied:
                for rest in longer.after(to, shorter, q):
                    yield read + c + rest, read + rest
        left += [(to, others[c], read + c) for c, to in arcs.items() if c in others]


def _partitions(vocab: DataFrame, group_words: int) -> DataFrame:
    """``size, lo, hi, outer, words``: words of length ``size`` and ``size - 1`` that agree outside places lo to hi - 1.

    ``outer`` is what stands outside. Partitions of one word are left out.
    """
    length = F.length("word")
    rows = vocab.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
    half = F.floor(F.col("size") / 2).cast("int")
    ends = F.explode(F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("size").alias("hi"))))
    rows = _keyed(rows.select("word", "n", "size", ends.alias("at")).select("word", "n", "size", "at.lo", "at.hi"))
    done = []
    while True:
        large = stage(rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("words"))
                      .filter((F.col("words") > group_words) & (F.col("hi") - F.col("lo") > 1)).drop("words"), "large-partitions")
        if large.isEmpty():
            break
        done.append(rows.join(large, list(KEY), "left_anti"))
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        ends = F.explode(F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi")))
        parts = rows.join(large, list(KEY), "left_semi").select("word", "n", "size", ends.alias("at"))
        rows = stage(_keyed(parts.select("word", "n", "size", "at.lo", "at.hi")), "halved-partitions")
    for part in done:
        rows = rows.unionByName(part)
    return rows.groupBy(*KEY).agg(F.collect_list(F.struct("word", "n")).alias("words")).filter(F.size("words") > 1)


def _keyed(rows: DataFrame) -> DataFrame:
    word, after = F.col("word"), F.col("hi") - (F.col("size") - F.length("word"))  # a shorter word lacks a place of the region
    outer = F.concat(word.substr(F.lit(1), F.col("lo")), F.lit("\0"), word.substr(after + 1, F.length("word")))
    return rows.withColumn("outer", outer)


def _pairs_of(size: int, lo: int, hi: int, words: list[dict]) -> Iterator[tuple[dict, dict]]:
    """Near pairs of a partition."""
    long, short = {}, {}
    for w in words:
        if len(w["word"]) == size:
            long[w["word"][lo:hi]] = w
        else:
            short[w["word"][lo:hi - 1]] = w
    if not long:
        return
    acceptor = Acceptor(sorted(long))
    if len(long) > 1:
        for u, v in replaced(acceptor):
            yield long[u], long[v]
    if short:
        before = next(iter(long.values()))["word"][lo - 1] if lo else ""
        for u, v in dropped(acceptor, Acceptor(sorted(short)), before):
            yield long[u], short[v]


PAIRS = "word string, n long, near string, near_n long"


def near_pairs(vocab: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """Each pair of words one edit apart, once: ``word, n, near, near_n``. ``vocab`` has distinct non-null words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [(u["word"], u["n"], v["word"], v["n"]) for u, v in _pairs_of(row["size"], row["lo"], row["hi"], row["words"])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["word", "n", "near", "near_n"])

    return _partitions(vocab, group_words).mapInArrow(run, PAIRS)


SUMMARY = "word string, n_near long, near_n long, near string"


def _summaries(vocab: DataFrame, group_words: int) -> DataFrame:
    """Of each partition and word with near words there: how many, and the most frequent one. Pairs stay in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                best: dict[str, list] = {}
                for pair in _pairs_of(row["size"], row["lo"], row["hi"], row["words"]):
                    for u, v in (pair, pair[::-1]):
                        rank, held = (-v["n"], v["word"]), best.get(u["word"])
                        if held is None:
                            best[u["word"]] = [1, rank]
                        else:
                            held[0] += 1
                            held[1] = min(held[1], rank)
                out += [(w, n, -rank[0], rank[1]) for w, (n, rank) in best.items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["word", "n_near", "near_n", "near"])

    return _partitions(vocab, group_words).mapInArrow(run, SUMMARY)


def _with_roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form: forms followed to the last, each round twice as far as the one before.

    A form is at least twice as frequent as its word, so paths are no longer than the logarithm of the largest count.
    """
    paths, changed = stage(forms.select("word", F.col("form").alias("root")), "forms"), 1
    while changed:
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        paths = stage(paths.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        changed = paths.filter("moved").count()
        paths = paths.drop("moved")
    return paths


def variants(vocab: DataFrame, factor: int = FORM_FACTOR, group_words: int = GROUP_WORDS) -> DataFrame:
    """Per word of ``vocab`` (``word, n``): ``word, form, root, n, n_near, form_n``.

    Two words are near if one inserted, deleted or replaced code point makes them equal. ``form`` is the near word of
    largest n, of several the smallest in code-point order, if its n is at least ``factor`` times the word's, else
    null; ``root`` is the last word on the path of forms, the word itself without one. Null words are left out, rows
    of one word are added up, other columns are ignored; an empty vocabulary gives no row. Words of any length count.
    """
    vocab = stage(vocab.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n"))
                  .filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    near = _summaries(vocab, group_words).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    enough = -F.col("best.rank") >= factor * F.col("n")
    rows = stage(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.rank")).alias("form_n")), "near-words")
    roots = _with_roots(rows.filter("form is not null"))
    return (rows.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def document_variants(docs: DataFrame, slip: int | None = 97, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """:func:`variants` of the words of whole texts; rows that share a doc_id each count, an empty table gives no row."""
    return variants(vocabulary(document_words(docs, slip), min_length, min_count))
