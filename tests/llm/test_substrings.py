"""Substring operators against brute force: sentence spans and suffix arrays."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from riskmart.llm import hashing, sentence_spans, suffix_dedup
from riskmart.llm.common import keyed


def key(row):
    return (row[0] is not None, row[0] or 0)


def is_stop(word):
    for _ in range(2):
        for mark in sentence_spans.CLOSERS:
            if word.endswith(mark) and len(word) > len(mark):
                word = word[:-len(mark)]
    return word.endswith(sentence_spans.STOPS)


def cut(text):
    """Byte ranges of the words of each sentence."""
    b = (text or "").encode()
    words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)]
    hasher = hashing.RangeHash()
    h = [int(x) for x in hashing.word_hashes(hasher, np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0]]
    natural = [i for i in range(len(words)) if i == 0 or is_stop(b[slice(*words[i - 1])].decode()) or b"\n" in b[words[i - 1][1]:words[i][0]]]
    opens = set(natural)
    for i in range(len(words)):
        before, after = max(x for x in natural if x <= i), min([x for x in natural if x > i] + [len(words)])
        if i - before >= sentence_spans.NEAR and after - i >= sentence_spans.NEAR:
            if all(h[i] < h[i - k] and h[i] <= h[i + k] for k in range(1, sentence_spans.NEIGHBOURS + 1)):
                opens.add(i)
    parts = []
    for i, w in enumerate(words):
        if i in opens or len(parts[-1]) == sentence_spans.MAX_SENTENCE:
            parts.append([])
        parts[-1].append(w)
    return b, parts


def by_sentence(rows):
    """Expected (doc_id, text, n_sentences, n_removed); distinct doc_ids, in order."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=key):
        b, parts = cut(text)
        gone = set()
        for i in range(len(parts)):
            for end in range(i + 3, len(parts) + 1):
                span = tuple(tuple(b[s:e] for s, e in p) for p in parts[i:end])
                if sum(map(len, span)) >= 12:
                    if span in seen:
                        gone |= set(range(i, end))
                    seen.add(span)
                    break
        starts = [p[0][0] for p in parts] + [len(b)]
        left = b[:starts[0]] + b"".join(b[starts[i]:starts[i + 1]] for i in range(len(parts)) if i not in gone)
        out.append((doc_id, None if text is None else left.decode(), len(parts), len(gone)))
    return out


def by_byte(rows):
    """Expected (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=key):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        left = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def unique_ids(edge):
    """Edge rows with one row per doc_id, as brute force needs them."""
    seen, rows = set(), []
    for r in edge.select("doc_id", "text").collect():
        if r["doc_id"] not in seen:
            seen.add(r["doc_id"])
            rows.append((r["doc_id"], r["text"]))
    return rows


def corpus(seed):
    """Small alphabet, shared passages, periodic text, copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() + rng.choice(["", "", "", ".", ".\n"]) for _ in range(n))
    passages = [text(60), text(60), "\n".join(" ".join(word() for _ in range(3)) for _ in range(20)),
                " ".join(word() + ("." + rng.choice(sentence_spans.CLOSERS) if i % 9 == 8 else "") for i in range(60))]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(1, 60)) for _ in range(rng.randrange(1, 4))]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        if rng.random() < 0.2:
            parts.append(word() * 80)
        rows.append((i, rng.choice(["\n", " "]).join(parts)))
    return rows + [(100 + i, rows[i][1]) for i in range(5)] + [(200, rows[3][1][:150]), (201, rows[3][1] + rows[4][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_sentence_spans_equal_brute_force(spark, ordered, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(ordered(sentence_spans.dedup(df))) == sorted(by_sentence(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffix_dedup.dedup(df).drop("kept").collect()
    assert sorted(tuple(r) for r in got) == sorted(by_byte(rows))


def test_common_anchors_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SAMPLE_EVERY", 1)
    monkeypatch.setattr(suffix_dedup, "COMMON_IN_SAMPLE", 2)
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert len(suffix_dedup.common_anchors(suffix_dedup.keyed(df).select(
        "id", F.col("th").alias("tk"), "text")))
    got = suffix_dedup.dedup(df).drop("kept").collect()
    assert sorted(tuple(r) for r in got) == sorted(by_byte(rows))


def test_edge_rows(spark, edge, edge_clashing, empty, ordered):
    rows = unique_ids(edge)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = lambda found: sorted(found, key=lambda r: (r[0] is not None, r[0] or 0))
    assert order(ordered(sentence_spans.dedup(df))) == order(by_sentence(rows))
    assert order(ordered(suffix_dedup.dedup(df).drop("kept"))) == order(by_byte(rows))
    for run in (sentence_spans.dedup, suffix_dedup.dedup):
        assert ordered(run(edge)) == ordered(run(edge_clashing))
        assert run(edge).count() == edge.count()
        assert run(empty).count() == 0


def test_repeated_rows_are_one_document(spark, ordered):
    text = " ".join(f"Wort{i} und etwas mehr dazu." for i in range(40))
    df = spark.createDataFrame([(5, text), (5, text), (6, text)], "doc_id long, text string")
    assert [r[2] for r in ordered(suffix_dedup.dedup(df), "doc_id", "n_bytes", "n_removed")] == [0, 0, len(text)]
    assert [r[1] for r in ordered(sentence_spans.dedup(df), "doc_id", "n_removed")] == [0, 0, 40]


def test_levels_merge_geometrically_and_find_all():
    rng = np.random.default_rng(1)
    levels, seen = suffix_dedup.SuffixLevels(), set()
    for _ in range(40):
        batch = np.unique(rng.integers(0, 4000, 50)).astype("S100")
        batch = np.sort(batch)
        assert (levels.holds(batch) == np.array([b in seen for b in batch])).all()
        fresh = np.array([b for b in batch if b not in seen], "S100")
        levels.add(fresh)
        seen |= set(batch)
        sizes = [len(x) for x in levels.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == len(seen)


@pytest.mark.parametrize("batch", [1, 300, 1 << 16])
def test_levels_hold_one_anchor(monkeypatch, batch):
    """Pieces of 50 anchors of which one goes over many batches: what is found, and how much is kept for it."""
    monkeypatch.setattr(suffix_dedup, "BATCH", batch)
    rng, most, match = random.Random(4), [0], suffix_dedup.MATCH
    rows, want, seen = [], set(), set()
    for k in range(50):
        stock = ["".join(rng.choice("ab") for _ in range(match + 20)) for _ in range(3)]
        for i in range(40 if k == 20 else 4):
            text = rng.choice(stock)[rng.randint(0, 10):] + "".join(rng.choice("cd") for _ in range(rng.randint(0, 15)))
            rows.append((k, i, 0, 7, text.encode()))
            for at in range(len(text) - match + 1):
                window = (k, text[at:at + match])
                want |= {(i + 1000 * k, 7 + at + j) for j in range(match)} if window in seen else set()
                seen.add(window)
    add = suffix_dedup.SuffixLevels.add

    def counted(self, keys):
        add(self, keys)
        most[0] = max(most[0], sum(map(len, self.levels)))

    monkeypatch.setattr(suffix_dedup.SuffixLevels, "add", counted)
    table = pa.Table.from_pylist([{"k": k, "id": i + 1000 * k, "tk": tk, "p": p, "piece": piece} for k, i, tk, p, piece in rows])
    got = {(i, j) for b in suffix_dedup._index(iter(table.to_batches(max_chunksize=37)))
           for i, first, last in zip(*(b.column(c).to_pylist() for c in ("id", "first", "last"))) for j in range(first, last)}
    assert got == want and len(want) > 1000
    assert most[0] <= max(sum(k == a for k, _ in seen) for a in range(50))


KINDS = {"no stop": lambda i: "", "one stop": lambda i: "." if i == 30 else "", "lines of three": lambda i: "\n" if i % 3 == 2 else "",
         "quoted": lambda i: ".”" if i % 10 == 9 else "", "sentences of 14": lambda i: "." if i % 14 == 13 else "", "commas": lambda i: "," if i % 6 == 5 else ""}


@pytest.mark.parametrize("kind", KINDS)
def test_passages_of_51_words_are_found_at_every_offset(spark, kind):
    """In front of the passage stand 0 to 24 words of a sentence that it goes on with, and other words follow."""
    rng = random.Random(kind)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, found = [], 0
    for n in range(25):
        passage = " ".join(word() + KINDS[kind](i) for i in range(51)).replace("\n ", "\n")
        front = lambda: "".join(f"{word()} " for _ in range(n))
        rows += [(2 * n, f"{word()} {word()}. {passage} {word()}. "), (2 * n + 1, f"{word()} {word()}. {front()}{passage} {word()} {word()}")]
    got = {r["doc_id"]: r for r in sentence_spans.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * n]["n_removed"] == 0 for n in range(25))
    found = sum(got[2 * n + 1]["n_removed"] > 0 for n in range(25))
    assert found >= 24


def test_the_smallest_doc_id_is_not_null(spark):
    df = spark.createDataFrame([(-(2**63), "one two"), (None, "three")], "doc_id long, text string")
    for module in (sentence_spans, suffix_dedup):
        assert sorted((r["doc_id"] for r in module.dedup(df).collect()), key=str) == [-(2**63), None]


def test_rows_that_share_a_doc_id_are_told_apart(spark):
    """More texts without doc_id than 31 bits keep apart, nothing shared, nothing removed."""
    texts = spark.range(120_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat_ws(
        " ", *[F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{i}"))), 1, 8) for i in range(14)]).alias("text"))
    assert keyed(texts).groupBy("id", "th").count().filter("count > 1").count() == 0
    shared = keyed(texts).groupBy("id", F.col("th").bitwiseAND(F.lit(0x7FFFFFFF)).alias("short")).count().filter("count > 1").count()
    assert shared > 0  # so there are pairs which 31 bits would take for one document
    assert sentence_spans.dedup(texts).filter("n_removed > 0").count() == 0
    assert suffix_dedup.dedup(texts).filter("n_removed > 0").count() == 0


@pytest.mark.parametrize("flush", [1, 500])
def test_flushing_does_not_change_the_result(spark, monkeypatch, ordered, flush):
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for module, name in ((sentence_spans, "FLUSH_ROWS"), (suffix_dedup, "FLUSH_PIECES")):
        want = ordered(module.dedup(df))
        rows_of, batches = [], [pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([0] * len(rows)), pa.array([t for _, t in rows])], ["id", "tk", "text"])]
        monkeypatch.setattr(module, name, flush)
        send = sentence_spans._sent if module is sentence_spans else suffix_dedup._sender(np.zeros(0, np.uint64))
        rows_of = [len(b) for b in send(iter(batches * 3))]
        assert len(rows_of) >= 3  # what was held left more than once
        assert ordered(module.dedup(df)) == want
