"""Spelling variants against brute force over the whole vocabulary."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from riskmart.llm import spelling

VOCAB = "word string, n long"


def near(u: str, v: str) -> bool:
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    long, short = sorted((u, v), key=len, reverse=True)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def neighbours(counts: dict[str, int]) -> dict[str, set[str]]:
    """Words near each word, by what is left when one character is dropped or starred."""
    by, out = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            by[w[:i] + "*" + w[i + 1:]].add(w)
            if w[:i] + w[i + 1:] in counts:
                out[w].add(w[:i] + w[i + 1:])
                out[w[:i] + w[i + 1:]].add(w)
    for group in by.values():
        for w in group:
            out[w] |= group - {w}
    return out


def expected(counts: dict[str, int]) -> dict[str, tuple]:
    """(form, root, n, n_near, form_n) of each word."""
    close, form = neighbours(counts), {}
    for w, n in counts.items():
        best = min(close[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(close[w]), counts.get(form[w]))
    return out


def got(df) -> dict[str, tuple]:
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("letters, words, longest, group", [("ab", 400, 9, 3), ("abc", 1200, 8, 20), ("aaab", 300, 14, 2), ("abcdefghij", 800, 6, 2000), ("äbß€", 200, 7, 5)])
def test_variants_equal_brute_force(spark, letters, words, longest, group):
    rng = random.Random(letters)
    counts = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, longest))): rng.randrange(1, 200) for _ in range(words)}
    counts |= {"a" * 300: 5, "a" * 301: 50, "a" * 150 + "b" + "a" * 149: 12}
    assert got(spelling.variants(spark.createDataFrame(list(counts.items()), VOCAB).repartition(4), group_words=group)) == expected(counts)


@pytest.mark.parametrize("group", [1, 7, 2000])
def test_each_pair_is_accepted_once(spark, group):
    rng = random.Random(group)
    counts = {"".join(rng.choice("aab") for _ in range(rng.randrange(3, 9))): rng.randrange(1, 9) for _ in range(250)}
    pairs = [(r["word"], r["near"]) for r in spelling.near_pairs(spark.createDataFrame(list(counts.items()), VOCAB), group).collect()]
    assert sorted(tuple(sorted(p)) for p in pairs) == sorted(tuple(sorted(p)) for p in itertools.combinations(counts, 2) if near(*p))


def test_a_hot_half_is_halved_again(spark):
    counts = {f"prefixprefix{a}{b}{c}": 1 for a, b, c in itertools.product("abcdefgh", repeat=3)}  # 512 words, one first half
    vocab = spark.createDataFrame(list(counts.items()), VOCAB)
    sizes = [r["n"] for r in spelling._partitions(vocab, 20).selectExpr("size(words) AS n").collect()]
    assert max(sizes) <= 64 and got(spelling.variants(vocab, group_words=20)) == expected(counts)


def test_acceptors_are_minimal():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7))) for _ in range(60)})
    acceptor = spelling.Acceptor(words)
    rights = set()
    for state in range(len(acceptor.arcs)):
        language, left = set(), [(state, "")]
        while left:
            s, read = left.pop()
            language |= {read} if acceptor.final[s] else set()
            left += [(to, read + c) for c, to in acceptor.arcs[s].items()]
        rights.add(frozenset(language))
        if state == acceptor.start:
            assert language == set(words)
    assert len(rights) == len(acceptor.arcs)  # no two states accept the same


def plain_counts(rows) -> Counter:
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            counts[word if h % 97 else word[:h % len(word)] + word[h % len(word) + 1:]] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})


def test_words_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    counts = plain_counts(map(tuple, docs.collect()))
    found = got(spelling.document_variants(docs))
    assert found == expected(counts) and sum(f[0] is not None for f in found.values()) > 50


def test_edge_rows(spark, edge, edge_clashing, empty, ordered):
    counts = plain_counts((r["doc_id"], r["text"]) for r in edge.collect())
    assert got(spelling.document_variants(edge)) == expected(counts)
    assert ordered(spelling.document_variants(edge)) == ordered(spelling.document_variants(edge_clashing))
    assert spelling.document_variants(empty).count() == 0
    odd = spark.createDataFrame([("words", 1), ("words", 2), (None, 9), ("worms", None)], VOCAB)
    assert {r["word"]: r["n"] for r in spelling.variants(odd.fillna({"n": 1})).collect()} == {"words": 3, "worms": 1}
