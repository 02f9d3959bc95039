"""N-gram join against all pairs, and components."""

from __future__ import annotations

import itertools
import random

import pytest

from riskmart.llm import ngram_join
from riskmart.llm.graph import components


def grams(text):
    w = (text or "").split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected(rows):
    sets, parent = {i: grams(t) for i, t in rows}, {i: i for i, _ in rows}
    links = dict.fromkeys(parent, 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a], links[b] = links[a] + 1, links[b] + 1
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in parent}


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    rows, base = [], text(150)
    for i in range(60):  # a cloud of near copies of different texts
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for i in range(60, 140):
        w = rng.choice(rows)[1].split() if rng.random() < 0.5 else text(rng.randrange(1, 120))
        rows.append((i, " ".join(w[:rng.randrange(1, len(w) + 1)])))
    return rows + [(200, None), (201, ""), (202, " \n "), (203, "a b c"), (204, "a b  c"), (205, "a b d")]


@pytest.mark.parametrize("nodes", [512, 7])
def test_equals_all_pairs(spark, monkeypatch, nodes):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", nodes)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.report(df).collect()}
    assert got == expected(rows)


def test_bands_reach_the_recall():
    for percent, recall, rows in ((80, 0.9999, 5), (90, 0.99, 8), (50, 0.95, 3)):
        bands = ngram_join.choose_bands(percent, recall, rows)
        miss = lambda b: (1 - (percent / 100) ** rows) ** b  # noqa: E731, B023
        assert miss(bands) <= 1 - recall < miss(bands - 1)


def test_edge_rows(edge_clashing, empty, ordered):
    got = ordered(ngram_join.report(edge_clashing))
    assert len(got) == edge_clashing.count()
    by_id = {r[0]: r for r in got if r[0] is not None}
    assert by_id[1][1:3] == (1, 3) and by_id[15][1:3] == (1, 3) and by_id[3][1:3] == (3, 0) and by_id[4][1:3] == (4, 0)
    assert ngram_join.report(empty).count() == 0
    kept = ngram_join.keep_first(edge_clashing)
    assert kept.columns == edge_clashing.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert 1 in ids and 2 not in ids and 15 not in ids and {3, 4, 5} <= set(ids)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)]
    parent: dict = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    lone = {a for a, b in edges if a == b} - {x for e in edges if e[0] != e[1] for x in e}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if x not in lone}
