"""Mixing: exact budgets, targets as by sharing the excess again and again, edge rows."""

from __future__ import annotations

import itertools
import random

import pytest

from riskmart.llm import mixing


def best(lengths, counts, budget):
    return max(s for c in itertools.product(*(range(n + 1) for n in counts))
               if (s := sum(a * b for a, b in zip(lengths, c))) <= budget)


@pytest.mark.parametrize("seed", range(20))
def test_counts_reach_the_largest_sum(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), 4))
    counts = [rng.randrange(0, 4) for _ in lengths]
    total = sum(a * b for a, b in zip(lengths, counts))
    budget = rng.randrange(0, total + 5)
    sums = mixing._knapsack(lengths, counts, budget)
    assert all(v <= counts[i] for i, v in sums.items())
    assert sum(lengths[i] * v for i, v in sums.items()) == best(lengths, counts, budget)
    taken = mixing.fit_counts(lengths, counts, budget)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    assert sum(a * b for a, b in zip(lengths, taken)) <= budget


def test_large_budgets_are_met_exactly():
    lengths, counts = list(range(1, 4000)), [50] * 3999
    for budget in (123_456_789, 399_000_000, 7):
        taken = mixing.fit_counts(lengths, counts, budget)
        assert sum(a * b for a, b in zip(lengths, taken)) == budget


@pytest.mark.parametrize("seed", range(20))
def test_a_length_above_the_rest(seed):
    rng = random.Random(100 + seed)
    dp_words = 400
    lengths = sorted(rng.sample(range(1, 30), 3)) + [rng.randrange(401, 4000)]
    counts = [rng.randrange(1, 6) for _ in lengths[:-1]] + [1]
    for budget in range(1, sum(a * b for a, b in zip(lengths, counts)) + 1, 17):
        taken = mixing.fit_counts(lengths, counts, budget, dp_words)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert sum(a * b for a, b in zip(lengths, taken)) == best(lengths, counts, budget)
    for small, long, budget in ((100, 100_000, 105_000), (500, 60_000, 66_000)):
        taken = mixing.fit_counts([100, long], [small, 1], budget)
        assert taken == [(budget - long) // 100, 1]


def shared(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    rest, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        per = rest / sum(weight[n] for n in open_)
        over = [n for n in open_ if per * weight[n] > 2 * sizes[n]]
        if not over:
            return out | {n: per * weight[n] for n in open_}
        for n in over:
            out[n] = 2 * sizes[n]
            rest -= 2 * sizes[n]
            open_.remove(n)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {n: rng.choice([0, 5, 1000, rng.randrange(100_000)]) for n in [*"abcdefgü", "", None]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(shared(sizes))


def test_choice(spark, edge, edge_clashing, empty, ordered):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(0, 90))), rng.choice(["a", "b", "b", "c", None]))
            for i in range(800)] + [(1000 + i, "gleich " * 7, "b") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.choose(df).collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    assert {r["id"]: r["size"] for r in got} == size
    by_source: dict = {}
    for r in got:
        by_source.setdefault((r["s"], r["sn"]), []).append(r)
    for group in by_source.values():
        taken = sum(r["size"] * r["copies"] for r in group)
        assert group[0]["target"] - 1 < taken <= group[0]["target"]
        assert max(r["copies"] for r in group) <= 2
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.choose(df.repartition(7)).collect()))
    columns = ("size", "s", "sn", "source_size", "target")
    assert ordered(mixing.choose(edge), *columns) == ordered(mixing.choose(edge_clashing), *columns)
    assert mixing.choose(empty).count() == 0
    assert mixing.mix(edge_clashing).columns == [*edge_clashing.columns, "mix_copies"]
