"""Bracketed quantiles against numpy, whatever the sketch says."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.operators import quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def data(n: int = 3000):
    rng = random.Random(4)
    return [(rng.choice([None, "a", "b"]), None if rng.random() < 0.1 else rng.gauss(0, 1), rng.choice([1.0, 1.0, 1.0, 2.0, 7.5]),
             float(i) if i < 3 else None) for i in range(n)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(data(), "g string, x double, tied double, few double").withColumn("none", F.lit(None).cast("double")).repartition(5)


@pytest.mark.parametrize("accuracy", [10_000, 50, 3])
@pytest.mark.parametrize("keys", [[], ["g"]])
def test_quantiles_equal_numpy(table, accuracy, keys):
    got = {(r["g"] if keys else "all", r["feature"], r["prob"]): r["value"]
           for r in quantiles.column_quantiles(table, ["x", "tied", "few", "none"], PROBS, keys, accuracy).collect()}
    want = {}
    for g in (None, "a", "b") if keys else ("all",):
        rows = [r for r in data() if not keys or r[0] == g]
        for i, name in enumerate(("x", "tied", "few"), 1):
            values = [r[i] for r in rows if r[i] is not None]
            want |= {(g, name, p): float(np.quantile(values, p)) for p in PROBS if values}
    assert got == pytest.approx(want)


def test_a_wrong_sketch_costs_time_and_nothing_else(table, monkeypatch):
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, points, accuracy: F.array(*[F.lit(50.0) + F.max(c) for _ in points]))
    got = {r["prob"]: r["value"] for r in quantiles.column_quantiles(table, ["x"], PROBS).collect()}
    values = [r[1] for r in data() if r[1] is not None]
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in PROBS})


def test_only_bracket_rows_are_shuffled(spark):
    df = spark.range(200_000).select(*[F.rand(i).alias(f"c{i}") for i in range(6)])
    out = quantiles.column_quantiles(df, [f"c{i}" for i in range(6)], [0.5])
    assert out.count() == 6
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("Join") <= 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, g string")
    assert quantiles.column_quantiles(df, ["x"], [0.5]).count() == quantiles.column_quantiles(df, ["x"], [0.5], ["g"]).count() == 0
