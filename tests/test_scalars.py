from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskmart.functions import bands, scalars


def one(spark, schema, values, column):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("a,b,high,low", [(1.0, 2.0, 2.0, 1.0), (None, 2.0, None, None), (-3.0, 0.0, 0.0, -3.0), (None, None, None, None)])
def test_greatest_and_least_are_null_when_an_argument_is(spark, a, b, high, low):
    assert one(spark, "a double, b double", (a, b), scalars.greatest_strict(F.col("a"), F.col("b"))) == high
    assert one(spark, "a double, b double", (a, b), scalars.least_strict(F.col("a"), F.col("b"))) == low


@pytest.mark.parametrize("value,digits,want", [(1.005, 2, 1.01), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.1 + 0.2, 1, 0.3), (1.00005, 4, 1.0001),
                                               (0.62499999999999989, 2, 0.63), (1.50004, 4, 1.5)])
def test_rounding_is_half_away_from_zero_on_the_decimal_value(spark, value, digits, want):
    assert one(spark, "a double", (value,), scalars.round_half_up("a", digits)) == want


def test_ratio_of_zero_denominator_is_null_and_alternative_applies(spark):
    assert one(spark, "a double, b double", (1.0, 0.0), scalars.ratio("a", "b")) is None
    assert one(spark, "a double, b double", (1.0, 0.0), scalars.ratio_or("a", "b")) == 0.0
    assert one(spark, "a int, b int", (1, 4), scalars.ratio("a", "b")) == 0.25


def test_counts_shares_and_flags_treat_null_as_false(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    row = df.agg(scalars.count_where(F.col("a") > 1).alias("n"), scalars.share_where(F.col("a") > 1).alias("s"),
                 scalars.count_where(F.col("a") > 9).alias("z")).first()
    assert (row["n"], row["z"]) == (1, 0) and row["s"] == pytest.approx(1 / 3)
    assert [r[0] for r in df.select(scalars.as_flag(F.col("a") > 1)).collect()] == [False, False, True]


def test_record_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "a string, b string")
    keys = [r[0] for r in df.select(scalars.record_key("a", "b")).collect()]
    assert keys[0] != keys[1] and len(keys[0]) == 32


def test_record_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("\\N", "x"), (None, "x"), ("-", "x")], "a string, b string")
    assert len({r[0] for r in df.select(scalars.record_key("a", "b")).collect()}) == 5


def test_row_values_are_rounded_once(spark):
    df = spark.createDataFrame([(1.50004999999995,), (1.50005,), (-1.50005,), (2.675,)], "a double")
    assert [r[0] for r in df.select(scalars.round_once("a", 4)).collect()] == [1.5, 1.5001, -1.5001, 2.675]
    assert one(spark, "r double", (1.5,), bands.risk_segment("r")) == "LOW"


def test_hash_unit_is_in_range_and_repeatable(spark):
    df = spark.range(2000)
    a = df.select(scalars.hash_unit(1, "id").alias("u"))
    stats = a.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= stats[0] and stats[1] < 1 and abs(stats[2] - 0.5) < 0.03
    assert a.collect() == df.repartition(7).orderBy("id").select(scalars.hash_unit(1, "id").alias("u")).collect()


@pytest.mark.parametrize("ratio,want", [(1.5, "LOW"), (1.5001, "MEDIUM"), (3.0, "MEDIUM"), (5.0, "HIGH"), (5.0001, "VERY_HIGH"), (None, "LOW")])
def test_segment_edges(spark, ratio, want):
    assert one(spark, "r double", (ratio,), bands.risk_segment("r")) == want


@pytest.mark.parametrize("p,tier,decision", [(0.0499999, "LOW", "APPROVE"), (0.05, "MEDIUM", "APPROVE_WITH_CONDITIONS"),
                                             (0.15, "HIGH", "MANUAL_REVIEW"), (0.30, "VERY_HIGH", "DECLINE")])
def test_tier_edges(spark, p, tier, decision):
    assert one(spark, "p double", (p,), bands.probability_tier("p")) == tier
    assert one(spark, "p double", (p,), bands.tier_decision("p")) == decision


@pytest.mark.parametrize("rate,want", [(0.9, "Low Rate Era"), (1.0, "Rising Rate Era"), (3.0, "High Rate Era"), (None, "High Rate Era")])
def test_rate_era(spark, rate, want):
    assert one(spark, "r double", (rate,), bands.rate_era("r")) == want


@pytest.mark.parametrize("rate,want", [(5.99, "green"), (6.0, "yellow"), (12.0, "yellow"), (12.01, "red"), (None, None)])
def test_traffic_light(spark, rate, want):
    assert one(spark, "r double", (rate,), bands.traffic_light("r")) == want


@pytest.mark.parametrize("age,want", [(29, "Under 30"), (30, "30–44"), (45, "45–59"), (60, "60+")])
def test_age_band(spark, age, want):
    assert one(spark, "a long", (age,), bands.age_band("a")) == want


@pytest.mark.parametrize("income,want", [(89999.0, "1_Low (<90K)"), (90000.0, "2_Mid (90–180K)"), (360000.0, "4_VeryHigh (360K+)")])
def test_income_bracket(spark, income, want):
    assert one(spark, "i double", (income,), bands.income_bracket("i")) == want


def test_composite_score_caps_only_the_ratio(spark):
    def score(*values):
        cols = [F.col(c) for c in "abcde"]
        return one(spark, "a double, b double, c double, d double, e double", values, bands.composite_score(*cols))

    assert score(1.0, 1.0, 20.0, 3.0, 1.0) == 1.0
    assert score(0.0, 0.0, 20.0, 30.0, 0.0) == 1.7
    assert score(None, None, 1.5, None, None) == 0.03
    assert score(0.1, 0.1, None, 0.1, 0.1) is None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(0, 6)), min_size=1, max_size=300), st.integers(0, 4))
def test_rounding_equals_decimal_rounding(spark, values, digits):
    """Doubles read off short decimals round as the decimals do, ties included."""
    exact = [Decimal(m).scaleb(-e) for m, e in values]
    df = spark.createDataFrame([(i, float(d)) for i, d in enumerate(exact)], "i int, x double")
    got = [r["y"] for r in df.select("i", scalars.round_half_up("x", digits).alias("y")).orderBy("i").collect()]
    assert got == [float(d.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) for d in exact]
