"""Credit-policy rules, what-if cuts and concentration figures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart import constants as K
from riskmart.functions.bands import age_band
from riskmart.functions.scalars import as_flag, count_where, ratio, ratio_or, round_half_up
from riskmart.operators.analytics import rate_pct


@dataclass(frozen=True)
class PolicyRule:
    name: str
    outcome: str  # DECLINE or MANUAL_REVIEW
    condition: Column


def standard_rules() -> list[PolicyRule]:
    """Rules over fact rows; the large-loan rule also needs the columns of ``with_recent_lateness``."""
    dti, age = F.col("credit_to_income_ratio"), F.col("age_years")
    refusal = F.col("prev_refusal_rate")
    young = age < 30
    # fixed values: policy thresholds
    return [
        PolicyRule("dti_above_limit", "DECLINE", dti > 5.0),
        PolicyRule("young_dti_decline", "DECLINE", young & (dti > 4.0)),
        PolicyRule("refusal_and_dti", "DECLINE", (refusal > 0.6) & (dti > 3.0)),
        PolicyRule("young_dti_review", "MANUAL_REVIEW", young & (dti > 3.0)),
        PolicyRule("refusal_and_delinquency", "MANUAL_REVIEW", (refusal > 0.4) & (F.col("bureau_worst_delinquency") >= 3)),
    ]


def decide(df: DataFrame, rules: Sequence[PolicyRule] | None = None) -> DataFrame:
    """Add the fired rule names and the strongest outcome (decline before review before none)."""
    rules = standard_rules() if rules is None else list(rules)
    fired = F.array_compact(F.array(*[F.when(r.condition, F.lit(r.name)) for r in rules]))

    def any_of(outcome: str) -> Column:
        hits = [as_flag(r.condition) for r in rules if r.outcome == outcome]
        out = F.lit(False)
        for h in hits:
            out = out | h
        return out

    return df.withColumn("fired_rules", fired).withColumn(
        "policy_outcome", F.when(any_of("DECLINE"), "DECLINE").when(any_of("MANUAL_REVIEW"), "MANUAL_REVIEW").otherwise("NONE"))


def with_recent_lateness(fact: DataFrame, payments: DataFrame, days_back: int = 730, late_days: int = 60) -> DataFrame:
    """Add whether a payment of the last ``days_back`` days came more than ``late_days`` late.

    Payments are cut to the window and reduced to one row per applicant before the join.
    """
    recent = payments.filter((F.col("days_instalment") >= -days_back) & F.col("days_late").isNotNull()).groupBy(
        "applicant_id").agg(F.max("days_late").alias("recent_max_days_late"))
    return fact.join(recent, "applicant_id", "left").withColumn(
        "recently_very_late", as_flag(F.col("recent_max_days_late") > late_days))


def large_loan_rule(loan_above: float = 200000.0, late_rate_above: float = 0.20) -> PolicyRule:
    return PolicyRule("large_loan_payment_check", "MANUAL_REVIEW",
                      (F.col("loan_amount") > loan_above)
                      & ((F.col("inst_late_rate") > late_rate_above) | F.col("recently_very_late")))


def cut_what_if(fact: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """What declining above each ratio cut removes and keeps.

    One scan: every cut is a set of conditional aggregates, so the rows are not repeated per cut.
    """
    dti, bad, value = F.col("credit_to_income_ratio"), F.col("default_flag") == 1, F.col("loan_amount")
    aggs = [F.count(F.lit(1)).alias("n"), count_where(bad).alias("d"), F.sum(value).alias("v")]
    for i, cut in enumerate(cuts):
        out = dti > cut
        aggs += [count_where(out).alias(f"n{i}"), count_where(out & bad).alias(f"d{i}"),
                 F.coalesce(F.sum(F.when(out, value)), F.lit(0.0)).alias(f"v{i}")]
    wide = fact.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(float(cut)).alias("dti_cut"), F.col(f"n{i}").alias("removed"), F.col(f"d{i}").alias("removed_defaults"),
        F.col(f"v{i}").alias("rv")) for i, cut in enumerate(cuts)]))
    r = wide.select("n", "d", "v", rows.alias("r")).select("n", "d", "v", "r.*")
    return r.select(
        "dti_cut", "removed", (F.col("n") - F.col("removed")).alias("kept"), "removed_defaults",
        (F.col("d") - F.col("removed_defaults")).alias("kept_defaults"),
        round_half_up("rv", 2).alias("removed_loan_value"),
        round_half_up(F.col("v") - F.col("rv"), 2).alias("kept_loan_value"),
        round_half_up(ratio_or(F.col("d") - F.col("removed_defaults"), F.col("n") - F.col("removed")) * 100, 4)
        .alias("kept_default_rate_pct"))


def fill_external_score(df: DataFrame, column: str = "ext_source_2", value: float = 0.3) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def young_limits(df: DataFrame, review: float = 3.0, decline: float = 4.0) -> Column:
    dti = F.col("credit_to_income_ratio")
    young = F.col("age_years") < 30
    return F.when(young & (dti > decline), "DECLINE").when(young & (dti > review), "MANUAL_REVIEW").otherwise("NONE")


def refusal_override() -> Column:
    refusal, dti = F.col("prev_refusal_rate"), F.col("credit_to_income_ratio")
    return (F.when((refusal > 0.6) & (dti > 3.0), "DECLINE")
            .when((refusal > 0.4) & (F.col("bureau_worst_delinquency") >= 3), "MANUAL_REVIEW").otherwise("NONE"))


def outcome_counts(df: DataFrame, outcome: Column, name: str = "outcome") -> DataFrame:
    return df.groupBy(outcome.alias(name)).agg(F.count(F.lit(1)).alias("applications"),
                                               rate_pct("default_flag").alias("default_rate_pct"))


def refusal_bands(fact: DataFrame) -> DataFrame:
    r = F.col("prev_refusal_rate")
    band = F.when(r == 0, "none").when(r <= 0.5, "up to half").otherwise("over half")
    return outcome_counts(fact, band, "refusal_band")


def age_gap(fact: DataFrame) -> DataFrame:
    """Default rate of each age band minus the whole portfolio's, in percentage points."""
    bands = fact.groupBy(age_band("age_years").alias("age_band")).agg(
        F.count(F.lit(1)).alias("applications"), F.count("default_flag").alias("_known"),
        F.sum(F.col("default_flag").cast("long")).alias("_bad"))
    everything = Window.partitionBy(F.lit(0))  # of the bands' rows
    bands = bands.withColumns({"_all_bad": F.sum("_bad").over(everything), "_all_known": F.sum("_known").over(everything)})
    rate, overall = ratio("_bad", "_known") * 100, ratio("_all_bad", "_all_known") * 100
    return bands.select(
        "age_band", "applications", round_half_up(rate, 2).alias("default_rate_pct"),
        round_half_up(rate - overall, 2).alias("gap_pp"))


def concentration(fact: DataFrame) -> DataFrame:
    """Share of the loan value in the two highest segments."""
    high = F.sum(F.when(F.col("credit_risk_segment").isin(*K.HIGH_SEGMENTS), F.col("loan_amount")).otherwise(F.lit(0.0)))
    return fact.agg(round_half_up(high, 2).alias("high_loan_value"),
                    round_half_up(F.sum("loan_amount"), 2).alias("loan_value"),
                    round_half_up(ratio_or(high, F.sum("loan_amount")) * 100, 4).alias("high_share_pct"))
