"""Fact, portfolio summary and training table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart import constants as K
from riskmart.functions.bands import composite_score, risk_segment
from riskmart.functions.scalars import round_half_up

UPDATED = "dbt_updated_at"

# fixed values: columns of the fact, in order, by origin; the number is the default for no history
FACT_APPLICATION = (
    "applicant_id", "default_flag", "loan_type", "gender", "age_years", "years_employed", "loan_amount",
    "annual_income", "credit_to_income_ratio", "annuity_to_income_ratio", "education_level", "family_status",
    "housing_type", "income_type", "num_children", "region_rating", "ext_source_1", "ext_source_2", "ext_source_3",
)
FACT_DEFAULTS = {
    "bureau_active_credits": 0, "bureau_total_debt": 0, "bureau_total_overdue": 0, "bureau_delinquency_rate": 0,
    "bureau_worst_delinquency": 0, "bureau_num_records": 0,
    "inst_late_rate": 0, "inst_max_days_late": 0, "inst_avg_payment_ratio": 1.0, "inst_total_underpaid": 0,
    "cc_avg_utilization": 0, "cc_max_utilization": 0, "cc_months_overdue": 0,
    "prev_num_applications": 0, "prev_refusal_rate": 0, "prev_approved": 0,
}
TRAINING_DEFAULTS = {"ext_source_1": 0.5, "ext_source_2": 0.5, "ext_source_3": 0.5, "years_employed": 0}
TRAINING_FEATURES = (
    "credit_to_income_ratio", "annuity_to_income_ratio", "bureau_delinquency_rate", "bureau_worst_delinquency",
    "bureau_total_overdue", "inst_late_rate", "inst_max_days_late", "inst_avg_payment_ratio", "cc_avg_utilization",
    "cc_months_overdue", "prev_refusal_rate", "prev_num_applications", "age_years", "composite_risk_score",
    "ext_source_1", "ext_source_2", "ext_source_3", "years_employed",
)
SUMMARY_KEYS = ("loan_type", "education_level", "credit_risk_segment", "gender", "income_type")


def credit_fact(app: DataFrame, bureau: DataFrame, installments: DataFrame, card: DataFrame, previous: DataFrame,
                defaults: Mapping[str, float] = FACT_DEFAULTS, weights: Mapping[str, float] = K.SCORE_WEIGHTS,
                now: datetime | None = None) -> DataFrame:
    """38 columns, one row per applicant.

    All five inputs are already hash-partitioned by applicant through their own aggregation, so the
    four joins reuse that partitioning and add no shuffle.
    """
    sides = []
    for side in (bureau, installments, card, previous):
        sides.append(side.select("applicant_id", *[c for c in defaults if c in side.columns]))
    wide = app.select(*FACT_APPLICATION)
    for side in sides:
        wide = wide.join(side, "applicant_id", "left")
    score = composite_score(F.col("bureau_delinquency_rate"), F.col("inst_late_rate"), F.col("credit_to_income_ratio"),
                            F.col("cc_avg_utilization"), F.col("prev_refusal_rate"), weights=weights)
    return wide.select(
        *FACT_APPLICATION,
        *[F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in defaults.items()],
        risk_segment("credit_to_income_ratio").alias("credit_risk_segment"),
        score.alias("composite_risk_score"),
        (F.current_timestamp() if now is None else F.lit(now)).alias(UPDATED),
    )


def portfolio_summary(fact: DataFrame, keys=SUMMARY_KEYS) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_applications"),
        F.sum(F.col("default_flag").cast("long")).alias("total_defaults"),
        round_half_up(F.avg("default_flag") * 100, 2).alias("default_rate_pct"),
        round_half_up(F.avg("loan_amount"), 0).alias("avg_loan_amount"),
        round_half_up(F.avg("annual_income"), 0).alias("avg_annual_income"),
        round_half_up(F.avg("credit_to_income_ratio"), 3).alias("avg_dti"),
        round_half_up(F.avg("composite_risk_score"), 4).alias("avg_risk_score"),
    )


def labelled_rows(fact: DataFrame, label: str = "default_flag") -> DataFrame:
    return fact.filter(F.col(label).isNotNull())


def training_table(fact: DataFrame, defaults: Mapping[str, float] = TRAINING_DEFAULTS) -> DataFrame:
    """Applicant, label and 18 features of the labelled rows."""
    def feature(name: str):
        filled = F.coalesce(F.col(name), F.lit(defaults[name])) if name in defaults else F.col(name)
        return filled.alias(name)

    return labelled_rows(fact).select(
        "applicant_id", F.col("default_flag").alias("label"), *[feature(c) for c in TRAINING_FEATURES])
