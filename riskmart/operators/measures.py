"""Dashboard measures and report tables over the fact: ``measure(fact, *group columns)``.

A filter context is a group-by; every block is one scan with conditional aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart import constants as K
from riskmart.functions.bands import age_band, income_bracket, score_terms, traffic_light
from riskmart.functions.scalars import count_where, ratio, ratio_or, round_half_up, share_where
from riskmart.operators.analytics import rate_pct
from riskmart.operators.ranking import exact_quantiles

FLAG, SEG = "default_flag", "credit_risk_segment"


def segment_dimension(spark) -> DataFrame:
    return spark.createDataFrame(
        [list(r) for r in K.SEGMENT_DIM],
        "credit_risk_segment string, risk_order int, description string, dti_threshold string, "
        "appetite string, risk_color_code string, osfi_risk_weight int")


def loan_type_dimension(spark) -> DataFrame:
    return spark.createDataFrame([list(r) for r in K.LOAN_TYPE_DIM], "loan_type string, loan_type_short string")


def with_dimensions(fact: DataFrame) -> DataFrame:
    """Fact rows with segment order, texts, capital weight and short loan type (fixed tables of 4 and 2 rows)."""
    spark = fact.sparkSession
    return fact.join(F.broadcast(segment_dimension(spark)), SEG, "left").join(
        F.broadcast(loan_type_dimension(spark)), "loan_type", "left")


def segment_exposure(fact: DataFrame) -> DataFrame:
    """Loan value and risk-weighted value per segment and loan type."""
    weight = F.col("osfi_risk_weight") / F.lit(100.0)
    return with_dimensions(fact).groupBy("risk_order", SEG, "loan_type_short").agg(
        F.count(F.lit(1)).alias("applications"),
        round_half_up(F.sum("loan_amount"), 2).alias("loan_value"),
        round_half_up(F.sum(F.col("loan_amount") * weight), 2).alias("risk_weighted_value"))


def kpi_block(fact: DataFrame, *by: str) -> DataFrame:
    defaults = count_where(F.col(FLAG) == 1)
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_applications"),
        defaults.alias("total_defaults"),
        round_half_up(ratio_or(defaults, F.count(F.lit(1))) * 100, 2).alias("default_rate_pct"),
        round_half_up(F.avg("loan_amount"), 2).alias("avg_loan_amount"),
        round_half_up(F.avg("annual_income"), 2).alias("avg_annual_income"),
        round_half_up(F.avg("credit_to_income_ratio"), 3).alias("avg_dti"),
        round_half_up(F.avg("composite_risk_score"), 4).alias("avg_risk_score"),
        round_half_up(F.sum("loan_amount") / 1000000, 1).alias("portfolio_value_m"),
    )


def high_risk(fact: DataFrame, *by: str) -> DataFrame:
    high = count_where(F.col(SEG).isin(*K.HIGH_SEGMENTS))
    return fact.groupBy(*by).agg(
        high.alias("high_risk_count"),
        round_half_up(ratio_or(high, F.count(F.lit(1))) * 100, 2).alias("high_risk_pct"))


def extreme_segment_ratio(fact: DataFrame, *by: str) -> DataFrame:
    """Default rate of the highest segment over that of the lowest."""
    def rate(segment: str):
        inside = F.col(SEG) == segment
        return ratio_or(count_where(inside & (F.col(FLAG) == 1)), count_where(inside)) * 100

    top, low = rate("VERY_HIGH"), rate("LOW")
    return fact.groupBy(*by).agg(
        round_half_up(top, 4).alias("very_high_rate_pct"), round_half_up(low, 4).alias("low_rate_pct"),
        round_half_up(ratio_or(top, low), 4).alias("very_high_low_ratio"))


def segment_rate_ignoring_filters(fact: DataFrame, *by: str) -> DataFrame:
    """Each cell beside the rate of its whole segment (other filters removed).

    Segment totals come from the cells, so the fact is scanned and shuffled once.
    """
    cells = fact.groupBy(SEG, *by).agg(F.count(F.lit(1)).alias("applications"),
                                       count_where(F.col(FLAG) == 1).alias("defaults"))
    whole = cells.groupBy(SEG).agg(F.sum("applications").alias("_n"), F.sum("defaults").alias("_d"))
    return cells.join(whole, SEG).select(
        SEG, *by, "applications",
        round_half_up(ratio_or("defaults", "applications") * 100, 2).alias("default_rate_pct"),
        round_half_up(ratio_or("_d", "_n") * 100, 2).alias("segment_default_rate_pct"))


def late_rates(fact: DataFrame, *by: str) -> DataFrame:
    late = F.col("inst_late_rate")
    bad = F.avg(F.when(F.col(FLAG) == 1, late)) * 100
    good = F.avg(F.when(F.col(FLAG) == 0, late)) * 100
    return fact.groupBy(*by).agg(
        round_half_up(F.avg(late) * 100, 4).alias("avg_late_rate_pct"),
        round_half_up(bad, 4).alias("defaulter_late_rate_pct"),
        round_half_up(good, 4).alias("non_defaulter_late_rate_pct"),
        round_half_up(ratio_or(bad, good), 4).alias("late_payment_lift"))


def bureau_measures(fact: DataFrame, *by: str) -> DataFrame:
    with_record = count_where(F.col("bureau_num_records") > 0)
    return fact.groupBy(*by).agg(
        round_half_up(F.avg("bureau_delinquency_rate") * 100, 4).alias("avg_bureau_delinquency_pct"),
        round_half_up(F.avg("bureau_total_overdue"), 2).alias("avg_bureau_overdue"),
        round_half_up(ratio_or(with_record, F.count(F.lit(1))) * 100, 2).alias("with_bureau_record_pct"))


def score_p90(fact: DataFrame, *by: str) -> DataFrame:
    """90th percentile, inclusive and interpolated."""
    return exact_quantiles(fact, "composite_risk_score", [0.90], list(by)).select(
        *by, round_half_up("value", 6).alias("risk_score_p90"))


def decision_funnel(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy(SEG).agg(F.count(F.lit(1)).alias("applications"))
    labels = fact.sparkSession.createDataFrame(list(K.SEGMENT_DECISION.items()), "segment string, decision string")
    dim = segment_dimension(fact.sparkSession).select(F.col(SEG).alias("segment"), "risk_order").join(labels, "segment")
    return dim.join(counts, F.col("segment") == F.col(SEG), "left").select(
        "risk_order", F.col("segment").alias(SEG), "decision",
        F.coalesce(F.col("applications"), F.lit(0)).alias("applications")).orderBy("risk_order")


def matrix(fact: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Default rate with one output column ``rate_<value>`` per named value, in lower snake case."""
    wide = fact.groupBy(rows).pivot(columns, list(values)).agg(rate_pct(FLAG))
    return wide.select(rows, *[F.col(f"`{v}`").alias(f"rate_{snake(v)}") for v in values])


def snake(text: str) -> str:
    kept = "".join(ch.lower() if ch.isalnum() and ch.isascii() else "_" for ch in text)
    return "_".join(p for p in kept.split("_") if p)


def banded(fact: DataFrame) -> DataFrame:
    return fact.withColumn("age_band", age_band("age_years")).withColumn(
        "income_bracket", income_bracket("annual_income", report=True))


def rate_cells(fact: DataFrame, *by: str) -> DataFrame:
    """Long form of a matrix with its traffic light."""
    return fact.groupBy(*by).agg(F.count(F.lit(1)).alias("applications"), rate_pct(FLAG).alias("default_rate_pct")
                                 ).withColumn("light", traffic_light("default_rate_pct"))


def portfolio_split(fact: DataFrame, *by: str) -> DataFrame:
    """Rows, loan value, share of the whole and default rate per group."""
    groups = fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("applications"), F.sum("loan_amount").alias("_value"), rate_pct(FLAG).alias("default_rate_pct"))
    everything = Window.partitionBy(F.lit(0))  # of the groups' rows
    rows, value = F.sum("applications").over(everything), F.sum("_value").over(everything)
    return groups.select(
        *by, "applications", round_half_up("_value", 2).alias("loan_value"),
        round_half_up(ratio("applications", rows) * 100, 4).alias("application_share_pct"),
        round_half_up(ratio("_value", value) * 100, 4).alias("loan_value_share_pct"), "default_rate_pct")


def score_components(fact: DataFrame, *by: str) -> DataFrame:
    """Mean weighted term of the composite score per group."""
    terms = score_terms(F.col("bureau_delinquency_rate"), F.col("inst_late_rate"), F.col("credit_to_income_ratio"),
                        F.col("cc_avg_utilization"), F.col("prev_refusal_rate"))
    return fact.groupBy(*by).agg(*[round_half_up(F.avg(t), 6).alias(f"{n}_term") for n, t in terms.items()],
                                 round_half_up(F.avg("composite_risk_score"), 6).alias("avg_risk_score"))


def delinquency_quantiles(fact: DataFrame, probs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    q = exact_quantiles(fact, "bureau_delinquency_rate", probs, [FLAG])
    return q.groupBy(FLAG).agg(*[
        round_half_up(F.max(F.when(F.col("prob") == p, F.col("value"))), 6).alias(f"p{round(p * 100):02d}") for p in probs])


def low_external_share(fact: DataFrame, cut: float = 0.3, *by: str) -> DataFrame:
    return fact.groupBy(*by).agg(
        round_half_up(share_where(F.col("ext_source_2") < cut) * 100, 4).alias("low_ext_source_2_pct"))


def quadrant(ratio_cut: float = 3.0, delinquency_cut: float = 0.2):
    wide = F.when(F.col("credit_to_income_ratio") > ratio_cut, "high_dti").otherwise("low_dti")
    late = F.when(F.col("bureau_delinquency_rate") > delinquency_cut, "high_delinquency").otherwise("low_delinquency")
    return F.concat_ws("/", wide, late)


def quadrants(fact: DataFrame) -> DataFrame:
    return fact.groupBy(quadrant().alias("quadrant"), FLAG).agg(
        F.count(F.lit(1)).alias("applications"), round_half_up(F.avg("loan_amount"), 2).alias("avg_loan_amount"))


def scatter_points(fact: DataFrame, share: float = 0.1, seed: int = 42) -> DataFrame:
    """Sample of points for the scatter plot, chosen by a hash of the applicant so it never changes."""
    pick = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("applicant_id").cast("string"))), 1, 8), 16, 10)
    return fact.filter(pick.cast("long") < F.lit(int(share * (1 << 32)))).select(
        "applicant_id", "credit_to_income_ratio", "bureau_delinquency_rate", "loan_amount", FLAG,
        quadrant().alias("quadrant"))


def gauges(fact: DataFrame, late_target: float = 0.08, delinquency_target: float = 0.10, *by: str) -> DataFrame:
    late, bad = F.avg("inst_late_rate"), F.avg("bureau_delinquency_rate")
    return fact.groupBy(*by).agg(
        round_half_up(late, 6).alias("avg_late_rate"), F.lit(late_target).alias("late_target"),
        (late <= late_target).alias("late_ok"),
        round_half_up(bad, 6).alias("avg_delinquency_rate"), F.lit(delinquency_target).alias("delinquency_target"),
        (bad <= delinquency_target).alias("delinquency_ok"))


def visible_to(fact: DataFrame, grants: DataFrame, user: str) -> DataFrame:
    """Rows whose income type the user may see; ``grants`` has (user_name, income_type)."""
    allowed = grants.filter(F.col("user_name") == user).select("income_type")
    return fact.join(allowed, "income_type", "left_semi")
