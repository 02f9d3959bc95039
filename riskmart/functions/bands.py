"""Named business bands, tiers and scores built from the fixed cuts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart import constants as K
from riskmart.functions.scalars import case_ladder, col_of, least_strict, round_half_up


def risk_segment(credit_to_income: Column | str) -> Column:
    """Segment of the (already rounded) ratio; NULL falls to the lowest segment."""
    return case_ladder(col_of(credit_to_income), K.SEGMENT_CUTS, K.SEGMENT_FLOOR, below=False)


def income_bracket(income: Column | str, *, report: bool = False) -> Column:
    steps, top = (K.INCOME_BANDS_REPORT, K.INCOME_TOP_REPORT) if report else (K.INCOME_BANDS, K.INCOME_TOP)
    return case_ladder(col_of(income), steps, top)


def age_band(age_years: Column | str) -> Column:
    return case_ladder(col_of(age_years), K.AGE_BANDS, K.AGE_TOP)


def rate_era(avg_rate: Column | str) -> Column:
    """An unknown rate lands in the last era."""
    return case_ladder(col_of(avg_rate), K.RATE_ERAS, K.RATE_ERA_TOP)


def traffic_light(rate_pct: Column | str) -> Column:
    rate = col_of(rate_pct)
    (green_below, green), (yellow_to, yellow) = K.TRAFFIC_LIGHTS
    return (F.when(rate < green_below, F.lit(green)).when(rate <= yellow_to, F.lit(yellow))
            .when(rate.isNotNull(), F.lit(K.TRAFFIC_TOP)))


def probability_tier(p: Column | str) -> Column:
    return case_ladder(col_of(p), [(cut, tier) for cut, tier, _ in K.TIER_CUTS], K.TIER_CEILING[0])


def tier_decision(p: Column | str) -> Column:
    return case_ladder(col_of(p), [(cut, decision) for cut, _, decision in K.TIER_CUTS], K.TIER_CEILING[1])


def score_terms(delinquency: Column, late: Column, credit_to_income: Column, utilization: Column,
                refusal: Column, weights: Mapping[str, float] = K.SCORE_WEIGHTS) -> dict[str, Column]:
    """Weighted terms of the composite score; only the ratio term is capped."""
    zero = F.lit(0.0)
    return {
        "delinquency": F.lit(weights["delinquency"]) * F.coalesce(delinquency, zero),
        "late": F.lit(weights["late"]) * F.coalesce(late, zero),
        "ratio": F.lit(weights["ratio"]) * least_strict(credit_to_income / F.lit(10.0), F.lit(1.0)),
        "utilization": F.lit(weights["utilization"]) * F.coalesce(utilization / F.lit(3.0), zero),
        "refusal": F.lit(weights["refusal"]) * F.coalesce(refusal, zero),
    }


def composite_score(*inputs: Column, weights: Mapping[str, float] = K.SCORE_WEIGHTS) -> Column:
    t = score_terms(*inputs, weights=weights)
    total = t["delinquency"] + t["late"] + t["ratio"] + t["utilization"] + t["refusal"]
    return round_half_up(total, 4)
