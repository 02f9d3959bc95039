"""Roll-ups of history tables to one row per applicant.

Every roll-up is a hash aggregation with partial sums before its shuffle, so an applicant holding a
large part of the history costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart import constants as K
from riskmart.functions.scalars import count_where, ratio, round_half_up


def _or_zero(c: Column, zero: float | int = 0.0) -> Column:
    return F.coalesce(c, F.lit(zero))


def balance_by_credit(balance: DataFrame) -> DataFrame:
    """Months, delinquent months and worst level per bureau credit."""
    status = F.col("status")
    level = F.when(status.isin(*K.DELINQUENT_LEVELS), status.try_cast("int")).otherwise(F.lit(0))
    return balance.groupBy("bureau_id").agg(
        F.count(F.lit(1)).alias("_months"),
        count_where(~status.isin(*K.NOT_DELINQUENT)).alias("_bad_months"),
        F.max(level).alias("_worst"),
    )


def with_balance_months(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """Every credit with each of its months, credits without history once.

    A left join written as its two halves: the inner half lets adaptive execution split a credit with a
    huge history, which it cannot do on the right side of a left join.
    """
    found = bureau.join(balance, "bureau_id")
    bare = bureau.join(balance.select("bureau_id").distinct(), "bureau_id", "left_anti")
    return found.unionByName(bare, allowMissingColumns=True)


def bureau_features(bureau: DataFrame, balance: DataFrame, fanout_safe: bool = False) -> DataFrame:
    """Nine bureau measures per applicant.

    By default a credit counts once per month of its balance history (at least once), as a plain join
    of the two tables would make it. The months are first reduced to one row per credit and then used
    as a weight, which gives the same numbers without multiplying the rows and keeps a credit with a
    huge history out of the join. ``fanout_safe`` counts every credit once instead.
    """
    joined = bureau.join(balance_by_credit(balance), "bureau_id", "left")
    # Counting the flipped id gives the same number but does not reuse the join's partitioning. With a
    # shuffle after the join anyway, adaptive execution is free to split a bureau_id (or NULL) that
    # holds a large part of the credits.
    credit = F.bitwise_not("bureau_id")
    months = F.coalesce(F.col("_months"), F.lit(1))
    weight = F.lit(1) if fanout_safe else months
    age = F.col("years_since_credit_start")

    def weighted_count(cond: Column) -> Column:
        return _or_zero(F.sum(F.when(cond, weight).otherwise(F.lit(0))), 0).cast("long")

    def weighted_sum(name: str) -> Column:
        return _or_zero(F.sum(F.col(name) * weight))

    return joined.groupBy("applicant_id").agg(
        F.count_distinct(credit).alias("bureau_num_records"),
        weighted_count(F.col("credit_status") == "Active").alias("bureau_active_credits"),
        weighted_count(F.col("credit_status") == "Closed").alias("bureau_closed_credits"),
        weighted_sum("credit_sum").alias("bureau_total_credit"),
        weighted_sum("credit_debt").alias("bureau_total_debt"),
        weighted_sum("credit_overdue").alias("bureau_total_overdue"),
        _or_zero(ratio(F.sum(age * weight), F.sum(F.when(age.isNotNull(), weight)))).alias("bureau_avg_credit_age_yrs"),
        _or_zero(F.max("_worst"), 0).cast("int").alias("bureau_worst_delinquency"),
        _or_zero(round_half_up(ratio(F.sum(_or_zero(F.col("_bad_months"), 0)), F.sum(months)), 4))
        .alias("bureau_delinquency_rate"),
    )


def installment_features(payments: DataFrame) -> DataFrame:
    late = count_where(F.col("is_late"))
    short = F.col("amount_due") - F.col("amount_paid")
    return payments.groupBy("applicant_id").agg(
        F.count(F.lit(1)).alias("inst_num_payments"),
        late.alias("inst_late_count"),
        round_half_up(ratio(late, F.count(F.lit(1))), 4).alias("inst_late_rate"),
        _or_zero(F.max("days_late")).alias("inst_max_days_late"),
        _or_zero(F.avg("days_late")).alias("inst_avg_days_late"),
        _or_zero(F.avg("payment_ratio"), 1.0).alias("inst_avg_payment_ratio"),
        _or_zero(F.sum(F.when(short > 0, short).otherwise(F.lit(0.0)))).alias("inst_total_underpaid"),
    )


def credit_card_features(card: DataFrame) -> DataFrame:
    """Months without a limit have no utilization and do not enter its mean."""
    used = ratio("balance", "credit_limit_actual")
    return card.groupBy("applicant_id").agg(
        F.count(F.lit(1)).alias("cc_num_months"),
        _or_zero(round_half_up(F.avg(used), 4)).alias("cc_avg_utilization"),
        _or_zero(F.max(used)).alias("cc_max_utilization"),
        _or_zero(F.avg("drawings_current")).alias("cc_avg_monthly_drawings"),
        count_where(F.col("days_past_due_def") > 0).alias("cc_months_overdue"),
    )


def previous_application_features(previous: DataFrame) -> DataFrame:
    status = F.col("contract_status")
    refused = count_where(status == "Refused")
    return previous.groupBy("applicant_id").agg(
        F.count(F.lit(1)).alias("prev_num_applications"),
        count_where(status == "Approved").alias("prev_approved"),
        refused.alias("prev_refused"),
        round_half_up(ratio(refused, F.count(F.lit(1))), 4).alias("prev_refusal_rate"),
        _or_zero(F.avg("amount_credited")).alias("prev_avg_credit"),
        _or_zero(F.avg("annuity")).alias("prev_avg_annuity"),
        _or_zero(F.avg("years_since_decision")).alias("prev_avg_decision_age_yrs"),
    )
