"""Staging steps: raw table in, renamed and typed table out. All lazy, one narrow pass each.

Only the application step shuffles, because it keeps one row per applicant.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart import constants as K
from riskmart.functions.scalars import as_flag, greatest_strict, ratio, round_once, whole_years, years_back

LOADED = "dbt_loaded_at"

# fixed values: raw column -> staged column
APPLICATION_NAMES = {
    "sk_id_curr": "applicant_id", "target": "default_flag", "name_contract_type": "loan_type",
    "code_gender": "gender", "flag_own_car": "owns_car", "flag_own_realty": "owns_realty",
    "cnt_children": "num_children", "amt_income_total": "annual_income", "amt_credit": "loan_amount",
    "amt_annuity": "loan_annuity", "amt_goods_price": "goods_price", "ext_source_1": "ext_source_1",
    "ext_source_2": "ext_source_2", "ext_source_3": "ext_source_3", "name_education_type": "education_level",
    "name_family_status": "family_status", "name_housing_type": "housing_type",
    "name_income_type": "income_type", "occupation_type": "occupation",
    "region_population_relative": "region_pop_pct", "region_rating_client": "region_rating",
    "flag_work_phone": "has_work_phone", "flag_email": "has_email", "cnt_fam_members": "family_size",
}
BUREAU_NAMES = {
    "sk_id_curr": "applicant_id", "sk_id_bureau": "bureau_id", "credit_active": "credit_status",
    "credit_currency": "credit_currency", "credit_type": "credit_type",
}
BALANCE_NAMES = {"sk_id_bureau": "bureau_id", "months_balance": "months_balance", "status": "status"}
INSTALLMENT_NAMES = {
    "sk_id_curr": "applicant_id", "sk_id_prev": "prev_loan_id", "num_instalment_version": "instalment_version",
    "num_instalment_number": "instalment_number", "days_instalment": "days_instalment",
    "days_entry_payment": "days_payment_made", "amt_instalment": "amount_due", "amt_payment": "amount_paid",
}
CARD_NAMES = {
    "sk_id_prev": "prev_loan_id", "sk_id_curr": "applicant_id", "months_balance": "months_balance",
    "amt_balance": "balance", "amt_credit_limit_actual": "credit_limit_actual",
    "amt_drawings_current": "drawings_current", "amt_payment_current": "payment_current",
    "amt_total_receivable": "total_receivable", "cnt_drawings_current": "count_drawings_current",
    "name_contract_status": "contract_status", "sk_dpd": "days_past_due", "sk_dpd_def": "days_past_due_def",
}
PREVIOUS_NAMES = {
    "sk_id_prev": "prev_loan_id", "sk_id_curr": "applicant_id", "name_contract_type": "loan_type",
    "amt_annuity": "annuity", "amt_application": "amount_applied", "amt_credit": "amount_credited",
    "amt_down_payment": "down_payment", "amt_goods_price": "goods_price",
    "name_contract_status": "contract_status", "name_payment_type": "payment_type",
    "code_reject_reason": "reject_reason", "name_client_type": "client_type", "name_portfolio": "portfolio",
    "name_product_type": "product_type", "channel_type": "channel_type", "name_yield_group": "yield_group",
}
POS_NAMES = {
    "sk_id_prev": "prev_loan_id", "sk_id_curr": "applicant_id", "months_balance": "months_balance",
    "cnt_instalment": "count_instalment", "cnt_instalment_future": "count_instalment_future",
    "name_contract_status": "contract_status", "sk_dpd": "days_past_due", "sk_dpd_def": "days_past_due_def",
}
MACRO_NAMES = {
    "overnight_rate": "overnight_rate", "bond_2yr": "bond_yield_2yr", "bond_10yr": "bond_yield_10yr",
    "cadusd": "fx_cad_usd", "cpi_total": "cpi_all",
}


def _renamed(names: dict[str, str]) -> list[Column]:
    return [F.col(raw).alias(staged) for raw, staged in names.items()]


def _stamp(now: datetime | None) -> Column:
    return (F.current_timestamp() if now is None else F.lit(now)).alias(LOADED)


def not_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def positive_amounts(df: DataFrame, *cols: str) -> DataFrame:
    """Rows whose amounts are all above zero; a missing amount is not."""
    for c in cols:
        df = df.filter(F.col(c) > 0)
    return df


def dedupe_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Catalyst turns the filter on the row number into a per-partition limit before the shuffle, so a
    key with very many copies sends one row per map task and not its whole group.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def _accepted(raw: DataFrame) -> DataFrame:
    return positive_amounts(not_null_key(raw, "sk_id_curr"), "amt_income_total", "amt_credit")


def applicant_keys(raw: DataFrame) -> DataFrame:
    """The applicants of ``stg_application``. Which copy of one wins does not matter for its key, so nothing is sorted."""
    return _accepted(raw).select(F.col("sk_id_curr").alias("applicant_id")).distinct()


def stg_application(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    """31 columns, one row per applicant with positive income and credit; the newest copy wins.

    Copies loaded at the same time are told apart by their business columns, so the winner does not
    depend on the row order.
    """
    kept = _accepted(raw)
    ties = [F.col(c).asc_nulls_last() for c in APPLICATION_NAMES if c != "sk_id_curr"]
    ties += [F.col(c).asc_nulls_last() for c in ("days_birth", "days_employed", "days_registration", "days_id_publish")]
    order = ([F.col("loaded_at").desc_nulls_last()] if "loaded_at" in raw.columns else []) + ties
    latest = dedupe_latest(kept, ["sk_id_curr"], order)
    employed = F.when(F.col("days_employed") != K.UNEMPLOYED_DAYS, whole_years("days_employed"))
    return latest.select(
        *_renamed(APPLICATION_NAMES),
        whole_years("days_birth").alias("age_years"),
        employed.alias("years_employed"),
        round_once(ratio("amt_credit", "amt_income_total"), 4).alias("credit_to_income_ratio"),
        round_once(ratio("amt_annuity", "amt_income_total"), 4).alias("annuity_to_income_ratio"),
        years_back("days_registration").alias("years_since_registration"),
        years_back("days_id_publish").alias("years_since_id_publish"),
        _stamp(now),
    )


def stg_bureau(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    amounts = {"amt_credit_sum": "credit_sum", "amt_credit_sum_debt": "credit_debt",
               "amt_credit_sum_overdue": "credit_overdue", "amt_credit_sum_limit": "credit_limit"}
    return not_null_key(raw, "sk_id_curr").select(
        *_renamed(BUREAU_NAMES),
        years_back("days_credit").alias("years_since_credit_start"),
        years_back("days_credit_enddate").alias("years_to_credit_end"),
        *[F.coalesce(F.col(a).cast("double"), F.lit(0.0)).alias(n) for a, n in amounts.items()],
        _stamp(now),
    )


def stg_bureau_balance(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return raw.select(*_renamed(BALANCE_NAMES), _stamp(now))


def stg_installments(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    delay = F.col("days_entry_payment") - F.col("days_instalment")
    return not_null_key(raw, "sk_id_curr").select(
        *_renamed(INSTALLMENT_NAMES),
        greatest_strict(delay, F.lit(0.0)).alias("days_late"),
        as_flag(delay > 0).alias("is_late"),
        round_once(ratio("amt_payment", "amt_instalment"), 4).alias("payment_ratio"),
        _stamp(now),
    )


def stg_credit_card(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return not_null_key(raw, "sk_id_curr").select(*_renamed(CARD_NAMES), _stamp(now))


def stg_previous_application(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return not_null_key(raw, "sk_id_curr").select(
        *_renamed(PREVIOUS_NAMES), years_back("days_decision").alias("years_since_decision"), _stamp(now))


def stg_pos_cash(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return not_null_key(raw, "sk_id_curr").select(*_renamed(POS_NAMES), _stamp(now))


def stg_macro(raw: DataFrame, now: datetime | None = None) -> DataFrame:
    return raw.select(
        F.col("date").cast("date").alias("obs_date"),
        *[F.col(r).cast("double").alias(s) for r, s in MACRO_NAMES.items()],
        _stamp(now),
    )


STAGING = {
    "stg_application_train": ("application_train", stg_application),
    "stg_bureau": ("bureau", stg_bureau),
    "stg_bureau_balance": ("bureau_balance", stg_bureau_balance),
    "stg_installments_payments": ("installments_payments", stg_installments),
    "stg_credit_card_balance": ("credit_card_balance", stg_credit_card),
    "stg_previous_application": ("previous_application", stg_previous_application),
    "stg_pos_cash_balance": ("pos_cash_balance", stg_pos_cash),
    "stg_boc_macro": ("boc_macro", stg_macro),
}
