"""Rule sets of the data model: the checks of every table, column by column."""

from __future__ import annotations

from collections.abc import Sequence

from riskmart import constants as K
from riskmart.operators.quality import ERROR, WARN, Rule

FLAG, BOOLEAN = (0, 1), (True, False)


def not_null(table: str, column: str, severity: str = ERROR) -> Rule:
    return Rule(table, column, "not_null", severity)


def unique(table: str, column: str, severity: str = ERROR) -> Rule:
    return Rule(table, column, "unique", severity)


def known_applicant(table: str, column: str, severity: str = ERROR) -> Rule:
    """The value is that of a staged application."""
    return Rule(table, column, "relationships", severity, {"to": "stg_application_train", "field": "applicant_id"})


def above(table: str, column: str, value: float, severity: str = ERROR) -> Rule:
    return Rule(table, column, "expression", severity, {"op": ">", "value": value})


def at_least(table: str, column: str, value: float, severity: str = ERROR) -> Rule:
    return Rule(table, column, "expression", severity, {"op": ">=", "value": value})


def between(table: str, column: str, low: float, high: float, severity: str = ERROR) -> Rule:
    return Rule(table, column, "between", severity, {"low": low, "high": high})


def one_of(table: str, column: str, values: Sequence, severity: str = ERROR) -> Rule:
    return Rule(table, column, "accepted_values", severity, {"values": values})


# --- fixed values: the checks of each table -------------------------------------------------------

def staging_rules() -> list[Rule]:
    """Checks of the staged tables."""
    rules = []
    table = "stg_application_train"
    rules += [
        not_null(table, "applicant_id"), unique(table, "applicant_id"),
        not_null(table, "default_flag"), one_of(table, "default_flag", FLAG),
        not_null(table, "loan_amount"), above(table, "loan_amount", 0),
        not_null(table, "annual_income"), above(table, "annual_income", 0),
        not_null(table, "credit_to_income_ratio"), above(table, "credit_to_income_ratio", 0),
        not_null(table, "loan_type"), one_of(table, "loan_type", K.LOAN_TYPES),
        one_of(table, "gender", K.GENDERS),
        not_null(table, "age_years"), at_least(table, "age_years", 18),
        at_least(table, "annuity_to_income_ratio", 0),
        not_null(table, "num_children"), at_least(table, "num_children", 0),
    ]
    table = "stg_bureau"
    rules += [
        not_null(table, "bureau_id"),
        not_null(table, "applicant_id"), known_applicant(table, "applicant_id", WARN),
        not_null(table, "credit_status"),
        at_least(table, "credit_sum", 0),
        at_least(table, "credit_debt", 0, WARN),
        at_least(table, "credit_overdue", 0),
    ]
    table = "stg_bureau_balance"
    rules += [
        not_null(table, "bureau_id"),
        not_null(table, "status"), one_of(table, "status", K.BUREAU_STATUSES),
    ]
    table = "stg_installments_payments"
    rules += [
        not_null(table, "applicant_id"), known_applicant(table, "applicant_id", WARN),
        not_null(table, "prev_loan_id"),
        not_null(table, "amount_due"),
        not_null(table, "amount_paid", WARN),
        not_null(table, "days_late", WARN), at_least(table, "days_late", 0),
        not_null(table, "is_late"), one_of(table, "is_late", BOOLEAN),
        at_least(table, "payment_ratio", 0),
    ]
    table = "stg_credit_card_balance"
    rules += [
        not_null(table, "applicant_id"),
        not_null(table, "prev_loan_id"),
        not_null(table, "months_balance"),
        not_null(table, "days_past_due"), at_least(table, "days_past_due", 0),
        not_null(table, "days_past_due_def"), at_least(table, "days_past_due_def", 0),
    ]
    table = "stg_previous_application"
    rules += [
        not_null(table, "prev_loan_id"),
        not_null(table, "applicant_id"), known_applicant(table, "applicant_id", WARN),
        not_null(table, "contract_status"), one_of(table, "contract_status", K.PREVIOUS_STATUSES),
    ]
    table = "stg_pos_cash_balance"
    rules += [
        not_null(table, "applicant_id"),
        not_null(table, "prev_loan_id"),
        not_null(table, "months_balance"),
        at_least(table, "days_past_due", 0),
        at_least(table, "days_past_due_def", 0),
    ]
    table = "stg_boc_macro"
    rules += [
        not_null(table, "obs_date"), unique(table, "obs_date"),
    ]
    return rules


def intermediate_rules() -> list[Rule]:
    """Checks of the roll-ups."""
    rules = []
    table = "int_bureau_features"
    rules += [
        not_null(table, "applicant_id"), unique(table, "applicant_id"), known_applicant(table, "applicant_id", WARN),
        not_null(table, "bureau_num_records"), at_least(table, "bureau_num_records", 0),
        not_null(table, "bureau_active_credits"), at_least(table, "bureau_active_credits", 0),
        not_null(table, "bureau_closed_credits"), at_least(table, "bureau_closed_credits", 0),
        not_null(table, "bureau_total_credit"), at_least(table, "bureau_total_credit", 0),
        not_null(table, "bureau_total_debt"), at_least(table, "bureau_total_debt", 0, WARN),
        not_null(table, "bureau_total_overdue"), at_least(table, "bureau_total_overdue", 0),
        not_null(table, "bureau_worst_delinquency"), between(table, "bureau_worst_delinquency", 0, 5),
        not_null(table, "bureau_delinquency_rate"), between(table, "bureau_delinquency_rate", 0, 1),
    ]
    table = "int_installment_features"
    rules += [
        not_null(table, "applicant_id"), unique(table, "applicant_id"), known_applicant(table, "applicant_id", WARN),
        not_null(table, "inst_num_payments"), above(table, "inst_num_payments", 0),
        not_null(table, "inst_late_count"), at_least(table, "inst_late_count", 0),
        not_null(table, "inst_late_rate"), between(table, "inst_late_rate", 0, 1),
        not_null(table, "inst_max_days_late"), at_least(table, "inst_max_days_late", 0),
        not_null(table, "inst_avg_days_late"), at_least(table, "inst_avg_days_late", 0),
        not_null(table, "inst_avg_payment_ratio"), at_least(table, "inst_avg_payment_ratio", 0),
        not_null(table, "inst_total_underpaid"), at_least(table, "inst_total_underpaid", 0),
    ]
    table = "int_credit_card_features"
    rules += [
        not_null(table, "applicant_id"), unique(table, "applicant_id"),
        not_null(table, "cc_num_months"), above(table, "cc_num_months", 0),
        not_null(table, "cc_avg_utilization"), between(table, "cc_avg_utilization", 0, 3, WARN),
        not_null(table, "cc_max_utilization"), at_least(table, "cc_max_utilization", 0),
        not_null(table, "cc_avg_monthly_drawings"), at_least(table, "cc_avg_monthly_drawings", 0, WARN),
        not_null(table, "cc_months_overdue"), at_least(table, "cc_months_overdue", 0),
    ]
    table = "int_previous_application_features"
    rules += [
        not_null(table, "applicant_id"), unique(table, "applicant_id"), known_applicant(table, "applicant_id", WARN),
        not_null(table, "prev_num_applications"), above(table, "prev_num_applications", 0),
        not_null(table, "prev_approved"), at_least(table, "prev_approved", 0),
        not_null(table, "prev_refused"), at_least(table, "prev_refused", 0),
        not_null(table, "prev_refusal_rate"), between(table, "prev_refusal_rate", 0, 1),
        not_null(table, "prev_avg_credit"), at_least(table, "prev_avg_credit", 0),
        not_null(table, "prev_avg_annuity"), at_least(table, "prev_avg_annuity", 0),
    ]
    return rules


def mart_rules() -> list[Rule]:
    """Checks of the marts."""
    rules = []
    table = "mart_credit_application_fact"
    rules += [
        not_null(table, "applicant_id"), unique(table, "applicant_id"),
        one_of(table, "default_flag", FLAG),
        not_null(table, "loan_type"),
        not_null(table, "loan_amount"), above(table, "loan_amount", 0),
        not_null(table, "annual_income"), above(table, "annual_income", 0),
        not_null(table, "credit_to_income_ratio"), above(table, "credit_to_income_ratio", 0),
        not_null(table, "age_years"), at_least(table, "age_years", 18),
        not_null(table, "credit_risk_segment"), one_of(table, "credit_risk_segment", K.SEGMENTS),
        not_null(table, "composite_risk_score"), between(table, "composite_risk_score", 0, 1),
        not_null(table, "bureau_active_credits"), at_least(table, "bureau_active_credits", 0),
        not_null(table, "bureau_total_debt"), at_least(table, "bureau_total_debt", 0, WARN),
        not_null(table, "bureau_total_overdue"), at_least(table, "bureau_total_overdue", 0),
        not_null(table, "bureau_delinquency_rate"), between(table, "bureau_delinquency_rate", 0, 1),
        not_null(table, "bureau_worst_delinquency"), between(table, "bureau_worst_delinquency", 0, 5),
        not_null(table, "inst_late_rate"), between(table, "inst_late_rate", 0, 1),
        not_null(table, "inst_max_days_late"), at_least(table, "inst_max_days_late", 0),
        not_null(table, "inst_avg_payment_ratio"), at_least(table, "inst_avg_payment_ratio", 0),
        not_null(table, "inst_total_underpaid"), at_least(table, "inst_total_underpaid", 0),
        not_null(table, "cc_avg_utilization"), between(table, "cc_avg_utilization", 0, 3, WARN),
        not_null(table, "cc_max_utilization"), at_least(table, "cc_max_utilization", 0),
        not_null(table, "cc_months_overdue"), at_least(table, "cc_months_overdue", 0),
        not_null(table, "prev_num_applications"), at_least(table, "prev_num_applications", 0),
        not_null(table, "prev_refusal_rate"), between(table, "prev_refusal_rate", 0, 1),
        not_null(table, "prev_approved"), at_least(table, "prev_approved", 0),
        not_null(table, "dbt_updated_at"),
    ]
    table = "mart_portfolio_summary"
    rules += [
        not_null(table, "total_applications"), above(table, "total_applications", 0),
        not_null(table, "total_defaults"), at_least(table, "total_defaults", 0),
        not_null(table, "default_rate_pct"), between(table, "default_rate_pct", 0, 100),
        not_null(table, "avg_loan_amount"), above(table, "avg_loan_amount", 0),
        not_null(table, "avg_annual_income"), above(table, "avg_annual_income", 0),
        not_null(table, "avg_dti"), above(table, "avg_dti", 0),
        not_null(table, "avg_risk_score"), between(table, "avg_risk_score", 0, 1),
        not_null(table, "credit_risk_segment"), one_of(table, "credit_risk_segment", K.SEGMENTS),
    ]
    table = "ml_features_training"
    rules += [
        not_null(table, "applicant_id"), unique(table, "applicant_id"),
        not_null(table, "label"), one_of(table, "label", FLAG),
        not_null(table, "ext_source_1"), between(table, "ext_source_1", 0, 1),
        not_null(table, "ext_source_2"), between(table, "ext_source_2", 0, 1),
        not_null(table, "ext_source_3"), between(table, "ext_source_3", 0, 1),
        not_null(table, "credit_to_income_ratio"), above(table, "credit_to_income_ratio", 0),
        not_null(table, "annuity_to_income_ratio", WARN), at_least(table, "annuity_to_income_ratio", 0),
        not_null(table, "bureau_delinquency_rate"), between(table, "bureau_delinquency_rate", 0, 1),
        not_null(table, "bureau_worst_delinquency"), between(table, "bureau_worst_delinquency", 0, 5),
        not_null(table, "bureau_total_overdue"), at_least(table, "bureau_total_overdue", 0),
        not_null(table, "inst_late_rate"), between(table, "inst_late_rate", 0, 1),
        not_null(table, "inst_max_days_late"), at_least(table, "inst_max_days_late", 0),
        not_null(table, "inst_avg_payment_ratio"), at_least(table, "inst_avg_payment_ratio", 0),
        not_null(table, "cc_avg_utilization"), between(table, "cc_avg_utilization", 0, 3, WARN),
        not_null(table, "cc_months_overdue"), at_least(table, "cc_months_overdue", 0),
        not_null(table, "prev_refusal_rate"), between(table, "prev_refusal_rate", 0, 1),
        not_null(table, "prev_num_applications"), at_least(table, "prev_num_applications", 0),
        not_null(table, "age_years"), at_least(table, "age_years", 18),
        not_null(table, "years_employed"), at_least(table, "years_employed", 0),
        not_null(table, "composite_risk_score"), between(table, "composite_risk_score", 0, 1),
    ]
    return rules


# --- fixed values: expectations on the fact ---------------------------------------------------------
NEVER_NULL = [
    "applicant_id", "default_flag", "loan_type", "loan_amount", "annual_income", "credit_to_income_ratio",
    "age_years", "credit_risk_segment", "composite_risk_score", "bureau_active_credits", "bureau_total_debt",
    "bureau_total_overdue", "bureau_delinquency_rate", "bureau_worst_delinquency", "inst_late_rate",
    "inst_max_days_late", "inst_avg_payment_ratio", "inst_total_underpaid", "cc_avg_utilization",
    "cc_max_utilization", "cc_months_overdue", "prev_num_applications", "prev_refusal_rate", "prev_approved",
    "dbt_updated_at",
]
NEVER_NEGATIVE = [
    "loan_amount", "annual_income", "bureau_active_credits", "bureau_total_overdue", "inst_max_days_late",
    "inst_avg_payment_ratio", "inst_total_underpaid", "cc_max_utilization", "cc_months_overdue",
    "prev_num_applications", "prev_approved", "credit_to_income_ratio",
]
UNIT_RANGE = [
    "bureau_delinquency_rate", "inst_late_rate", "composite_risk_score", "prev_refusal_rate",
]


def expectation_rules(tolerant: bool = True, rows: tuple[int, int] = (100_000, 500_000)) -> list[Rule]:
    """54 expectations. The tolerant set accepts 5% outliers in two columns, the strict set none."""
    t = "mart_credit_application_fact"

    def rule(column: str, kind: str, **params) -> Rule:
        return Rule(t, column, kind, ERROR, params)

    slack = {"mostly": 0.95} if tolerant else {}
    out = [rule(c, "not_null") for c in NEVER_NULL]
    out += [rule(c, "between", low=0, high=None) for c in NEVER_NEGATIVE]
    out += [rule("bureau_total_debt", "between", low=0, high=None, **slack)]
    out += [rule(c, "between", low=0, high=1) for c in UNIT_RANGE]
    out += [rule("age_years", "between", low=18, high=None),
            rule("bureau_worst_delinquency", "between", low=0, high=5),
            rule("cc_avg_utilization", "between", low=0, high=3, **slack),
            rule("default_flag", "accepted_values", values=(0, 1)),
            rule("credit_risk_segment", "accepted_values", values=K.SEGMENTS),
            rule("loan_type", "accepted_values", values=K.LOAN_TYPES),
            rule("*", "row_count", low=rows[0], high=rows[1]),
            rule("applicant_id", "unique"),
            rule("credit_risk_segment", "length_between", low=2, high=10),
            rule("loan_type", "length_between", low=4, high=20),
            rule("default_flag", "mean_between", low=0.01, high=0.20),
            rule("age_years", "median_between", low=20, high=65)]
    return out
