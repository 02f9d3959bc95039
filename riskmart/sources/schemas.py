"""Schemas of the eight raw tables and the files they are delivered in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# fixed values: raw columns the models read, and their types
DDL = {
    "application_train": """
        sk_id_curr bigint, target int, name_contract_type string, code_gender string, flag_own_car string,
        flag_own_realty string, cnt_children int, amt_income_total double, amt_credit double, amt_annuity double,
        amt_goods_price double, ext_source_1 double, ext_source_2 double, ext_source_3 double,
        name_education_type string, name_family_status string, name_housing_type string, name_income_type string,
        occupation_type string, region_population_relative double, region_rating_client int, flag_work_phone int,
        flag_email int, cnt_fam_members double, days_birth int, days_employed int, days_registration double,
        days_id_publish int""",
    "bureau": """
        sk_id_curr bigint, sk_id_bureau bigint, credit_active string, credit_currency string, credit_type string,
        days_credit int, days_credit_enddate double, amt_credit_sum double, amt_credit_sum_debt double,
        amt_credit_sum_overdue double, amt_credit_sum_limit double""",
    "bureau_balance": "sk_id_bureau bigint, months_balance int, status string",
    "previous_application": """
        sk_id_prev bigint, sk_id_curr bigint, name_contract_type string, amt_annuity double, amt_application double,
        amt_credit double, amt_down_payment double, amt_goods_price double, name_contract_status string,
        name_payment_type string, code_reject_reason string, name_client_type string, name_portfolio string,
        name_product_type string, channel_type string, name_yield_group string, days_decision int""",
    "pos_cash_balance": """
        sk_id_prev bigint, sk_id_curr bigint, months_balance int, cnt_instalment double, cnt_instalment_future double,
        name_contract_status string, sk_dpd int, sk_dpd_def int""",
    "installments_payments": """
        sk_id_curr bigint, sk_id_prev bigint, num_instalment_version double, num_instalment_number int,
        days_instalment double, days_entry_payment double, amt_instalment double, amt_payment double""",
    "credit_card_balance": """
        sk_id_prev bigint, sk_id_curr bigint, months_balance int, amt_balance double, amt_credit_limit_actual double,
        amt_drawings_current double, amt_payment_current double, amt_total_receivable double, cnt_drawings_current int,
        name_contract_status string, sk_dpd int, sk_dpd_def int""",
    "boc_macro": """
        date string, overnight_rate double, bond_2yr double, bond_10yr double, cadusd double, cpi_total double""",
}
# fixed values: delivered file per table
FILES = {
    "application_train": "application_train.csv", "bureau": "bureau.csv", "bureau_balance": "bureau_balance.csv",
    "previous_application": "previous_application.csv", "pos_cash_balance": "POS_CASH_balance.csv",
    "installments_payments": "installments_payments.csv", "credit_card_balance": "credit_card_balance.csv",
    "boc_macro": "boc_macro.csv",
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(DDL[table].split()))


class SchemaError(ValueError):
    pass


def require_schema(df: DataFrame, table: str) -> DataFrame:
    """The columns of the table's schema in its order; a missing column or another type is an error."""
    have = {f.name.lower(): f for f in df.schema.fields}
    wrong = []
    for field in raw_schema(table):
        found = have.get(field.name)
        if found is None:
            wrong.append(f"{field.name} is missing")
        elif found.dataType != field.dataType:
            wrong.append(f"{field.name} is {found.dataType.simpleString()}, not {field.dataType.simpleString()}")
    if wrong:
        raise SchemaError(f"{table}: {'; '.join(wrong)}")
    return df.select(*[df[have[f.name].name].alias(f.name) for f in raw_schema(table)])
