"""The same tables as SQL text for the second engine.

Each named table is a WITH block; ``compose`` puts the blocks a query mentions, and theirs, in front of
it. The texts state the wanted results on their own: the bureau roll-up, for example, is the plain
join-then-group form, and every rank is the engine's own window function.
"""

from __future__ import annotations

import re


def rnd(x: str, n: int) -> str:
    """Half away from zero on the decimal value, with the noise of doubles removed first."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,{n + 6})), {n}) AS DOUBLE)"


def rnd_once(x: str, n: int) -> str:
    """Half away from zero on the shortest decimal text of a double."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def ladder(x: str, steps, last: str, op: str = "<") -> str:
    return "CASE " + " ".join(f"WHEN {x} {op} {b} THEN '{label}'" for b, label in steps) + f" ELSE '{last}' END"


SEGMENT = ladder("{x}", ((5, "VERY_HIGH"), (3, "HIGH"), (1.5, "MEDIUM")), "LOW", ">")
AGE = ladder("{x}", ((30, "Under 30"), (45, "30–44"), (60, "45–59")), "60+")
INCOME = ladder("{x}", ((90000, "1_Low (<90K)"), (180000, "2_Mid (90–180K)"), (360000, "3_High (180–360K)")), "4_VeryHigh (360K+)")
INCOME_REPORT = ladder("{x}", ((90000, "1_Low (<$90K)"), (180000, "2_Mid ($90–$180K)"), (360000, "3_High ($180–$360K)")),
                       "4_Very High ($360K+)")


def segment(x: str) -> str:
    return SEGMENT.replace("{x}", x)


def age(x: str) -> str:
    return AGE.replace("{x}", x)


def income(x: str, report: bool = False) -> str:
    return (INCOME_REPORT if report else INCOME).replace("{x}", x)


def pick(index: str, values) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def unit(factor: int, modulus: int) -> str:
    return f"CAST((k * {factor}) % {modulus} AS DOUBLE) / CAST({modulus} AS DOUBLE)"


_DAYS = "CAST(date_diff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) AS INTEGER)"
_RATE = "CAST(25 + (year(d) - 1995) * 60 + dayofyear(d) % 10 AS DOUBLE) / CAST(100 AS DOUBLE)"

TABLES: dict[str, str] = {}

TABLES["applicant_base"] = """
SELECT c_custkey AS id, c_custkey AS k, CAST(c_nationkey AS BIGINT) AS nat, c_acctbal AS bal, c_mktsegment AS seg, 0 AS ver FROM customer
UNION ALL SELECT -(s_suppkey + 1), s_suppkey, CAST(s_nationkey AS BIGINT), s_acctbal, 'SUPPLIER', 0 FROM supplier
UNION ALL SELECT c_custkey, c_custkey, CAST(c_nationkey AS BIGINT), c_acctbal, c_mktsegment, 1 FROM customer WHERE c_mktsegment = 'BUILDING'
"""
TABLES["applicant_credit"] = """
SELECT *, CASE WHEN k % 211 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(45000 + ((k * 7919) % 1000) * 600 + ver * 1000 AS DOUBLE) END AS credit,
  7000 + (k * 37) % 17000 AS age_days FROM applicant_base
"""
TABLES["application_train"] = f"""
SELECT id AS sk_id_curr,
  CASE WHEN k % 31 <> 30 THEN CASE WHEN (k * 6151 + nat * 31) % 100
    < 4 + CASE WHEN (k * 15485863) % 9973 < 2000 THEN 14 ELSE 0 END + CASE WHEN age_days < 10957 THEN 6 ELSE 0 END
      + CASE WHEN credit > 400000 THEN 5 ELSE 0 END THEN 1 ELSE 0 END END AS target,
  CASE WHEN nat % 8 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END AS name_contract_type,
  CASE WHEN k % 100 = 99 THEN 'XNA' WHEN k % 3 = 0 THEN 'M' ELSE 'F' END AS code_gender,
  CASE WHEN k % 3 = 1 THEN 'Y' ELSE 'N' END AS flag_own_car, CASE WHEN k % 2 = 1 THEN 'Y' ELSE 'N' END AS flag_own_realty,
  CAST(k % 4 AS INTEGER) AS cnt_children, bal * CAST(40 AS DOUBLE) AS amt_income_total, credit AS amt_credit,
  CASE WHEN k % 11 <> 0 THEN credit / CAST(24 AS DOUBLE) END AS amt_annuity,
  CASE WHEN k % 13 <> 0 THEN credit * CAST(0.9 AS DOUBLE) END AS amt_goods_price,
  CASE WHEN k % 2 <> 0 THEN {unit(104729, 10007)} END AS ext_source_1,
  CASE WHEN k % 50 <> 7 THEN {unit(15485863, 9973)} END AS ext_source_2,
  CASE WHEN k % 4 <> 1 THEN {unit(32452843, 9949)} END AS ext_source_3,
  CASE seg WHEN 'AUTOMOBILE' THEN 'Higher education' WHEN 'FURNITURE' THEN 'Incomplete higher' WHEN 'HOUSEHOLD' THEN 'Lower secondary'
    WHEN 'MACHINERY' THEN 'Academic degree' WHEN 'BUILDING' THEN 'Secondary / secondary special'
    WHEN 'SUPPLIER' THEN 'Secondary / secondary special' END AS name_education_type,
  {pick('k % 4', ('Married', 'Single / not married', 'Civil marriage', 'Widow'))} AS name_family_status,
  {pick('k % 3', ('House / apartment', 'Rented apartment', 'With parents'))} AS name_housing_type,
  {pick('nat % 4', ('Working', 'Commercial associate', 'Pensioner', 'State servant'))} AS name_income_type,
  CASE WHEN k % 5 <> 0 THEN {pick('nat % 12', ('Laborers', 'Sales staff', 'Core staff', 'Managers', 'Drivers', 'Accountants',
    'Medicine staff', 'Cleaning staff', 'Cooking staff', 'Security staff', 'IT staff', 'Secretaries'))} END AS occupation_type,
  CAST(k % 70 AS DOUBLE) / CAST(1000 AS DOUBLE) AS region_population_relative, CAST(1 + nat % 3 AS INTEGER) AS region_rating_client,
  CAST(k % 2 AS INTEGER) AS flag_work_phone, CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS flag_email,
  CASE WHEN k % 97 <> 0 THEN CAST(k % 4 + 2 AS DOUBLE) END AS cnt_fam_members,
  CAST(-age_days AS INTEGER) AS days_birth,
  CAST(CASE WHEN k % 9 = 0 THEN 365243 ELSE -((k * 53) % 9000) END AS INTEGER) AS days_employed,
  CAST(-((k * 11) % 12000) AS DOUBLE) AS days_registration, CAST(-((k * 17) % 6000) AS INTEGER) AS days_id_publish,
  CASE WHEN ver = 1 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-01-02 00:00:00' END AS loaded_at
FROM applicant_credit
"""
TABLES["bureau"] = f"""
SELECT CASE WHEN NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P') THEN o_custkey END AS sk_id_curr,
  o_orderkey AS sk_id_bureau,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END AS credit_active,
  CASE WHEN o_orderkey % 20 = 0 THEN 'currency 2' ELSE 'currency 1' END AS credit_currency,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Microloan' WHEN '2-HIGH' THEN 'Consumer credit' WHEN '3-MEDIUM' THEN 'Credit card'
    WHEN '4-NOT SPECIFIED' THEN 'Car loan' WHEN '5-LOW' THEN 'Mortgage' END AS credit_type,
  {_DAYS} AS days_credit,
  CASE WHEN o_orderkey % 10 <> 3 THEN CAST({_DAYS} + 365 * (1 + o_orderkey % 5) AS DOUBLE) END AS days_credit_enddate,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS amt_credit_sum,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN CAST(-500 AS DOUBLE)
    WHEN o_orderstatus = 'O' THEN o_totalprice * CAST(0.6 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS amt_credit_sum_debt,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN o_totalprice * CAST(0.01 AS DOUBLE)
    ELSE CAST(0 AS DOUBLE) END AS amt_credit_sum_overdue,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice * CAST(0.1 AS DOUBLE) END AS amt_credit_sum_limit
FROM orders
"""
TABLES["bureau_balance"] = """
SELECT l_orderkey AS sk_id_bureau, -l_linenumber AS months_balance,
  CASE WHEN l_returnflag = 'R' AND l_quantity <= 15 THEN CAST(1 + l_linenumber % 5 AS VARCHAR) WHEN l_returnflag <> 'A' THEN '0'
    WHEN l_linestatus = 'F' THEN 'C' ELSE 'X' END AS status
FROM lineitem
"""
TABLES["installments_payments"] = f"""
SELECT o_custkey AS sk_id_curr, l_orderkey AS sk_id_prev, CAST(1 AS DOUBLE) AS num_instalment_version,
  l_linenumber AS num_instalment_number, CAST({_DAYS} + 30 * l_linenumber AS DOUBLE) AS days_instalment,
  CASE WHEN l_partkey % 97 <> 0 THEN CAST({_DAYS} + 30 * l_linenumber + (l_partkey * 13 + l_suppkey) % 45 - 33 AS DOUBLE) END AS days_entry_payment,
  CASE WHEN l_partkey % 19 = 0 AND l_linenumber = 7 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS amt_instalment,
  CASE WHEN l_partkey % 89 <> 0 THEN l_extendedprice * (CAST(1 AS DOUBLE) - l_discount) END AS amt_payment
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
TABLES["credit_card_balance"] = """
SELECT event_id AS sk_id_prev, user_id AS sk_id_curr, CAST(-day(ts) AS INTEGER) AS months_balance, value * CAST(160 AS DOUBLE) AS amt_balance,
  CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE CAST(800 + (event_id % 10) * 800 AS DOUBLE) END AS amt_credit_limit_actual,
  CASE WHEN event_type <> 'view' THEN value END AS amt_drawings_current,
  CASE WHEN event_type <> 'click' THEN value * CAST(0.5 AS DOUBLE) END AS amt_payment_current,
  value * CAST(160 AS DOUBLE) AS amt_total_receivable, CAST(event_id % 5 AS INTEGER) AS cnt_drawings_current,
  CASE event_type WHEN 'signup' THEN 'Signed' WHEN 'purchase' THEN 'Completed' ELSE 'Active' END AS name_contract_status,
  CAST(CASE WHEN event_type = 'error' THEN event_id % 40 ELSE 0 END AS INTEGER) AS sk_dpd,
  CAST(CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN event_id % 20 ELSE 0 END AS INTEGER) AS sk_dpd_def
FROM events
"""
TABLES["previous_application"] = f"""
SELECT o_orderkey AS sk_id_prev, o_custkey AS sk_id_curr,
  CASE WHEN o_orderkey % 8 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END AS name_contract_type,
  CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice / CAST(12 AS DOUBLE) END AS amt_annuity, o_totalprice AS amt_application,
  CASE WHEN o_orderkey % 29 <> 0 THEN o_totalprice * CAST(0.95 AS DOUBLE) END AS amt_credit,
  CASE WHEN o_orderkey % 2 <> 0 THEN o_totalprice * CAST(0.05 AS DOUBLE) END AS amt_down_payment,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * CAST(0.9 AS DOUBLE) END AS amt_goods_price,
  CASE WHEN o_orderpriority = '3-MEDIUM' OR (o_orderpriority = '5-LOW' AND o_custkey % 4 = 0) THEN 'Refused'
    WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Approved' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Canceled'
    ELSE 'Unused offer' END AS name_contract_status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Cash through the bank' ELSE 'XNA' END AS name_payment_type,
  CASE WHEN o_orderpriority = '3-MEDIUM' OR (o_orderpriority = '5-LOW' AND o_custkey % 4 = 0) THEN 'HC' ELSE 'XAP' END AS code_reject_reason,
  CASE WHEN o_orderkey % 4 = 0 THEN 'New' ELSE 'Repeater' END AS name_client_type,
  CASE WHEN o_orderkey % 8 = 0 THEN 'Cards' ELSE 'Cash' END AS name_portfolio,
  CASE WHEN o_orderkey % 7 = 0 THEN 'walk-in' ELSE 'x-sell' END AS name_product_type,
  CASE WHEN o_orderkey % 9 = 0 THEN 'Stone' ELSE 'Country-wide' END AS channel_type,
  CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low_normal' END AS name_yield_group,
  {_DAYS} AS days_decision
FROM orders
"""
TABLES["pos_cash_balance"] = """
SELECT l_orderkey AS sk_id_prev, -(l_suppkey + 1) AS sk_id_curr, -l_linenumber AS months_balance, l_quantity AS cnt_instalment,
  CASE WHEN l_quantity >= l_linenumber THEN l_quantity - l_linenumber END AS cnt_instalment_future,
  CASE WHEN l_linestatus = 'F' THEN 'Completed' ELSE 'Active' END AS name_contract_status,
  CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS sk_dpd,
  CASE WHEN l_returnflag = 'R' AND l_quantity > 25 THEN l_linenumber ELSE 0 END AS sk_dpd_def
FROM lineitem
"""
TABLES["macro_day"] = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders"
TABLES["boc_macro"] = f"""
SELECT strftime(d, '%Y-%m-%d') AS date, CASE WHEN dayofyear(d) % 50 <> 0 THEN {_RATE} END AS overnight_rate,
  {_RATE} + CAST(0.5 AS DOUBLE) AS bond_2yr, CASE WHEN dayofyear(d) % 7 <> 0 THEN {_RATE} + CAST(1.25 AS DOUBLE) END AS bond_10yr,
  CAST(700 + dayofyear(d) AS DOUBLE) / CAST(1000 AS DOUBLE) AS cadusd,
  CASE WHEN day(d) = 1 THEN CAST(dayofyear(d) AS DOUBLE) / CAST(100 AS DOUBLE) END AS cpi_total,
  TIMESTAMP '2024-01-02 00:00:00' AS loaded_at
FROM macro_day
"""

# ---- staging ----
_YEARS = "CAST({x} AS DOUBLE) / CAST(-365.25 AS DOUBLE)"


def years(x: str) -> str:
    return _YEARS.replace("{x}", x)


def whole(x: str) -> str:
    return f"CAST(FLOOR(CAST(ABS({x}) AS DOUBLE) / CAST(365.25 AS DOUBLE)) AS BIGINT)"


TABLES["newest_application"] = """
SELECT * FROM application_train WHERE sk_id_curr IS NOT NULL AND amt_income_total > 0 AND amt_credit > 0
QUALIFY ROW_NUMBER() OVER (PARTITION BY sk_id_curr ORDER BY loaded_at DESC) = 1
"""
TABLES["stg_application_train"] = f"""
SELECT sk_id_curr AS applicant_id, target AS default_flag, name_contract_type AS loan_type, code_gender AS gender,
  flag_own_car AS owns_car, flag_own_realty AS owns_realty, cnt_children AS num_children, amt_income_total AS annual_income,
  amt_credit AS loan_amount, amt_annuity AS loan_annuity, amt_goods_price AS goods_price, ext_source_1, ext_source_2, ext_source_3,
  name_education_type AS education_level, name_family_status AS family_status, name_housing_type AS housing_type,
  name_income_type AS income_type, occupation_type AS occupation, region_population_relative AS region_pop_pct,
  region_rating_client AS region_rating, flag_work_phone AS has_work_phone, flag_email AS has_email, cnt_fam_members AS family_size,
  {whole('days_birth')} AS age_years,
  CASE WHEN days_employed <> 365243 THEN {whole('days_employed')} END AS years_employed,
  {rnd_once(div('amt_credit', 'amt_income_total'), 4)} AS credit_to_income_ratio,
  {rnd_once(div('amt_annuity', 'amt_income_total'), 4)} AS annuity_to_income_ratio,
  {years('days_registration')} AS years_since_registration, {years('days_id_publish')} AS years_since_id_publish
FROM newest_application
"""
TABLES["stg_bureau"] = f"""
SELECT sk_id_curr AS applicant_id, sk_id_bureau AS bureau_id, credit_active AS credit_status, credit_currency, credit_type,
  {years('days_credit')} AS years_since_credit_start, {years('days_credit_enddate')} AS years_to_credit_end,
  COALESCE(amt_credit_sum, 0) AS credit_sum, COALESCE(amt_credit_sum_debt, 0) AS credit_debt,
  COALESCE(amt_credit_sum_overdue, 0) AS credit_overdue, COALESCE(amt_credit_sum_limit, 0) AS credit_limit
FROM bureau WHERE sk_id_curr IS NOT NULL
"""
TABLES["stg_bureau_balance"] = "SELECT sk_id_bureau AS bureau_id, months_balance, status FROM bureau_balance"
TABLES["stg_installments_payments"] = f"""
SELECT sk_id_curr AS applicant_id, sk_id_prev AS prev_loan_id, num_instalment_version AS instalment_version,
  num_instalment_number AS instalment_number, days_instalment, days_entry_payment AS days_payment_made,
  amt_instalment AS amount_due, amt_payment AS amount_paid,
  CASE WHEN days_entry_payment > days_instalment THEN days_entry_payment - days_instalment
    WHEN days_entry_payment <= days_instalment THEN CAST(0 AS DOUBLE) END AS days_late,
  CASE WHEN days_entry_payment > days_instalment THEN TRUE ELSE FALSE END AS is_late,
  {rnd_once(div('amt_payment', 'amt_instalment'), 4)} AS payment_ratio
FROM installments_payments WHERE sk_id_curr IS NOT NULL
"""
TABLES["stg_credit_card_balance"] = """
SELECT sk_id_prev AS prev_loan_id, sk_id_curr AS applicant_id, months_balance, amt_balance AS balance,
  amt_credit_limit_actual AS credit_limit_actual, amt_drawings_current AS drawings_current, amt_payment_current AS payment_current,
  amt_total_receivable AS total_receivable, cnt_drawings_current AS count_drawings_current, name_contract_status AS contract_status,
  sk_dpd AS days_past_due, sk_dpd_def AS days_past_due_def
FROM credit_card_balance WHERE sk_id_curr IS NOT NULL
"""
TABLES["stg_previous_application"] = f"""
SELECT sk_id_prev AS prev_loan_id, sk_id_curr AS applicant_id, name_contract_type AS loan_type, amt_annuity AS annuity,
  amt_application AS amount_applied, amt_credit AS amount_credited, amt_down_payment AS down_payment, amt_goods_price AS goods_price,
  name_contract_status AS contract_status, name_payment_type AS payment_type, code_reject_reason AS reject_reason,
  name_client_type AS client_type, name_portfolio AS portfolio, name_product_type AS product_type, channel_type,
  name_yield_group AS yield_group, {years('days_decision')} AS years_since_decision
FROM previous_application WHERE sk_id_curr IS NOT NULL
"""
TABLES["stg_pos_cash_balance"] = """
SELECT sk_id_prev AS prev_loan_id, sk_id_curr AS applicant_id, months_balance, cnt_instalment AS count_instalment,
  cnt_instalment_future AS count_instalment_future, name_contract_status AS contract_status, sk_dpd AS days_past_due,
  sk_dpd_def AS days_past_due_def
FROM pos_cash_balance WHERE sk_id_curr IS NOT NULL
"""
TABLES["stg_boc_macro"] = """
SELECT CAST(date AS DATE) AS obs_date, overnight_rate, bond_2yr AS bond_yield_2yr, bond_10yr AS bond_yield_10yr,
  cadusd AS fx_cad_usd, cpi_total AS cpi_all FROM boc_macro
"""

# ---- features: the plain join-then-group statement of the roll-ups ----
TABLES["int_bureau_features"] = f"""
SELECT applicant_id, COUNT(DISTINCT c.bureau_id) AS bureau_num_records,
  COUNT(*) FILTER (WHERE credit_status = 'Active') AS bureau_active_credits,
  COUNT(*) FILTER (WHERE credit_status = 'Closed') AS bureau_closed_credits,
  SUM(credit_sum) AS bureau_total_credit, SUM(credit_debt) AS bureau_total_debt, SUM(credit_overdue) AS bureau_total_overdue,
  COALESCE(AVG(years_since_credit_start), 0) AS bureau_avg_credit_age_yrs,
  COALESCE(MAX(CASE WHEN m.status BETWEEN '1' AND '5' THEN CAST(m.status AS INTEGER) ELSE 0 END), 0) AS bureau_worst_delinquency,
  {rnd(div("COUNT(*) FILTER (WHERE m.status NOT IN ('0', 'X', 'C'))", 'COUNT(*)'), 4)} AS bureau_delinquency_rate
FROM stg_bureau c LEFT JOIN stg_bureau_balance m ON c.bureau_id = m.bureau_id GROUP BY applicant_id
"""
TABLES["int_installment_features"] = f"""
SELECT applicant_id, COUNT(*) AS inst_num_payments, COUNT(*) FILTER (WHERE is_late) AS inst_late_count,
  {rnd(div('COUNT(*) FILTER (WHERE is_late)', 'COUNT(*)'), 4)} AS inst_late_rate,
  COALESCE(MAX(days_late), 0) AS inst_max_days_late, COALESCE(AVG(days_late), 0) AS inst_avg_days_late,
  COALESCE(AVG(payment_ratio), 1) AS inst_avg_payment_ratio,
  COALESCE(SUM(amount_due - amount_paid) FILTER (WHERE amount_paid < amount_due), 0) AS inst_total_underpaid
FROM stg_installments_payments GROUP BY applicant_id
"""
TABLES["int_credit_card_features"] = f"""
SELECT applicant_id, COUNT(*) AS cc_num_months,
  COALESCE({rnd('AVG(balance / NULLIF(credit_limit_actual, 0))', 4)}, 0) AS cc_avg_utilization,
  COALESCE(MAX(balance / NULLIF(credit_limit_actual, 0)), 0) AS cc_max_utilization,
  COALESCE(AVG(drawings_current), 0) AS cc_avg_monthly_drawings, COUNT(*) FILTER (WHERE days_past_due_def > 0) AS cc_months_overdue
FROM stg_credit_card_balance GROUP BY applicant_id
"""
TABLES["int_previous_application_features"] = f"""
SELECT applicant_id, COUNT(*) AS prev_num_applications, COUNT(*) FILTER (WHERE contract_status = 'Approved') AS prev_approved,
  COUNT(*) FILTER (WHERE contract_status = 'Refused') AS prev_refused,
  {rnd(div("COUNT(*) FILTER (WHERE contract_status = 'Refused')", 'COUNT(*)'), 4)} AS prev_refusal_rate,
  COALESCE(AVG(amount_credited), 0) AS prev_avg_credit, COALESCE(AVG(annuity), 0) AS prev_avg_annuity,
  COALESCE(AVG(years_since_decision), 0) AS prev_avg_decision_age_yrs
FROM stg_previous_application GROUP BY applicant_id
"""

# ---- marts ----
SCORE_TERMS = {
    "delinquency": "CAST(0.30 AS DOUBLE) * COALESCE(bureau_delinquency_rate, 0)",
    "late": "CAST(0.25 AS DOUBLE) * COALESCE(inst_late_rate, 0)",
    "ratio": "CAST(0.20 AS DOUBLE) * CASE WHEN credit_to_income_ratio / CAST(10 AS DOUBLE) > 1 THEN CAST(1 AS DOUBLE) "
             "ELSE credit_to_income_ratio / CAST(10 AS DOUBLE) END",
    "utilization": "CAST(0.15 AS DOUBLE) * COALESCE(cc_avg_utilization / CAST(3 AS DOUBLE), 0)",
    "refusal": "CAST(0.10 AS DOUBLE) * COALESCE(prev_refusal_rate, 0)",
}
TABLES["mart_credit_application_fact"] = f"""
SELECT applicant_id, default_flag, loan_type, gender, age_years, years_employed, loan_amount, annual_income, credit_to_income_ratio,
  annuity_to_income_ratio, education_level, family_status, housing_type, income_type, num_children, region_rating,
  ext_source_1, ext_source_2, ext_source_3,
  COALESCE(bureau_active_credits, 0) AS bureau_active_credits, COALESCE(bureau_total_debt, 0) AS bureau_total_debt,
  COALESCE(bureau_total_overdue, 0) AS bureau_total_overdue, COALESCE(bureau_delinquency_rate, 0) AS bureau_delinquency_rate,
  COALESCE(bureau_worst_delinquency, 0) AS bureau_worst_delinquency, COALESCE(bureau_num_records, 0) AS bureau_num_records,
  COALESCE(inst_late_rate, 0) AS inst_late_rate, COALESCE(inst_max_days_late, 0) AS inst_max_days_late,
  COALESCE(inst_avg_payment_ratio, 1) AS inst_avg_payment_ratio, COALESCE(inst_total_underpaid, 0) AS inst_total_underpaid,
  COALESCE(cc_avg_utilization, 0) AS cc_avg_utilization, COALESCE(cc_max_utilization, 0) AS cc_max_utilization,
  COALESCE(cc_months_overdue, 0) AS cc_months_overdue, COALESCE(prev_num_applications, 0) AS prev_num_applications,
  COALESCE(prev_refusal_rate, 0) AS prev_refusal_rate, COALESCE(prev_approved, 0) AS prev_approved,
  {segment('credit_to_income_ratio')} AS credit_risk_segment,
  {rnd(' + '.join(SCORE_TERMS.values()), 4)} AS composite_risk_score,
  TIMESTAMP '2024-01-02 00:00:00' AS dbt_updated_at
FROM stg_application_train
LEFT JOIN int_bureau_features USING (applicant_id) LEFT JOIN int_installment_features USING (applicant_id)
LEFT JOIN int_credit_card_features USING (applicant_id) LEFT JOIN int_previous_application_features USING (applicant_id)
"""
TABLES["mart_portfolio_summary"] = f"""
SELECT loan_type, education_level, credit_risk_segment, gender, income_type, COUNT(*) AS total_applications,
  CAST(SUM(default_flag) AS BIGINT) AS total_defaults, {rnd('AVG(default_flag) * 100', 2)} AS default_rate_pct,
  {rnd('AVG(loan_amount)', 0)} AS avg_loan_amount, {rnd('AVG(annual_income)', 0)} AS avg_annual_income,
  {rnd('AVG(credit_to_income_ratio)', 3)} AS avg_dti, {rnd('AVG(composite_risk_score)', 4)} AS avg_risk_score
FROM mart_credit_application_fact GROUP BY loan_type, education_level, credit_risk_segment, gender, income_type
"""
TABLES["ml_features_training"] = """
SELECT applicant_id, default_flag AS label, credit_to_income_ratio, annuity_to_income_ratio, bureau_delinquency_rate,
  bureau_worst_delinquency, bureau_total_overdue, inst_late_rate, inst_max_days_late, inst_avg_payment_ratio, cc_avg_utilization,
  cc_months_overdue, prev_refusal_rate, prev_num_applications, age_years, composite_risk_score,
  COALESCE(ext_source_1, 0.5) AS ext_source_1, COALESCE(ext_source_2, 0.5) AS ext_source_2, COALESCE(ext_source_3, 0.5) AS ext_source_3,
  COALESCE(years_employed, 0) AS years_employed
FROM mart_credit_application_fact WHERE default_flag IS NOT NULL
"""


def _mentioned(text: str) -> set[str]:
    return {n for n in TABLES if re.search(rf"\b{n}\b", text)}


def compose(body: str, given: dict[str, str] | None = None) -> str:
    """The query with the WITH blocks it needs, in the order they are defined; ``given`` tables stand in for the usual ones."""
    tables = {**TABLES, **(given or {})}
    needed, todo = set(), _mentioned(body)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= _mentioned(tables[name]) - needed
    blocks = [f"{n} AS ({tables[n].strip()})" for n in tables if n in needed]
    return (f"WITH {', '.join(blocks)} " if blocks else "") + body.strip()
