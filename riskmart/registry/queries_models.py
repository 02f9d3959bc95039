"""Staging, features, joins, marts and analytical reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.constants import FEATURES, UNEMPLOYED_DAYS
from riskmart.functions import bands, scalars
from riskmart.functions.scalars import round_half_up
from riskmart.operators import analytics as an
from riskmart.operators import features as feat
from riskmart.operators import staging as st
from riskmart.operators.quantiles import column_quantiles
from riskmart.operators.ranking import with_ntile
from riskmart.plans.marts import labelled_rows, portfolio_summary
from riskmart.registry.bound import Bound, cast_long, rounded
from riskmart.registry.catalog import add
from riskmart.registry.sql import age, div, income, ladder, rnd
from riskmart.sources.credit_binding import AS_OF

# ---- staging --------------------------------------------------------------------------------------

for _name in ("stg_application_train", "stg_bureau", "stg_bureau_balance", "stg_installments_payments",
              "stg_credit_card_balance", "stg_previous_application", "stg_pos_cash_balance"):
    add(_name, lambda b, n=_name: b.staged[n].drop(st.LOADED), f"SELECT * FROM {_name}")
add("stg_boc_macro",
    lambda b: b.staged["stg_boc_macro"].drop(st.LOADED).withColumn("obs_date", F.col("obs_date").cast("string")),
    "SELECT * REPLACE (CAST(obs_date AS VARCHAR) AS obs_date) FROM stg_boc_macro")

add("not_null_key_filter",
    lambda b: st.not_null_key(b.raw["bureau"], "sk_id_curr").select("sk_id_curr", "sk_id_bureau"),
    "SELECT sk_id_curr, sk_id_bureau FROM bureau WHERE sk_id_curr IS NOT NULL")
add("positive_amount_filter",
    lambda b: st.positive_amounts(b.raw["application_train"], "amt_income_total", "amt_credit").select(
        "sk_id_curr", "amt_income_total", "amt_credit"),
    "SELECT sk_id_curr, amt_income_total, amt_credit FROM application_train WHERE amt_income_total > 0 AND amt_credit > 0")
add("labelled_rows", lambda b: labelled_rows(b.fact).select("applicant_id", cast("default_flag")),
    "SELECT applicant_id, CAST(default_flag AS BIGINT) AS default_flag FROM mart_credit_application_fact WHERE default_flag IS NOT NULL")


def cast(name: str, kind: str = "long"):
    return F.col(name).cast(kind).alias(name)


add("risk_segments", lambda b: b.staged["stg_application_train"].select(
    "applicant_id", "credit_to_income_ratio", bands.risk_segment("credit_to_income_ratio").alias("credit_risk_segment")),
    "SELECT applicant_id, credit_to_income_ratio, " + ladder("credit_to_income_ratio", (
        ("5", "VERY_HIGH"), ("3", "HIGH"), ("1.5", "MEDIUM")), "LOW", ">") + " AS credit_risk_segment FROM stg_application_train")
add("composite_scores", lambda b: b.fact.select("applicant_id", "composite_risk_score"),
    "SELECT applicant_id, composite_risk_score FROM mart_credit_application_fact")
add("income_brackets", lambda b: b.raw["application_train"].select(
    "sk_id_curr", "amt_income_total", bands.income_bracket("amt_income_total").alias("income_bracket")),
    f"SELECT sk_id_curr, amt_income_total, {income('amt_income_total')} AS income_bracket FROM application_train")
add("age_bands", lambda b: b.staged["stg_application_train"].select(
    "applicant_id", "age_years", bands.age_band("age_years").alias("age_band")),
    f"SELECT applicant_id, age_years, {age('age_years')} AS age_band FROM stg_application_train")
add("rate_eras", lambda b: b.raw["boc_macro"].select(
    "date", "overnight_rate", bands.rate_era("overnight_rate").alias("era")),
    "SELECT date, overnight_rate, " + ladder("overnight_rate", ((1, "Low Rate Era"), (3, "Rising Rate Era")), "High Rate Era")
    + " AS era FROM boc_macro")

# ---- features -------------------------------------------------------------------------------------

_BUREAU_SUMS = ("bureau_total_credit", "bureau_total_debt", "bureau_total_overdue")


def _bureau(b: Bound, **options) -> DataFrame:
    out = feat.bureau_features(b.staged["stg_bureau"], b.staged["stg_bureau_balance"], **options)
    return cast_long(rounded(rounded(out, 2, *_BUREAU_SUMS), 6, "bureau_avg_credit_age_yrs"), "bureau_worst_delinquency")


def _replace(table: str, digits: dict[str, int], longs: tuple[str, ...] = (), exclude: str = "") -> str:
    parts = [f"{rnd(c, n)} AS {c}" for c, n in digits.items()] + [f"CAST({c} AS BIGINT) AS {c}" for c in longs]
    return f"SELECT * {exclude} REPLACE ({', '.join(parts)}) FROM {table}"


add("bureau_features", _bureau, _replace(
    "int_bureau_features", {**{c: 2 for c in _BUREAU_SUMS}, "bureau_avg_credit_age_yrs": 6}, ("bureau_worst_delinquency",)))
add("bureau_features_fanout_safe", lambda b: _bureau(b, fanout_safe=True), f"""
SELECT applicant_id, COUNT(DISTINCT bureau_id) AS bureau_num_records, COUNT(*) FILTER (WHERE credit_status = 'Active') AS bureau_active_credits,
  COUNT(*) FILTER (WHERE credit_status = 'Closed') AS bureau_closed_credits, {rnd('SUM(credit_sum)', 2)} AS bureau_total_credit,
  {rnd('SUM(credit_debt)', 2)} AS bureau_total_debt, {rnd('SUM(credit_overdue)', 2)} AS bureau_total_overdue,
  {rnd('AVG(years_since_credit_start)', 6)} AS bureau_avg_credit_age_yrs, CAST(MAX(COALESCE(worst, 0)) AS BIGINT) AS bureau_worst_delinquency,
  {rnd(div('SUM(COALESCE(bad, 0))', 'SUM(COALESCE(months, 1))'), 4)} AS bureau_delinquency_rate
FROM stg_bureau LEFT JOIN (SELECT bureau_id, COUNT(*) AS months, COUNT(*) FILTER (WHERE status BETWEEN '1' AND '5') AS bad,
  MAX(CASE WHEN status BETWEEN '1' AND '5' THEN CAST(status AS INTEGER) ELSE 0 END) AS worst FROM stg_bureau_balance GROUP BY bureau_id) m
USING (bureau_id) GROUP BY applicant_id""")
add("installment_features", lambda b: rounded(rounded(
    b.ints["int_installment_features"], 6, "inst_avg_days_late", "inst_avg_payment_ratio"), 2, "inst_total_underpaid"),
    _replace("int_installment_features", {"inst_avg_days_late": 6, "inst_avg_payment_ratio": 6, "inst_total_underpaid": 2}))
add("credit_card_features", lambda b: rounded(rounded(
    b.ints["int_credit_card_features"], 6, "cc_max_utilization"), 4, "cc_avg_monthly_drawings"),
    _replace("int_credit_card_features", {"cc_max_utilization": 6, "cc_avg_monthly_drawings": 4}))
add("previous_application_features", lambda b: rounded(rounded(
    b.ints["int_previous_application_features"], 2, "prev_avg_credit", "prev_avg_annuity"), 6, "prev_avg_decision_age_yrs"),
    _replace("int_previous_application_features", {"prev_avg_credit": 2, "prev_avg_annuity": 2, "prev_avg_decision_age_yrs": 6}))
add("conditional_counts", lambda b: b.raw["previous_application"].groupBy("sk_id_curr").agg(
    scalars.count_where(F.col("name_contract_status") == "Approved").alias("approved"),
    scalars.count_where(F.col("name_contract_status") == "Refused").alias("refused")),
    """SELECT sk_id_curr, CAST(SUM(CASE WHEN name_contract_status = 'Approved' THEN 1 ELSE 0 END) AS BIGINT) AS approved,
    CAST(SUM(CASE WHEN name_contract_status = 'Refused' THEN 1 ELSE 0 END) AS BIGINT) AS refused FROM previous_application GROUP BY sk_id_curr""")


def _distinct_credits(b: Bound) -> DataFrame:
    months = b.raw["bureau_balance"].groupBy("sk_id_bureau").agg(F.count(F.lit(1)).alias("_months"))
    return b.raw["bureau"].select("sk_id_bureau", "sk_id_curr").join(months, "sk_id_bureau").groupBy("sk_id_curr").agg(
        F.count_distinct(F.bitwise_not("sk_id_bureau")).alias("credits"), F.sum("_months").alias("months"))


add("distinct_credits", _distinct_credits, """SELECT sk_id_curr, COUNT(DISTINCT sk_id_bureau) AS credits, COUNT(*) AS months
    FROM bureau_balance JOIN bureau USING (sk_id_bureau) GROUP BY sk_id_curr""")

# ---- joins and marts ------------------------------------------------------------------------------

_FACT_MONEY = ("bureau_total_debt", "bureau_total_overdue", "inst_total_underpaid")
_FACT_LONG = ("default_flag", "num_children", "region_rating", "bureau_worst_delinquency")


def _fact_output(df: DataFrame) -> DataFrame:
    out = rounded(rounded(df.drop("dbt_updated_at"), 2, *_FACT_MONEY), 6, "inst_avg_payment_ratio", "cc_max_utilization")
    return cast_long(out, *_FACT_LONG)


_FACT_SQL = _replace("mart_credit_application_fact", {**{c: 2 for c in _FACT_MONEY}, "inst_avg_payment_ratio": 6, "cc_max_utilization": 6},
                     _FACT_LONG, "EXCLUDE (dbt_updated_at)")
add("credit_fact", lambda b: _fact_output(b.fact_plan()), _FACT_SQL)
add("portfolio_summary", lambda b: portfolio_summary(b.fact_plan()), "SELECT * FROM mart_portfolio_summary")
add("ml_features_training", lambda b: cast_long(rounded(rounded(b.training, 2, "bureau_total_overdue"), 6, "inst_avg_payment_ratio"),
                                                "label", "bureau_worst_delinquency"),
    _replace("ml_features_training", {"bureau_total_overdue": 2, "inst_avg_payment_ratio": 6}, ("label", "bureau_worst_delinquency")))
add("credit_balance_left_join", lambda b: feat.with_balance_months(
    b.staged["stg_bureau"].select("applicant_id", "bureau_id", "credit_status"),
    b.staged["stg_bureau_balance"].select("bureau_id", cast("months_balance"), "status")),
    """SELECT bureau_id, applicant_id, credit_status, CAST(months_balance AS BIGINT) AS months_balance, status
    FROM stg_bureau LEFT JOIN stg_bureau_balance USING (bureau_id)""")
add("application_debt_join", lambda b: an.bureau_dti(b.raw["application_train"], b.raw["bureau"]).select(
    "sk_id_curr", cast("target"), round_half_up("total_bureau_debt", 2).alias("total_bureau_debt"),
    round_half_up("total_overdue", 2).alias("total_overdue"), "bureau_dti"),
    f"""SELECT sk_id_curr, CAST(target AS BIGINT) AS target, {rnd('debt', 2)} AS total_bureau_debt, {rnd('overdue', 2)} AS total_overdue,
    {rnd(div('debt', 'amt_income_total'), 4)} AS bureau_dti FROM application_train JOIN (
      SELECT sk_id_curr, COALESCE(SUM(amt_credit_sum_debt), 0) AS debt, COALESCE(SUM(amt_credit_sum_overdue), 0) AS overdue
      FROM bureau GROUP BY sk_id_curr) USING (sk_id_curr)""")
for _child, _key in (("bureau", "stg_bureau"), ("installment", "stg_installments_payments"), ("previous_application", "stg_previous_application"),
                     ("bureau_features", "int_bureau_features"), ("installment_features", "int_installment_features"),
                     ("previous_features", "int_previous_application_features")):
    add(f"orphan_{_child}_rows", lambda b, k=_key: an.orphan_counts(
        b.staged[k] if k in b.staged else b.ints[k], "applicant_id", b.staged["stg_application_train"], "applicant_id"),
        f"""SELECT applicant_id, COUNT(*) AS rows FROM {_key} WHERE applicant_id IS NOT NULL
        AND applicant_id NOT IN (SELECT applicant_id FROM stg_application_train) GROUP BY applicant_id""")
add("surrogate_income_type", lambda b: an.surrogate_dimension(b.fact, "income_type", "income_type_key"),
    """SELECT income_type, ROW_NUMBER() OVER (ORDER BY income_type) AS income_type_key
    FROM (SELECT DISTINCT income_type FROM mart_credit_application_fact WHERE income_type IS NOT NULL)""")
add("distinct_education", lambda b: b.fact.select("education_level").distinct(),
    "SELECT DISTINCT education_level FROM mart_credit_application_fact")

# ---- analytical reports ---------------------------------------------------------------------------

add("default_rate_by_segment", lambda b: an.default_rate_by_segment(b.raw["application_train"]), f"""
SELECT {income('amt_income_total')} AS income_bracket,
  {age("FLOOR(ABS(days_birth) / CAST(365.25 AS DOUBLE))")} AS age_band, name_contract_type, COUNT(*) AS total_applications,
  CAST(SUM(target) AS BIGINT) AS total_defaults, {rnd('AVG(target) * 100', 2)} AS default_rate_pct, {rnd('AVG(amt_credit)', 0)} AS avg_loan_amount,
  {rnd('AVG(' + rnd(div('amt_credit', 'amt_income_total'), 2) + ')', 3)} AS avg_dti_ratio
FROM application_train WHERE amt_income_total > 0 GROUP BY ALL ORDER BY default_rate_pct DESC""")
add("bureau_debt_by_applicant", lambda b: rounded(an.bureau_debt_by_applicant(b.raw["bureau"]), 2, "total_bureau_debt", "total_overdue",
                                                  "max_active_debt"), f"""
SELECT sk_id_curr, COUNT(*) AS num_bureau_records, COUNT(*) FILTER (WHERE credit_active = 'Active') AS active_credits,
  {rnd('COALESCE(SUM(amt_credit_sum_debt), 0)', 2)} AS total_bureau_debt, {rnd('COALESCE(SUM(amt_credit_sum_overdue), 0)', 2)} AS total_overdue,
  {rnd("MAX(CASE WHEN credit_active = 'Active' THEN amt_credit_sum_debt ELSE 0 END)", 2)} AS max_active_debt
FROM bureau GROUP BY sk_id_curr""")

_DTI = f"""SELECT sk_id_curr, loaded_at, target, debt, overdue,
    NTILE(10) OVER (ORDER BY {rnd(div('debt', 'amt_income_total'), 6)} NULLS LAST, sk_id_curr, loaded_at) AS tile
  FROM application_train JOIN (SELECT sk_id_curr, COALESCE(SUM(amt_credit_sum_debt), 0) AS debt,
    COALESCE(SUM(amt_credit_sum_overdue), 0) AS overdue FROM bureau GROUP BY sk_id_curr) USING (sk_id_curr)"""
add("risk_by_dti_decile", lambda b: cast_long(an.risk_by_dti_decile(b.raw["application_train"], b.raw["bureau"]), "dti_decile"), f"""
SELECT CAST(tile AS BIGINT) AS dti_decile, COUNT(*) AS applicants, {rnd('AVG(target) * 100', 2)} AS default_rate_pct,
  {rnd('AVG(debt)', 0)} AS avg_bureau_debt, {rnd('AVG(overdue)', 2)} AS avg_overdue_amt FROM ({_DTI}) GROUP BY tile ORDER BY tile""")


def _dti_deciles(b: Bound) -> DataFrame:
    keyed = an.bureau_dti(b.raw["application_train"], b.raw["bureau"]).select(
        "sk_id_curr", "loaded_at", round_half_up("_load", 6).alias("_rank_key"))
    return with_ntile(keyed, 10, [F.col("_rank_key").asc_nulls_last(), F.col("sk_id_curr").asc(), F.col("loaded_at").asc()],
                      name="tile").select("sk_id_curr", F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded"), cast("tile"))


add("bureau_dti_deciles", _dti_deciles,
    f"SELECT sk_id_curr, strftime(loaded_at, '%Y-%m-%d') AS loaded, CAST(tile AS BIGINT) AS tile FROM ({_DTI})")
add("payment_behaviour", lambda b: cast_long(an.payment_behaviour(b.raw["application_train"], b.raw["installments_payments"]), "target"), f"""
SELECT CAST(target AS BIGINT) AS target, {rnd('AVG(late / CAST(n AS DOUBLE)) * 100', 2)} AS avg_late_pmt_rate_pct,
  {rnd('AVG(worst)', 1)} AS avg_worst_days_late, {rnd('AVG(coverage)', 4)} AS avg_payment_coverage, COUNT(*) AS applicant_count
FROM application_train JOIN (SELECT sk_id_curr, COUNT(*) AS n, COUNT(*) FILTER (WHERE days_entry_payment > days_instalment) AS late,
    MAX(CASE WHEN days_entry_payment - days_instalment > 0 THEN days_entry_payment - days_instalment
      WHEN days_entry_payment IS NOT NULL THEN 0 END) AS worst, {rnd('AVG(amt_payment / NULLIF(amt_instalment, 0))', 4)} AS coverage
  FROM installments_payments GROUP BY sk_id_curr) USING (sk_id_curr) GROUP BY target""")


def _macro_by_year(b: Bound) -> DataFrame:
    labels = b.staged["stg_application_train"].select(F.col("applicant_id").alias("sk_id_curr"), F.col("default_flag").alias("target"))
    dated = b.raw["previous_application"].select("sk_id_curr", "days_decision").join(labels, "sk_id_curr")
    return cast_long(rounded(an.macro_by_year(dated, b.raw["boc_macro"], AS_OF), 6, "avg_overnight_rate"), "application_year")


add("macro_by_year", _macro_by_year, f"""
SELECT CAST(yr AS BIGINT) AS application_year, avg_overnight_rate, applications, default_rate_pct,
  {ladder('avg_overnight_rate', ((1, 'Low Rate Era'), (3, 'Rising Rate Era')), 'High Rate Era')} AS rate_environment
FROM (SELECT year(DATE '{AS_OF}' + days_decision) AS yr, COUNT(*) AS applications, {rnd('AVG(default_flag) * 100', 2)} AS default_rate_pct
  FROM previous_application JOIN stg_application_train ON sk_id_curr = applicant_id GROUP BY 1)
LEFT JOIN (SELECT year(TRY_CAST(date AS DATE)) AS yr, {rnd('AVG(overnight_rate)', 6)} AS avg_overnight_rate FROM boc_macro GROUP BY 1)
USING (yr) ORDER BY yr""")

_EXT = """SELECT *, NTILE(5) OVER (ORDER BY ext_source_2, sk_id_curr, loaded_at) AS tile FROM application_train WHERE ext_source_2 IS NOT NULL"""
add("external_score_by_education", lambda b: cast_long(an.external_score_by_education(b.raw["application_train"]), "ext2_quintile"), f"""
SELECT name_education_type, CAST(tile AS BIGINT) AS ext2_quintile, COUNT(*) AS applicants, {rnd('AVG(target) * 100', 2)} AS default_rate_pct,
  {rnd('AVG(ext_source_2)', 4)} AS avg_ext_score_2 FROM ({_EXT}) GROUP BY name_education_type, tile""")
add("external_score_pivot", lambda b: an.external_score_pivot(b.raw["application_train"]), "SELECT name_education_type, " + ", ".join(
    f"{rnd(f'AVG(target) FILTER (WHERE tile = {i}) * 100', 2)} AS q{i}_default_rate_pct" for i in range(1, 6))
    + f" FROM ({_EXT}) GROUP BY name_education_type")
add("external_score_quintiles", lambda b: with_ntile(
    b.raw["application_train"].filter("ext_source_2 IS NOT NULL").select("sk_id_curr", "loaded_at", "ext_source_2"), 5,
    [F.col("ext_source_2").asc(), F.col("sk_id_curr").asc(), F.col("loaded_at").asc()]).select(
    "sk_id_curr", F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded"), cast("tile")),
    f"SELECT sk_id_curr, strftime(loaded_at, '%Y-%m-%d') AS loaded, CAST(tile AS BIGINT) AS tile FROM ({_EXT})")

_PROFILED = ("amt_income_total", "ext_source_1", "ext_source_2", "ext_source_3", "occupation_type")
add("null_profile", lambda b: an.null_profile(b.raw["application_train"], _PROFILED), " UNION ALL ".join(
    f"SELECT '{c.upper()}' AS col, COUNT(*) - COUNT({c}) AS nulls, {rnd(div(f'(COUNT(*) - COUNT({c}))', 'COUNT(*)') + ' * 100', 1)} AS null_pct "
    f"FROM application_train" for c in _PROFILED))


def _quantile_wide(df: DataFrame, probs) -> DataFrame:
    return df.groupBy("feature").agg(*[
        round_half_up(F.max(F.when(F.col("prob") == p, F.col("value"))), 6).alias(f"p{round(p * 100):02d}") for p in probs])


_PROBS = (0.01, 0.25, 0.5, 0.9, 0.99)
_QUANTILED = ("composite_risk_score", "loan_amount", "annual_income", "ext_source_2", "credit_to_income_ratio")
add("fact_quantiles", lambda b: _quantile_wide(column_quantiles(b.fact, _QUANTILED, _PROBS), _PROBS), " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + ", ".join(f"{rnd(f'quantile_cont({c}, {p})', 6)} AS p{round(p * 100):02d}" for p in _PROBS)
    + " FROM mart_credit_application_fact" for c in _QUANTILED))
add("label_correlations", lambda b: an.label_correlations(b.training, FEATURES), " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {rnd(f'corr(CAST({c} AS DOUBLE), CAST(label AS DOUBLE))', 6)} AS correlation FROM ml_features_training" for c in FEATURES))
add("class_balance", lambda b: cast_long(an.class_balance(b.training), "label"), f"""
SELECT CAST(label AS BIGINT) AS label, COUNT(*) AS rows, {rnd(div('COUNT(*)', '(SELECT COUNT(*) FROM ml_features_training)'), 6)} AS share,
  {rnd(div('(SELECT COUNT(*) FROM ml_features_training WHERE label = 0)', '(SELECT COUNT(*) FROM ml_features_training WHERE label = 1)'), 6)} AS neg_pos_ratio
FROM ml_features_training GROUP BY label""")

_HISTOGRAM = ("ext_source_2", "bureau_delinquency_rate", "inst_late_rate", "credit_to_income_ratio", "inst_max_days_late", "cc_avg_utilization")
add("clipped_histogram", lambda b: cast_long(an.clipped_histogram(b.training, _HISTOGRAM), "label", "bin"), " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(label AS BIGINT) AS label, bin, COUNT(*) AS rows, outside AS rows_outside FROM (
      SELECT label, CAST(LEAST(COALESCE(FLOOR((v - lo) / NULLIF((hi - lo) / CAST(20 AS DOUBLE), 0)), 0), 19) AS BIGINT) AS bin, inside,
        COUNT(*) FILTER (WHERE NOT inside) OVER (PARTITION BY label) AS outside
      FROM (SELECT label, v, lo, hi, v BETWEEN lo AND hi AS inside FROM (SELECT label, CAST({c} AS DOUBLE) AS v FROM ml_features_training WHERE {c} IS NOT NULL)
        JOIN (SELECT label, quantile_cont(CAST({c} AS DOUBLE), 0.01) AS lo, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS hi
          FROM ml_features_training GROUP BY label) USING (label)))
    WHERE inside GROUP BY ALL""" for c in _HISTOGRAM))

# ---- windows --------------------------------------------------------------------------------------

add("latest_application", lambda b: st.dedupe_latest(b.raw["application_train"], ["sk_id_curr"], [F.col("loaded_at").desc()]).select(
    "sk_id_curr", "amt_credit", F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded")),
    """SELECT sk_id_curr, amt_credit, strftime(loaded_at, '%Y-%m-%d') AS loaded FROM application_train
    QUALIFY ROW_NUMBER() OVER (PARTITION BY sk_id_curr ORDER BY loaded_at DESC) = 1""")

_SEG_TILE = """SELECT *, NTILE(10) OVER (PARTITION BY credit_risk_segment ORDER BY credit_to_income_ratio DESC NULLS FIRST, applicant_id) AS tile
  FROM mart_credit_application_fact"""
_SEG_COLS = ["applicant_id", "credit_risk_segment", "default_flag", "credit_to_income_ratio", "bureau_delinquency_rate", "inst_max_days_late",
             "inst_late_rate"]
add("segment_dti_deciles", lambda b: with_ntile(
    b.fact.select("applicant_id", "credit_risk_segment", "credit_to_income_ratio"), 10,
    [F.col("credit_to_income_ratio").desc_nulls_first(), F.col("applicant_id").asc()], ["credit_risk_segment"], "dti_risk_decile").select(
    "applicant_id", "credit_risk_segment", cast("dti_risk_decile")),
    f"SELECT applicant_id, credit_risk_segment, CAST(tile AS BIGINT) AS dti_risk_decile FROM ({_SEG_TILE})")
add("segment_enriched", lambda b: an.segment_enriched(b.fact.select(*_SEG_COLS)).select(
    "applicant_id", "credit_risk_segment", cast("dti_risk_decile"), round_half_up("avg_segment_delinquency", 6).alias("avg_segment_delinquency"),
    "max_segment_days_late", round_half_up("late_payment_rate_by_default", 6).alias("late_payment_rate_by_default")),
    f"""SELECT applicant_id, credit_risk_segment, CAST(tile AS BIGINT) AS dti_risk_decile,
    {rnd('AVG(bureau_delinquency_rate) OVER (PARTITION BY credit_risk_segment, tile)', 6)} AS avg_segment_delinquency,
    MAX(inst_max_days_late) OVER (PARTITION BY credit_risk_segment, tile) AS max_segment_days_late,
    {rnd('AVG(inst_late_rate) OVER (PARTITION BY default_flag)', 6)} AS late_payment_rate_by_default FROM ({_SEG_TILE})""")
add("late_rate_by_label", lambda b: cast_long(rounded(b.fact.groupBy("default_flag").agg(
    F.avg("inst_late_rate").alias("late_payment_rate_by_default")), 6, "late_payment_rate_by_default"), "default_flag"),
    f"""SELECT CAST(default_flag AS BIGINT) AS default_flag, {rnd('AVG(inst_late_rate)', 6)} AS late_payment_rate_by_default
    FROM mart_credit_application_fact GROUP BY default_flag""")
add("rate_by_score_decile", lambda b: cast_long(an.rate_by_score_decile(b.fact), "score_decile"), f"""
SELECT CAST(tile AS BIGINT) AS score_decile, COUNT(*) AS applicants, {rnd('AVG(default_flag) * 100', 2)} AS default_rate_pct,
  MIN(composite_risk_score) AS min_score, MAX(composite_risk_score) AS max_score
FROM (SELECT *, NTILE(10) OVER (ORDER BY composite_risk_score NULLS LAST, applicant_id) AS tile FROM mart_credit_application_fact) GROUP BY tile""")


def _dated_previous(b: Bound) -> DataFrame:
    prev = b.raw["previous_application"].select(
        F.col("sk_id_curr").alias("applicant_id"), F.date_add(F.lit(AS_OF).cast("date"), F.col("days_decision")).alias("application_date"))
    return prev.join(b.staged["stg_application_train"].select("applicant_id", "default_flag"), "applicant_id")


add("year_over_year", lambda b: cast_long(an.year_over_year(_dated_previous(b), "application_date", "default_flag"), "year"), f"""
SELECT CAST(a.year AS BIGINT) AS year, a.rate AS default_rate_pct, {rnd('a.rate - p.rate', 2)} AS yoy_change FROM (
  SELECT year(DATE '{AS_OF}' + days_decision) AS year, {rnd('AVG(default_flag) * 100', 2)} AS rate
  FROM previous_application JOIN stg_application_train ON sk_id_curr = applicant_id GROUP BY 1) a
LEFT JOIN (SELECT year(DATE '{AS_OF}' + days_decision) + 1 AS year, {rnd('AVG(default_flag) * 100', 2)} AS rate
  FROM previous_application JOIN stg_application_train ON sk_id_curr = applicant_id GROUP BY 1) p ON a.year = p.year""")

# ---- sorts, limits, sets --------------------------------------------------------------------------

add("top_risk_applicants", lambda b: cast_long(an.top_by(
    b.fact, 20, [F.col("composite_risk_score").desc_nulls_last(), F.col("applicant_id").asc()],
    ["applicant_id", "credit_risk_segment", "composite_risk_score", "default_flag"]), "default_flag"),
    """SELECT applicant_id, credit_risk_segment, composite_risk_score, CAST(default_flag AS BIGINT) AS default_flag
    FROM mart_credit_application_fact ORDER BY composite_risk_score DESC NULLS LAST, applicant_id LIMIT 20""")
add("top_occupations", lambda b: an.top_occupations(b.staged["stg_application_train"]), f"""
SELECT occupation, COUNT(*) AS applications, {rnd('AVG(default_flag) * 100', 2)} AS default_rate_pct FROM stg_application_train
WHERE occupation IS NOT NULL GROUP BY occupation ORDER BY default_rate_pct DESC NULLS LAST, occupation LIMIT 10""")

# ---- scalar functions over whole tables -----------------------------------------------------------

add("scalar_numeric", lambda b: b.raw["bureau"].select(
    "sk_id_bureau", scalars.round_half_up(F.col("amt_credit_sum") / 7.0, 2).alias("rounded"),
    F.floor(F.abs("days_credit") / F.lit(365.25)).cast("long").alias("years"),
    F.coalesce("amt_credit_sum_debt", F.lit(0.0)).alias("filled"),
    F.nullif(F.col("amt_credit_sum_overdue"), F.lit(0.0)).alias("zero_to_null"),
    scalars.greatest_strict(F.col("amt_credit_sum_debt"), F.col("amt_credit_sum_overdue")).alias("larger"),
    scalars.least_strict(F.col("amt_credit_sum_debt"), F.col("amt_credit_sum_overdue")).alias("smaller"),
    scalars.round_half_up(scalars.ratio_or("amt_credit_sum_debt", "amt_credit_sum", 0.0), 6).alias("divided"),
    F.col("credit_active").isin("Active", "Sold").alias("is_open"),
    F.when(F.col("amt_credit_sum_debt") > 0, "owes").when(F.col("amt_credit_sum_debt") < 0, "credit").otherwise("none").alias("sign")),
    f"""SELECT sk_id_bureau, {rnd('amt_credit_sum / CAST(7 AS DOUBLE)', 2)} AS rounded,
    CAST(FLOOR(ABS(days_credit) / CAST(365.25 AS DOUBLE)) AS BIGINT) AS years, COALESCE(amt_credit_sum_debt, 0) AS filled,
    NULLIF(amt_credit_sum_overdue, 0) AS zero_to_null,
    CASE WHEN amt_credit_sum_debt >= amt_credit_sum_overdue THEN amt_credit_sum_debt
      WHEN amt_credit_sum_debt < amt_credit_sum_overdue THEN amt_credit_sum_overdue END AS larger,
    CASE WHEN amt_credit_sum_debt <= amt_credit_sum_overdue THEN amt_credit_sum_debt
      WHEN amt_credit_sum_debt > amt_credit_sum_overdue THEN amt_credit_sum_overdue END AS smaller,
    COALESCE({rnd(div('amt_credit_sum_debt', 'amt_credit_sum'), 6)}, 0) AS divided, credit_active IN ('Active', 'Sold') AS is_open,
    CASE WHEN amt_credit_sum_debt > 0 THEN 'owes' WHEN amt_credit_sum_debt < 0 THEN 'credit' ELSE 'none' END AS sign FROM bureau""")
add("scalar_dates_and_casts", lambda b: b.raw["boc_macro"].select(
    "date", cast_of(F.year(F.try_to_date("date", "yyyy-MM-dd")), "year"),
    F.date_format(F.date_add(F.try_to_date("date", "yyyy-MM-dd"), 30), "yyyy-MM-dd").alias("plus_30"),
    F.col("overnight_rate").cast("string").try_cast("double").alias("number"),
    F.concat(F.lit("x"), "date").try_cast("double").alias("no_number"),
    F.date_format(F.try_to_date(F.concat(F.lit("x"), "date"), "yyyy-MM-dd"), "yyyy-MM-dd").alias("no_date")),
    """SELECT date, CAST(year(TRY_CAST(date AS DATE)) AS BIGINT) AS year, strftime(TRY_CAST(date AS DATE) + 30, '%Y-%m-%d') AS plus_30,
    TRY_CAST(CAST(overnight_rate AS VARCHAR) AS DOUBLE) AS number, TRY_CAST('x' || date AS DOUBLE) AS no_number,
    strftime(TRY_CAST('x' || date AS DATE), '%Y-%m-%d') AS no_date FROM boc_macro""")


def cast_of(c, name: str):
    return c.cast("long").alias(name)


add("scalar_text", lambda b: b.raw["application_train"].select(
    "sk_id_curr", F.upper(F.trim(F.concat(F.lit(" "), "name_family_status", F.lit(" ")))).alias("upper_trimmed"),
    F.lower("name_income_type").alias("lowered"), cast_of(F.length("occupation_type"), "occupation_length"),
    scalars.record_key("sk_id_curr", "code_gender", "occupation_type").alias("record_key"),
    F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded")),
    """SELECT sk_id_curr, UPPER(TRIM(' ' || name_family_status || ' ')) AS upper_trimmed, LOWER(name_income_type) AS lowered,
    CAST(LENGTH(occupation_type) AS BIGINT) AS occupation_length,
    md5(COALESCE(LENGTH(CAST(sk_id_curr AS VARCHAR)) || ':' || CAST(sk_id_curr AS VARCHAR), '-') || '|' || COALESCE(LENGTH(code_gender) || ':' || code_gender, '-') || '|'
      || COALESCE(LENGTH(occupation_type) || ':' || occupation_type, '-')) AS record_key,
    strftime(loaded_at, '%Y-%m-%d') AS loaded FROM application_train""")
add("unemployed_years", lambda b: b.raw["application_train"].select(
    "sk_id_curr", F.when(F.col("days_employed") != UNEMPLOYED_DAYS, scalars.whole_years("days_employed")).alias("years_employed"),
    scalars.years_back("days_registration").alias("years_since_registration")),
    """SELECT sk_id_curr, CASE WHEN days_employed <> 365243 THEN CAST(FLOOR(-days_employed / CAST(365.25 AS DOUBLE)) AS BIGINT) END AS years_employed,
    days_registration / CAST(-365.25 AS DOUBLE) AS years_since_registration FROM application_train""")
