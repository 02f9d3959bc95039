"""Dashboard measures, policy rules, classifier metrics, training and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.constants import FEATURES, SMOTE_SHARE
from riskmart.operators import measures as me
from riskmart.operators import metrics as mt
from riskmart.operators import logit, ml
from riskmart.operators import policy as po
from riskmart.registry.bound import Bound, cast_long, rounded
from riskmart.registry.catalog import add
from riskmart.registry.sql import SCORE_TERMS, age, div, income, ladder, rnd
from riskmart.session import scratch_path
from riskmart.sources.credit_binding import AS_OF

FACT = "mart_credit_application_fact"
_BAD = "COUNT(*) FILTER (WHERE default_flag = 1)"
_RATE = rnd("AVG(default_flag) * 100", 2)

# ---- measures -------------------------------------------------------------------------------------

_KPI = f"""COUNT(*) AS total_applications, {_BAD} AS total_defaults, {rnd(div(_BAD, 'COUNT(*)') + ' * 100', 2)} AS default_rate_pct,
  {rnd('AVG(loan_amount)', 2)} AS avg_loan_amount, {rnd('AVG(annual_income)', 2)} AS avg_annual_income,
  {rnd('AVG(credit_to_income_ratio)', 3)} AS avg_dti, {rnd('AVG(composite_risk_score)', 4)} AS avg_risk_score,
  {rnd('SUM(loan_amount) / 1000000', 1)} AS portfolio_value_m"""
add("kpi_block", lambda b: me.kpi_block(b.fact), f"SELECT {_KPI} FROM {FACT}")
add("kpi_by_loan_type_and_gender", lambda b: me.kpi_block(b.fact, "loan_type", "gender"),
    f"SELECT loan_type, gender, {_KPI} FROM {FACT} GROUP BY loan_type, gender")
_HIGH = "COUNT(*) FILTER (WHERE credit_risk_segment IN ('HIGH', 'VERY_HIGH'))"
add("high_risk_by_education", lambda b: me.high_risk(b.fact, "education_level"),
    f"SELECT education_level, {_HIGH} AS high_risk_count, {rnd(div(_HIGH, 'COUNT(*)') + ' * 100', 2)} AS high_risk_pct FROM {FACT} GROUP BY education_level")


def _seg_rate(s: str) -> str:
    return (f"COALESCE({div(f'COUNT(*) FILTER (WHERE default_flag = 1 AND credit_risk_segment = {s!r})', f'COUNT(*) FILTER (WHERE credit_risk_segment = {s!r})')}"
            ", 0) * 100")


add("extreme_segment_ratio", lambda b: me.extreme_segment_ratio(b.fact, "loan_type"), f"""
SELECT loan_type, {rnd(_seg_rate('VERY_HIGH'), 4)} AS very_high_rate_pct, {rnd(_seg_rate('LOW'), 4)} AS low_rate_pct,
  {rnd(f"COALESCE({div('(' + _seg_rate('VERY_HIGH') + ')', '(' + _seg_rate('LOW') + ')')}, 0)", 4)} AS very_high_low_ratio FROM {FACT} GROUP BY loan_type""")
add("segment_rate_ignoring_filters", lambda b: me.segment_rate_ignoring_filters(b.fact, "gender"), f"""
SELECT credit_risk_segment, gender, n AS applications, {rnd(div('d', 'n') + ' * 100', 2)} AS default_rate_pct,
  {rnd(div('SUM(d) OVER (PARTITION BY credit_risk_segment)', 'SUM(n) OVER (PARTITION BY credit_risk_segment)') + ' * 100', 2)} AS segment_default_rate_pct
FROM (SELECT credit_risk_segment, gender, COUNT(*) AS n, {_BAD} AS d FROM {FACT} GROUP BY credit_risk_segment, gender)""")
_LATE = {"all": "AVG(inst_late_rate) * 100", "bad": "AVG(inst_late_rate) FILTER (WHERE default_flag = 1) * 100",
         "good": "AVG(inst_late_rate) FILTER (WHERE default_flag = 0) * 100"}
add("late_rates", lambda b: me.late_rates(b.fact, "income_type"), f"""
SELECT income_type, {rnd(_LATE['all'], 4)} AS avg_late_rate_pct, {rnd(_LATE['bad'], 4)} AS defaulter_late_rate_pct,
  {rnd(_LATE['good'], 4)} AS non_defaulter_late_rate_pct,
  {rnd('COALESCE((' + _LATE['bad'] + ') / NULLIF(' + _LATE['good'] + ', 0), 0)', 4)} AS late_payment_lift FROM {FACT} GROUP BY income_type""")
add("late_rate_by_segment", lambda b: me.late_rates(b.fact, "credit_risk_segment").select("credit_risk_segment", "avg_late_rate_pct"),
    f"SELECT credit_risk_segment, {rnd(_LATE['all'], 4)} AS avg_late_rate_pct FROM {FACT} GROUP BY credit_risk_segment")
add("bureau_measures", lambda b: me.bureau_measures(b.fact, "housing_type"), f"""
SELECT housing_type, {rnd('AVG(bureau_delinquency_rate) * 100', 4)} AS avg_bureau_delinquency_pct, {rnd('AVG(bureau_total_overdue)', 2)} AS avg_bureau_overdue,
  {rnd(div('COUNT(*) FILTER (WHERE bureau_num_records > 0)', 'COUNT(*)') + ' * 100', 2)} AS with_bureau_record_pct FROM {FACT} GROUP BY housing_type""")
add("risk_score_p90", lambda b: me.score_p90(b.fact), f"SELECT {rnd('quantile_cont(composite_risk_score, 0.9)', 6)} AS risk_score_p90 FROM {FACT}")
add("risk_score_p90_by_segment", lambda b: me.score_p90(b.fact, "credit_risk_segment"),
    f"SELECT credit_risk_segment, {rnd('quantile_cont(composite_risk_score, 0.9)', 6)} AS risk_score_p90 FROM {FACT} GROUP BY credit_risk_segment")
_SEG_ROWS = "(VALUES ('LOW', 1, 'Approved', 35), ('MEDIUM', 2, 'Conditional', 75), ('HIGH', 3, 'Review', 100), ('VERY_HIGH', 4, 'Declined', 150)) s(seg, ord, decision, weight)"
add("decision_funnel", lambda b: cast_long(me.decision_funnel(b.fact), "risk_order"), f"""
SELECT CAST(ord AS BIGINT) AS risk_order, seg AS credit_risk_segment, decision, COUNT(applicant_id) AS applications
FROM {_SEG_ROWS} LEFT JOIN {FACT} ON seg = credit_risk_segment GROUP BY ord, seg, decision""")
add("segment_exposure", lambda b: cast_long(me.segment_exposure(b.fact), "risk_order"), f"""
SELECT CAST(ord AS BIGINT) AS risk_order, credit_risk_segment, SPLIT_PART(loan_type, ' ', 1) AS loan_type_short, COUNT(*) AS applications,
  {rnd('SUM(loan_amount)', 2)} AS loan_value, {rnd('SUM(loan_amount * (weight / CAST(100 AS DOUBLE)))', 2)} AS risk_weighted_value
FROM {FACT} JOIN {_SEG_ROWS} ON seg = credit_risk_segment GROUP BY ord, credit_risk_segment, loan_type""")


def _matrix_sql(row: str, col: str, values, source: str = FACT) -> str:
    def cell(v: str) -> str:
        return rnd(f"AVG(default_flag) FILTER (WHERE {col} = '{v}') * 100", 2)

    return f"SELECT {row}, " + ", ".join(f"{cell(v)} AS rate_{me.snake(v)}" for v in values) + f" FROM {source} GROUP BY {row}"


_INCOMES = ("Working", "Commercial associate", "Pensioner", "State servant")
_SCHOOLS = ("Higher education", "Secondary / secondary special", "Incomplete higher", "Lower secondary", "Academic degree")
_BRACKETS = ("1_Low (<$90K)", "2_Mid ($90–$180K)", "3_High ($180–$360K)", "4_Very High ($360K+)")
_BANDED = f"(SELECT *, {age('age_years')} AS age_band, {income('annual_income', True)} AS income_bracket FROM {FACT})"
add("matrix_loan_by_income_type", lambda b: me.matrix(b.fact, "loan_type", "income_type", _INCOMES), _matrix_sql("loan_type", "income_type", _INCOMES))
add("matrix_segment_by_education", lambda b: me.matrix(b.fact, "credit_risk_segment", "education_level", _SCHOOLS),
    _matrix_sql("credit_risk_segment", "education_level", _SCHOOLS))
add("matrix_age_by_income_bracket", lambda b: me.matrix(me.banded(b.fact), "age_band", "income_bracket", _BRACKETS),
    _matrix_sql("age_band", "income_bracket", _BRACKETS, _BANDED))
add("traffic_light_cells", lambda b: me.rate_cells(b.fact, "loan_type", "income_type"), f"""
SELECT *, CASE WHEN default_rate_pct < 6 THEN 'green' WHEN default_rate_pct <= 12 THEN 'yellow' WHEN default_rate_pct > 12 THEN 'red' END AS light
FROM (SELECT loan_type, income_type, COUNT(*) AS applications, {_RATE} AS default_rate_pct FROM {FACT} GROUP BY loan_type, income_type)""")


def _split_sql(by: str, source: str = FACT) -> str:
    return f"""SELECT {by}, COUNT(*) AS applications, {rnd('SUM(loan_amount)', 2)} AS loan_value,
    {rnd(div('COUNT(*)', 'SUM(COUNT(*)) OVER ()') + ' * 100', 4)} AS application_share_pct,
    {rnd(div('SUM(loan_amount)', 'SUM(SUM(loan_amount)) OVER ()') + ' * 100', 4)} AS loan_value_share_pct,
    {_RATE} AS default_rate_pct FROM {source} GROUP BY {by}"""


add("portfolio_split_by_segment", lambda b: me.portfolio_split(b.fact, "credit_risk_segment"), _split_sql("credit_risk_segment"))
add("treemap_income_education", lambda b: me.portfolio_split(b.fact, "income_type", "education_level"), _split_sql("income_type, education_level"))
add("volume_by_age_band", lambda b: me.portfolio_split(me.banded(b.fact), "age_band"), _split_sql("age_band", _BANDED))
add("rate_by_segment_and_education", lambda b: me.rate_cells(b.fact, "credit_risk_segment", "education_level").drop("light"),
    f"SELECT credit_risk_segment, education_level, COUNT(*) AS applications, {_RATE} AS default_rate_pct FROM {FACT} GROUP BY ALL")
add("score_components_by_segment", lambda b: me.score_components(b.fact, "credit_risk_segment"), "SELECT credit_risk_segment, " + ", ".join(
    f"{rnd(f'AVG({t})', 6)} AS {n}_term" for n, t in SCORE_TERMS.items()) + f", {rnd('AVG(composite_risk_score)', 6)} AS avg_risk_score FROM {FACT} GROUP BY credit_risk_segment")
add("delinquency_quantiles", lambda b: cast_long(me.delinquency_quantiles(b.fact), "default_flag"), "SELECT CAST(default_flag AS BIGINT) AS default_flag, " + ", ".join(
    f"{rnd(f'quantile_cont(bureau_delinquency_rate, {p / 100})', 6)} AS p{p:02d}" for p in (5, 25, 50, 75, 95)) + f" FROM {FACT} GROUP BY default_flag")
add("low_external_share", lambda b: me.low_external_share(b.fact),
    f"SELECT {rnd(div('COUNT(*) FILTER (WHERE ext_source_2 < 0.3)', 'COUNT(*)') + ' * 100', 4)} AS low_ext_source_2_pct FROM {FACT}")
_QUADRANT = """CASE WHEN credit_to_income_ratio > 3 THEN 'high_dti' ELSE 'low_dti' END || '/' ||
  CASE WHEN bureau_delinquency_rate > 0.2 THEN 'high_delinquency' ELSE 'low_delinquency' END"""
add("quadrants", lambda b: cast_long(me.quadrants(b.fact), "default_flag"), f"""
SELECT {_QUADRANT} AS quadrant, CAST(default_flag AS BIGINT) AS default_flag, COUNT(*) AS applications, {rnd('AVG(loan_amount)', 2)} AS avg_loan_amount
FROM {FACT} GROUP BY ALL""")
add("scatter_points", lambda b: cast_long(me.scatter_points(b.fact), "default_flag"), f"""
SELECT applicant_id, credit_to_income_ratio, bureau_delinquency_rate, loan_amount, CAST(default_flag AS BIGINT) AS default_flag, {_QUADRANT} AS quadrant
FROM {FACT} WHERE CAST('0x' || SUBSTR(md5('42:' || CAST(applicant_id AS VARCHAR)), 1, 8) AS BIGINT) < CAST(FLOOR(0.1 * 4294967296) AS BIGINT)""")
add("gauges", lambda b: me.gauges(b.fact), f"""
SELECT {rnd('AVG(inst_late_rate)', 6)} AS avg_late_rate, CAST(0.08 AS DOUBLE) AS late_target, AVG(inst_late_rate) <= 0.08 AS late_ok,
  {rnd('AVG(bureau_delinquency_rate)', 6)} AS avg_delinquency_rate, CAST(0.10 AS DOUBLE) AS delinquency_target,
  AVG(bureau_delinquency_rate) <= 0.10 AS delinquency_ok FROM {FACT}""")


def _visible(b: Bound) -> DataFrame:
    grants = b.spark.createDataFrame([("analyst_a", "Working"), ("analyst_a", "Pensioner"), ("analyst_b", "State servant")],
                                     "user_name string, income_type string")
    return me.visible_to(b.fact, grants, "analyst_a").select("applicant_id", "income_type")


add("visible_rows", _visible, f"SELECT applicant_id, income_type FROM {FACT} WHERE income_type IN ('Working', 'Pensioner')")

# ---- policy ---------------------------------------------------------------------------------------

_YOUNG = "age_years < 30"
_RULES = {
    "dti_above_limit": "credit_to_income_ratio > 5", "young_dti_decline": f"{_YOUNG} AND credit_to_income_ratio > 4",
    "refusal_and_dti": "prev_refusal_rate > 0.6 AND credit_to_income_ratio > 3", "young_dti_review": f"{_YOUNG} AND credit_to_income_ratio > 3",
    "refusal_and_delinquency": "prev_refusal_rate > 0.4 AND bureau_worst_delinquency >= 3",
    "large_loan_payment_check": "loan_amount > 200000 AND (inst_late_rate > 0.2 OR recent > 60)",
}
_DECLINES = ("dti_above_limit", "young_dti_decline", "refusal_and_dti")
_RECENT = f"""(SELECT * FROM {FACT} LEFT JOIN (SELECT applicant_id, MAX(days_late) AS recent FROM stg_installments_payments
  WHERE days_instalment >= -730 GROUP BY applicant_id) USING (applicant_id))"""


def _decisions(b: Bound) -> DataFrame:
    ready = po.with_recent_lateness(b.fact, b.staged["stg_installments_payments"])
    out = po.decide(ready, po.standard_rules() + [po.large_loan_rule()])
    return out.select("applicant_id", F.array_join("fired_rules", ",").alias("fired_rules"), "policy_outcome")


add("policy_decisions", _decisions, "SELECT applicant_id, concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} THEN '{n}' END" for n, c in _RULES.items()) + ") AS fired_rules, CASE WHEN "
    + " OR ".join(f"({_RULES[n]})" for n in _DECLINES) + " THEN 'DECLINE' WHEN "
    + " OR ".join(f"({c})" for n, c in _RULES.items() if n not in _DECLINES) + f" THEN 'MANUAL_REVIEW' ELSE 'NONE' END AS policy_outcome FROM {_RECENT}")
_CUTS = (3.0, 4.0, 5.0)


def _cut_sql(cut: float) -> str:
    out, kept = f"(WHERE credit_to_income_ratio > {cut})", f"(WHERE NOT credit_to_income_ratio > {cut})"
    kept_bad = f"COUNT(*) FILTER (WHERE NOT credit_to_income_ratio > {cut} AND default_flag = 1)"
    return f"""SELECT CAST({cut} AS DOUBLE) AS dti_cut, COUNT(*) FILTER {out} AS removed, COUNT(*) FILTER {kept} AS kept,
    COUNT(*) FILTER (WHERE credit_to_income_ratio > {cut} AND default_flag = 1) AS removed_defaults, {kept_bad} AS kept_defaults,
    {rnd(f'COALESCE(SUM(loan_amount) FILTER {out}, 0)', 2)} AS removed_loan_value, {rnd(f'COALESCE(SUM(loan_amount) FILTER {kept}, 0)', 2)} AS kept_loan_value,
    {rnd(div(kept_bad, f'COUNT(*) FILTER {kept}') + ' * 100', 4)} AS kept_default_rate_pct FROM {FACT}"""


add("dti_cut_what_if", lambda b: po.cut_what_if(b.fact, _CUTS), " UNION ALL ".join(_cut_sql(c) for c in _CUTS))
add("large_loan_review", lambda b: po.decide(po.with_recent_lateness(b.fact, b.staged["stg_installments_payments"]), [po.large_loan_rule()])
    .filter(F.col("policy_outcome") == "MANUAL_REVIEW").select("applicant_id", "loan_amount", "inst_late_rate", "recent_max_days_late"),
    f"SELECT applicant_id, loan_amount, inst_late_rate, recent AS recent_max_days_late FROM {_RECENT} WHERE {_RULES['large_loan_payment_check']}")
add("filled_external_score", lambda b: po.fill_external_score(b.fact).select("applicant_id", "ext_source_2"),
    f"SELECT applicant_id, COALESCE(ext_source_2, CAST(0.3 AS DOUBLE)) AS ext_source_2 FROM {FACT}")
add("young_dti_limits", lambda b: po.outcome_counts(b.fact, po.young_limits(b.fact)), f"""
SELECT CASE WHEN {_YOUNG} AND credit_to_income_ratio > 4 THEN 'DECLINE' WHEN {_YOUNG} AND credit_to_income_ratio > 3 THEN 'MANUAL_REVIEW' ELSE 'NONE' END AS outcome,
  COUNT(*) AS applications, {_RATE} AS default_rate_pct FROM {FACT} GROUP BY 1""")
add("refusal_overrides", lambda b: po.outcome_counts(b.fact, po.refusal_override()), f"""
SELECT CASE WHEN {_RULES['refusal_and_dti']} THEN 'DECLINE' WHEN {_RULES['refusal_and_delinquency']} THEN 'MANUAL_REVIEW' ELSE 'NONE' END AS outcome,
  COUNT(*) AS applications, {_RATE} AS default_rate_pct FROM {FACT} GROUP BY 1""")
add("refusal_bands", lambda b: po.refusal_bands(b.fact), f"""
SELECT CASE WHEN prev_refusal_rate = 0 THEN 'none' WHEN prev_refusal_rate <= 0.5 THEN 'up to half' ELSE 'over half' END AS refusal_band,
  COUNT(*) AS applications, {_RATE} AS default_rate_pct FROM {FACT} GROUP BY 1""")
add("age_gap_to_portfolio", lambda b: po.age_gap(b.fact), f"""
SELECT {age('age_years')} AS age_band, COUNT(*) AS applications, {_RATE} AS default_rate_pct,
  {rnd(f'AVG(default_flag) * 100 - (SELECT AVG(default_flag) * 100 FROM {FACT})', 2)} AS gap_pp FROM {FACT} GROUP BY 1""")
_HIGH_VALUE = "SUM(loan_amount) FILTER (WHERE credit_risk_segment IN ('HIGH', 'VERY_HIGH'))"
add("loan_concentration", lambda b: po.concentration(b.fact), f"""
SELECT {rnd(_HIGH_VALUE, 2)} AS high_loan_value, {rnd('SUM(loan_amount)', 2)} AS loan_value,
  {rnd(div(_HIGH_VALUE, 'SUM(loan_amount)') + ' * 100', 4)} AS high_share_pct FROM {FACT}""")

# ---- metrics and splits ---------------------------------------------------------------------------

_SCORED = "(SELECT composite_risk_score AS score, label FROM ml_features_training)"
_CURVE = f"""(SELECT score AS threshold, CAST(SUM(pos) OVER w AS DOUBLE) AS cp, CAST(SUM(neg) OVER w AS DOUBLE) AS cn, pos, neg,
    CAST(SUM(pos) OVER () AS DOUBLE) AS p, CAST(SUM(neg) OVER () AS DOUBLE) AS n
  FROM (SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg FROM {_SCORED} GROUP BY score)
  WINDOW w AS (ORDER BY score DESC))"""


def _scored(b: Bound) -> DataFrame:
    return b.training.select(F.col("composite_risk_score").alias("score"), "label")


_AUC = "SUM(neg * (cp - pos / CAST(2 AS DOUBLE))) / MAX(p * n)"
add("classifier_metrics", lambda b: mt.classifier_metrics(_scored(b)), f"""
SELECT {rnd(_AUC, 6)} AS auc, {rnd(f'2 * {_AUC} - 1', 6)} AS gini, {rnd('MAX(ABS(cp / p - cn / n))', 6)} AS ks,
  MAX_BY(threshold, (ROUND(ABS(cp / p - cn / n), 12), threshold)) AS ks_threshold, {_AUC} > 0.7 AS auc_ok, 2 * {_AUC} - 1 > 0.35 AS gini_ok,
  MAX(ABS(cp / p - cn / n)) > 0.3 AS ks_ok FROM {_CURVE}""")
add("roc_points", lambda b: rounded(mt.roc_points(mt.score_curve(_scored(b))), 9, "fpr", "tpr"),
    f"SELECT threshold, {rnd('cn / n', 9)} AS fpr, {rnd('cp / p', 9)} AS tpr FROM {_CURVE}")
_SHUFFLED = "ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(applicant_id AS VARCHAR)), applicant_id)"
add("stratified_folds", lambda b: cast_long(mt.stratified_folds(b.training.select("applicant_id", "label")), "label", "fold"),
    f"SELECT applicant_id, CAST(label AS BIGINT) AS label, ({_SHUFFLED} - 1) % 5 AS fold FROM ml_features_training")
add("stratified_split", lambda b: cast_long(mt.stratified_split(b.training.select("applicant_id", "label")), "label"),
    f"""SELECT applicant_id, CAST(label AS BIGINT) AS label,
    {_SHUFFLED} <= ROUND(COUNT(*) OVER (PARTITION BY label) * CAST(0.2 AS DOUBLE)) AS is_test FROM ml_features_training""")
_PSI = {"ext_source_2": (0.2, 0.4, 0.6, 0.8), "composite_risk_score": (0.1, 0.2, 0.3), "age_years": (30.0, 45.0, 60.0),
        "credit_to_income_ratio": (1.5, 3.0, 5.0), "inst_late_rate": (0.1, 0.2, 0.3)}


def _psi(b: Bound) -> DataFrame:
    return mt.population_stability(b.fact.filter(F.col("loan_type") == "Cash loans"), b.fact.filter(F.col("loan_type") == "Revolving loans"), _PSI)


def _psi_sql(f: str, edges) -> str:
    place = " + ".join(f"CASE WHEN {f} > {e} THEN 1 ELSE 0 END" for e in edges)
    return f"""SELECT '{f}' AS feature, {rnd('SUM((a - e) * LN(a / e))', 6)} AS psi, SUM((a - e) * LN(a / e)) > 0.25 AS retrain FROM (
      SELECT GREATEST(en / SUM(en) OVER (), CAST(0.0001 AS DOUBLE)) AS e, GREATEST(an / SUM(an) OVER (), CAST(0.0001 AS DOUBLE)) AS a FROM (
        SELECT {place} AS bin, CAST(COUNT(*) FILTER (WHERE loan_type = 'Cash loans') AS DOUBLE) AS en,
          CAST(COUNT(*) FILTER (WHERE loan_type = 'Revolving loans') AS DOUBLE) AS an FROM {FACT} WHERE {f} IS NOT NULL GROUP BY 1))"""


add("population_stability", _psi, " UNION ALL ".join(_psi_sql(f, e) for f, e in _PSI.items()))


def _monthly(b: Bound) -> DataFrame:
    """PSI by the month in which an applicant's last earlier application was decided."""
    decided = b.raw["previous_application"].groupBy(F.col("sk_id_curr").alias("applicant_id")).agg(F.max("days_decision").alias("d"))
    month = F.date_format(F.date_add(F.lit(AS_OF).cast("date"), F.col("d")), "yyyy-MM")
    return mt.stability_by_period(b.fact.join(decided, "applicant_id").withColumn("month", month), "month", _PSI)


def _monthly_sql(f: str, edges) -> str:
    return f"""SELECT month AS period, '{f}' AS feature, {rnd('SUM((a - e) * LN(a / e))', 6)} AS psi, SUM((a - e) * LN(a / e)) > 0.25 AS retrain FROM (
      SELECT g.month, GREATEST(CAST(COALESCE(c.n, 0) AS DOUBLE) / SUM(COALESCE(c.n, 0)) OVER (PARTITION BY g.month), CAST(0.0001 AS DOUBLE)) AS a,
        GREATEST(CAST(COALESCE(b.n, 0) AS DOUBLE) / SUM(COALESCE(b.n, 0)) OVER (PARTITION BY g.month), CAST(0.0001 AS DOUBLE)) AS e
      FROM (SELECT DISTINCT month, bin FROM m{f}, (SELECT unnest(range({len(edges) + 1})) AS bin)) g
      LEFT JOIN c{f} c ON c.month = g.month AND c.bin = g.bin
      LEFT JOIN c{f} b ON b.month = (SELECT MIN(month) FROM m{f}) AND b.bin = g.bin)
    WHERE month <> (SELECT MIN(month) FROM m{f}) GROUP BY month"""


def _month_tables(f: str, edges) -> str:
    place = " + ".join(f"CASE WHEN {f} > {e} THEN 1 ELSE 0 END" for e in edges)
    return f"""m{f} AS (SELECT strftime(DATE '{AS_OF}' + d, '%Y-%m') AS month, {f} FROM {FACT} JOIN
      (SELECT sk_id_curr, MAX(days_decision) AS d FROM previous_application GROUP BY 1) ON sk_id_curr = applicant_id),
    c{f} AS (SELECT month, {place} AS bin, COUNT(*) AS n FROM m{f} WHERE {f} IS NOT NULL GROUP BY ALL)"""


add("stability_by_month", _monthly, f"SELECT * FROM (WITH {', '.join(_month_tables(f, e) for f, e in _PSI.items())} "
    + " UNION ALL ".join(_monthly_sql(f, e) for f, e in _PSI.items()) + ") WHERE psi IS NOT NULL AND isfinite(psi)")

# ---- imputation, scoring, explanation -------------------------------------------------------------

_GAPPED = ("annuity_to_income_ratio", "ext_source_1", "ext_source_2", "ext_source_3", "years_employed")
add("median_imputation", lambda b: rounded(ml.impute_medians(b.fact.select("applicant_id", *_GAPPED), _GAPPED), 6, *_GAPPED), "SELECT applicant_id, "
    + ", ".join(f"{rnd(f'COALESCE(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM {FACT}))', 6)} AS {c}" for c in _GAPPED) + f" FROM {FACT}")
_TIERED = ladder("p", ((0.05, "LOW"), (0.15, "MEDIUM"), (0.3, "HIGH")), "VERY_HIGH")
_DECIDED = ladder("p", ((0.05, "APPROVE"), (0.15, "APPROVE_WITH_CONDITIONS"), (0.3, "MANUAL_REVIEW")), "DECLINE")


def _tiered(b: Bound) -> DataFrame:
    p = b.fact.select("applicant_id", (F.col("composite_risk_score") / F.lit(3.0)).alias("score"))
    return ml.with_tier(p).drop("score")


add("tiered_scoring", _tiered, f"""
SELECT applicant_id, {rnd('p', 4)} AS default_probability, {_TIERED} AS risk_tier, {_DECIDED} AS decision, 'xgb_v1' AS model_version
FROM (SELECT applicant_id, composite_risk_score / CAST(3 AS DOUBLE) AS p FROM {FACT})""")
_COEF = {"ext_source_2": -2.0, "inst_late_rate": 3.0, "bureau_delinquency_rate": 1.5, "credit_to_income_ratio": 0.05, "age_years": -0.02}
_MEANS = {"ext_source_2": 0.5, "inst_late_rate": 0.24, "bureau_delinquency_rate": 0.1, "credit_to_income_ratio": 4.0, "age_years": 42.0}


def _factors(b: Bound) -> DataFrame:
    top = b.training.select("applicant_id", ml.top_factors(ml.linear_contributions(_COEF, _MEANS)).alias("t"))
    return top.select("applicant_id", *[F.col("t")[i][f].alias(f"{f}_{i + 1}") for i in range(3) for f in ("feature", "direction", "impact")])


def _factor_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT applicant_id, {i} AS i, '{f}' AS feature, CAST({c} AS DOUBLE) * (CAST({f} AS DOUBLE) - CAST({_MEANS[f]} AS DOUBLE)) AS v FROM ml_features_training"
        for i, (f, c) in enumerate(_COEF.items()))
    ranked = f"SELECT *, ROW_NUMBER() OVER (PARTITION BY applicant_id ORDER BY ABS(v) DESC, i) AS r FROM ({rows})"
    cols = ", ".join(f"MAX(feature) FILTER (WHERE r = {r}) AS feature_{r}, MAX(CASE WHEN v > 0 THEN 'increases' ELSE 'decreases' END) FILTER (WHERE r = {r}) AS direction_{r}, "
                     f"{rnd(f'MAX(ABS(v)) FILTER (WHERE r = {r})', 4)} AS impact_{r}" for r in (1, 2, 3))
    return f"SELECT applicant_id, {cols} FROM ({ranked}) GROUP BY applicant_id"


add("linear_top_factors", _factors, _factor_sql())
add("global_importance", lambda b: ml.global_importance(b.training, ml.linear_contributions(_COEF, _MEANS)), " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, {rnd(f'AVG(ABS(CAST({c} AS DOUBLE) * (CAST({f} AS DOUBLE) - CAST({_MEANS[f]} AS DOUBLE))))', 6)} AS mean_abs_contribution FROM ml_features_training""" for f, c in _COEF.items()))


def _reuse(b: Bound) -> DataFrame:
    """Every order is a scoring request with its applicant's figures, so most requests repeat a record."""
    inputs = ["credit_to_income_ratio", "age_years", "composite_risk_score"]
    records = b.fact.select(F.col("applicant_id").alias("o_custkey"), *inputs)
    requests = b.source("orders").select("o_orderkey", "o_custkey").join(records, "o_custkey")
    scored = ml.score_once_per_record(requests, lambda d: ml.with_tier(d.withColumn("score", F.col("composite_risk_score") / F.lit(3.0))), inputs)
    return scored.select("o_orderkey", "default_probability", "risk_tier", "decision")


add("score_reuse", _reuse, f"""
SELECT o_orderkey, {rnd('p', 4)} AS default_probability, {_TIERED} AS risk_tier, {_DECIDED} AS decision
FROM orders JOIN (SELECT applicant_id, composite_risk_score / CAST(3 AS DOUBLE) AS p FROM {FACT}) ON o_custkey = applicant_id""")

# ---- training: no SQL form ------------------------------------------------------------------------


def _training(b: Bound) -> DataFrame:
    return ml.impute_medians(b.training)


add("smote_balance", lambda b: ml.smote(_training(b)).groupBy("label", (F.col("copy") > 0).alias("synthetic")).agg(F.count(F.lit(1)).alias("rows")), f"""
SELECT label, FALSE AS synthetic, COUNT(*) AS rows FROM ml_features_training GROUP BY label
UNION ALL SELECT 1, TRUE, CAST(FLOOR({SMOTE_SHARE} * many) AS BIGINT) - few
FROM (SELECT COUNT(*) FILTER (WHERE label = 0) AS many, COUNT(*) FILTER (WHERE label = 1) AS few FROM ml_features_training)
WHERE FLOOR({SMOTE_SHARE} * many) > few AND few > 1""")
_LOGIT_FEATURES, _LOGIT_STEPS = ("credit_to_income_ratio", "inst_late_rate"), 6


def _logit(b: Bound) -> logit.Logit:
    """Two features and a fixed number of steps, which SQL can follow."""
    return logit.fit_logit(b.training, _LOGIT_FEATURES, max_steps=_LOGIT_STEPS, tolerance=0.0)


def _logit_sql(final: str) -> str:
    """The same steps: curvature and slope by one aggregation each, the 3 by 3 equations solved by Cramer's rule."""
    one = "CAST(1 AS DOUBLE)"
    blocks = [
        f"t AS (SELECT applicant_id, CAST(label AS DOUBLE) AS y, CAST({_LOGIT_FEATURES[0]} AS DOUBLE) AS x1, CAST({_LOGIT_FEATURES[1]} AS DOUBLE) AS x2 "
        f"FROM ml_features_training WHERE label IS NOT NULL AND {_LOGIT_FEATURES[0]} IS NOT NULL AND {_LOGIT_FEATURES[1]} IS NOT NULL)",
        "m AS (SELECT AVG(x1) AS m1, STDDEV_SAMP(x1) AS s1, AVG(x2) AS m2, STDDEV_SAMP(x2) AS s2 FROM t)",
        "z AS (SELECT y, (x1 - m1) / s1 AS a, (x2 - m2) / s2 AS b FROM t, m)",
        "b0 AS (SELECT CAST(0 AS DOUBLE) AS c0, CAST(0 AS DOUBLE) AS c1, CAST(0 AS DOUBLE) AS c2)"]
    for k in range(_LOGIT_STEPS):
        blocks += [
            f"p{k} AS (SELECT y, a, b, {one} / ({one} + EXP(-(c0 + c1 * a + c2 * b))) AS p, c0, c1, c2 FROM z, b{k})",
            f"g{k} AS (SELECT SUM(p * (1 - p)) AS h00, SUM(p * (1 - p) * a) AS h01, SUM(p * (1 - p) * b) AS h02, SUM(p * (1 - p) * a * a) + 1 AS h11, "
            f"SUM(p * (1 - p) * a * b) AS h12, SUM(p * (1 - p) * b * b) + 1 AS h22, SUM(y - p) AS g0, SUM((y - p) * a) - MAX(c1) AS g1, "
            f"SUM((y - p) * b) - MAX(c2) AS g2, MAX(c0) AS c0, MAX(c1) AS c1, MAX(c2) AS c2 FROM p{k})",
            f"d{k} AS (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM g{k})",
            f"b{k + 1} AS (SELECT c0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det AS c0, "
            f"c1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det AS c1, "
            f"c2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det AS c2 FROM d{k})"]
    blocks.append(f"fit AS (SELECT c1 / s1 AS k1, c2 / s2 AS k2, c0 - c1 * m1 / s1 - c2 * m2 / s2 AS k0 FROM b{_LOGIT_STEPS}, m)")
    return f"SELECT * FROM (WITH {', '.join(blocks)} {final})"


add("logistic_coefficients", lambda b: rounded(_logit(b).to_frame(b.spark), 6, "coefficient"), _logit_sql(
    f"SELECT '(intercept)' AS feature, {rnd('k0', 6)} AS coefficient FROM fit UNION ALL SELECT '{_LOGIT_FEATURES[0]}', {rnd('k1', 6)} FROM fit "
    f"UNION ALL SELECT '{_LOGIT_FEATURES[1]}', {rnd('k2', 6)} FROM fit"))
add("logistic_scoring", lambda b: ml.with_tier(ml.with_probability(_logit(b), b.training, ["applicant_id"])).drop("score"), _logit_sql(
    f"SELECT applicant_id, {rnd('p', 4)} AS default_probability, {_TIERED} AS risk_tier, {_DECIDED} AS decision, 'xgb_v1' AS model_version "
    "FROM (SELECT applicant_id, CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + EXP(-(k0 + k1 * x1 + k2 * x2))) AS p FROM t, fit)"))


def _logit_factors(b: Bound) -> DataFrame:
    """The fitted model's contributions, against the mean row of the table it was fitted on."""
    model = _logit(b)
    parts = ml.linear_contributions(model.weights(), dict(zip(model.features, model.means)))
    return ml.global_importance(b.training, parts)


add("logistic_importance", _logit_factors, _logit_sql(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, {rnd(f'AVG(ABS(k{i} * (x{i} - m{i})))', 6)} AS mean_abs_contribution FROM t, fit, m" for i, f in enumerate(_LOGIT_FEATURES, 1))))


_validated: dict[tuple[str, str, str], ml.CrossValidation] = {}


def _validation(b: Bound, model: str) -> ml.CrossValidation:
    """The folds of a model, fitted once per application and data folder."""
    key = (b.spark.sparkContext.applicationId, b.sf_dir, model)
    if key not in _validated:
        fit, oversample = {"logistic": (lambda t: ml.fit_logistic(t), lambda t: ml.smote(t)), "boosted_trees": (lambda t: ml.fit_trees(t), None)}[model]
        _validated[key] = ml.cross_validate(_training(b), fit, oversample=oversample)
    return _validated[key]


def _checked_folds(b: Bound, model: str) -> DataFrame:
    """What must hold of each fold; the AUC itself is in the query of the scores."""
    in_range = (F.col("auc") >= 0) & (F.col("auc") <= 1)
    return _validation(b, model).fold_frame(b.spark, model).select(
        "model", F.col("fold").cast("long").alias("fold"), "n_train", "n_test", "n_default", F.coalesce(in_range, F.lit(False)).alias("auc_in_range"))


def _folds_sql(model: str, train: str) -> str:
    return f"""
WITH folds AS (SELECT label, ({_SHUFFLED} - 1) % 5 AS fold FROM ml_features_training),
sizes AS (SELECT fold, COUNT(*) AS n_test, COUNT(*) FILTER (WHERE label = 1) AS n_default, COUNT(*) FILTER (WHERE label = 0) AS n_good FROM folds GROUP BY fold),
rest AS (SELECT s.*, (SELECT SUM(o.n_default) FROM sizes o WHERE o.fold <> s.fold) AS few, (SELECT SUM(o.n_good) FROM sizes o WHERE o.fold <> s.fold) AS many FROM sizes s)
SELECT '{model}' AS model, CAST(fold AS BIGINT) AS fold, CAST({train} AS BIGINT) AS n_train, n_test, n_default, n_default > 0 AND n_good > 0 AS auc_in_range FROM rest"""


for _model, _train in (("logistic", f"many + CASE WHEN few > 1 THEN GREATEST(few, FLOOR({SMOTE_SHARE} * many)) ELSE few END"), ("boosted_trees", "many + few")):
    _query = {"logistic": "logistic_cross_validation", "boosted_trees": "tree_cross_validation"}[_model]
    add(_query, lambda b, m=_model: _checked_folds(b, m), f"SELECT * FROM ({_folds_sql(_model, _train)})")
    add(f"{_query}_scores", lambda b, m=_model: _validation(b, m).to_frame(b.spark, m))


_models: dict[tuple[str, str], str] = {}


def _fitted(b: Bound, data: DataFrame | None = None) -> PipelineModel:
    """The trees over all training rows (``data``, if these are there already): fitted and saved once per application
    and data folder, then read."""
    key = (b.spark.sparkContext.applicationId, b.sf_dir)
    if key not in _models:
        path = scratch_path(b.spark, "trees")
        ml.fit_trees(_training(b) if data is None else data).write().save(path)
        _models[key] = path
    return PipelineModel.load(_models[key])


def _held_out(b: Bound) -> DataFrame:
    cut = mt.stratified_split(_training(b))
    model = ml.fit_trees(cut.filter("NOT is_test"))
    return mt.classifier_metrics(ml.with_probability(model, cut.filter("is_test"), ["label"]))


add("tree_held_out_metrics", _held_out)
add("tree_feature_importances", lambda b: ml.feature_importances(_fitted(b), b.spark))


def _explained(b: Bound) -> DataFrame:
    data = _training(b)
    model = _fitted(b, data)
    keep = ["applicant_id", *FEATURES]
    scored = ml.with_tier(ml.with_probability(model, data, keep))
    explained = ml.with_tree_contributions(model, scored)
    return explained.select("applicant_id", "default_probability", "risk_tier", "decision",
                            ml.top_factors(ml.array_contributions()).alias("top_risk_factors"), "model_version")


add("tree_scores_with_factors", _explained)
