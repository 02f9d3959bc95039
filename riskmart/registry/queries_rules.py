"""Data checks, alerts, gates, record validation and change history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.constants import RECORD_BOUNDS
from riskmart.operators import history as hi
from riskmart.operators import quality as qu
from riskmart.operators.quality import Rule
from riskmart.operators.staging import stg_application
from riskmart.plans import rulesets, run
from riskmart.plans.marts import FACT_DEFAULTS
from riskmart.registry.bound import Bound
from riskmart.registry.catalog import add
from riskmart.registry.sql import TABLES, compose, rnd

FACT = "mart_credit_application_fact"
NOW = "2024-01-20 12:00:00"


# ---- rule sets ------------------------------------------------------------------------------------

def _literal(v) -> str:
    return str(v).upper() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v)


def _range(x: str, p) -> str:
    parts = [f"{x} < {p['low']}"] if p.get("low") is not None else []
    parts += [f"{x} > {p['high']}"] if p.get("high") is not None else []
    return " OR ".join(parts)


def _rule_sql(r: Rule) -> str:
    """One rule as its own query over its table: one scan per rule, unlike the folded Spark form."""
    c, p, t = r.column, r.params, r.table
    total, observed, passed, failed = "COUNT(*)", "CAST(NULL AS DOUBLE)", "", ""
    bad = {"not_null": lambda: f"{c} IS NULL", "accepted_values": lambda: f"{c} NOT IN ({', '.join(map(_literal, p['values']))})",
           "expression": lambda: f"NOT ({c} {p['op']} {p['value']})", "between": lambda: _range(c, p),
           "length_between": lambda: _range(f"LENGTH({c})", p)}
    source = t
    if r.kind in bad:
        failed = f"COUNT(*) FILTER (WHERE {bad[r.kind]()})"
        if "mostly" in p:
            share = f"COALESCE(CAST(COUNT({c}) - {failed} AS DOUBLE) / NULLIF(COUNT({c}), 0), 1)"
            total, observed, passed = f"COUNT({c})", rnd(share, 6), f"{share} >= {p['mostly']}"
    elif r.kind == "unique":
        failed = f"(SELECT COUNT(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1))"
    elif r.kind == "relationships":
        failed = f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {p['field']} FROM {p['to']}))"
    else:
        value = {"row_count": "COUNT(*)", "mean_between": f"AVG({c})", "median_between": f"quantile_cont(CAST({c} AS DOUBLE), 0.5)"}[r.kind]
        failed, observed, passed = "0", rnd(value, 6), f"NOT ({_range(value, p)})"
    return (f"SELECT '{r.rule_id}' AS rule_id, '{c}' AS \"column\", '{r.kind}' AS kind, '{r.severity}' AS severity, "
            f"CAST({failed} AS BIGINT) AS failed, CAST({total} AS BIGINT) AS total, {observed} AS observed, "
            f"{passed or f'({failed}) = 0'} AS passed FROM {source}")


def _rules_sql(rules) -> str:
    return " UNION ALL ".join(_rule_sql(r) for r in rules)


add("check_staging", lambda b: qu.check_all(b.tables, rulesets.staging_rules(), b.parents), _rules_sql(rulesets.staging_rules()))
add("check_features", lambda b: qu.check_all(b.tables, rulesets.intermediate_rules(), b.parents), _rules_sql(rulesets.intermediate_rules()))
add("check_marts", lambda b: qu.check_all(b.tables, rulesets.mart_rules(), b.parents), _rules_sql(rulesets.mart_rules()))
add("expectations_tolerant", lambda b: qu.check(b.fact, rulesets.expectation_rules(True)), _rules_sql(rulesets.expectation_rules(True)))
add("expectations_strict", lambda b: qu.check(b.fact, rulesets.expectation_rules(False)), _rules_sql(rulesets.expectation_rules(False)))
_SUITE = _rules_sql(rulesets.expectation_rules(True))
add("suite_report", lambda b: qu.suite_report(qu.check(b.fact, rulesets.expectation_rules(True))), f"""
SELECT COUNT(*) AS rules, COUNT(*) FILTER (WHERE passed) AS passed, COUNT(*) FILTER (WHERE NOT passed) AS failed,
  COUNT(*) FILTER (WHERE NOT passed AND severity = 'error') AS failed_errors,
  COALESCE(STRING_AGG(rule_id, ',' ORDER BY rule_id) FILTER (WHERE NOT passed), '') AS failed_rules FROM ({_SUITE})""")
add("failed_check_severities", lambda b: qu.check_all(b.tables, rulesets.staging_rules(), b.parents).filter("NOT passed").groupBy("severity").agg(
    F.count(F.lit(1)).alias("rules"), F.sum("failed").alias("rows")),
    f"SELECT severity, COUNT(*) AS rules, CAST(SUM(failed) AS BIGINT) AS rows FROM ({_rules_sql(rulesets.staging_rules())}) WHERE NOT passed GROUP BY severity")
add("duplicated_application_ids", lambda b: qu.duplicated_values(b.raw["application_train"], "sk_id_curr"),
    "SELECT sk_id_curr, COUNT(*) AS copies FROM application_train WHERE sk_id_curr IS NOT NULL GROUP BY sk_id_curr HAVING COUNT(*) > 1")

# ---- alert, freshness, gates ----------------------------------------------------------------------

_ALERTS = {"negative_ratio": "credit_to_income_ratio < 0", "delinquency_above_one": "bureau_delinquency_rate > 1",
           "late_rate_above_one": "inst_late_rate > 1", "score_above_one": "composite_risk_score > 1", "score_below_zero": "composite_risk_score < 0",
           "flag_domain": "default_flag NOT IN (0, 1)", "segment_domain": "credit_risk_segment NOT IN ('LOW', 'MEDIUM', 'HIGH', 'VERY_HIGH')"}


def _alert_sql(names) -> str:
    text = ", ".join(f"CASE WHEN {_ALERTS[n]} THEN '{n}' END" for n in names)
    return f"SELECT applicant_id, concat_ws(',', {text}) AS broken FROM {FACT} WHERE " + " OR ".join(f"({_ALERTS[n]})" for n in names)


def _violations(b: Bound, strict: bool) -> DataFrame:
    return qu.domain_violations(b.fact, strict).select("applicant_id", F.array_join("broken", ",").alias("broken"))


add("domain_alert_strict", lambda b: _violations(b, True), _alert_sql(list(_ALERTS)))
add("domain_alert_tolerant", lambda b: _violations(b, False), _alert_sql(list(_ALERTS)[:5]))
add("alert_raised", lambda b: b.spark.createDataFrame([(qu.alert_raised(b.fact), qu.alert_raised(b.fact, False))], "strict boolean, tolerant boolean"),
    f"SELECT EXISTS ({_alert_sql(list(_ALERTS))}) AS strict, EXISTS ({_alert_sql(list(_ALERTS)[:5])}) AS tolerant")
add("source_freshness", lambda b: qu.freshness({"application_train": b.raw["application_train"], "boc_macro": b.raw["boc_macro"]},
                                               {"application_train": 30, "boc_macro": 3}, NOW), " UNION ALL ".join(
    f"""SELECT '{t}' AS source, strftime(MAX(loaded_at), '%Y-%m-%d %H:%M:%S') AS newest,
    {rnd(f"date_diff('second', MAX(loaded_at), TIMESTAMP '{NOW}') / CAST(86400 AS DOUBLE)", 4)} AS age_days,
    date_diff('second', MAX(loaded_at), TIMESTAMP '{NOW}') > {d} * 86400 AS stale FROM {t}""" for t, d in (("application_train", 30), ("boc_macro", 3))))
add("row_count_gates", lambda b: b.spark.createDataFrame(
    [(n, qu.row_count_gate(b.tables[t], k)) for n, t, k in (("raw_enough", "stg_application_train", 100), ("raw_short", "stg_application_train", 10**12),
                                                            ("features", "int_bureau_features", 1))], "gate string, open boolean"),
    """SELECT 'raw_enough' AS gate, COUNT(*) >= 100 AS open FROM stg_application_train
    UNION ALL SELECT 'raw_short', COUNT(*) >= 1000000000000 FROM stg_application_train UNION ALL SELECT 'features', COUNT(*) >= 1 FROM int_bureau_features""")

# ---- record validation ----------------------------------------------------------------------------


def _reasons_sql() -> str:
    checks = []
    for f, (default, low, high) in RECORD_BOUNDS.items():
        if default is None:
            checks.append(f"CASE WHEN {f} IS NULL THEN '{f}: missing' END")
        if low is not None:
            checks.append(f"CASE WHEN {f} < {low} THEN '{f}: below {low}' END")
        if high is not None:
            checks.append(f"CASE WHEN {f} > {high} THEN '{f}: above {high}' END")
    return f"concat_ws(',', {', '.join(checks)})"


def _records(b: Bound) -> DataFrame:
    """The fact's feature columns as scoring records, gaps and outliers included."""
    return b.fact.select("applicant_id", *RECORD_BOUNDS)


add("rejected_records", lambda b: qu.validate_records(_records(b), RECORD_BOUNDS)[1].select(
    "applicant_id", F.array_join("reasons", ",").alias("reasons")),
    f"SELECT * FROM (SELECT applicant_id, {_reasons_sql()} AS reasons FROM {FACT}) WHERE reasons <> ''")
add("valid_records", lambda b: qu.validate_records(_records(b), RECORD_BOUNDS)[0].select(
    "applicant_id", "ext_source_1", "ext_source_2", "ext_source_3", F.col("years_employed").cast("double").alias("years_employed"), "credit_to_income_ratio"),
    f"""SELECT applicant_id, COALESCE(ext_source_1, 0.5) AS ext_source_1, COALESCE(ext_source_2, 0.5) AS ext_source_2,
    COALESCE(ext_source_3, 0.5) AS ext_source_3, CAST(COALESCE(years_employed, 0) AS DOUBLE) AS years_employed, credit_to_income_ratio
    FROM {FACT} WHERE {_reasons_sql()} = ''""")

# ---- history --------------------------------------------------------------------------------------

# The first load sees only the versions handed in by the first day; the second sees all of them.
_DAY1, _DAY2 = "2024-01-01 06:00:00", "2024-01-02 06:00:00"
_SCORE_RATES = {"int_bureau_features": "bureau_delinquency_rate", "int_installment_features": "inst_late_rate",
                "int_credit_card_features": "cc_avg_utilization", "int_previous_application_features": "prev_refusal_rate"}


def _risk(b: Bound, until: str) -> DataFrame:
    """What the snapshot of a day sees: the fact's risk columns over the applications loaded by then.

    The score needs one rate of each roll-up, which do not differ by day: they are written once for both.
    """
    loaded = b.raw["application_train"].filter(F.col("loaded_at") <= F.lit(until).cast("timestamp_ntz"))
    rates = {n: b.written(f"{n}-rate", lambda n=n, rate=rate: b.ints[n].select("applicant_id", rate)) for n, rate in _SCORE_RATES.items()}
    defaults = {rate: FACT_DEFAULTS[rate] for rate in _SCORE_RATES.values()}
    fact = run.fact_of({"stg_application_train": stg_application(loaded)}, rates, defaults=defaults)
    return b.written(f"risk-{until[:10]}", lambda: hi.snapshot_source(fact))


def _history(b: Bound) -> DataFrame:
    first = hi.scd2_start(_risk(b, _DAY1), hi.RISK_KEY, hi.RISK_COLUMNS, _DAY1)
    return hi.scd2_apply(first, _risk(b, _DAY2), hi.RISK_KEY, hi.RISK_COLUMNS, _DAY2)


def _show(df: DataFrame) -> DataFrame:
    return df.select("applicant_id", "credit_risk_segment", "composite_risk_score", "is_current",
                     *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("valid_from", "valid_to")])


def _risk_sql(until: str) -> str:
    loaded = f"SELECT * FROM ({TABLES['application_train']}) WHERE loaded_at <= TIMESTAMP '{until}'"
    body = "SELECT applicant_id, credit_risk_segment, composite_risk_score FROM mart_credit_application_fact"
    return f"({compose(body, {'application_train': loaded})})"


_PAIRS = f"""SELECT o.applicant_id AS old_id, o.credit_risk_segment AS old_seg, o.composite_risk_score AS old_score, n.*,
    o.applicant_id IS NOT NULL AND n.applicant_id IS NOT NULL AND
      (o.credit_risk_segment IS DISTINCT FROM n.credit_risk_segment OR o.composite_risk_score IS DISTINCT FROM n.composite_risk_score) AS changed
  FROM {_risk_sql(_DAY1)} o FULL JOIN {_risk_sql(_DAY2)} n ON o.applicant_id = n.applicant_id"""
_HISTORY = f"""SELECT old_id AS applicant_id, old_seg AS credit_risk_segment, old_score AS composite_risk_score, NOT changed AS is_current,
  '{_DAY1}' AS valid_from, CASE WHEN changed THEN '{_DAY2}' END AS valid_to FROM ({_PAIRS}) WHERE old_id IS NOT NULL
UNION ALL SELECT applicant_id, credit_risk_segment, composite_risk_score, TRUE, '{_DAY2}', NULL FROM ({_PAIRS}) WHERE changed OR old_id IS NULL"""
add("risk_history", lambda b: _show(_history(b)), _HISTORY)
add("risk_history_unchanged_reload", lambda b: _show(hi.scd2_apply(
    _history(b), _risk(b, _DAY2), hi.RISK_KEY, hi.RISK_COLUMNS, "2024-01-03 06:00:00")), _HISTORY)
add("risk_history_as_of", lambda b: _show(hi.as_of(_history(b), "2024-01-01 18:00:00")),
    f"SELECT * FROM ({_HISTORY}) WHERE valid_from <= '2024-01-01 18:00:00' AND (valid_to IS NULL OR valid_to > '2024-01-01 18:00:00')")
