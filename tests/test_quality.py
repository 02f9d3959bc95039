from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskmart.constants import RECORD_BOUNDS
from riskmart.operators import quality as qu
from riskmart.operators.quality import WARN, Rule
from riskmart.plans import rulesets


def results(df, rules, parents=None):
    return {r["rule_id"].split(".", 1)[1]: r for r in qu.check(df, rules, parents).collect()}


def test_rule_counts():
    assert [len(r) for r in (rulesets.staging_rules(), rulesets.intermediate_rules(), rulesets.mart_rules())] == [57, 63, 103]
    assert len(rulesets.expectation_rules()) == 54
    warned = [r.rule_id for r in rulesets.intermediate_rules() if r.severity == WARN]
    assert "int_credit_card_features.cc_avg_utilization.between" in warned


def test_row_rules_and_null_handling(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "z", -1.0), (None, None, None), (2, "a", 9.0)], "id int, code string, v double")
    r = results(df, [Rule("t", "id", "not_null"), Rule("t", "id", "unique"), Rule("t", "code", "accepted_values", params={"values": ("a", "b")}),
                     Rule("t", "v", "expression", params={"op": ">=", "value": 0}), Rule("t", "v", "between", params={"low": 0, "high": 5}),
                     Rule("t", "code", "length_between", params={"low": 1, "high": 1}), Rule("t", "*", "row_count", params={"low": 4, "high": 4}),
                     Rule("t", "v", "mean_between", params={"low": 4, "high": 5}), Rule("t", "v", "median_between", params={"low": 0, "high": 4})])
    assert {k: (x["failed"], x["passed"]) for k, x in r.items()} == {
        "id.not_null": (1, False), "id.unique": (1, False), "code.accepted_values": (1, False), "v.expression": (1, False), "v.between": (2, False),
        "code.length_between": (0, True), "*.row_count": (0, True), "v.mean_between": (0, True), "v.median_between": (0, False)}
    assert r["v.median_between"]["observed"] == 5.0 and r["*.row_count"]["observed"] == 4.0


@pytest.mark.parametrize("outside,passed", [(5, True), (6, False)])
def test_mostly(spark, outside, passed):
    df = spark.range(110).select(F.when(F.col("id") < outside, -1.0).when(F.col("id") < 100, 1.0).alias("v"))
    r = results(df, [Rule("t", "v", "between", params={"low": 0, "high": None, "mostly": 0.95})])["v.between"]
    assert (r["total"], r["failed"], r["passed"]) == (100, outside, passed)


def test_relationships_count_rows_and_skip_nulls(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "p int")
    r = results(child, [Rule("c", "k", "relationships", params={"to": "parent", "field": "p"})], {"parent": parent})["k.relationships"]
    assert (r["failed"], r["total"], r["passed"]) == (2, 4, False)


def test_row_rules_and_a_reference_share_one_scan_of_the_child(spark, tmp_path):
    spark.createDataFrame([(1, 5), (9, -1), (9, None), (None, -2)], "k int, v int").write.parquet(str(tmp_path / "c"))
    child, parent = spark.read.parquet(str(tmp_path / "c")), spark.createDataFrame([(1,), (2,), (2,)], "p int")
    rules = [Rule("c", "k", "not_null"), Rule("c", "k", "relationships", params={"to": "parent", "field": "p"}), Rule("c", "v", "not_null"),
             Rule("c", "v", "expression", params={"op": ">=", "value": 0})]
    for df, want in ((child, {"k.not_null": (1, 4), "k.relationships": (2, 4), "v.not_null": (1, 4), "v.expression": (2, 4)}),
                     (child.limit(0), dict.fromkeys(("k.not_null", "k.relationships", "v.not_null", "v.expression"), (0, 0)))):
        assert {n: (r["failed"], r["total"]) for n, r in results(df, rules, {"parent": parent}).items()} == want
    assert qu.check(child, rules, {"parent": parent})._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_all_row_rules_share_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "id AS b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [Rule("t", c, k, params=p) for c in "ab" for k, p in (("not_null", {}), ("expression", {"op": ">", "value": 0}), ("between", {"low": 0, "high": 5}))]
    plan = qu.check(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_severity_decides_whether_the_run_stops(spark):
    df = spark.createDataFrame([(None,)], "a int")
    qu.require_passed(qu.check(df, [Rule("t", "a", "not_null", WARN)]))
    with pytest.raises(qu.DataQualityError, match="t.a.not_null"):
        qu.require_passed(qu.check(df, [Rule("t", "a", "not_null")]))


def test_report(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    r = qu.suite_report(qu.check(df, [Rule("t", "a", "not_null"), Rule("t", "b", "not_null"), Rule("t", "a", "unique", WARN)])).first()
    assert (r["rules"], r["passed"], r["failed"], r["failed_errors"], r["failed_rules"]) == (3, 2, 1, 1, "t.a.not_null")


def fact_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "applicant_id int, credit_to_income_ratio double, bureau_delinquency_rate double, inst_late_rate double, "
                                             "composite_risk_score double, default_flag int, credit_risk_segment string")


def test_domain_alert(spark):
    fine, unknown = (1, 1.0, 0.0, 0.0, 0.5, 0, "LOW"), (2, None, None, None, None, None, None)
    bad, odd = (3, -1.0, 0.0, 2.0, 0.5, 0, "LOW"), (4, 1.0, 0.0, 0.0, 0.5, 7, "NONE")
    out = {r["applicant_id"]: r["broken"] for r in qu.domain_violations(fact_rows(spark, fine, unknown, bad, odd)).collect()}
    assert out == {3: ["negative_ratio", "late_rate_above_one"], 4: ["flag_domain", "segment_domain"]}
    assert not qu.alert_raised(fact_rows(spark, fine, unknown))
    assert qu.alert_raised(fact_rows(spark, odd)) and not qu.alert_raised(fact_rows(spark, odd), strict=False)


@pytest.mark.parametrize("rows,threshold,open_", [(15, 10, True), (5, 10, False), (10, 10, True), (0, 1, False)])
def test_row_count_gate(spark, rows, threshold, open_):
    assert qu.row_count_gate(spark.range(rows), threshold) is open_
    if not open_:
        with pytest.raises(qu.RowCountError, match=f"{rows} rows"):
            qu.require_rows(spark.range(rows), threshold)


def test_freshness(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS loaded_at")
    empty = df.filter("false")
    out = {r["source"]: r["stale"] for r in qu.freshness({"a": df, "b": df, "c": empty}, {"a": 30, "b": 3, "c": 3}, "2024-01-10 00:00:00").collect()}
    assert out == {"a": False, "b": True, "c": True}


FIELDS = ", ".join(f"{f} double" for f in RECORD_BOUNDS)


def record(spark, **values):
    return spark.createDataFrame([tuple(values.get(f) for f in RECORD_BOUNDS)], FIELDS)


OK = {"credit_to_income_ratio": 1.5, "annuity_to_income_ratio": 0.1, "age_years": 45.0}


def test_minimal_record_takes_defaults(spark):
    valid, rejected = qu.validate_records(record(spark, **OK), RECORD_BOUNDS)
    r = valid.first()
    assert rejected.count() == 0
    assert (r["ext_source_1"], r["inst_avg_payment_ratio"], r["cc_avg_utilization"], r["age_years"]) == (0.5, 1.0, 0.0, 45.0)


@pytest.mark.parametrize("change,reason", [({"age_years": None}, "age_years: missing"), ({"ext_source_1": 1.5}, "ext_source_1: above 1"),
                                           ({"age_years": 16.0}, "age_years: below 18"), ({"years_employed": -1.0}, "years_employed: below 0")])
def test_invalid_records_are_rejected_with_reasons(spark, change, reason):
    valid, rejected = qu.validate_records(record(spark, **{**OK, **change}), RECORD_BOUNDS)
    assert valid.count() == 0 and rejected.first()["reasons"] == [reason]
