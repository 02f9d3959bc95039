from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskmart.operators import features as feat
from riskmart.operators import staging as st
from riskmart.plans import marts

APPLICATION = ("sk_id_curr long, target int, name_contract_type string, code_gender string, flag_own_car string, flag_own_realty string, "
               "cnt_children int, amt_income_total double, amt_credit double, amt_annuity double, amt_goods_price double, ext_source_1 double, "
               "ext_source_2 double, ext_source_3 double, name_education_type string, name_family_status string, name_housing_type string, "
               "name_income_type string, occupation_type string, region_population_relative double, region_rating_client int, flag_work_phone int, "
               "flag_email int, cnt_fam_members double, days_birth int, days_employed int, days_registration double, days_id_publish int, loaded_at timestamp")
NAMES = [p.split()[0] for p in APPLICATION.split(", ")]


def application(spark, *changes):
    base = dict(sk_id_curr=1, target=0, name_contract_type="Cash loans", code_gender="F", flag_own_car="N", flag_own_realty="Y", cnt_children=0,
                amt_income_total=100000.0, amt_credit=150000.0, amt_annuity=None, amt_goods_price=None, ext_source_1=None, ext_source_2=0.4,
                ext_source_3=None, name_education_type="x", name_family_status="y", name_housing_type="z", name_income_type="w",
                occupation_type=None, region_population_relative=0.01, region_rating_client=2, flag_work_phone=0, flag_email=0,
                cnt_fam_members=None, days_birth=-14610, days_employed=-730, days_registration=-365.25, days_id_publish=731,
                loaded_at=datetime(2024, 1, 1))
    return spark.createDataFrame([tuple({**base, **c}[n] for n in NAMES) for c in changes], APPLICATION)


def test_application_filters_and_dedupes(spark, rows):
    raw = application(spark, {}, {"loaded_at": datetime(2024, 1, 2), "amt_credit": 200000.0}, {"sk_id_curr": 2, "amt_income_total": 0.0},
                      {"sk_id_curr": 3, "amt_income_total": None}, {"sk_id_curr": 4, "amt_credit": -1.0}, {"sk_id_curr": None})
    out = rows(st.stg_application(raw), "applicant_id")
    assert [(r["applicant_id"], r["loan_amount"]) for r in out] == [(1, 200000.0)]
    assert len(st.stg_application(raw).columns) == 31


def test_application_ties_do_not_depend_on_row_order(spark, rows):
    changes = [{"amt_credit": float(c)} for c in (300, 100, 200)]
    for order in (changes, changes[::-1], changes[1:] + changes[:1]):
        assert rows(st.stg_application(application(spark, *order)), "applicant_id")[0]["loan_amount"] == 100.0


def test_application_derived_columns(spark, rows):
    out = rows(st.stg_application(application(spark, {}, {"sk_id_curr": 2, "days_employed": 365243, "amt_credit": 150004.0})), "applicant_id")
    assert out[0]["age_years"] == 40 and out[0]["years_employed"] == 1
    assert out[0]["years_since_registration"] == 1.0 and out[0]["years_since_id_publish"] < 0
    assert out[1]["years_employed"] is None
    assert out[1]["credit_to_income_ratio"] == 1.5  # 1.50004 is rounded before it is compared
    assert out[1]["annuity_to_income_ratio"] is None


@pytest.mark.parametrize("due,paid,late,is_late", [(10.0, None, None, False), (10.0, 8.0, 0.0, False), (10.0, 15.0, 5.0, True)])
def test_installment_lateness(spark, due, paid, late, is_late):
    df = spark.createDataFrame([(1, 2, 1.0, 1, due, paid, 0.0, 50.0)], "sk_id_curr long, sk_id_prev long, num_instalment_version double, "
                               "num_instalment_number int, days_instalment double, days_entry_payment double, amt_instalment double, amt_payment double")
    row = st.stg_installments(df).first()
    assert (row["days_late"], row["is_late"], row["payment_ratio"]) == (late, is_late, None)


def test_staged_bureau_keeps_sign_of_future_dates(spark):
    df = spark.createDataFrame([(1, 2, "Active", "c", "t", -365, 365.25, None, None, None, None), (None, 3, "Active", "c", "t", 0, 0.0, 1.0, 1.0, 1.0, 1.0)],
                               "sk_id_curr long, sk_id_bureau long, credit_active string, credit_currency string, credit_type string, days_credit int, "
                               "days_credit_enddate double, amt_credit_sum double, amt_credit_sum_debt double, amt_credit_sum_overdue double, amt_credit_sum_limit double")
    out = st.stg_bureau(df).collect()
    assert len(out) == 1 and out[0]["years_to_credit_end"] == -1.0 and out[0]["credit_sum"] == 0.0


def bureau(spark, *credits):
    return spark.createDataFrame(list(credits), "applicant_id long, bureau_id long, credit_status string, years_since_credit_start double, "
                                                "credit_sum double, credit_debt double, credit_overdue double")


def balance(spark, *months):
    return spark.createDataFrame(list(months), "bureau_id long, status string")


def test_bureau_fanout_weights_credits_by_their_months(spark):
    b = bureau(spark, (1, 10, "Active", 2.0, 100.0, 5.0, 1.0), (1, 11, "Closed", 6.0, 10.0, 0.0, 0.0))
    m = balance(spark, (10, "0"), (10, "0"), (10, "0"))
    r = feat.bureau_features(b, m).first()
    assert (r["bureau_num_records"], r["bureau_active_credits"], r["bureau_closed_credits"], r["bureau_total_credit"]) == (2, 3, 1, 310.0)
    assert r["bureau_avg_credit_age_yrs"] == 3.0 and r["bureau_total_debt"] == 15.0
    s = feat.bureau_features(b, m, fanout_safe=True).first()
    assert (s["bureau_num_records"], s["bureau_active_credits"], s["bureau_closed_credits"], s["bureau_total_credit"]) == (2, 1, 1, 110.0)
    assert s["bureau_avg_credit_age_yrs"] == 4.0


def test_bureau_delinquency_from_mixed_statuses(spark):
    b = bureau(spark, (1, 10, "Active", None, 0.0, 0.0, 0.0), (1, 11, "Sold", None, 0.0, 0.0, 0.0))
    r = feat.bureau_features(b, balance(spark, *[(10, s) for s in "015CX"])).first()
    assert (r["bureau_worst_delinquency"], r["bureau_delinquency_rate"], r["bureau_avg_credit_age_yrs"]) == (5, 0.3333, 0.0)


def test_bureau_features_equal_the_plain_join(spark):
    """Random credits and months, one credit with most of the months, against join-then-group in SQL."""
    credits = spark.range(200).select((F.col("id") % 17).alias("applicant_id"), (F.col("id") % 190).alias("bureau_id"),
                                      F.element_at(F.array(F.lit("Active"), F.lit("Closed"), F.lit("Sold")), (F.col("id") % 3 + 1).cast("int")).alias("credit_status"),
                                      F.when(F.col("id") % 7 > 0, F.col("id") / 10.0).alias("years_since_credit_start"),
                                      (F.col("id") * 1.5).alias("credit_sum"), (F.col("id") - 50.0).alias("credit_debt"), F.lit(1.0).alias("credit_overdue"))
    months = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 150).alias("bureau_id"),
                                      F.element_at(F.split(F.lit("0 1 2 3 4 5 C X 7"), " "), (F.col("id") % 9 + 1).cast("int")).alias("status"))
    months = months.withColumn("status", F.when(F.rand(1) > 0.1, F.col("status")))
    months = spark.createDataFrame(months.collect(), months.schema)  # fix the random statuses
    credits.createOrReplaceTempView("t_credits")
    months.createOrReplaceTempView("t_months")
    want = spark.sql("""
        SELECT c.applicant_id, count(DISTINCT c.bureau_id) AS a, sum(if(credit_status = 'Active', 1, 0)) AS b, sum(if(credit_status = 'Closed', 1, 0)) AS c,
          round(sum(credit_sum), 4) AS d, round(sum(credit_debt), 4) AS e, round(coalesce(avg(years_since_credit_start), 0), 6) AS f,
          max(CASE WHEN status IN ('1','2','3','4','5') THEN int(status) ELSE 0 END) AS g, round(avg(CASE WHEN status NOT IN ('0','X','C') THEN 1.0D ELSE 0.0D END), 4) AS h
        FROM t_credits c LEFT JOIN t_months m ON c.bureau_id = m.bureau_id GROUP BY c.applicant_id""")
    got = feat.bureau_features(credits, months).select(
        "applicant_id", F.col("bureau_num_records").alias("a"), F.col("bureau_active_credits").alias("b"), F.col("bureau_closed_credits").alias("c"),
        F.round("bureau_total_credit", 4).alias("d"), F.round("bureau_total_debt", 4).alias("e"), F.round("bureau_avg_credit_age_yrs", 6).alias("f"),
        F.col("bureau_worst_delinquency").alias("g"), F.col("bureau_delinquency_rate").alias("h"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_card_without_limit_has_no_utilization(spark):
    df = spark.createDataFrame([(1, 50.0, 0.0, None, 0), (1, 70.0, 0.0, None, 3)], "applicant_id long, balance double, credit_limit_actual double, "
                                                                                   "drawings_current double, days_past_due_def int")
    r = feat.credit_card_features(df).first()
    assert (r["cc_num_months"], r["cc_avg_utilization"], r["cc_max_utilization"], r["cc_avg_monthly_drawings"], r["cc_months_overdue"]) == (2, 0.0, 0.0, 0.0, 1)


def test_installment_features(spark):
    df = spark.createDataFrame([(1, True, 5.0, 0.5, 100.0, 50.0), (1, False, None, None, 100.0, None), (1, False, 0.0, 1.0, 100.0, 120.0)],
                               "applicant_id long, is_late boolean, days_late double, payment_ratio double, amount_due double, amount_paid double")
    r = feat.installment_features(df).first()
    assert (r["inst_num_payments"], r["inst_late_count"], r["inst_late_rate"], r["inst_max_days_late"]) == (3, 1, 0.3333, 5.0)
    assert (r["inst_avg_days_late"], r["inst_avg_payment_ratio"], r["inst_total_underpaid"]) == (2.5, 0.75, 50.0)


def test_fact_defaults_without_history(spark):
    app = st.stg_application(application(spark, {"days_employed": 365243}))
    b = feat.bureau_features(bureau(spark, (9, 10, "Active", 2.0, 100.0, 5.0, 1.0)), balance(spark, (10, "0")))
    i = feat.installment_features(spark.createDataFrame([], "applicant_id long, is_late boolean, days_late double, payment_ratio double, amount_due double, amount_paid double"))
    c = feat.credit_card_features(spark.createDataFrame([], "applicant_id long, balance double, credit_limit_actual double, drawings_current double, days_past_due_def int"))
    p = feat.previous_application_features(spark.createDataFrame([], "applicant_id long, contract_status string, amount_credited double, annuity double, years_since_decision double"))
    fact = marts.credit_fact(app, b, i, c, p)
    r = fact.first()
    assert len(fact.columns) == 38 and fact.count() == 1
    assert r["inst_avg_payment_ratio"] == 1.0 and r["bureau_active_credits"] == 0 and r["prev_approved"] == 0
    assert r["credit_risk_segment"] == "LOW" and r["composite_risk_score"] == 0.03 and r["years_employed"] is None
    t = marts.training_table(fact).first()
    assert (t["ext_source_1"], t["ext_source_2"], t["years_employed"]) == (0.5, 0.4, 0) and len(t) == 20


def test_training_table_has_only_labelled_rows(spark):
    fact = spark.createDataFrame([(1, 0), (2, None)], "applicant_id long, default_flag int")
    assert [r["applicant_id"] for r in marts.labelled_rows(fact).collect()] == [1]


def test_summary_counts_add_up(spark):
    fact = spark.range(100).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("loan_type"), F.lit("e").alias("education_level"), F.lit("LOW").alias("credit_risk_segment"),
        F.lit("F").alias("gender"), F.lit("w").alias("income_type"), (F.col("id") % 10 == 0).cast("int").alias("default_flag"),
        F.col("id").cast("double").alias("loan_amount"), F.lit(2.0).alias("annual_income"), F.lit(1.0).alias("credit_to_income_ratio"),
        F.lit(0.1).alias("composite_risk_score"))
    out = marts.portfolio_summary(fact).collect()
    assert sum(r["total_applications"] for r in out) == 100 and sum(r["total_defaults"] for r in out) == 10
