"""Shape of the physical plans: what shuffles, what is pushed down, what never meets in one task."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from riskmart.operators import features as feat
from riskmart.operators import staging as st
from riskmart.operators.ranking import exact_quantiles, with_ntile, with_running_total
from riskmart.plans import run
from riskmart.registry.bound import Bound
from riskmart.sources.tables import LayerStore

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fact_joins_reuse_the_applicant_partitioning(spark, no_broadcast):
    lines = plan(Bound(spark, SF).fact_plan()).split("\n")
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin [applicant_id" in line]
    assert len(joins) == 4
    # one shuffle by applicant per side (each side's own aggregation or dedup) and none for the joins
    by_applicant = [line for line in lines if re.search(r"Exchange hashpartitioning\((applicant_id|sk_id_curr)#\d+L, \d+\)", line)]
    assert len(by_applicant) == 5
    assert "SinglePartition" not in "\n".join(lines) and "CartesianProduct" not in "\n".join(lines)


def test_dedup_limits_rows_before_its_shuffle(spark):
    text = plan(st.stg_application(Bound(spark, SF).raw["application_train"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_balance_is_reduced_before_it_meets_the_credits(spark, no_broadcast):
    b = Bound(spark, SF)
    text = plan(feat.bureau_features(b.staged["stg_bureau"], b.staged["stg_bureau_balance"]))
    join = text.index("SortMergeJoin [bureau_id")
    assert "HashAggregate(keys=[bureau_id" in text[join:]
    # a shuffle follows the join, so adaptive execution may split a hot credit without adding one
    assert "Exchange hashpartitioning(applicant_id" in text[:join] and "~bureau_id" in text[:join]


def test_ranks_never_use_one_partition(spark):
    df = Bound(spark, SF).fact.select("applicant_id", "credit_risk_segment", "composite_risk_score")
    order = [F.col("composite_risk_score").asc_nulls_last(), F.col("applicant_id").asc()]
    for out in (with_ntile(df, 10, order), with_ntile(df, 10, order, ["credit_risk_segment"]), exact_quantiles(df, "composite_risk_score", [0.5]),
                with_running_total(df.withColumn("v", F.lit(1)), order, ["v"])):
        assert "SinglePartition" not in plan(out)


def test_hot_key_is_spread_by_the_rank(spark):
    """Nine rows of ten share the key, yet no partition of the sorted stage holds most of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20000, 1, 4).select("id", F.when(F.col("id") % 10 > 0, 1.0).otherwise(F.col("id").cast("double")).alias("k"))
        keys = [F.col("k").asc(), F.col("id").asc()]
        sizes = [r["count"] for r in df.repartitionByRange(*keys).groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 0.4 * 20000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_filters_and_columns_reach_the_scan(spark):
    b = Bound(spark, SF)
    text = plan(b.fact.filter(F.col("credit_risk_segment") == "HIGH").select("applicant_id"))
    assert "PushedFilters: [IsNotNull(credit_risk_segment), EqualTo(credit_risk_segment,HIGH)]" in text
    assert re.search(r"ReadSchema: struct<applicant_id:bigint,credit_risk_segment:string>", text)
    balance = plan(b.raw["bureau_balance"].groupBy("sk_id_bureau").count())
    assert "ReadSchema: struct<l_orderkey:bigint>" in balance


def test_whole_run(spark, tmp_path):
    b = Bound(spark, SF)
    store = LayerStore(spark, str(tmp_path / "wh"))
    raw = {n: b.raw[n] for n in b.raw}
    with pytest.raises(Exception, match="at least 300000 needed"):
        run.run_layers(raw, store)
    out = run.run_layers(raw, store, raw_rows_at_least=1, stop_on_failure=False, snapshot_at="2024-01-02")
    fact = out[run.FACT]
    assert fact.count() == out["stg_application_train"].count() and len(fact.columns) == 38
    assert out[run.SUMMARY].agg(F.sum("total_applications")).first()[0] == fact.count()
    for name in run.FEATURE_STEPS:
        assert out[name].groupBy("applicant_id").count().filter("count > 1").count() == 0
    assert out["check_results"].count() == 223
    again = run.run_layers(raw, store, raw_rows_at_least=1, checks=False, snapshot_at="2024-01-03")
    assert again["snap_application_risk"].count() == fact.count()  # nothing changed, nothing added


def test_checks_and_gates_build_only_the_tables_they_read(spark, monkeypatch):
    """Neither the staging checks nor the gates need the fact, and the gates need one roll-up."""
    import __spark_entry__ as entry
    from riskmart.registry import bound

    wrote, real = [], bound.stage
    monkeypatch.setattr(bound, "_written", {})
    monkeypatch.setattr(bound, "stage", lambda df, name: wrote.append(name) or real(df, name))
    assert entry.queries()["row_count_gates"](spark, SF).count() == 3
    assert wrote == ["int_bureau_features"]
    assert entry.queries()["check_staging"](spark, SF).count() > 0
    assert wrote == ["int_bureau_features", "reference-keys"]


def test_reference_keys_are_the_staged_applicants_without_a_sort(spark):
    b = Bound(spark, SF)
    keys = st.applicant_keys(b.raw["application_train"])
    assert sorted(keys.collect()) == sorted(b.staged["stg_application_train"].select("applicant_id").collect())
    assert "Window" not in plan(keys) and "ext_source" not in plan(keys)


def test_history_writes_no_fact_and_no_whole_roll_up(spark, monkeypatch):
    import __spark_entry__ as entry
    from riskmart.registry import bound

    wrote, real = {}, bound.stage
    monkeypatch.setattr(bound, "_written", {})
    monkeypatch.setattr(bound, "stage", lambda df, name: wrote.setdefault(name, df.columns) and real(df, name))
    assert entry.queries()["risk_history_as_of"](spark, SF).count() > 0
    assert all(len(c) == 2 for n, c in wrote.items() if n.endswith("-rate"))
    assert sorted(wrote) == ["int_bureau_features-rate", "int_credit_card_features-rate", "int_installment_features-rate",
                             "int_previous_application_features-rate", "risk-2024-01-01", "risk-2024-01-02"]


def test_instalment_join_moves_no_keys_of_parts_and_suppliers(spark, no_broadcast):
    from riskmart.sources.credit_binding import installments_payments

    text = plan(installments_payments(spark, SF))
    moved = text[text.index("SortMergeJoin"):].split("Exchange hashpartitioning(l_orderkey")[1]
    assert "shift" in moved.split("FileScan")[0]
    kept = text[text.index("SortMergeJoin"):].split("Project [l_orderkey")[1].split("\n")[0]
    assert "AS shift" in kept and not kept.split(" AS shift")[-1].count("l_suppkey")
