"""The whole run in dependency order: gate, staging, features, marts, checks, history."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from riskmart.operators import features as feat
from riskmart.operators.history import RISK_COLUMNS, RISK_KEY, scd2_apply, scd2_start, snapshot_source
from riskmart.operators.quality import check_all, require_passed, require_rows
from riskmart.operators.staging import STAGING
from riskmart.plans import rulesets
from riskmart.plans.marts import credit_fact, portfolio_summary, training_table
from riskmart.sources.raw_csv import load_delivery
from riskmart.sources.schemas import FILES, require_schema
from riskmart.sources.tables import LayerStore

FACT, SUMMARY, TRAINING = "mart_credit_application_fact", "mart_portfolio_summary", "ml_features_training"


def staged(raw: Mapping[str, DataFrame], now: datetime | None = None) -> dict[str, DataFrame]:
    return {name: step(raw[source], now) for name, (source, step) in STAGING.items()}


FEATURE_STEPS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "int_bureau_features": lambda s: feat.bureau_features(s["stg_bureau"], s["stg_bureau_balance"]),
    "int_installment_features": lambda s: feat.installment_features(s["stg_installments_payments"]),
    "int_credit_card_features": lambda s: feat.credit_card_features(s["stg_credit_card_balance"]),
    "int_previous_application_features": lambda s: feat.previous_application_features(s["stg_previous_application"]),
}


def features(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: step(stg) for name, step in FEATURE_STEPS.items()}


def fact_of(stg: Mapping[str, DataFrame], ints: Mapping[str, DataFrame], now: datetime | None = None, **options) -> DataFrame:
    return credit_fact(stg["stg_application_train"], ints["int_bureau_features"], ints["int_installment_features"],
                       ints["int_credit_card_features"], ints["int_previous_application_features"], now=now, **options)


def reference_keys(fact: DataFrame) -> dict[str, DataFrame]:
    """Key tables for reference checks. The written fact has exactly the staged applicants, and reading
    one column of it is cheaper than deduplicating the raw applications again for every check."""
    return {"stg_application_train": fact.select("applicant_id")}


class DeliveryError(RuntimeError):
    pass


def run_delivery(spark: SparkSession, folder: str, raw: str, store: LayerStore, now: datetime | None = None, **options) -> dict[str, DataFrame]:
    """The delivered files of ``folder`` to all layers.

    Every file is loaded into ``raw`` on its own with its load time, rows that break the schema go to quarantine beside
    their table. A file that cannot be loaded stops the run, which names it, before any layer is built; the tables of
    the others are there by then. Options as in :func:`run_layers`.
    """
    report = load_delivery(spark, folder, raw, now)
    failed = report.filter("status <> 'ok'").orderBy("table").collect()
    if failed:
        raise DeliveryError("; ".join(f"{r['table']}: {r['error']}" for r in failed))
    tables = {t: spark.read.parquet(f"{raw}/{t}") for t in FILES}
    for name, df in tables.items():
        require_schema(df, name)
    return run_layers(tables, store, now, **options)


def run_layers(raw: Mapping[str, DataFrame], store: LayerStore, now: datetime | None = None,
               raw_rows_at_least: int = 300_000, checks: bool = True, stop_on_failure: bool = True,
               snapshot_at: str | None = None) -> dict[str, DataFrame]:
    """Build every layer; each written layer is read back, so a later step never recomputes an earlier one.

    The raw gate runs before anything is built, the feature gate after the features exist. Failed checks
    of severity error raise (unless told not to) after all results are written.
    """
    require_rows(raw["application_train"], raw_rows_at_least, "application_train")
    out = {n: store.put("STAGING", n, df) for n, df in staged(raw, now).items()}
    for name, df in features(out).items():
        out[name] = store.put("INTERMEDIATE", name, df)
        require_rows(out[name], 1, name)
    out[FACT] = store.put("MARTS", FACT, fact_of(out, out, now), cluster_by=["credit_risk_segment", "default_flag"],
                          spread="applicant_id")
    out[SUMMARY] = store.put("MARTS", SUMMARY, portfolio_summary(out[FACT]))
    out[TRAINING] = store.put("ML_FEATURES", TRAINING, training_table(out[FACT]))
    if snapshot_at is not None:
        history = store.versioned("SNAPSHOTS", "snap_application_risk")
        rows = snapshot_source(out[FACT])
        out["snap_application_risk"] = history.replace(
            lambda cur: scd2_start(rows, RISK_KEY, RISK_COLUMNS, snapshot_at) if cur is None
            else scd2_apply(cur, rows, RISK_KEY, RISK_COLUMNS, snapshot_at))
    if checks:
        rules = rulesets.staging_rules() + rulesets.intermediate_rules() + rulesets.mart_rules()
        out["check_results"] = store.put("MARTS", "check_results", check_all(out, rules, reference_keys(out[FACT])))
        if stop_on_failure:
            require_passed(out["check_results"])
    return out
