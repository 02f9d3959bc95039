"""Sources, sinks, loading, layers and the streaming jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.constants import FEATURES, MACRO_SERIES, RECORD_BOUNDS
from riskmart.operators import ml
from riskmart.operators import staging as st
from riskmart.operators.analytics import load_counts
from riskmart.plans import run
from riskmart.registry.bound import Bound, cast_long
from riskmart.registry.catalog import add
from riskmart.registry.queries_models import _FACT_SQL, _fact_output
from riskmart.registry.queries_reports import _DECIDED, _TIERED
from riskmart.registry.queries_rules import _ALERTS, _alert_sql, _reasons_sql
from riskmart.registry.sql import TABLES, rnd
from riskmart.session import scratch_path, stage
from riskmart.sources import macro_json as mj
from riskmart.sources import raw_csv as rc
from riskmart.sources.credit_binding import RAW_TABLES
from riskmart.sources.schemas import DDL, FILES, raw_schema
from riskmart.sources.tables import LayerStore, VersionedTable, feature_store_summary, write_csv
from riskmart.streaming import jobs, requests

# ---- CSV ------------------------------------------------------------------------------------------

_PREVIOUS = T.StructType([
    T.StructField("sk_id_prev", T.LongType()), T.StructField("sk_id_curr", T.LongType()), T.StructField("name_contract_status", T.StringType()),
    T.StructField("remark", T.StringType()), T.StructField("amt_credit", T.DoubleType()), T.StructField("days_decision", T.LongType())])


def _previous(b: Bound) -> DataFrame:
    """Columns with quotes, separators and NULLs in them."""
    remark = F.when(F.col("sk_id_prev") % 3 == 0, F.concat(F.lit('said "'), "name_yield_group", F.lit('", then left')))
    return b.raw["previous_application"].select("sk_id_prev", "sk_id_curr", "name_contract_status", remark.alias("remark"), "amt_credit",
                                                F.col("days_decision").cast("long").alias("days_decision"))


_PREVIOUS_SQL = """SELECT sk_id_prev, sk_id_curr, name_contract_status,
  CASE WHEN sk_id_prev % 3 = 0 THEN 'said "' || name_yield_group || '", then left' END AS remark, amt_credit,
  CAST(days_decision AS BIGINT) AS days_decision FROM previous_application"""


def _csv_of(b: Bound, df: DataFrame, name: str) -> str:
    path = scratch_path(b.spark, name)
    write_csv(df, path)
    return path


def _with_bad_text(df: DataFrame) -> DataFrame:
    """NULLs spelled out, and some amounts that are no numbers."""
    dirty = F.when(F.col("name_contract_status") == "Canceled", F.lit("n/a")).otherwise(
        F.coalesce(F.col("amt_credit").cast("string"), F.lit("NULL")))
    return df.withColumn("amt_credit", dirty).withColumn("remark", F.coalesce("remark", F.lit("null")))


add("csv_scan", lambda b: rc.read_raw_csv(b.spark, _csv_of(b, _previous(b), "csv"), _PREVIOUS)[0], _PREVIOUS_SQL)
add("csv_sink", lambda b: rc.read_text(b.spark, _csv_of(b, _previous(b).select("sk_id_prev", "name_contract_status"), "csv"),
                                       ["sk_id_prev", "name_contract_status"]),
    "SELECT CAST(sk_id_prev AS VARCHAR) AS sk_id_prev, name_contract_status FROM previous_application")
add("csv_null_tokens_and_good_rows", lambda b: rc.read_raw_csv(b.spark, _csv_of(b, _with_bad_text(_previous(b)), "csv"), _PREVIOUS)[0],
    f"SELECT * FROM ({_PREVIOUS_SQL}) WHERE name_contract_status <> 'Canceled'")
add("csv_quarantine", lambda b: rc.read_raw_csv(b.spark, _csv_of(b, _with_bad_text(_previous(b)), "csv"), _PREVIOUS)[1].select(
    "sk_id_prev", "amt_credit", F.array_join("reasons", ",").alias("reasons")),
    """SELECT CAST(sk_id_prev AS VARCHAR) AS sk_id_prev, 'n/a' AS amt_credit, 'amt_credit is no double' AS reasons
    FROM previous_application WHERE name_contract_status = 'Canceled'""")


def _delivered(b: Bound) -> DataFrame:
    """A delivered file: upper-case header, columns in another order, columns nobody reads."""
    raw = b.raw["installments_payments"].withColumn("unused", F.lit("x"))
    shuffled = raw.select(*[F.col(c).alias(c.upper()) for c in sorted(raw.columns, reverse=True)])
    good, _ = rc.read_delivered_csv(b.spark, _csv_of(b, shuffled, "csv"), raw_schema("installments_payments"))
    return cast_long(good, "num_instalment_number")


add("csv_delivered_file", _delivered, """SELECT sk_id_curr, sk_id_prev, num_instalment_version, CAST(num_instalment_number AS BIGINT) AS num_instalment_number,
  days_instalment, days_entry_payment, amt_instalment, amt_payment FROM installments_payments""")


def _ragged(b: Bound) -> DataFrame:
    """Lines of two, three and four fields read as three."""
    d = b.raw["previous_application"]
    line = F.when(F.col("name_client_type") == "New", F.concat_ws(",", "sk_id_prev", "sk_id_curr")).when(
        F.col("name_portfolio") == "Cards", F.concat_ws(",", "sk_id_prev", "sk_id_curr", "channel_type", "name_portfolio")).otherwise(
        F.concat_ws(",", "sk_id_prev", "sk_id_curr", "channel_type"))
    path = scratch_path(b.spark, "ragged")
    d.select(line.alias("value")).write.text(path)
    return b.spark.read.schema(rc.text_schema(["sk_id_prev", "sk_id_curr", "channel_type"])).option("mode", "PERMISSIVE").csv(path)


add("csv_ragged_rows", _ragged, """SELECT CAST(sk_id_prev AS VARCHAR) AS sk_id_prev, CAST(sk_id_curr AS VARCHAR) AS sk_id_curr,
  CASE WHEN name_client_type <> 'New' THEN channel_type END AS channel_type FROM previous_application""")
add("csv_schema_inference", lambda b: b.spark.createDataFrame(
    [(f.name, f.dataType.simpleString()) for f in rc.infer_table_schema(b.spark, _csv_of(b, b.raw["bureau"], "csv"))], "name string, type string"),
    " UNION ALL ".join(f"""SELECT '{c.upper()}' AS name, CASE
  WHEN COUNT(*) > 0 AND COUNT(*) FILTER (WHERE regexp_full_match(CAST({c} AS VARCHAR), '-?[0-9]+')) = COUNT(*) THEN 'bigint'
  WHEN COUNT({c}) = COUNT(TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)) THEN 'double' ELSE 'string' END AS type FROM bureau"""
                       for c in (field.split()[0] for field in DDL["bureau"].split(","))))
add("audit_column", lambda b: rc.with_loaded_at(b.raw["bureau_balance"], datetime(2024, 1, 2, 3, 4, 5)).groupBy("loaded_at").agg(
    F.count(F.lit(1)).alias("rows")).select("rows"), "SELECT COUNT(*) AS rows FROM bureau_balance")


def _refresh(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "refresh")
    rc.full_refresh(b.raw["pos_cash_balance"], path)
    rc.full_refresh(b.raw["bureau_balance"], path)
    return cast_long(b.spark.read.parquet(path), "months_balance")


add("full_refresh", _refresh, "SELECT sk_id_bureau, CAST(months_balance AS BIGINT) AS months_balance, status FROM bureau_balance")


def _load_many(b: Bound) -> DataFrame:
    loads = {n: (lambda n=n: b.raw[n]) for n in RAW_TABLES}
    loads["application_test"] = lambda: b.spark.read.parquet(f"{b.sf_dir}/no_such_table.parquet")
    return rc.load_many(b.spark, loads, scratch_path(b.spark, "load")).select("table", "status", "rows")


_COUNTS = " UNION ALL ".join(f"SELECT '{n.upper()}' AS tbl, COUNT(*) AS rows FROM {n}" for n in RAW_TABLES)
add("multi_table_load", _load_many, f"""SELECT LOWER(tbl) AS "table", 'ok' AS status, rows FROM ({_COUNTS})
  UNION ALL SELECT 'application_test', 'failed', NULL""")
add("load_validation", lambda b: load_counts(b.raw), _COUNTS)

# ---- macro observations ---------------------------------------------------------------------------


def _payloads(b: Bound) -> DataFrame:
    """One JSON payload per day; a missing ten-year yield arrives as text, other gaps are left out."""
    values = {code: F.col(name).cast("string") for code, name in MACRO_SERIES.items()}
    values["BD.CDN.10YR.DQ.YLD"] = F.coalesce(values["BD.CDN.10YR.DQ.YLD"], F.lit("not available"))
    objects = [F.when(v.isNotNull(), F.struct(v.alias("v"))).alias(code) for code, v in values.items()]
    one = F.struct(F.col("date").alias("d"), *objects, F.lit("preliminary").alias("note"))
    return b.raw["boc_macro"].select(F.to_json(F.struct(F.array(one).alias("observations"))).alias("payload"))


def _observations(b: Bound) -> DataFrame:
    """Observations of the landed payloads."""
    return mj.observations(mj.parse_payloads(stage(_payloads(b), "payloads")))


_LONG_SQL = " UNION ALL ".join(
    f"SELECT date AS obs_date, '{code}' AS series, {name} AS value FROM boc_macro" + ("" if name == "bond_10yr" else f" WHERE {name} IS NOT NULL")
    for code, name in MACRO_SERIES.items())
_WIDE = ("overnight_rate", "bond_2yr", "bond_10yr", "cadusd", "cpi_total")
add("json_observations", lambda b: _observations(b).select("obs_date", "series", F.col("value").isNotNull().alias("has_text")),
    f"SELECT obs_date, series, TRUE AS has_text FROM ({_LONG_SQL})")
add("numeric_coercion", lambda b: mj.to_numbers(_observations(b)), _LONG_SQL)
add("macro_wide_merge", lambda b: mj.merge_series(_observations(b)), f"SELECT date, {', '.join(_WIDE)} FROM boc_macro")


def _outer_chain(b: Bound) -> DataFrame:
    """The same table as a chain of full outer joins, one series at a time."""
    long, out = mj.to_numbers(_observations(b)), None
    for code, name in MACRO_SERIES.items():
        one = long.filter(F.col("series") == code).select(F.col("obs_date").alias("date"), F.col("value").alias(name))
        out = one if out is None else out.join(one, "date", "full")
    return out


add("macro_full_outer_joins", _outer_chain, f"SELECT date, {', '.join(_WIDE)} FROM boc_macro")
add("macro_profile", lambda b: mj.series_profile(mj.merge_series(_observations(b))), " UNION ALL ".join(
    f"""SELECT '{c}' AS series, COUNT(*) AS rows, MIN(date) AS first_date, MAX(date) AS last_date,
    {rnd(f'CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*)', 3)} AS null_rate FROM boc_macro""" for c in _WIDE))
add("macro_pivot_of_seen_series", lambda b: mj.pivot_seen(mj.to_numbers(_observations(b))).select(
    "obs_date", *[F.col(f"`{code}`").alias(name) for code, name in MACRO_SERIES.items()]),
    f"SELECT date AS obs_date, {', '.join(_WIDE)} FROM boc_macro")


def _incremental(b: Bound) -> DataFrame:
    wide = b.raw["boc_macro"].select(F.col("date").alias("obs_date"), "overnight_rate", "cadusd")
    held = wide.filter(F.col("obs_date") < "2000-01-01")
    revised = mj.since(wide, "1999-07-01").withColumn("overnight_rate", F.col("overnight_rate") + 1)
    return mj.upsert(held, revised, "obs_date")


add("macro_incremental_upsert", _incremental, """SELECT date AS obs_date,
  CASE WHEN date >= '1999-07-01' THEN overnight_rate + CAST(1 AS DOUBLE) ELSE overnight_rate END AS overnight_rate, cadusd FROM boc_macro""")

# ---- layers ---------------------------------------------------------------------------------------


def _sink(b: Bound) -> DataFrame:
    store = LayerStore(b.spark, scratch_path(b.spark, "layers"))
    return store.put("marts", "features", b.ints["int_credit_card_features"]).select("applicant_id", "cc_num_months", "cc_months_overdue")


add("table_sink", _sink, "SELECT applicant_id, cc_num_months, cc_months_overdue FROM int_credit_card_features")


def _layered(b: Bound) -> DataFrame:
    store = LayerStore(b.spark, scratch_path(b.spark, "layers"))
    store.put("staging", "card", b.staged["stg_credit_card_balance"])
    store.put(" intermediate ", "card_months", store.get("STAGING", "card").groupBy("applicant_id").agg(F.count(F.lit(1)).alias("months")))
    return store.get("INTERMEDIATE", "card_months")


add("layered_tables", _layered, "SELECT applicant_id, COUNT(*) AS months FROM stg_credit_card_balance GROUP BY applicant_id")


def _clustered(b: Bound) -> DataFrame:
    store = LayerStore(b.spark, scratch_path(b.spark, "layers"))
    return _fact_output(store.put("MARTS", "fact", b.fact, ["credit_risk_segment", "default_flag"], "applicant_id"))


add("clustered_fact", _clustered, _FACT_SQL)
add("feature_store_summary", lambda b: cast_long(feature_store_summary(b.training.toDF(*[c.upper() for c in b.training.columns])), "columns"),
    f"SELECT COUNT(*) AS rows, CAST(20 AS BIGINT) AS columns, {rnd('AVG(label)', 6)} AS default_rate FROM ml_features_training")


def _delivered_run(b: Bound) -> DataFrame:
    """The fact of a run from delivered files, one for each raw table, upper-case and with the columns in another order."""
    folder = scratch_path(b.spark, "delivery")
    for table, file in FILES.items():
        df = b.raw[table]
        if table == "application_train":  # a delivery holds one row per application
            df = st.dedupe_latest(df, ["sk_id_curr"], [F.col("loaded_at").desc()])
        df = df.drop("loaded_at")
        write_csv(df.select(*[F.col(c).alias(c.upper()) for c in sorted(df.columns, reverse=True)]), f"{folder}/{file}")
    out = run.run_delivery(b.spark, folder, scratch_path(b.spark, "raw"), LayerStore(b.spark, scratch_path(b.spark, "run")),
                           raw_rows_at_least=1, stop_on_failure=False)
    return _fact_output(out[run.FACT])


add("delivered_run", _delivered_run, _FACT_SQL)


def _run(b: Bound) -> DataFrame:
    """Rows per table after a whole run. Failed checks are reported as data here."""
    store = LayerStore(b.spark, scratch_path(b.spark, "run"))
    out = run.run_layers({n: b.raw[n] for n in b.raw}, store, raw_rows_at_least=1, stop_on_failure=False, snapshot_at="2024-01-02 00:00:00")
    return load_counts({n: df for n, df in out.items() if not n.startswith("stg_")})


_RUN_TABLES = [t for t in TABLES if t.startswith(("int_", "mart_", "ml_"))]
add("layered_run", _run, " UNION ALL ".join(f"SELECT '{t.upper()}' AS tbl, COUNT(*) AS rows FROM {t}" for t in _RUN_TABLES)
    + " UNION ALL SELECT 'SNAP_APPLICATION_RISK', COUNT(*) FROM mart_credit_application_fact UNION ALL SELECT 'CHECK_RESULTS', 223")

# ---- streaming ------------------------------------------------------------------------------------


def _stream_csv(b: Bound) -> DataFrame:
    base, source = scratch_path(b.spark, "stream"), _csv_of(b, _with_bad_text(_previous(b)), "csv")
    jobs.ingest_csv(b.spark, source, _PREVIOUS, f"{base}/good", f"{base}/bad", f"{base}/checkpoint").awaitTermination()
    return b.spark.read.schema(_PREVIOUS).option("recursiveFileLookup", True).parquet(f"{base}/good")


add("stream_csv_ingest", _stream_csv, f"SELECT * FROM ({_PREVIOUS_SQL}) WHERE name_contract_status <> 'Canceled'")


def _stream_macro(b: Bound) -> DataFrame:
    base = scratch_path(b.spark, "stream")
    _payloads(b).select(F.col("payload").alias("value")).write.text(f"{base}/in")
    target = VersionedTable(b.spark, f"{base}/macro")
    jobs.upsert_macro(b.spark, f"{base}/in", target, f"{base}/checkpoint").awaitTermination()
    return target.read().drop("_at", "_file")


add("stream_macro_upsert", _stream_macro, _LONG_SQL)


def _stream_of(df: DataFrame, base: str) -> DataFrame:
    df.write.parquet(f"{base}/in")
    return df.sparkSession.readStream.schema(df.schema).parquet(f"{base}/in")


def _stream_alert(b: Bound) -> DataFrame:
    base = scratch_path(b.spark, "stream")
    jobs.alert_rows(_stream_of(b.fact, base), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return b.spark.read.parquet(f"{base}/out").select("applicant_id", F.array_join("broken", ",").alias("broken"))


add("stream_domain_alert", _stream_alert, _alert_sql(list(_ALERTS)))


def _stream_score(b: Bound) -> DataFrame:
    """Each event is a scoring request with its user's figures; every one is answered."""
    base = scratch_path(b.spark, "stream")
    records = b.fact.select(F.col("applicant_id").alias("user_id"), *[F.col(f).cast("double").alias(f) for f in FEATURES])
    asked = b.source("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("event_time")).join(records, "user_id")
    answers = requests.answer_requests(_stream_of(asked, base), lambda d: ml.with_tier(
        d.withColumn("score", F.col("composite_risk_score") / F.lit(3.0))).drop("score"), "event_id", "event_time")
    requests.write_answers(answers, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return b.spark.read.parquet(f"{base}/out").select(
        F.col("request_id").cast("long").alias("event_id"), "status", F.array_join("reasons", ",").alias("reasons"),
        F.col("scored_by").cast("long").alias("scored_by"), "default_probability", "risk_tier", "decision")


_FILLED = ", ".join(f"COALESCE(CAST({f} AS DOUBLE), {RECORD_BOUNDS[f][0]})" if RECORD_BOUNDS[f][0] is not None else f"CAST({f} AS DOUBLE)" for f in FEATURES)

add("stream_scoring", _stream_score, f"""
SELECT * FROM (WITH RECURSIVE asked AS (
  SELECT event_id, ts, reasons, md5(CAST(rec AS VARCHAR)) AS rec, p FROM events JOIN (
    SELECT applicant_id, {_reasons_sql()} AS reasons, [{_FILLED}] AS rec,
      COALESCE(CAST(composite_risk_score AS DOUBLE), 0.0) / CAST(3 AS DOUBLE) AS p
    FROM mart_credit_application_fact) ON user_id = applicant_id),
valid AS (SELECT *, struct_pack(ts := ts, id := CAST(event_id AS VARCHAR)) AS place FROM asked WHERE reasons = ''),
scored AS (
  SELECT rec, MIN(place) AS place FROM valid GROUP BY rec
  UNION ALL
  SELECT s.rec, MIN(v.place) FROM scored s JOIN valid v ON v.rec = s.rec AND v.ts >= s.place.ts + INTERVAL 1 HOUR GROUP BY s.rec, s.place),
answered AS (
  SELECT event_id, rec, p, reasons, place, (SELECT MAX(s.place) FROM scored s WHERE s.rec = v.rec AND s.place <= v.place) AS source FROM valid v)
SELECT event_id, CASE WHEN source = place THEN 'scored' ELSE 'reused' END AS status, reasons, CAST(source.id AS BIGINT) AS scored_by,
  {rnd('p', 4)} AS default_probability, {_TIERED} AS risk_tier, {_DECIDED} AS decision
FROM answered
UNION ALL
SELECT event_id, 'rejected', reasons, NULL, NULL, NULL, NULL FROM asked WHERE reasons <> '')""")
