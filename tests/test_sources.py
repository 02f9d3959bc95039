from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.sources import macro_json as mj
from riskmart.sources import raw_csv as rc
from riskmart.sources import schemas
from riskmart.sources.tables import LayerStore, feature_store_summary, layer_name, lower_names

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("v", T.DoubleType())])


def write(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_dirty_csv(spark, tmp_path):
    path = write(tmp_path, 'id,name,v\n1,"a,b",1.5\n2,NULL\n3,"say ""hi""",2,extra\n4,x,abc\n5,,null\n')
    good, bad = rc.read_raw_csv(spark, path, SCHEMA)
    assert sorted(map(tuple, good.collect())) == [(1, "a,b", 1.5), (2, None, None), (3, 'say "hi"', 2.0), (5, None, None)]
    assert [(r["id"], r["v"], r["reasons"]) for r in bad.collect()] == [("4", "abc", ["v is no double"])]
    with pytest.raises(rc.LoadError, match="v is no double"):
        rc.read_raw_csv(spark, path, SCHEMA, rc.ABORT)


def test_schema_inference(spark, tmp_path):
    path = write(tmp_path, "i,gap,f,b,s,empty\n1,1,1.5,true,x,\n2,,2,False,2,\n")
    kinds = {f.name: f.dataType.simpleString() for f in rc.infer_table_schema(spark, path)}
    assert kinds == {"I": "bigint", "GAP": "double", "F": "double", "B": "boolean", "S": "string", "EMPTY": "double"}


def test_inference_reads_all_rows_unless_told_otherwise(spark, tmp_path):
    path = write(tmp_path, "v\n" + "1\n" * 100 + "text\n")
    assert rc.infer_table_schema(spark, path)["V"].dataType == T.StringType()
    assert rc.infer_table_schema(spark, path, sample_rows=100)["V"].dataType == T.LongType()


@pytest.mark.parametrize("kind,want", [("int64", "bigint"), ("float64", "double"), ("object", "string"), ("bool", "boolean"), ("category", "string"),
                                       ("datetime64[ns]", "timestamp_ntz"), ("datetime64[us]", "timestamp_ntz")])
def test_type_map(kind, want):
    assert rc.spark_type(kind).simpleString() == want


def test_load_many_isolates_failures(spark, tmp_path):
    def broken():
        raise FileNotFoundError("gone")

    report = rc.load_many(spark, {"a": lambda: spark.range(3), "b": broken, "c": lambda: spark.range(1)}, str(tmp_path / "out")).collect()
    assert [(r["table"], r["status"], r["rows"]) for r in report] == [("a", "ok", 3), ("b", "failed", None), ("c", "ok", 1)]
    assert "FileNotFoundError: gone" == report[1]["error"]


def payload(*obs):
    return json.dumps({"observations": list(obs)})


def observations(spark, *texts):
    return mj.observations(mj.parse_payloads(spark.createDataFrame([(t,) for t in texts], "payload string")))


def test_observations(spark):
    text = payload({"d": "2024-01-01", "CAOVERAGE": {"v": "4.5"}, "FXCADUSD": {"v": "0.73"}, "note": "text"}, {"d": "2024-01-02", "CAOVERAGE": {"v": "bad"}})
    out = sorted(map(tuple, mj.to_numbers(observations(spark, text, payload(), "{}")).collect()))
    assert out == [("2024-01-01", "CAOVERAGE", 4.5), ("2024-01-01", "FXCADUSD", 0.73), ("2024-01-02", "CAOVERAGE", None)]


def test_payload_files(spark, tmp_path):
    write(tmp_path, json.dumps(json.loads(payload({"d": "2024-01-01", "X": {"v": "1"}})), indent=2), "a.json")
    assert mj.observations(mj.read_payloads(spark, str(tmp_path))).collect()[0]["value"] == "1"


def test_merge_keeps_all_dates_and_skips_empty_series(spark, rows):
    text = payload(*[{"d": f"2024-01-0{d}", "CAOVERAGE": {"v": str(d)}} for d in (1, 2)], *[{"d": f"2024-01-0{d}", "FXCADUSD": {"v": str(d)}} for d in (2, 3)])
    out = rows(mj.merge_series(observations(spark, text)), "date")
    assert out == [{"date": "2024-01-01", "overnight_rate": 1.0, "cadusd": None}, {"date": "2024-01-02", "overnight_rate": 2.0, "cadusd": 2.0},
                   {"date": "2024-01-03", "overnight_rate": None, "cadusd": 3.0}]
    profile = {r["series"]: r["null_rate"] for r in mj.series_profile(mj.merge_series(observations(spark, text))).collect()}
    assert profile == {"overnight_rate": 0.333, "cadusd": 0.333}
    with pytest.raises(mj.NoSeriesError):
        mj.merge_series(observations(spark, payload()))


@pytest.mark.parametrize("n,want", [(5, "load"), (0, "skip"), (None, "skip"), (1, "load"), (1_000_000, "load")])
def test_load_or_skip(n, want):
    assert mj.load_or_skip(n) == want


def test_upsert_is_idempotent(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "obs_date string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "obs_date string, v int")
    once = mj.upsert(old, new)
    assert rows(once, "obs_date") == [{"obs_date": "a", "v": 1}, {"obs_date": "b", "v": 9}, {"obs_date": "c", "v": 3}]
    assert rows(mj.upsert(once, new), "obs_date") == rows(once, "obs_date")
    assert mj.upsert(None, new) is new


def test_layers(spark, tmp_path):
    assert layer_name(" marts ", "RAW") == "MARTS" and layer_name(None, "RAW") == "RAW" and layer_name("  ", "RAW") == "RAW"
    store = LayerStore(spark, str(tmp_path / "layers"))
    store.put("staging", "t", spark.range(5))
    written = store.put("marts", "u", store.get("staging", "t").withColumn("g", F.col("id") % 2), ["g"], "id")
    assert written.count() == 5 and (tmp_path / "layers" / "MARTS" / "u").exists() and not (tmp_path / "layers" / "STAGING").exists()
    with pytest.raises(ValueError):
        LayerStore(spark)


def test_feature_store(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "APPLICANT_ID int, LABEL int")
    assert lower_names(df).columns == ["applicant_id", "label"]
    assert tuple(feature_store_summary(df).first()) == (2, 2, 0.5)


def test_load_since(spark, rows):
    old = spark.createDataFrame([("2024-01-01", "X", 1.0)], "obs_date string, series string, value double")
    feed = spark.createDataFrame([("2024-01-01", "X", 9.0), ("2024-01-02", "X", 2.0)], "obs_date string, series string, value double")
    assert mj.load_since(old, feed, "2024-02-01") == ("skip", old)
    action, out = mj.load_since(old, feed, "2024-01-02")
    assert action == "load" and [r["value"] for r in rows(out, "obs_date")] == [1.0, 2.0]


def test_delivered_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bureau_balance.csv").write_text("STATUS,SK_ID_BUREAU,OTHER,MONTHS_BALANCE\nC,1,x,-1\n0,oops,y,-2\n,2,z,NULL\n")
    report = {r["table"]: r for r in rc.load_delivery(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert len(report) == 8 and report["bureau_balance"]["rows"] == 2 and report["bureau"]["status"] == "failed"
    out = spark.read.parquet(str(tmp_path / "out" / "bureau_balance"))
    assert sorted(map(tuple, out.drop("loaded_at").collect())) == [(1, -1, "C"), (2, None, None)]
    assert spark.read.parquet(str(tmp_path / "out" / "quarantine" / "bureau_balance")).first()["sk_id_bureau"] == "oops"
    write(tmp_path, "STATUS\nC\n")
    with pytest.raises(rc.LoadError, match="no column sk_id_bureau, months_balance"):
        rc.read_delivered_csv(spark, str(tmp_path / "in.csv"), schemas.raw_schema("bureau_balance"))


def test_delivered_file_is_parsed_again_only_for_rows_that_do_not_fit(spark, tmp_path, monkeypatch):
    scans, real = {}, rc.full_refresh
    monkeypatch.setattr(rc, "FILES", {"bureau_balance": "good.csv", "pos_cash_balance": "bad.csv"})
    monkeypatch.setattr(rc, "raw_schema", lambda table: SCHEMA)

    def refresh(df, path):
        scans[path.split("/out/")[1]] = df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")
        real(df, path)

    monkeypatch.setattr(rc, "full_refresh", refresh)
    names = [f.name for f in SCHEMA.fields]
    fits = {"long": "1", "integer": "1", "double": "1.5"}
    good = ",".join(fits.get(f.dataType.typeName(), "x") for f in SCHEMA.fields)
    bad = ",".join("oops" for _ in names)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.csv").write_text("\n".join([",".join(names), good, good]) + "\n")
    (tmp_path / "in" / "bad.csv").write_text("\n".join([",".join(names), good, bad, bad]) + "\n")
    report = {r["table"]: (r["status"], r["rows"]) for r in rc.load_delivery(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert report == {"bureau_balance": ("ok", 2), "pos_cash_balance": ("ok", 1)}
    assert scans == {"bureau_balance": 1, "quarantine/bureau_balance": 0, "pos_cash_balance": 1, "quarantine/pos_cash_balance": 1}
    aside = {t: spark.read.parquet(str(tmp_path / "out" / "quarantine" / t)) for t in ("bureau_balance", "pos_cash_balance")}
    assert {t: df.count() for t, df in aside.items()} == {"bureau_balance": 0, "pos_cash_balance": 2}
    assert aside["bureau_balance"].schema == aside["pos_cash_balance"].schema and aside["pos_cash_balance"].columns[-1] == "reasons"


def test_a_delivery_with_missing_files_stops_before_the_layers(spark, tmp_path):
    from riskmart.plans import run

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bureau_balance.csv").write_text("STATUS,SK_ID_BUREAU,MONTHS_BALANCE\nC,1,-1\n")
    store = LayerStore(spark, str(tmp_path / "layers"))
    with pytest.raises(run.DeliveryError, match="application_train: .*; boc_macro: .*; bureau: "):
        run.run_delivery(spark, str(tmp_path / "in"), str(tmp_path / "raw"), store)
    assert spark.read.parquet(str(tmp_path / "raw" / "bureau_balance")).count() == 1 and not (tmp_path / "layers").exists()


def test_raw_schemas(spark):
    assert set(schemas.DDL) == set(schemas.FILES) and len(schemas.raw_schema("application_train")) == 28
    good = spark.createDataFrame([(1, 2, "C", 9)], "SK_ID_BUREAU bigint, months_balance int, status string, extra int")
    assert schemas.require_schema(good, "bureau_balance").columns == ["sk_id_bureau", "months_balance", "status"]
    with pytest.raises(schemas.SchemaError, match="status is missing"):
        schemas.require_schema(good.drop("status"), "bureau_balance")
    with pytest.raises(schemas.SchemaError, match="months_balance is bigint, not int"):
        schemas.require_schema(good.withColumn("months_balance", F.lit(1).cast("long")), "bureau_balance")


@pytest.mark.parametrize("table", sorted(schemas.DDL))
def test_bound_tables_have_the_raw_schema(spark, table):
    from riskmart.registry.bound import Bound

    assert schemas.require_schema(Bound(spark, "/root/testdata/sf0.001").raw[table], table).columns == schemas.raw_schema(table).names


def test_catalog_layers(spark, tmp_path):
    spark.sql(f"CREATE DATABASE risk_marts LOCATION '{tmp_path}/risk_marts'")
    try:
        store = LayerStore(spark, database="risk")
        store.put("MARTS", "t", spark.range(5))
        assert store.put("MARTS", "t", spark.range(3)).count() == 3 == spark.table("risk_marts.t").count()
    finally:
        spark.sql("DROP DATABASE risk_marts CASCADE")


def test_forms_of_numbers_pass_all_that_casts_take(spark):
    marks = ["", " ", "\t", "\n", "\r\n", "\x00", "\x1f", "\x7f", "\u00a0", "\u2003", "-", "+", "--", "+-", "0x", "0x1p", ".", "e", "x"]
    cores = ["", "0", "12", "007", "9223372036854775807", "9223372036854775808", "1.5", "5.", ".5", ".", "1e5", "1E-5", "1.e5", ".5e+3", "1e", "1e400", "5f", "5F",
             "5d", "5.0D", "5L", "nan", "NaN", "NAN", "inf", "Inf", "Infinity", "infinity", "INFINITY", "infinit", "0x1p3", "0X1.8P-1", "0x1p3f", "0x", "1,000", "1_000",
             "12 3", "1.2.3", "2024-01-02", "true", "currency 1", "north", "i", "\u0661\u0662", "\uff11", "\u0131nf", "\u0130nf", "null"]
    texts = sorted({a + c + z for a in marks for c in cores for z in marks})
    df = spark.createDataFrame([(t,) for t in texts], "v string").withColumns({
        kind: F.col("v").try_cast(kind).cast("string") for kind in ("bigint", "double")})
    for kind, form in (("bigint", rc.WHOLE_FORM), ("double", rc.NUMBER_FORM)):
        guarded = rc.number_of(F.col("v"), form, kind).cast("string")
        assert df.filter(~guarded.eqNullSafe(F.col(kind))).collect() == []
        assert df.filter(F.col(kind).isNotNull()).count() > 20
    refused = df.filter(F.col("double").isNull() & ~F.col("v").rlike(rc.NUMBER_FORM))
    assert {"currency 1", "north", "2024-01-02", "1.2.3", "true"} <= {r["v"] for r in refused.collect()}
