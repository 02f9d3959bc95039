from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.constants import FEATURES, RECORD_BOUNDS
from riskmart.operators import ml
from riskmart.operators.quality import domain_violations, validate_records
from riskmart.sources import raw_csv as rc
from riskmart.sources.tables import VersionedTable
from riskmart.streaming import jobs, requests

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])


def test_csv_ingest_equals_batch_and_resumes(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id,v\n1,1.5\n2,abc\n3,NULL\n")

    def drain():
        jobs.ingest_csv(spark, str(src), SCHEMA, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()
        return (sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "good")).collect()),
                sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()))

    assert drain() == ([1, 3], ["2"])
    (src / "b.csv").write_text("id,v\n4,2\n")
    assert drain() == ([1, 3, 4], ["2"]) == drain()
    good, bad = rc.read_raw_csv(spark, str(src), SCHEMA)
    assert sorted(r["id"] for r in good.collect()) == [1, 3, 4] and bad.count() == 1


def test_macro_upsert_takes_the_newest_value(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    table = VersionedTable(spark, str(tmp_path / "macro"))

    def arrive(name, *obs, hours_ago=0):
        (src / name).write_text(json.dumps({"observations": list(obs)}) + "\n")
        os.utime(src / name, (time.time() - 3600 * hours_ago,) * 2)
        jobs.upsert_macro(spark, str(src), table, str(tmp_path / "cp")).awaitTermination()
        return sorted(map(tuple, table.read().select("obs_date", "series", "value").collect()))

    assert arrive("1.json", {"d": "2024-01-01", "X": {"v": "1"}}, {"d": "2024-01-02", "X": {"v": "2"}}) == [("2024-01-01", "X", 1.0), ("2024-01-02", "X", 2.0)]
    late = {"d": "2024-01-02", "X": {"v": "9"}, "Z": {"v": "4"}}
    assert arrive("2.json", {"d": "2024-01-02", "X": {"v": "5"}, "Y": {"v": "7"}}) == [("2024-01-01", "X", 1.0), ("2024-01-02", "X", 5.0), ("2024-01-02", "Y", 7.0)]
    # an older file that comes later adds what is new and takes nothing back
    assert arrive("3.json", late, hours_ago=5) == [("2024-01-01", "X", 1.0), ("2024-01-02", "X", 5.0), ("2024-01-02", "Y", 7.0), ("2024-01-02", "Z", 4.0)]


def test_alert_stream_equals_batch(spark, tmp_path):
    fact = spark.range(50).select(
        F.col("id").alias("applicant_id"), (F.col("id") - 10.0).alias("credit_to_income_ratio"), F.lit(0.5).alias("bureau_delinquency_rate"),
        (F.col("id") / 40).alias("inst_late_rate"), F.lit(0.1).alias("composite_risk_score"), F.lit(0).alias("default_flag"), F.lit("LOW").alias("credit_risk_segment"))
    fact.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(fact.schema).parquet(str(tmp_path / "in"))
    jobs.alert_rows(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 19 and got.exceptAll(domain_violations(fact)).count() == 0


def test_scoring_stream_skips_invalid_and_repeated_records(spark, tmp_path):
    base = {f: 0.5 for f in FEATURES} | {"age_years": 40.0}
    records = [dict(base, n=i, at=f"2024-01-01 00:0{i}:00") for i in range(3)] + [dict(base, n=7, at="2024-01-01 00:05:00", age_years=16.0),
                                                                                dict(base, n=8, at="2024-01-01 00:06:00", ext_source_1=0.1)]
    df = spark.createDataFrame(records).withColumn("event_time", F.col("at").cast("timestamp")).drop("at")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))

    def score(d):
        return ml.with_tier(d.withColumn("score", F.col("ext_source_1")))

    jobs.write_stream(jobs.score_applications(stream, score, "event_time"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["ext_source_1"], r["risk_tier"]) for r in out) == [(0.1, "MEDIUM"), (0.5, "VERY_HIGH")]
    assert 7 not in {r["n"] for r in out}
    assert validate_records(df, RECORD_BOUNDS)[1].count() == jobs.rejected_applications(df).count() == 1


def test_every_request_is_answered_over_restarts(spark, tmp_path):
    base = {f: 0.5 for f in FEATURES} | {"age_years": 40.0}
    day = "2024-01-01 "

    def arrive(factor, *asked):
        df = spark.createDataFrame([dict(base, **a) for a in asked]).withColumn("at", F.col("at").cast("timestamp"))
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        answers = requests.answer_requests(
            stream, lambda d: ml.with_tier(d.withColumn("score", F.col("ext_source_1") * factor)).drop("score"), "n", "at")
        requests.write_answers(answers, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        out = spark.read.parquet(str(tmp_path / "out"))
        return {int(r["request_id"]): (r["status"], r["scored_by"], r["default_probability"], list(r["reasons"])) for r in out.collect()}

    found = arrive(1.0, dict(n=2, at=day + "00:59:59"), dict(n=1, at=day + "00:00:00"), dict(n=3, at=day + "01:00:00"),
                   dict(n=4, at=day + "00:00:00", age_years=16.0), dict(n=5, at=day + "00:30:00", ext_source_1=0.1))
    assert found == {1: ("scored", "1", 0.5, []), 2: ("reused", "1", 0.5, []), 3: ("scored", "3", 0.5, []),
                     4: ("rejected", None, None, ["age_years: below 18"]), 5: ("scored", "5", 0.1, [])}
    # A new model scores what is new; repeats, late ones too, get the answer that is held. Two of one time: by id.
    found = arrive(0.5, dict(n=6, at=day + "01:30:00"), dict(n=7, at=day + "00:10:00"), dict(n=9, at=day + "02:00:00"),
                   dict(n=8, at=day + "02:00:00"), dict(n=8, at=day + "02:00:00"))
    assert {n: found[n][:3] for n in (6, 7, 9)} == {6: ("reused", "3", 0.5), 7: ("reused", "3", 0.5), 9: ("reused", "8", 0.25)}
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 10 and sorted(r["status"] for r in out.filter("request_id = 8").collect()) == ["reused", "scored"]
