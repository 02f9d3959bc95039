from __future__ import annotations

import uuid
from multiprocessing.pool import ThreadPool

from pyspark.sql import functions as F

from riskmart.operators import history as hi
from riskmart.sources.tables import LayerStore, VersionedTable

COLS = ["seg", "score"]


def load(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, seg string, score double")


def shape(df):
    return sorted(((r["id"], r["seg"], r["score"], str(r["valid_from"])[:10], str(r["valid_to"])[:10], r["is_current"]) for r in df.collect()), key=str)


def test_four_days(spark):
    h = hi.scd2_start(load(spark, (1, "LOW", 0.1), (2, "HIGH", None)), "id", COLS, "2024-01-01")
    day2 = hi.scd2_apply(h, load(spark, (1, "LOW", 0.1), (2, "HIGH", None)), "id", COLS, "2024-01-02")
    assert shape(day2) == shape(h)
    day3 = hi.scd2_apply(day2, load(spark, (1, "MEDIUM", 0.1), (2, "HIGH", 0.4), (3, "LOW", 0.0)), "id", COLS, "2024-01-03")
    assert shape(day3) == sorted([
        (1, "LOW", 0.1, "2024-01-01", "2024-01-03", False), (1, "MEDIUM", 0.1, "2024-01-03", "None", True),
        (2, "HIGH", None, "2024-01-01", "2024-01-03", False), (2, "HIGH", 0.4, "2024-01-03", "None", True),
        (3, "LOW", 0.0, "2024-01-03", "None", True)], key=str)
    day4 = hi.scd2_apply(day3, load(spark, (1, "MEDIUM", 0.1)), "id", COLS, "2024-01-04")
    assert shape(day4) == shape(day3)  # missing keys stay open
    assert {(r["id"], r["seg"]) for r in hi.as_of(day4, "2024-01-02 12:00:00").collect()} == {(1, "LOW"), (2, "HIGH")}
    assert {(r["id"], r["seg"]) for r in hi.as_of(day4, "2024-01-03").collect()} == {(1, "MEDIUM"), (2, "HIGH"), (3, "LOW")}
    assert day4.groupBy("id").agg(F.sum(F.col("is_current").cast("int")).alias("n")).filter("n <> 1").count() == 0
    assert day4.filter("row_hash IS NULL").count() == 0


def test_a_row_without_key_is_not_doubled(spark):
    rows = ((1, "LOW", 0.1), (None, "HIGH", 0.5))
    h = hi.scd2_start(load(spark, *rows), "id", COLS, "2024-01-01")
    assert shape(hi.scd2_apply(h, load(spark, *rows), "id", COLS, "2024-01-02")) == shape(h)
    changed = hi.scd2_apply(h, load(spark, rows[0], (None, "LOW", 0.5)), "id", COLS, "2024-01-02")
    assert sorted(r["is_current"] for r in changed.filter("id IS NULL").collect()) == [False, True]


def test_versions_are_swapped_not_overwritten(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "hist"))
    assert table.read() is None
    table.replace(lambda cur: hi.scd2_start(load(spark, (1, "LOW", 0.1)), "id", COLS, "2024-01-01"))
    first = table.read()
    table.replace(lambda cur: hi.scd2_apply(cur, load(spark, (1, "HIGH", 0.1)), "id", COLS, "2024-01-02"))
    assert table.latest() == 1 and table.read().count() == 2 and first.count() == 1
    (tmp_path / "hist" / "v00000007").mkdir()  # an unfinished version is not current
    assert table.latest() == 1
    table.prune(keep=1)
    assert table.read().count() == 2 and not list((tmp_path / "hist").glob("v00000000*"))


def test_writers_at_once_lose_no_change(spark, tmp_path):
    tables = [VersionedTable(spark, str(tmp_path / "shared")) for _ in range(3)]

    def write(table, who):
        for n in range(3):
            table.replace(lambda cur, n=n: load(spark, (who * 10 + n, "LOW", 0.1)) if cur is None else cur.union(load(spark, (who * 10 + n, "LOW", 0.1))))

    with ThreadPool(3) as pool:
        pool.starmap(write, [(t, i) for i, t in enumerate(tables)])
    assert sorted(r["id"] for r in tables[0].read().collect()) == sorted(i * 10 + n for i in range(3) for n in range(3))
    assert tables[1].latest() == 8 and [tables[2].read(v).count() for v in range(9)] == list(range(1, 10))


def test_a_dead_writers_claim_is_passed_over(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(lambda cur: load(spark, (1, "LOW", 0.1)))
    (tmp_path / "t" / "_commits" / "00000001").write_text("")
    assert table.latest() == 0
    table.replace(lambda cur: cur.union(load(spark, (2, "LOW", 0.1))), patience=0.2)
    assert table.latest() == 2 and table.read().count() == 2


def test_history_in_a_catalog(spark, tmp_path):
    name = f"risk{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}_snapshots LOCATION '{tmp_path}/snapshots'")
    store = LayerStore(spark, database=name)
    store.versioned("SNAPSHOTS", "h").replace(lambda cur: hi.scd2_start(load(spark, (1, "LOW", 0.1)), "id", COLS, "2024-01-01"))
    after = store.versioned("snapshots", "h").replace(lambda cur: hi.scd2_apply(cur, load(spark, (1, "HIGH", 0.1)), "id", COLS, "2024-01-02"))
    assert after.count() == 2 and after.filter("is_current").first()["seg"] == "HIGH"
    spark.sql(f"DROP DATABASE {name}_snapshots")
