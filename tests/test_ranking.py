from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskmart.operators.quantiles import column_quantiles
from riskmart.operators.ranking import (exact_quantiles, tile_of, with_ntile, with_position, with_running_total)


def keyed(spark, n=1500):
    """A third of the rows share one key, a seventh have none."""
    return spark.range(n).select(
        F.col("id"), (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 37 % 101).cast("double")).alias("k"))


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("order", ["asc_nulls_last", "desc_nulls_first", "asc_nulls_first"])
def test_ntile_equals_the_window_function(spark, groups, order):
    df = keyed(spark)
    by = [getattr(F.col("k"), order)(), F.col("id").asc()]
    window = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy(*by)
    want = {(r["id"], r["t"]) for r in df.select("id", F.ntile(7).over(window).alias("t")).collect()}
    got = {(r["id"], r["tile"]) for r in with_ntile(df.repartition(5), 7, by, groups).collect()}
    assert got == want


def test_position_with_null_groups_and_many_partitions(spark):
    df = keyed(spark, 400).withColumn("g", F.when(F.col("g") != 1, F.col("g")))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = with_position(df, [F.col("k").asc_nulls_last(), F.col("id").asc()], ["g"])
        want = df.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy(F.col("k").asc_nulls_last(), "id")))
        assert out.select("id", "_pos").exceptAll(want.select("id", "w")).count() == 0
        assert {(r["g"], r["_n"]) for r in out.select("g", "_n").distinct().collect()} == {
            (r["g"], r["n"]) for r in df.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("n", range(0, 13))
def test_tile_sizes_for_small_tables(spark, n):
    for tiles in (1, 4, 10):
        got = [r[0] for r in spark.range(1, n + 1).select(tile_of(F.col("id"), F.lit(n).cast("long"), tiles)).collect()]
        small, extra = divmod(n, tiles)
        want = [t + 1 for t in range(tiles) for _ in range(small + (t < extra))]
        assert got == want


def test_uneven_tiles_put_missing_keys_last(spark):
    df = spark.createDataFrame([(i, None if i < 2 else float(i)) for i in range(11)], "id long, k double")
    out = with_ntile(df, 4, [F.col("k").asc_nulls_last(), F.col("id").asc()]).collect()
    sizes = [sum(r["tile"] == t for r in out) for t in (1, 2, 3, 4)]
    assert sizes == [3, 3, 3, 2] and {r["tile"] for r in out if r["k"] is None} == {4}


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_total_equals_the_window_sum(spark, groups):
    df = keyed(spark, 300).withColumn("v", F.when(F.col("id") % 11 > 0, F.col("id")))
    order = [F.col("k").desc_nulls_last(), F.col("id").asc()]
    w = (Window.partitionBy(*groups) if groups else Window.partitionBy())
    want = df.select("id", F.coalesce(F.sum("v").over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("c"), F.sum("v").over(w).alias("a"))
    assert with_running_total(df, order, ["v"], groups).select("id", "cum_v", "all_v").exceptAll(want).count() == 0


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=200), np.full(100, 0.25)])
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)] + [(0, None), (1, None)], "g int, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for g in (0, 1):
        want = np.quantile([v for i, v in enumerate(values) if i % 2 == g], probs)
        got = [r["value"] for r in exact_quantiles(df, "v", probs, ["g"]).filter(F.col("g") == g).orderBy("prob").collect()]
        assert got == pytest.approx(list(want), abs=1e-12)


def test_column_quantiles_skip_missing_values(spark):
    df = spark.createDataFrame([(1.0, 10), (None, 20), (3.0, None)], "a double, b int")
    got = {r["feature"]: r["value"] for r in column_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {"a": 2.0, "b": 15.0}


def test_empty_input(spark):
    df = keyed(spark, 0)
    order = [F.col("k").asc_nulls_last(), F.col("id").asc()]
    assert with_ntile(df, 4, order).count() == 0 and with_ntile(df, 4, order, ["g"]).count() == 0
    assert exact_quantiles(df, "k", [0.5]).count() == 0


def test_many_groups_and_groups_without_order(spark):
    """Far more (partition, group) pairs than rows a driver should hold, and NaN and NULL groups."""
    many = spark.range(600_000).select("id", (F.col("id") % 550_000).alias("g"))
    out = with_position(many, [F.col("id").asc()], ["g"])
    row = out.agg(F.sum("_pos").alias("p"), F.max("_n").alias("n")).first()
    assert (row["p"], row["n"]) == (550_000 + 2 * 50_000, 2)
    odd = spark.createDataFrame([(i, (1.0, 2.0, float("nan"), None)[i % 4]) for i in range(40)], "id long, g double")
    placed = with_position(odd, [F.col("id").asc()], ["g"]).collect()
    assert sorted(r["_pos"] for r in placed) == sorted(list(range(1, 11)) * 4) and {r["_n"] for r in placed} == {10}
    assert all(r["_pos"] == r["id"] // 4 + 1 for r in placed)
