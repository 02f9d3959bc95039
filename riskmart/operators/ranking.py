"""Exact global positions, tiles and running totals without a single-partition window.

``ntile``, ``row_number`` or a running sum over a whole table (or over a handful of large groups) makes
Spark sort everything in one task. Here the rows are range-partitioned on the full sort order, which
ends in a unique column so even one key value held by most rows is spread, sorted inside each
partition and written with ``monotonically_increasing_id``: its upper bits are the partition, its
lower bits the row's place in it. Counting the written rows per partition and group gives each group's
offset in each partition, and place + offset is the exact position. One range shuffle; the counts stay a
table, which is written too, so that the join that brings them back is planned by its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions.scalars import col_of
from riskmart.session import stage

_LOCAL_BITS = 33  # fixed by monotonically_increasing_id


def _sorted_stage(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    keys = [F.col(g).asc_nulls_first() for g in groups] + list(order)
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
    return stage(placed, "ranked").withColumn("_part", F.shiftright(F.col("_mid"), _LOCAL_BITS).cast("int"))


def _join_numbers(placed: DataFrame, numbers: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bring one row per (part, group) back to its rows; NULL and NaN groups meet as in grouping."""
    small = stage(numbers, "ranked-parts")
    small = small.withColumnsRenamed({"_part": "_g__part", **{g: f"_g_{g}" for g in groups}})
    cond = F.col("_part") == F.col("_g__part")
    for g in groups:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return placed.join(small, cond).drop("_g__part", *[f"_g_{g}" for g in groups])


def _over_parts(groups: Sequence[str]):
    """Frames over the parts of a group: those before, and all. Without groups that is one row per partition."""
    parts = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    return parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1), parts


def with_position(df: DataFrame, order: Sequence[Column], partition_by: Sequence[str] = (),
                  pos: str = "_pos", total: str = "_n") -> DataFrame:
    """Add the 1-based position in the sort order and the number of rows (of the group).

    ``order`` must end in a unique column and spell out its NULL order.
    """
    placed = _sorted_stage(df, partition_by, order)
    counts = placed.groupBy("_part", *partition_by).agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_first"))
    before, parts = _over_parts(partition_by)
    numbers = counts.select("_part", *partition_by, F.sum("_c").over(parts).alias(total),
                            (F.coalesce(F.sum("_c").over(before), F.lit(0)) + 1 - F.col("_first")).alias("_add"))
    ranked = _join_numbers(placed, numbers, partition_by)
    return ranked.withColumn(pos, F.col("_mid") + F.col("_add")).drop("_mid", "_part", "_add")


def tile_of(pos: Column | str, total: Column | str, tiles: int) -> Column:
    """Tile number of a position: sizes differ by at most one, larger tiles first."""
    pos, total = col_of(pos), col_of(total)
    small = F.floor(total / F.lit(tiles)).cast("long")
    extra = total % F.lit(tiles)
    head = extra * (small + 1)
    in_head = F.ceil(pos / (small + 1))
    in_tail = extra + F.ceil((pos - head) / F.nullif(small, F.lit(0)))
    return F.when(pos <= head, in_head).otherwise(in_tail).cast("int")


def with_ntile(df: DataFrame, tiles: int, order: Sequence[Column], partition_by: Sequence[str] = (),
               name: str = "tile") -> DataFrame:
    ranked = with_position(df, order, partition_by)
    return ranked.withColumn(name, tile_of("_pos", "_n", tiles)).drop("_pos", "_n")


def with_running_total(df: DataFrame, order: Sequence[Column], values: Sequence[str],
                       partition_by: Sequence[str] = ()) -> DataFrame:
    """Add ``cum_<v>`` (sum up to and with the row) and ``all_<v>`` (sum of the group) for long columns."""
    placed = _sorted_stage(df, partition_by, order)
    whole = {v: F.coalesce(F.col(v), F.lit(0)).cast("long") for v in values}
    sums = placed.groupBy("_part", *partition_by).agg(*[F.sum(whole[v]).alias(f"_s_{v}") for v in values])
    before, parts = _over_parts(partition_by)
    numbers = sums.select("_part", *partition_by, *[F.sum(f"_s_{v}").over(parts).alias(f"all_{v}") for v in values],
                          *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_b_{v}") for v in values])
    frame = Window.partitionBy("_part", *partition_by).orderBy("_mid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = _join_numbers(placed.withColumns({f"cum_{v}": F.sum(whole[v]).over(frame) for v in values}), numbers, partition_by)
    return out.withColumns({f"cum_{v}": F.col(f"cum_{v}") + F.col(f"_b_{v}") for v in values}).drop(
        "_mid", "_part", *[f"_b_{v}" for v in values])


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], partition_by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles of the non-NULL values: one row per group and probability.

    Equal values are counted together first, so a value held by many rows is one row afterwards; the
    two neighbours of each wanted position are then read off the running count. No group is ever held
    in one task, unlike the built-in exact ``percentile``.
    """
    counted = (df.filter(F.col(column).isNotNull()).groupBy(*partition_by, F.col(column).cast("double").alias("_v"))
               .agg(F.count(F.lit(1)).alias("c")))
    cum = with_running_total(counted, [F.col("_v").asc()], ["c"], partition_by)
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    spread = cum.select(*partition_by, "_v", "c", "cum_c", "all_c", wanted)
    at = F.col("prob") * (F.col("all_c") - 1)
    low, high = F.floor(at) + 1, F.ceil(at) + 1
    first, last = F.col("cum_c") - F.col("c") + 1, F.col("cum_c")
    picked = spread.filter(((low >= first) & (low <= last)) | ((high >= first) & (high <= last)))
    return picked.groupBy(*partition_by, "prob").agg(
        F.max(F.when((low >= first) & (low <= last), F.col("_v"))).alias("_lo"),
        F.max(F.when((high >= first) & (high <= last), F.col("_v"))).alias("_hi"),
        F.max(at - F.floor(at)).alias("_f"),
    ).select(*partition_by, "prob", (F.col("_lo") + F.col("_f") * (F.col("_hi") - F.col("_lo"))).alias("value"))


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep…, feature, value) rows of several numeric columns, for one pass over all of them."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                                for c in columns]))
    return df.select(*keep, pairs.alias("_p")).select(*keep, "_p.feature", "_p.value")
