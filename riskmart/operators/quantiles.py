"""Exact quantiles of many columns: sketches bracket them, and only the values inside the brackets are sorted."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.scalars import count_where
from riskmart.operators.ranking import with_running_total
from riskmart.session import stage

ACCURACY = 10_000


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], partition_by: Sequence[str] = (),
                     accuracy: int = ACCURACY) -> DataFrame:
    """Linearly interpolated quantiles of the non-NULL values: ``*partition_by, feature, prob, value``.

    The first scan sketches all columns and takes, for each wanted quantile, two values between which it should lie.
    The second counts what is below the lower one and what is between them. Where that proves the bracket right, only
    its values, about ``4 / accuracy`` of the rows, go on; otherwise all values of that column do, so the result is
    exact whatever the sketch said. Equal values are counted together before they are shuffled and no row is
    multiplied by the columns. A column without values has no quantile. NULL is a group of its own.
    """
    values = df.select(*partition_by, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    margin = 2.0 / accuracy
    points = [float(x) for p in probs for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketched = stage(values.groupBy(*partition_by).agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.percentile_approx(f"v{i}", points, accuracy).alias(f"q{i}") for i in range(len(columns))]), "sketches")
    wanted = [(i, k, f"{i}_{k}") for i in range(len(columns)) for k in range(len(probs))]

    with_points, low = _beside(values, sketched, partition_by)
    counted = with_points.groupBy(*partition_by).agg(*[
        count_where(test).alias(f"{name}{at}") for i, k, at in wanted for name, test in (
            ("below", F.col(f"v{i}") < low(f"q{i}", 2 * k)),
            ("inside", (F.col(f"v{i}") >= low(f"q{i}", 2 * k)) & (F.col(f"v{i}") <= low(f"q{i}", 2 * k + 1))))])
    together = _same_group(sketched, counted, partition_by)

    def bracket(i: int, k: int, at: str) -> Column:
        place = F.lit(float(probs[k])) * (F.col(f"n{i}") - 1)
        right = (F.col(f"below{at}") <= F.floor(place)) & (F.col(f"below{at}") + F.col(f"inside{at}") > F.ceil(place))
        return F.struct(F.lit(columns[i]).alias("feature"), F.lit(float(probs[k])).alias("prob"),
                        F.when(right, F.col(f"q{i}")[2 * k]).alias("lo"), F.when(right, F.col(f"q{i}")[2 * k + 1]).alias("hi"),
                        F.when(right, F.col(f"below{at}")).otherwise(0).alias("below"), F.col(f"n{i}").alias("n"))

    brackets = stage(together.select(*partition_by, F.array(*[bracket(*w) for w in wanted]).alias("b")), "brackets")
    with_brackets, edge = _beside(values, brackets, partition_by)

    def inside(i: int, w: int) -> Column:
        v, lo, hi = F.col(f"v{i}"), edge("b", w)["lo"], edge("b", w)["hi"]
        return F.when(v.isNotNull() & (lo.isNull() | ((v >= lo) & (v <= hi))), F.struct(F.lit(w).alias("w"), v.alias("v")))

    found = with_brackets.select(*partition_by, F.explode(F.array_compact(F.array(
        *[inside(i, w) for w, (i, _, _) in enumerate(wanted)]))).alias("x")).groupBy(*partition_by, "x.w", "x.v").agg(F.count(F.lit(1)).alias("c"))
    total = with_running_total(found, [F.col("v").asc()], ["c"], [*partition_by, "w"])
    listed = brackets.select(*partition_by, F.posexplode("b").alias("w", "b")).select(*partition_by, "w", "b.*")
    ranked = _same_group(total, listed.drop("lo", "hi"), [*partition_by, "w"])
    place = F.col("prob") * (F.col("n") - 1)
    first, last = F.col("below") + F.col("cum_c") - F.col("c"), F.col("below") + F.col("cum_c") - 1
    at_low, at_high = F.floor(place).between(first, last), F.ceil(place).between(first, last)
    return ranked.filter(at_low | at_high).groupBy(*partition_by, "feature", "prob").agg(
        F.max(F.when(at_low, F.col("v"))).alias("_lo"), F.max(F.when(at_high, F.col("v"))).alias("_hi"),
        F.max(place - F.floor(place)).alias("_f"),
    ).select(*partition_by, "feature", "prob", (F.col("_lo") + F.col("_f") * (F.col("_hi") - F.col("_lo"))).alias("value"))


def _same_group(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both with equal keys; NULL equals NULL."""
    if not keys:  # one row each
        row = right.first()
        return left.withColumns({c: F.lit(row[c]) for c in right.columns})
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(other, same).drop(*[f"_{k}" for k in keys])


def _beside(rows: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Callable[[str, int], Column]]:
    """``rows`` with the arrays of their group's ``numbers``; without groups those few are literals of the plan."""
    if keys:
        return _same_group(rows, numbers, keys), lambda name, k: F.get(F.col(name), F.lit(k))
    row = numbers.first()

    def literal(name: str, k: int) -> Column:
        entry = row[name][k] if row[name] is not None else None
        if name != "b":
            return F.lit(entry).cast("double")
        return F.struct(F.lit(entry["lo"]).cast("double").alias("lo"), F.lit(entry["hi"]).cast("double").alias("hi"))

    return rows, literal
