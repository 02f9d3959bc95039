"""Exact classifier metrics, deterministic splits and population drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart import constants as K
from riskmart.functions.scalars import count_where, ratio, round_half_up
from riskmart.operators.ranking import long_values, with_position, with_running_total
from riskmart.session import stage


def score_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Per distinct score, from the highest down: positives and negatives at it and at or above it."""
    by_score = df.filter(F.col(label).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        count_where(F.col(label) == 1).alias("pos"), count_where(F.col(label) == 0).alias("neg"))
    return with_running_total(by_score, [F.col("threshold").desc_nulls_last()], ["pos", "neg"])


def roc_points(curve: DataFrame) -> DataFrame:
    return curve.select("threshold", ratio("cum_neg", "all_neg").alias("fpr"), ratio("cum_pos", "all_pos").alias("tpr"))


def curve_metrics(curve: DataFrame, gates: Mapping[str, float] = K.METRIC_GATES) -> DataFrame:
    """AUC (ties count half), Gini, KS, the cut with the largest separation, and the gates."""
    above = (F.col("cum_pos") - F.col("pos")).cast("double")
    area = F.col("neg").cast("double") * (above + F.col("pos").cast("double") / F.lit(2.0))
    gap = F.abs(ratio("cum_pos", "all_pos") - ratio("cum_neg", "all_neg"))
    # of equal separations the highest cut is taken
    best = F.max_by("threshold", F.struct(F.round(gap, 12), F.col("threshold")))
    raw = curve.agg(
        ratio(F.sum(area), F.max(F.col("all_pos").cast("double") * F.col("all_neg").cast("double"))).alias("_auc"),
        F.max(gap).alias("_ks"), best.alias("ks_threshold"))
    return raw.select(
        round_half_up("_auc", 6).alias("auc"), round_half_up(F.col("_auc") * 2 - 1, 6).alias("gini"),
        round_half_up("_ks", 6).alias("ks"), "ks_threshold",
        (F.col("_auc") > gates["auc"]).alias("auc_ok"), (F.col("_auc") * 2 - 1 > gates["gini"]).alias("gini_ok"),
        (F.col("_ks") > gates["ks"]).alias("ks_ok"))


def classifier_metrics(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return curve_metrics(score_curve(df, score, label))


def _shuffled(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Position of each row within its label in the order of a hash of its key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    keyed = df.withColumn("_h", digest)
    return with_position(keyed, [F.col("_h").asc(), F.col(key).asc()], [label]).drop("_h")


def stratified_folds(df: DataFrame, k: int = 5, label: str = "label", key: str = "applicant_id", seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1; the folds of a label differ by at most one row."""
    return _shuffled(df, label, key, seed).withColumn("fold", ((F.col("_pos") - 1) % k).cast("int")).drop("_pos", "_n")


def stratified_split(df: DataFrame, test_share: float = 0.2, label: str = "label", key: str = "applicant_id",
                     seed: int = 42) -> DataFrame:
    """Add ``is_test``; each label gives its exact rounded share."""
    quota = F.round(F.col("_n") * F.lit(test_share))
    return _shuffled(df, label, key, seed).withColumn("is_test", F.col("_pos") <= quota).drop("_pos", "_n")


def _bin(value: Column, edges: Sequence[float]) -> Column:
    """0 up to the first edge, then one more per edge passed."""
    out = F.lit(0)
    for e in edges:
        out = out + F.when(value > e, 1).otherwise(0)
    return out


def population_stability(expected: DataFrame, actual: DataFrame, edges: Mapping[str, Sequence[float]],
                         floor: float = 1e-4, retrain_above: float = K.PSI_RETRAIN) -> DataFrame:
    """PSI per feature over fixed bins; an empty bin counts with the floor share.

    Both populations are reduced to bin counts in one grouping; NULL values form no bin.
    """
    features = list(edges)

    def binned(df: DataFrame, side: int) -> DataFrame:
        rows = long_values(df.select(*features), features).filter(F.col("value").isNotNull())
        place = F.lit(None).cast("int")
        for f, e in edges.items():
            place = F.when(F.col("feature") == f, _bin(F.col("value"), e)).otherwise(place)
        return rows.select("feature", place.alias("bin"), F.lit(side).alias("side"))

    counts = binned(expected, 0).unionByName(binned(actual, 1)).groupBy("feature", "bin").agg(
        count_where(F.col("side") == 0).alias("e"), count_where(F.col("side") == 1).alias("a"))
    totals = counts.groupBy("feature").agg(F.sum("e").alias("te"), F.sum("a").alias("ta"))
    pe, pa = (F.greatest(F.coalesce(ratio(c, t), F.lit(0.0)), F.lit(floor)) for c, t in (("e", "te"), ("a", "ta")))
    joined = counts.join(totals, "feature")
    # bins empty on both sides contribute nothing: their two floors are equal
    return joined.groupBy("feature").agg(F.sum((pa - pe) * F.log(pa / pe)).alias("_psi")).select(
        "feature", round_half_up("_psi", 6).alias("psi"), (F.col("_psi") > retrain_above).alias("retrain"))


def stability_by_period(df: DataFrame, period: str, edges: Mapping[str, Sequence[float]], floor: float = 1e-4,
                        retrain_above: float = K.PSI_RETRAIN) -> DataFrame:
    """PSI of each feature in each period against the earliest one: ``period, feature, psi, retrain``.

    All bins of all features are counted in one grouping by period, without a row per feature; the earliest period's
    counts, a few numbers, become literals. An empty bin counts with the floor share. NULL values form no bin and rows
    without a period are left out; a feature without values in one of the two periods has no PSI there.
    """
    counts = df.filter(F.col(period).isNotNull()).groupBy(F.col(period).alias("period")).agg(*[
        F.array(*[count_where(F.col(f).isNotNull() & (_bin(F.col(f), cuts) == k)) for k in range(len(cuts) + 1)]).alias(f)
        for f, cuts in edges.items()])
    counts = stage(counts, "period-counts")
    first = counts.orderBy("period").first()
    if first is None:
        return counts.select("period", F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("psi"),
                             F.lit(None).cast("boolean").alias("retrain"))

    def psi(feature: str) -> Column:
        base, total = first[feature], sum(first[feature])
        share = F.aggregate(feature, F.lit(0).cast("long"), lambda s, x: s + x)
        out = F.lit(0.0)
        for k, n in enumerate(base):
            e = F.lit(max(n / total, floor) if total else None).cast("double")
            a = F.greatest(ratio(F.col(feature)[k], share), F.lit(floor))
            out = out + (a - e) * F.log(a / e)
        return F.when(share > 0, out)

    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), psi(f).alias("psi")) for f in edges])).alias("r")
    return counts.filter(F.col("period") != first["period"]).select("period", rows).select(
        "period", "r.feature", round_half_up("r.psi", 6).alias("psi"), (F.col("r.psi") > retrain_above).alias("retrain")).filter(
        F.col("psi").isNotNull())
