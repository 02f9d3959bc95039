"""Imputation, oversampling, training, scoring and explanation with Spark ML."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart import constants as K
from riskmart.functions.bands import probability_tier, tier_decision
from riskmart.functions.scalars import count_where, hash_unit, record_key, round_half_up
from riskmart.operators.logit import Logit
from riskmart.operators.metrics import classifier_metrics, stratified_folds
from riskmart.operators.quantiles import column_quantiles
from riskmart.operators.ranking import with_position
from riskmart.session import scratch_path, scratch_root, stage

FEATURES = list(K.FEATURES)


# --- preparation -----------------------------------------------------------------------------------

def medians(df: DataFrame, features: Sequence[str] = FEATURES) -> dict[str, float]:
    """Exact median per feature; one number per feature reaches the driver."""
    return {r["feature"]: r["value"] for r in column_quantiles(df, features, [0.5]).collect()}


def impute_medians(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    mid = medians(df, features)
    filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(mid.get(f))) for f in features}
    return df.withColumns(filled)


def synthetic_population(spark, n: int, default_rate: float = 0.08, seed: int = 42, features: Sequence[str] = FEATURES) -> DataFrame:
    """``n`` rows of uniform features and a label of the given rate; the same rows in any partitioning."""
    base = spark.range(n).withColumnRenamed("id", "applicant_id")
    cols = [hash_unit(seed + i, "applicant_id").alias(f) for i, f in enumerate(features)]
    label = F.when(hash_unit(seed - 1, "applicant_id") < default_rate, 1).otherwise(0).alias("label")
    return base.select("applicant_id", label, *cols)


# --- oversampling ----------------------------------------------------------------------------------

def nearest_by_projection(rows: DataFrame, key: str, dims: int, k: int = 5, projections: int = 3, seed: int = 42,
                          block: int = 4096) -> DataFrame:
    """(key, x, near): up to ``k`` near rows for each row of (key, x array).

    Rows close in space stay close when projected on a line. For a few random lines the rows are put in
    line order, every row meets the ``k`` rows before and after it, and the nearest of those by true
    distance are kept. Blocks of the order overlap by ``k`` rows, so no neighbour is lost at an edge and
    every group has a fixed size; the work is linear in the rows however dense one region is.
    """
    rng = np.random.default_rng(seed)
    met = None
    for _ in range(projections):
        line = F.lit([float(w) for w in rng.normal(size=dims)])
        on_line = F.aggregate(F.zip_with(F.col("x"), line, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        placed = with_position(rows.withColumn("_t", on_line), [F.col("_t").asc(), F.col(key).asc()])
        place = (F.col("_pos") - 1) % block
        mine = F.floor((F.col("_pos") - 1) / block)
        homes = F.array_compact(F.array(mine, F.when(place < k, mine - 1), F.when(place >= block - k, mine + 1)))
        spread = placed.select(key, "x", "_pos", mine.alias("_home"), F.explode(homes).alias("_block"))
        here = F.struct(F.col(key).alias("id"), F.col("x").alias("x"))
        around = F.collect_list(here).over(Window.partitionBy("_block").orderBy("_pos").rowsBetween(-k, k))
        others = F.filter(F.col("_around"), lambda c: c["id"] != F.col(key))
        seen = (spread.withColumn("_around", around).filter(F.col("_home") == F.col("_block"))
                .select(key, "x", _nearest(others, k).alias("near")))
        met = seen if met is None else met.unionByName(seen)
    # the nearest of all are among the nearest of each line, so no others are moved
    merged = met.groupBy(key).agg(F.first("x").alias("x"), F.flatten(F.collect_list("near")).alias("near"))
    return merged.select(key, "x", F.slice(F.array_sort(F.array_distinct("near")), 1, k).alias("near"))


def _nearest(others: Column, k: int) -> Column:
    """The ``k`` of ``others`` (id, x) nearest to the row's x, with their squared distance, ties by id."""
    def distance(c: Column) -> Column:
        return F.aggregate(F.zip_with(c["x"], F.col("x"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)

    measured = F.transform(others, lambda c: F.struct(distance(c).alias("d"), c["id"].alias("id"), c["x"].alias("x")))
    return F.slice(F.array_sort(measured), 1, k)


def smote(df: DataFrame, share: float = K.SMOTE_SHARE, features: Sequence[str] = FEATURES, label: str = "label",
          key: str = "applicant_id", k: int = 5, seed: int = 42) -> DataFrame:
    """Grow label 1 to ``share`` × label 0 with points between a row and one of its near rows.

    Output: key, copy (0 for given rows), label, features. The number of new rows is exact.
    """
    cast = [F.col(f).cast("double").alias(f) for f in features]
    given = df.select(key, F.lit(0).alias("copy"), F.col(label).cast("int").alias(label), *cast)
    sizes = df.agg(count_where(F.col(label) == 1).alias("few"), count_where(F.col(label) == 0).alias("many")).first()
    missing = int(share * sizes["many"]) - sizes["few"]
    if missing <= 0 or sizes["few"] < 2:
        return given
    minority = stage(given.filter(F.col(label) == 1).select(key, F.array(*features).alias("x")), "minority")
    near = nearest_by_projection(minority, key, len(features), k, seed=seed)
    order = with_position(minority.select(key, hash_unit(seed, key).alias("_u")), [F.col("_u").asc(), F.col(key).asc()])
    each, extra = divmod(missing, sizes["few"])
    copies = F.lit(each) + F.when(F.col("_pos") <= extra, 1).otherwise(0)
    plan = order.select(key, copies.cast("int").alias("_copies")).filter("_copies > 0")
    born = near.join(plan, key).select(key, "x", "near", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
    pick = F.floor(hash_unit(seed + 1, key, "copy") * F.size("near")).cast("int")
    step = hash_unit(seed + 2, key, "copy")
    point = F.zip_with(F.col("x"), F.get(F.col("near"), pick)["x"], lambda a, b: a + F.col("_step") * (b - a))
    made = born.withColumn("_step", step).withColumn("_new", point).select(
        key, "copy", F.lit(1).alias(label), *[F.col("_new")[i].alias(f) for i, f in enumerate(features)])
    return given.unionByName(made)


# --- models ----------------------------------------------------------------------------------------

def fit_logistic(train: DataFrame, features: Sequence[str] = FEATURES, label: str = "label", c: float = K.LOGIT_PARAMS["c"],
                 max_iter: int = K.LOGIT_PARAMS["max_iter"], rows: int | None = None) -> PipelineModel:
    """Standardised inputs, ridge penalty 1/(c·rows).

    The model is saved and read back: as fitted it holds a summary of its training and with that the session, which
    cannot be sent to tasks once anything in the session was observed.
    """
    n = train.count() if rows is None else rows
    fitted = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="scaled", labelCol=label, maxIter=max_iter, regParam=1.0 / (c * max(n, 1)),
                           elasticNetParam=0.0, standardization=False),
    ]).fit(train)
    path = scratch_path(train.sparkSession, "logistic")
    fitted.write().save(path)
    return PipelineModel.load(path)


ROWS_A_TASK = 80_000


def fit_trees(train: DataFrame, features: Sequence[str] = FEATURES, label: str = "label",
              n_trees: int = K.TREE_PARAMS["n_trees"], depth: int = K.TREE_PARAMS["depth"], step: float = K.TREE_PARAMS["step"],
              row_share: float = K.TREE_PARAMS["row_share"], column_share: float = K.TREE_PARAMS["column_share"],
              positive_weight: float = K.TREE_PARAMS["positive_weight"], seed: int = 42,
              checkpoint_interval: int = 10) -> PipelineModel:
    """Boosted trees; rows of label 1 carry ``positive_weight``.

    A tree is some six short jobs, whose time is that of their tasks and not of the rows while these are few, so the
    number of tasks follows from the rows and not from the files or cores. Nothing is shuffled for it.
    """
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:  # hundreds of trees need their lineage cut on the way
        context.setCheckpointDir(scratch_root(train.sparkSession))
    tasks = math.ceil(train.count() / ROWS_A_TASK)
    weighted = train.coalesce(max(tasks, 1)).withColumn("_weight", F.when(F.col(label) == 1, positive_weight).otherwise(1.0))
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw"),
        GBTClassifier(featuresCol="raw", labelCol=label, weightCol="_weight", maxIter=n_trees, maxDepth=depth, stepSize=step,
                      subsamplingRate=row_share, featureSubsetStrategy=str(column_share), seed=seed,
                      checkpointInterval=checkpoint_interval),
    ]).fit(weighted)


def with_probability(model: PipelineModel | Logit, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    if isinstance(model, Logit):
        return df.select(*keep, model.probability().alias("score"))
    scored = model.transform(df.withColumn("_weight", F.lit(1.0)))
    return scored.select(*keep, vector_to_array("probability")[1].alias("score"))


@dataclass(frozen=True)
class Fold:
    """Rows a fold's model was fitted on, rows and defaults it was tested on, and the exact AUC there."""

    n_train: int
    n_test: int
    n_default: int
    auc: float | None


@dataclass(frozen=True)
class CrossValidation:
    auc: list[float]
    folds: list[Fold] = field(default_factory=list)

    @property
    def mean(self) -> float:
        return float(np.mean(self.auc))

    @property
    def std(self) -> float:
        return float(np.std(self.auc))

    @property
    def gini(self) -> float:
        return 2 * self.mean - 1

    def to_frame(self, spark, model: str) -> DataFrame:
        return spark.createDataFrame([(model, len(self.auc), round(self.mean, 6), round(self.std, 6), round(self.gini, 6))],
                                     "model string, folds int, cv_auc_mean double, cv_auc_std double, gini double")

    def fold_frame(self, spark, model: str) -> DataFrame:
        """A row per fold: ``model, fold, n_train, n_test, n_default, auc``."""
        return spark.createDataFrame([(model, i, f.n_train, f.n_test, f.n_default, f.auc) for i, f in enumerate(self.folds)],
                                     "model string, fold int, n_train long, n_test long, n_default long, auc double")


def cross_validate(df: DataFrame, fit, folds: int = 5, label: str = "label", key: str = "applicant_id", seed: int = 42,
                   oversample=None, reference_order: bool = False, at_once: int | None = None) -> CrossValidation:
    """Mean and spread of the exact AUC over stratified folds.

    The folds are cut and written once, and ``at_once`` of them (all by default) are fitted at the same time, each by a
    thread of its own: the hundreds of short jobs of one fold fill the gaps between those of the others. A fold whose
    test rows have one label has no AUC and is left out of the mean.

    ``oversample`` is applied to the training folds only. ``reference_order`` applies it to the whole
    table before the folds are cut; points made from a row can then reach the fold the row is tested in,
    so the AUC comes out too high.
    """
    if oversample is not None and reference_order:
        grown = oversample(df)
        one_key = F.struct(F.col(key), F.col("copy")) if "copy" in grown.columns else F.col(key)
        cut = stratified_folds(grown.withColumn("_row", F.to_json(one_key) if "copy" in grown.columns else one_key.cast("string")),
                               folds, label, "_row", seed)
        oversample = None
    else:
        cut = stratified_folds(df, folds, label, key, seed)
    cut = stage(cut, "folds")
    sizes = {r["fold"]: r for r in cut.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), count_where(F.col(label) == 1).alias("bad")).collect()}
    total = sum(r["n"] for r in sizes.values())

    def one(i: int) -> Fold:
        train = cut.filter(F.col("fold") != i)
        if oversample is not None:
            train = stage(oversample(train), "train")  # the fit reads it many times
        n_train = total - sizes[i]["n"] if oversample is None else train.count()
        scored = with_probability(fit(train), cut.filter(F.col("fold") == i), [label])
        return Fold(n_train, sizes[i]["n"], sizes[i]["bad"], classifier_metrics(scored, "score", label).first()["auc"])

    with ThreadPool(at_once or folds) as pool:  # the threads take the session's properties with them
        done = pool.map(inheritable_thread_target(df.sparkSession)(one), sorted(sizes))
    return CrossValidation([f.auc for f in done if f.auc is not None], done)


def feature_importances(model: PipelineModel, spark, features: Sequence[str] = FEATURES) -> DataFrame:
    """Shares that sum to one, largest first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature")


# --- scoring ---------------------------------------------------------------------------------------

def with_tier(df: DataFrame, p: str = "score", model_version: str = K.MODEL_VERSION) -> DataFrame:
    """Tier and decision of the exact probability, which is rounded only afterwards."""
    return df.withColumns({
        "default_probability": round_half_up(p, 4), "risk_tier": probability_tier(p), "decision": tier_decision(p),
        "model_version": F.lit(model_version)})


def top_factors(contributions: Mapping[str, Column], n: int = 3) -> Column:
    """The ``n`` largest contributions by size as (feature, direction, impact); earlier features win ties."""
    entries = F.array(*[F.struct((-F.abs(c)).alias("k"), F.lit(i).alias("i"), F.lit(f).alias("feature"), c.alias("v"))
                        for i, (f, c) in enumerate(contributions.items())])
    return F.transform(F.slice(F.array_sort(entries), 1, n), lambda e: F.struct(
        e["feature"].alias("feature"), F.when(e["v"] > 0, "increases").otherwise("decreases").alias("direction"),
        round_half_up(F.abs(e["v"]), 4).alias("impact")))


def linear_contributions(coefficients: Mapping[str, float], means: Mapping[str, float]) -> dict[str, Column]:
    """Exact additive contributions of a linear score, relative to the mean row."""
    return {f: F.lit(float(b)) * (F.col(f).cast("double") - F.lit(float(means[f]))) for f, b in coefficients.items()}


def logistic_contributions(model: PipelineModel, features: Sequence[str] = FEATURES) -> dict[str, Column]:
    scaler, logit = model.stages[1], model.stages[2]
    std = [s if s > 0 else 1.0 for s in scaler.std]
    coef = {f: b / s for f, b, s in zip(features, logit.coefficients, std)}
    return linear_contributions(coef, dict(zip(features, scaler.mean)))


def global_importance(df: DataFrame, contributions: Mapping[str, Column], key: str = "applicant_id",
                      rows: int | None = None, seed: int = 42) -> DataFrame:
    """Mean absolute contribution per feature over all rows, or over a fixed sample of ``rows``."""
    sample = df if rows is None else df.withColumn(
        "_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))).orderBy("_h", key).limit(rows)
    wide = sample.agg(*[F.avg(F.abs(c)).alias(f) for f, c in contributions.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in contributions]))
    return wide.select(pairs.alias("p")).select("p.feature", round_half_up("p.v", 6).alias("mean_abs_contribution")).orderBy(
        F.col("mean_abs_contribution").desc(), "feature")


def score_once_per_record(df: DataFrame, score, inputs: Sequence[str]) -> DataFrame:
    """Score each distinct set of inputs once and give the result to all its requests.

    ``score`` maps a DataFrame of the inputs to itself plus result columns. A record sent very often is
    one row in the scoring step; in the join back it sits on the streamed side, where adaptive execution
    splits it.
    """
    keyed = df.withColumn("_key", record_key(*inputs))
    unique = keyed.select("_key", *inputs).dropDuplicates(["_key"])
    results = score(unique)
    gained = [c for c in results.columns if c not in unique.columns]
    return keyed.join(results.select("_key", *gained), "_key", "left").drop("_key")


# --- explanation of tree models --------------------------------------------------------------------

def leaf_paths(model: PipelineModel, spark) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per leaf: weighted value, and for each feature on its path the allowed interval and the share of
    training rows that stay on the path at that feature's splits. Read from the saved node table, whose
    size is set by the model's parameters and not by the data."""
    path = scratch_path(spark, "model")
    trees = model.stages[-1]
    trees.save(path)
    nodes: dict[int, dict] = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        n = r["nodeData"] if "nodeData" in r.__fields__ else r
        nodes.setdefault(r["treeID"], {})[n["id"]] = n
    out = []
    for tree_id, weight in enumerate(trees.treeWeights):
        tree = nodes[tree_id]
        todo = [(0, {})]
        while todo:
            at, seen = todo.pop()
            node = tree[at]
            if node["leftChild"] < 0:
                f = np.array(list(seen), dtype=int)
                lo, hi, share = (np.array([seen[i][j] for i in seen], dtype=float) for j in range(3))
                out.append((weight * node["prediction"], f, lo, hi, share))
                continue
            feature, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
            lo, hi, share = seen.get(feature, (-math.inf, math.inf, 1.0))
            for child, bounds in ((node["leftChild"], (lo, min(hi, cut))), (node["rightChild"], (max(lo, cut), hi))):
                kept = share * tree[child]["rawCount"] / node["rawCount"]
                todo.append((child, {**seen, feature: (*bounds, kept)}))
    return out


@dataclass(frozen=True)
class LeafStack:
    """Leaves whose paths test the same number of features: values, and features, interval places and shares by row."""

    value: np.ndarray
    feature: np.ndarray
    above: np.ndarray
    upto: np.ndarray
    share: np.ndarray


def stack_leaves(leaves, n_features: int) -> tuple[list[np.ndarray], list[LeafStack]]:
    """Sorted thresholds of each feature, and the leaves by path length, with places among them for their bounds.

    A row's values are then compared as small integers: it lies in a leaf's interval of a feature if its place
    among that feature's thresholds is above one place and not above another.
    """
    cuts = [set() for _ in range(n_features)]
    for _, f, lo, hi, _ in leaves:
        for i, bounds in zip(f, zip(lo, hi)):
            cuts[i].update(b for b in bounds if math.isfinite(b))
    cuts = [np.array(sorted(c)) for c in cuts]
    small = np.int16 if max(map(len, cuts), default=0) < 1 << 15 else np.int32
    stacks = []
    for d in sorted({len(leaf[1]) for leaf in leaves} - {0}):
        same = [leaf for leaf in leaves if len(leaf[1]) == d]
        feature, lo, hi, share = (np.array([leaf[k] for leaf in same]) for k in range(1, 5))
        above = np.array([[-1 if b == -math.inf else np.searchsorted(cuts[i], b) for i, b in zip(*row)] for row in zip(feature, lo)], small)
        upto = np.array([[len(cuts[i]) if b == math.inf else np.searchsorted(cuts[i], b) for i, b in zip(*row)] for row in zip(feature, hi)], small)
        stacks.append(LeafStack(np.array([leaf[0] for leaf in same]), feature, above, upto, share))
    return cuts, stacks


def _payments(value: np.ndarray, share: np.ndarray, met: np.ndarray) -> np.ndarray:
    """What leaves pay to the features of their paths, given which of the conditions are met (features last).

    A leaf pays its value when the conditions of all its features are met; a feature left out counts with
    its training share. For such a product the Shapley weights turn into an integral over t of the product
    of ``share·(1-t) + met·t`` over the other features. That is a polynomial in t, so a few Gauss nodes
    give it exactly.
    """
    at, weight = np.polynomial.legendre.leggauss((share.shape[-1] + 1) // 2)
    others = np.zeros(np.broadcast_shapes(share.shape, met.shape))
    for t, w in zip((at + 1) / 2, weight / 2):
        factor = share * (1 - t) + met * t
        others += w * factor.prod(axis=-1, keepdims=True) / factor
    return value * (met - share) * others


LEAVES_AT_ONCE, ROWS_AT_ONCE, LONG_PATH = 256, 2000, 10


def shapley_of_leaves(x: np.ndarray, cuts: list[np.ndarray], stacks: list[LeafStack]) -> np.ndarray:
    """Shapley values of the tree score for a batch of rows.

    All that a row can do to a leaf of d features is to meet some of its d conditions, so the leaf's payments are
    worked out once per pattern and looked up for the rows; leaves and rows go through together, a block at a time that
    fits a core's cache. On paths of more than ``LONG_PATH`` features, which have too many patterns, a leaf's payments are
    worked out row by row.
    """
    out = np.zeros((x.shape[1], len(x)))
    small = stacks[0].above.dtype if stacks else np.int32
    place = np.array([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], small)  # a value at a threshold stays left
    for stack in stacks:
        d = stack.feature.shape[1]
        at_once = LEAVES_AT_ONCE if d <= LONG_PATH else 1
        for first in range(0, len(stack.value), at_once):
            chosen = slice(first, first + at_once)
            feature, value, share = stack.feature[chosen], stack.value[chosen, None, None], stack.share[chosen, None, :]
            if d > LONG_PATH:
                own = place[feature[0]]
                met = (own > stack.above[first, :, None]) & (own <= stack.upto[first, :, None])
                np.add.at(out, feature[0], _payments(value, share, met.T[None].astype(float))[0].T)
                continue
            patterns = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
            pay = _payments(value, share, patterns[None])
            for start in range(0, len(x), ROWS_AT_ONCE):
                rows = slice(start, start + ROWS_AT_ONCE)
                here = place[:, rows]
                shown = np.repeat(np.arange(len(feature), dtype=np.int32)[:, None] << d, here.shape[1], axis=1)
                for j in range(d):
                    own = here[feature[:, j]]
                    shown += ((own > stack.above[chosen, j, None]) & (own <= stack.upto[chosen, j, None])).view(np.uint8).astype(np.int32) << j
                for j in range(d):
                    to = np.zeros((x.shape[1], len(feature)))
                    to[feature[:, j], np.arange(len(feature))] = 1.0
                    out[:, rows] += to @ np.ascontiguousarray(pay[:, :, j]).ravel().take(shown)
    return out.T


def with_tree_contributions(model: PipelineModel, df: DataFrame, features: Sequence[str] = FEATURES,
                            name: str = "contributions") -> DataFrame:
    """Add an array of per-feature contributions to the log-odds, in feature order."""
    spark = df.sparkSession
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the executors need no copy of this package
    shared = spark.sparkContext.broadcast(stack_leaves(leaf_paths(model, spark), len(features)))

    @F.pandas_udf("array<double>")
    def explain(x: pd.Series) -> pd.Series:
        # the log-odds of a two-class boosted ensemble are twice its summed tree outputs
        return pd.Series(list(2.0 * shapley_of_leaves(np.stack(x.to_numpy()), *shared.value)))

    return df.withColumn(name, explain(F.array(*[F.col(f).cast("double") for f in features])))


def array_contributions(features: Sequence[str] = FEATURES, name: str = "contributions") -> dict[str, Column]:
    return {f: F.col(name)[i] for i, f in enumerate(features)}
