from __future__ import annotations

import itertools
import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskmart.operators import metrics as mt
from riskmart.operators import logit, ml

SHORT = ["f0", "f1", "f2"]


def labelled(spark, scores, labels):
    return spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels)], "score double, label int")


def auc_by_pairs(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_metrics_with_ties(spark):
    r = mt.classifier_metrics(labelled(spark, [.5, .5, .5, .9], [0, 1, 0, 1])).first()
    assert (r["auc"], r["gini"], r["ks"], r["ks_threshold"]) == (0.75, 0.5, 0.5, 0.9)
    assert r["auc_ok"] and r["gini_ok"] and r["ks_ok"]


def test_auc_equals_all_pairs_on_random_scores(spark):
    rng = np.random.default_rng(0)
    scores, labels = rng.integers(0, 40, 400) / 40, rng.random(400) < 0.2
    r = mt.classifier_metrics(labelled(spark, scores, labels)).first()
    assert r["auc"] == pytest.approx(auc_by_pairs(scores, labels), abs=1e-6)
    assert r["gini"] == pytest.approx(2 * r["auc"] - 1, abs=2e-6)


def test_ks_extremes(spark):
    perfect = mt.classifier_metrics(labelled(spark, [0.9] * 200 + [0.1] * 1800, [1] * 200 + [0] * 1800)).first()
    assert perfect["ks"] == 1.0 and perfect["auc"] == 1.0
    rng = np.random.default_rng(42)
    noise = mt.classifier_metrics(labelled(spark, rng.random(2000), [1] * 200 + [0] * 1800)).first()
    assert noise["ks"] < 0.12


def test_roc_points_rise_to_one(spark):
    pts = mt.roc_points(mt.score_curve(labelled(spark, [.1, .4, .4, .8], [0, 1, 0, 1]))).orderBy(F.col("threshold").desc()).collect()
    assert [(p["fpr"], p["tpr"]) for p in pts] == [(0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_folds_and_split_are_stratified_and_repeatable(spark):
    df = ml.synthetic_population(spark, 503, 0.1, features=SHORT)
    folds = mt.stratified_folds(df)
    for label, sizes in folds.groupBy("label").pivot("fold").count().rdd.map(lambda r: (r[0], list(r)[1:])).collect():
        assert max(sizes) - min(sizes) <= 1
    again = mt.stratified_folds(df.repartition(7))
    assert folds.select("applicant_id", "fold").exceptAll(again.select("applicant_id", "fold")).count() == 0
    cut = mt.stratified_split(df)
    for r in cut.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect():
        assert abs(r["t"] - 0.2 * r["n"]) <= 0.5


def test_psi(spark):
    a = spark.range(1000).select((F.col("id") / 1000).alias("x"))
    same = mt.population_stability(a, a, {"x": (0.25, 0.5, 0.75)}).first()
    assert same["psi"] == 0.0 and not same["retrain"]
    moved = mt.population_stability(a, a.select((F.col("x") / 2).alias("x")), {"x": (0.25, 0.5, 0.75)}).first()
    # shares .25 each against .5, .5 and two empty bins at the floor
    want = 2 * (0.5 - 0.25) * math.log(2) + 2 * (1e-4 - 0.25) * math.log(1e-4 / 0.25)
    # bin edges are inclusive above, so one row of a thousand sits on each edge
    assert moved["psi"] == pytest.approx(want, rel=0.02) and moved["retrain"]


def test_median_imputation(spark):
    df = spark.createDataFrame([(1.0, 10), (None, 20), (3.0, None), (8.0, 40)], "a double, b int")
    out = ml.impute_medians(df, ["a", "b"]).collect()
    assert out[1]["a"] == 3.0 and out[2]["b"] == 20.0


def test_smote_grows_the_minority_between_its_rows(spark):
    df = ml.synthetic_population(spark, 1200, 0.08, features=SHORT).cache()
    n = {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    grown = ml.smote(df, 0.3, SHORT)
    after = {r["label"]: r["n"] for r in grown.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert after[0] == n[0] and after[1] == int(0.3 * n[0])
    lo_hi = df.filter("label = 1").agg(*[F.min(f) for f in SHORT], *[F.max(f) for f in SHORT]).first()
    new = grown.filter("copy > 0").collect()
    for r in new:
        assert all(lo_hi[i] - 1e-12 <= r[f] <= lo_hi[i + 3] + 1e-12 for i, f in enumerate(SHORT))
    assert sorted(map(tuple, new)) == sorted(map(tuple, ml.smote(df.repartition(5), 0.3, SHORT).filter("copy > 0").collect()))


def test_projection_neighbours_are_near(spark):
    """Every row gets k others, never itself, and most of them are true near neighbours."""
    rng = np.random.default_rng(1)
    x = rng.random((300, 3))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, x array<double>")
    out = {r["id"]: [n["id"] for n in r["near"]] for r in ml.nearest_by_projection(df, "id", 3, k=5, projections=6, block=64).collect()}
    assert len(out) == 300 and all(len(set(v)) == 5 and i not in v for i, v in out.items())
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    near40 = np.argsort(d, axis=1)[:, 1:41]
    assert np.mean([len(set(v) & set(near40[i])) / 5 for i, v in out.items()]) > 0.75


def test_smote_without_need_returns_the_rows(spark):
    df = ml.synthetic_population(spark, 100, 0.6, features=SHORT)
    assert ml.smote(df, 0.3, SHORT).count() == 100


@pytest.fixture(scope="module")
def signal(spark):
    df = ml.synthetic_population(spark, 1500, 0.5, features=SHORT)
    return df.withColumn("label", (F.col("f0") + 0.4 * F.col("f1") > 0.75).cast("int")).cache()


def test_logistic_scores_and_contributions(spark, signal):
    model = ml.fit_logistic(signal, SHORT)
    scored = ml.with_probability(model, signal, ["label", *SHORT])
    assert mt.classifier_metrics(scored).first()["auc"] > 0.97
    stats = scored.agg(F.min("score"), F.max("score")).first()
    assert 0 <= stats[0] and stats[1] <= 1
    parts = ml.logistic_contributions(model, SHORT)
    base = model.stages[2].intercept
    total = sum(parts.values(), F.lit(float(base)))
    gap = scored.select(F.abs(F.lit(1.0) / (1 + F.exp(-total)) - F.col("score")).alias("g")).agg(F.max("g")).first()[0]
    assert gap < 1e-9


def test_cross_validation_applies_oversampling_inside_folds(spark, signal):
    seen = []

    def oversample(train):
        seen.append(train.count())
        return train

    cv = ml.cross_validate(signal, lambda t: ml.fit_logistic(t, SHORT, max_iter=20), folds=3, oversample=oversample)
    assert len(cv.auc) == 3 and cv.mean > 0.9 and cv.gini == pytest.approx(2 * cv.mean - 1) and all(n < 1500 for n in seen)
    before = ml.cross_validate(signal, lambda t: ml.fit_logistic(t, SHORT, max_iter=20), folds=2,
                               oversample=lambda d: ml.smote(d, 0.9, SHORT), reference_order=True)
    assert before.mean > 0.9


def brute_force_shapley(tree_values, x, n):
    """Average marginal contribution over all orders, with the path-share expectation of one tree."""
    out = np.zeros(n)
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        for size in range(n):
            for s in itertools.combinations(rest, size):
                w = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                out[i] += w * (tree_values(x, set(s) | {i}) - tree_values(x, set(s)))
    return out


def test_tree_contributions_are_exact_shapley_values(spark, signal):
    model = ml.fit_trees(signal, SHORT, n_trees=3, depth=3)
    leaves = ml.leaf_paths(model, spark)

    def expectation(x, known):
        total = 0.0
        for value, f, lo, hi, share in leaves:
            part = value
            for j, feature in enumerate(f):
                part *= float(lo[j] < x[feature] <= hi[j]) if feature in known else share[j]
            total += part
        return 2.0 * total

    rows = ml.with_tree_contributions(model, ml.with_probability(model, signal, ["applicant_id", *SHORT]).filter("applicant_id < 20"), SHORT).collect()
    for r in rows:
        x = np.array([r[f] for f in SHORT])
        assert r["contributions"] == pytest.approx(list(brute_force_shapley(expectation, x, 3)), abs=1e-9)
        margin = expectation(x, set()) + sum(r["contributions"])
        assert 1 / (1 + math.exp(-margin)) == pytest.approx(r["score"], abs=1e-9)


def test_trees_are_fitted_in_as_many_tasks_as_the_rows_need(spark, signal, monkeypatch):
    spread, tracker = signal.repartition(12).localCheckpoint(), spark.sparkContext.statusTracker()

    def tasks(group):
        spark.sparkContext.setJobGroup(group, group)
        ml.fit_trees(spread, SHORT, n_trees=3, depth=3)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        return sorted(s.numTasks for s in stages if s is not None)

    few = tasks("few-rows")
    assert few[len(few) // 2] == 1
    monkeypatch.setattr(ml, "ROWS_A_TASK", signal.count() / 4)
    more = tasks("more-rows")
    assert more[len(more) // 2] == 4


def test_importances_sum_to_one_and_are_sorted(spark, signal):
    out = [r["importance"] for r in ml.feature_importances(ml.fit_trees(signal, SHORT, n_trees=3, depth=3), spark, SHORT).collect()]
    assert sum(out) == pytest.approx(1.0) and out == sorted(out, reverse=True)


def test_top_factors(spark):
    df = spark.createDataFrame([(1.0, -3.00006, 0.5, 0.0)], "a double, b double, c double, d double")
    r = df.select(ml.top_factors({c: F.col(c) for c in "abcd"}).alias("t")).first()["t"]
    assert [(x["feature"], x["direction"], x["impact"]) for x in r] == [("b", "decreases", 3.0001), ("a", "increases", 1.0), ("c", "increases", 0.5)]


@pytest.mark.parametrize("long_path", [10, 2])
def test_stacked_leaves_give_the_sum_over_single_leaves(monkeypatch, long_path):
    monkeypatch.setattr(ml, "LONG_PATH", long_path)
    monkeypatch.setattr(ml, "LEAVES_AT_ONCE", 7)
    rng = np.random.default_rng(1)
    leaves = []
    for _ in range(60):
        f = rng.choice(6, rng.integers(0, 5), replace=False)
        lo, hi = np.sort(rng.integers(0, 5, (2, len(f))) / 4, axis=0)
        leaves.append((rng.normal(), f, np.where(rng.random(len(f)) < 0.3, -np.inf, lo), np.where(rng.random(len(f)) < 0.3, np.inf, hi), rng.random(len(f)) * 0.9 + 0.05))
    x = rng.integers(0, 5, (40, 6)) / 4  # many values at a threshold
    got = ml.shapley_of_leaves(x, *ml.stack_leaves(leaves, 6))
    want = np.zeros(x.shape)
    for value, f, lo, hi, share in leaves:
        for r, row in enumerate(x):
            met = (row[f] > lo) & (row[f] <= hi)
            for j in range(len(f)):
                rest = [k for k in range(len(f)) if k != j]
                for size in range(len(f)):
                    for s in itertools.combinations(rest, size):
                        w = math.factorial(size) * math.factorial(len(f) - size - 1) / math.factorial(len(f))
                        others = math.prod(float(met[k]) if k in s else share[k] for k in rest)
                        want[r, f[j]] += w * value * others * (met[j] - share[j])
    assert got == pytest.approx(want, abs=1e-12)


def test_explanation_keeps_a_block_of_rows_at_a_time():
    rng = np.random.default_rng(2)
    leaves = []
    for _ in range(256):
        f = rng.choice(6, 4, replace=False)
        lo, hi = np.sort(rng.integers(0, 9, (2, 4)) / 8, axis=0)
        leaves.append((rng.normal(), f, lo, hi, rng.random(4) * 0.9 + 0.05))
    x, stacked = rng.integers(0, 9, (40_000, 6)) / 8, ml.stack_leaves(leaves, 6)
    tracemalloc.start()
    got = ml.shapley_of_leaves(x, *stacked)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 40e6  # of 10 million pairs of leaf and row
    parts = [ml.shapley_of_leaves(x[i:i + 7_001], *stacked) for i in range(0, len(x), 7_001)]
    assert np.concatenate(parts) == pytest.approx(got, abs=1e-12)


def test_scored_rows_are_prepared_once(spark, monkeypatch):
    import __spark_entry__ as entry

    real, calls = ml.fit_trees, []
    monkeypatch.setattr(ml, "fit_trees", lambda train, **options: real(train, n_trees=2, depth=2))
    impute = ml.impute_medians
    monkeypatch.setattr(ml, "impute_medians", lambda df: calls.append(df) or impute(df))
    monkeypatch.setattr("riskmart.registry.queries_reports._models", {})
    assert entry.queries()["tree_scores_with_factors"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(calls) == 1


def test_folds_fitted_at_once_equal_folds_fitted_in_turn(spark, signal):
    runs = [ml.cross_validate(signal, lambda t: ml.fit_logistic(t, SHORT), folds=4, at_once=n) for n in (1, 4)]
    assert runs[0] == runs[1] and len(runs[0].folds) == 4
    rows = signal.count()
    assert all(f.n_train + f.n_test == rows for f in runs[0].folds) and sum(f.n_test for f in runs[0].folds) == rows
    assert [r["n_default"] for r in runs[0].fold_frame(spark, "m").orderBy("fold").collect()] == [f.n_default for f in runs[0].folds]


def test_tier_is_taken_before_rounding(spark):
    r = ml.with_tier(spark.createDataFrame([(0.04999999,)], "score double")).first()
    assert (r["risk_tier"], r["default_probability"], r["decision"]) == ("LOW", 0.05, "APPROVE")


def test_repeated_records_are_scored_once(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)] + [(99, None), (98, None)], "id int, x double")
    scored_rows = []

    def score(d):
        scored_rows.append(d.count())
        return d.withColumn("score", F.col("x") * 2)

    out = ml.score_once_per_record(df, score, ["x"])
    assert scored_rows == [4] and out.count() == 32
    assert out.filter("x IS NOT NULL AND score <> 2 * x").count() == 0


def test_global_importance(spark, signal):
    out = ml.global_importance(signal, ml.linear_contributions({"f0": 2.0, "f1": 0.0}, {"f0": 0.5, "f1": 0.5}), rows=500).collect()
    assert [r["feature"] for r in out] == ["f0", "f1"] and out[1]["mean_abs_contribution"] == 0.0 and 0.4 < out[0]["mean_abs_contribution"] < 0.6


def test_synthetic_population_rate(spark):
    df = ml.synthetic_population(spark, 2000)
    assert len(df.columns) == 20 and 0.05 < df.agg(F.avg("label")).first()[0] < 0.11


def test_registered_tree_queries_use_the_full_settings(spark, monkeypatch):
    import inspect

    import __spark_entry__ as entry

    real, fits, folds = ml.fit_trees, [], []

    def small(train, **options):
        fits.append(options)
        return real(train, n_trees=2, depth=2)

    def cross_validate(df, fit, **options):
        folds.append(options.get("folds", inspect.signature(real_cv).parameters["folds"].default))
        fit(df)
        return ml.CrossValidation([0.5] * folds[-1], [ml.Fold(8, 2, 1, 0.5)] * folds[-1])

    real_cv = ml.cross_validate
    monkeypatch.setattr(ml, "fit_trees", small)
    monkeypatch.setattr(ml, "cross_validate", cross_validate)
    monkeypatch.setattr("riskmart.registry.queries_reports._models", {})
    monkeypatch.setattr("riskmart.registry.queries_reports._validated", {})
    for name in ("tree_cross_validation", "tree_cross_validation_scores", "tree_held_out_metrics", "tree_feature_importances", "tree_scores_with_factors"):
        assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert fits == [{}] * 3 and folds == [5]


def test_reweighted_least_squares_equals_the_library_fit(spark, signal):
    model = logit.fit_logit(signal.repartition(3), SHORT)
    rows = signal.count()
    pipeline = ml.Pipeline(stages=[
        ml.VectorAssembler(inputCols=SHORT, outputCol="raw"), ml.StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        ml.LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=500, tol=1e-12, regParam=1.0 / rows, elasticNetParam=0.0, standardization=False),
    ]).fit(signal)
    scaler, fitted = pipeline.stages[1], pipeline.stages[2]
    assert model.converged and model.steps < 15
    assert list(model.coefficients) == pytest.approx([b / s for b, s in zip(fitted.coefficients, scaler.std)], abs=1e-6)
    scored = ml.with_probability(model, signal, ["applicant_id"]).join(
        ml.with_probability(pipeline, signal, ["applicant_id"]).withColumnRenamed("score", "other"), "applicant_id")
    assert scored.agg(F.max(F.abs(F.col("score") - F.col("other")))).first()[0] < 1e-6


def test_a_logistic_model_scores_after_an_observation(spark, signal):
    seen = Observation("seen")
    signal.observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get["n"] > 0
    model = ml.fit_logistic(signal, SHORT, max_iter=20)
    assert 0 < ml.with_probability(model, signal, ["label"]).agg(F.avg("score")).first()[0] < 1
    assert len(ml.logistic_contributions(model, SHORT)) == len(SHORT)


def test_logit_of_odd_tables(spark):
    schema = "label int, a double, b double"
    empty = logit.fit_logit(spark.createDataFrame([], schema), ["a", "b"])
    assert empty.coefficients == (0.0, 0.0) and empty.converged
    flat = logit.fit_logit(spark.createDataFrame([(i % 2, 1.0, float(i)) for i in range(8)] + [(None, 2.0, 3.0), (1, None, 3.0)], schema), ["a", "b"])
    assert flat.coefficients[0] == pytest.approx(0.0) and flat.converged
    apart = logit.fit_logit(spark.createDataFrame([(int(i > 5), 0.0, float(i)) for i in range(12)], schema), ["a", "b"])  # separable
    assert apart.converged and apart.coefficients[1] > 0


def test_near_rows_are_cut_per_line_before_they_are_moved(spark):
    rows = spark.range(40).select("id", F.array(F.col("id").cast("double"), (F.col("id") * 7 % 40).cast("double")).alias("x"))
    near = ml.nearest_by_projection(rows, "id", 2, k=2, projections=3)
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("collect_list(near"):]
    assert below.count("slice(") == 3  # one for each line
    points = {r["id"]: r["x"] for r in rows.collect()}
    for r in near.collect():
        found = [(n["d"], n["id"]) for n in r["near"]]
        assert len(found) == 2 and found == sorted(found) and r["id"] not in [i for _, i in found]
        assert all(d == sum((a - b) ** 2 for a, b in zip(points[i], points[r["id"]])) for d, i in found)
