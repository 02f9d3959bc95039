"""Logistic regression by iteratively reweighted least squares: one pass over the rows per step."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart import constants as K


@dataclass(frozen=True)
class Logit:
    """Coefficients on the scale of the inputs; ``means`` are those of the training rows."""

    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    means: tuple[float, ...]
    steps: int
    converged: bool

    def margin(self) -> Column:
        out = F.lit(self.intercept)
        for f, c in zip(self.features, self.coefficients):
            out = out + F.lit(c) * F.col(f).cast("double")
        return out

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))

    def weights(self) -> Mapping[str, float]:
        return dict(zip(self.features, self.coefficients))

    def to_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([("(intercept)", self.intercept), *zip(self.features, self.coefficients)], "feature string, coefficient double")


def _moments(rows: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation of each feature, 1 where there is none."""
    row = rows.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)], *[F.stddev_samp(f).alias(f"s{i}") for i, f in enumerate(features)]).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(len(features))])
    return mean, np.array([row[f"s{i}"] or 1.0 for i in range(len(features))])


def _sums(rows: DataFrame, beta: np.ndarray, mean: np.ndarray, std: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Curvature, slope and log-likelihood at ``beta`` (intercept first, standardised features).

    Each task adds up its own rows; the sums of the tasks, a few hundred numbers each, are added by Spark.
    """
    size = len(beta)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size + size + 1)
        for batch in batches:
            y, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            z = np.column_stack([np.ones(len(y)), (np.column_stack(x) - mean) / std])
            margin = z @ beta
            p = 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))
            total[:size * size] += ((z * (p * (1 - p))[:, None]).T @ z).ravel()
            total[size * size:-1] += (y - p) @ z
            total[-1] += (y * margin - np.logaddexp(0.0, margin)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "value"])

    summed = rows.mapInArrow(part, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(size * size + size + 1)
    for r in summed:
        flat[r["place"]] = r["value"]
    return flat[:size * size].reshape(size, size), flat[size * size:-1], float(flat[-1])


def fit_logit(train: DataFrame, features: Sequence[str] = K.FEATURES, label: str = "label", c: float = K.LOGIT_PARAMS["c"],
              max_steps: int = 50, tolerance: float = 1e-9) -> Logit:
    """Logistic regression on standardised features with ridge penalty 1/c, which spares the intercept.

    A step solves the weighted least-squares equations of the features, whose size is that of the feature list and not
    of the data; a step that lowers the penalised likelihood is halved. It ends when no standardised coefficient
    moves by more than ``tolerance``, or after ``max_steps`` passes. Rows with a missing feature or label are left
    out; without rows all coefficients are 0, and a feature with one value gets 0.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the executors need no copy of this package
    rows = train.select(F.col(label).cast("double").alias("y"), *[F.col(f).cast("double").alias(f) for f in features]).dropna()
    mean, std = _moments(rows, features)
    penalty = np.array([0.0, *[1.0 / c] * len(features)])
    beta, last, best, steps, moved = np.zeros(len(penalty)), None, -np.inf, 0, np.inf
    while steps < max_steps and moved > tolerance:
        curvature, slope, likelihood = _sums(rows, beta, mean, std)
        value = likelihood - 0.5 * float(penalty @ beta**2)
        steps += 1
        if last is not None and value < best - 1e-9 * abs(best):
            beta = (beta + last) / 2
            moved = float(np.abs(beta - last).max())
            continue
        step = np.linalg.lstsq(curvature + np.diag(penalty), slope - penalty * beta, rcond=None)[0]
        last, best, beta, moved = beta, value, beta + step, float(np.abs(step).max())
    raw = beta[1:] / std
    return Logit(tuple(features), float(beta[0] - raw @ mean), tuple(map(float, raw)), tuple(map(float, mean)), steps, moved <= tolerance)
