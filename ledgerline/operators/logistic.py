"""Logistic regression by Newton steps, each from one distributed pass (M1).

Minimises ``sum of class weight x log loss + |coefficients|^2 / 2`` over features standardised with their mean and population
deviation (constant features are only centred); the intercept is free, class weights are rows / (2 x rows of the class).  The
problem is strictly convex, so the solution does not depend on the solver and its gradient can be checked (``gradient``).

A pass sums the loss, the gradient and the weighted Gram matrix of every task's rows; Spark adds the tasks' sums, and the driver
solves one system of features + 1 unknowns.  A step that does not lower the objective is halved.  Partial sums are added
in the order of their values, so the same rows in the same partitions give the same bits whichever task ends first.

Missing values count as 0, rows without a label are left out, and one class only (or no rows) gives a constant.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import nan_to_null
from ledgerline.operators.trees import _written
from ledgerline.session import ship_package

L2 = 1.0
TOLERANCE = 1e-12  # of the expected gain of a step; the step is taken, and squares the distance
HALVINGS = 40


def _value(name: str) -> Column:
    return F.coalesce(nan_to_null(name), F.lit(0.0))


@dataclass
class Logistic:
    features: list[str]
    means: list[float]
    scales: list[float]
    coefficients: list[float]  # of the standardised features
    intercept: float

    def raw_score(self) -> Column:
        out = F.lit(self.intercept)
        for name, mean, scale, c in zip(self.features, self.means, self.scales, self.coefficients):
            out = out + (_value(name) - F.lit(mean)) / F.lit(scale) * F.lit(c)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``raw_score``, ``p_up`` and ``prediction``; missing values count as 0."""
        out = df.withColumn("raw_score", self.raw_score())
        out = out.withColumn("p_up", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("raw_score"))))
        return out.withColumn("prediction", (F.col("p_up") > 0.5).cast("double"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(place, name, mean, scale, coefficient); the intercept is the row without a name."""
        rows = [(i, *r) for i, r in enumerate(zip(self.features, self.means, self.scales, self.coefficients))]
        return spark.createDataFrame([*rows, (len(rows), None, 0.0, 1.0, self.intercept)], "place int, name string, mean double, scale double, coefficient double")

    def save(self, spark: SparkSession, path: str) -> str:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Logistic:
        *rows, last = spark.read.parquet(f"{path}/coefficients").orderBy("place").collect()  # one row a feature
        return cls([r["name"] for r in rows], [r["mean"] for r in rows], [r["scale"] for r in rows], [r["coefficient"] for r in rows], last["coefficient"])


def balanced_weights(n0: int, n1: int) -> tuple[float, float]:
    total = n0 + n1
    return (total / (2.0 * n0) if n0 else 0.0, total / (2.0 * n1) if n1 else 0.0)


def gradient(model: Logistic, train: DataFrame, label: str, l2: float = L2) -> DataFrame:
    """(feature, gradient) of the penalised objective at ``model``, by plain aggregates over ``train``; zero at the solution."""
    rows = train.where(F.col(label).isNotNull()).withColumn("_y", F.col(label).cast("double"))
    sizes = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two classes
    w0, w1 = balanced_weights(sizes.get(0.0, 0), sizes.get(1.0, 0))
    residual = F.when(F.col("_y") == 1, w1).otherwise(w0) * (F.col("p_up") - F.col("_y"))
    sums = [
        (F.sum(residual * (_value(name) - F.lit(mean)) / F.lit(scale)) + F.lit(l2 * c)).alias(f"g{i}")
        for i, (name, mean, scale, c) in enumerate(zip(model.features, model.means, model.scales, model.coefficients))
    ]
    one = model.transform(rows).agg(*sums, F.sum(residual).alias(f"g{len(sums)}"))
    named = [F.struct(F.lit(name).alias("feature"), F.col(f"g{i}").alias("gradient")) for i, name in enumerate([*model.features, "intercept"])]
    return one.select(F.explode(F.array(*named)).alias("x")).select("x.*")


def _summed(rows: DataFrame, width: int, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``part(features, label)``, an array of ``width`` numbers for a batch."""

    def run(batches):
        held = np.zeros(width)
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            held += part(np.column_stack(columns[:-1]) if columns[1:] else np.empty((batch.num_rows, 0)), columns[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(held)], names=["place", "value"])

    parts = rows.mapInArrow(run, "place int, value double")
    total = F.aggregate(F.array_sort(F.collect_list("value")), F.lit(0.0), lambda a, b: a + b)  # one number a task
    found = parts.groupBy("place").agg(total.alias("value")).toArrow()
    out = np.zeros(width)
    out[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return out


@dataclass
class _State:
    loss: float
    gradient: np.ndarray
    gram: np.ndarray


def _pass(rows: DataFrame, theta: np.ndarray, means: np.ndarray, scales: np.ndarray, weights: tuple[float, float], l2: float) -> _State:
    n = len(theta)
    upper = np.triu_indices(n)

    def part(x, y):
        z = np.column_stack([(x - means) / scales, np.ones(len(y))])
        s = z @ theta
        w = np.where(y == 1, weights[1], weights[0])
        p = 0.5 * (1.0 + np.tanh(0.5 * s))
        gram = (z * (w * p * (1.0 - p))[:, None]).T @ z
        return np.concatenate([[np.sum(w * np.logaddexp(0.0, np.where(y == 1, -s, s)))], z.T @ (w * (p - y)), gram[upper]])

    sums = _summed(rows, 1 + n + len(upper[0]), part)
    penalty = np.append(np.full(n - 1, l2), 0.0)
    gram = np.zeros((n, n))
    gram[upper] = sums[1 + n :]
    gram = gram + np.triu(gram, 1).T + np.diag(penalty)
    return _State(float(sums[0] + 0.5 * np.sum(penalty * theta * theta)), sums[1 : 1 + n] + penalty * theta, gram)


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 2000, l2: float = L2, rows_per_task: int = 50_000) -> Logistic:
    """The fitted model for a 0/1 ``label``; raises ``RuntimeError`` when ``max_iter`` steps do not reach the optimum."""
    features = list(features)
    source = train.where(F.col(label).isNotNull()).select(*[_value(c).alias(f"_f{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("_y"))
    n, up = source.agg(F.count(F.lit(1)), F.sum("_y")).first()
    n1 = int(up or 0)
    ship_package(train.sparkSession)
    if n1 in (0, n):
        odds = math.log(max(n1, 1e-9) / max(n - n1, 1e-9)) if n else 0.0
        return Logistic(features, [0.0] * len(features), [1.0] * len(features), [0.0] * len(features), odds)
    rows = _written(source.coalesce(max(1, -(-n // rows_per_task))), "logistic-rows")
    means = _summed(rows, len(features), lambda x, y: x.sum(axis=0)) / n
    scales = np.sqrt(_summed(rows, len(features), lambda x, y: np.square(x - means).sum(axis=0)) / n)
    scales = np.where(scales > 1e-12 * np.maximum(1.0, np.abs(means)), scales, 1.0)
    weights = balanced_weights(n - n1, n1)
    theta = np.zeros(len(features) + 1)
    state = _pass(rows, theta, means, scales, weights, l2)
    for _ in range(max_iter):
        step = np.linalg.solve(state.gram, state.gradient)
        gain = float(step @ state.gradient) / 2
        for halving in range(HALVINGS):
            trial = theta - step * 0.5**halving
            after = _pass(rows, trial, means, scales, weights, l2)
            if after.loss <= state.loss or gain <= TOLERANCE * max(1.0, state.loss):
                break
        theta, state = trial, after
        if gain <= TOLERANCE * max(1.0, state.loss):
            return Logistic(features, means.tolist(), scales.tolist(), theta[:-1].tolist(), float(theta[-1]))
    raise RuntimeError(f"the logistic regression did not converge in {max_iter} steps")
