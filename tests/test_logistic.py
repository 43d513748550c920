"""Logistic regression: the optimum against plain numpy, its gradient, edge cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from given import SF001
from ledgerline import catalog as C
from ledgerline.operators import logistic as LG
from ledgerline.operators import ml as ML

NAMES = ["a", "b", "c"]


def rows(n=400, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.gauss(3, 2), rng.gauss(-100, 0.5)
        up = rng.random() < 1 / (1 + math.exp(-(a - 3) - 2 * (b + 100) + 1))
        out.append((a if i % 9 else None, b if i % 11 else float("nan"), 7.0, int(up)))
    return out


def objective_gradient(model, data):
    x = np.array([[0.0 if v is None or v != v else v for v in r[:3]] for r in data])
    y = np.array([r[3] for r in data], float)
    z = (x - model.means) / model.scales
    p = 1 / (1 + np.exp(-(z @ model.coefficients + model.intercept)))
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    return [*(z.T @ (w * (p - y)) + np.array(model.coefficients)), np.sum(w * (p - y))], x


def test_gradient_is_zero_and_scales_are_population_ones(spark):
    data = rows()
    df = spark.createDataFrame(data, "a double, b double, c double, target int").repartition(5)
    model = LG.fit_logistic(df, NAMES, "target", rows_per_task=100)
    grad, x = objective_gradient(model, data)
    assert max(map(abs, grad)) < 1e-7
    assert model.means == pytest.approx(x.mean(axis=0)) and model.scales[:2] == pytest.approx(x.std(axis=0)[:2])
    assert model.scales[2] == 1.0 and model.coefficients[2] == pytest.approx(0.0, abs=1e-12)
    checked = {r["feature"]: r["gradient"] for r in LG.gradient(model, df, "target").collect()}
    assert set(checked) == {*NAMES, "intercept"} and max(map(abs, checked.values())) < 1e-7


def test_partitions_and_order_do_not_move_the_optimum(spark):
    df = spark.createDataFrame(rows(), "a double, b double, c double, target int")
    one = LG.fit_logistic(df.coalesce(1), NAMES, "target")
    many = LG.fit_logistic(df.orderBy(F.desc("b")).repartition(7), NAMES, "target", rows_per_task=60)
    assert one.coefficients == pytest.approx(many.coefficients, abs=1e-8) and one.intercept == pytest.approx(many.intercept, abs=1e-8)


def test_separable_rows_converge_under_the_penalty(spark):
    df = spark.createDataFrame([(float(i), int(i >= 10)) for i in range(20)], "a double, target int")
    model = LG.fit_logistic(df, ["a"], "target")
    assert max(abs(r["gradient"]) for r in LG.gradient(model, df, "target").collect()) < 1e-7
    scored = model.transform(df).select("target", "prediction").collect()
    assert all(r["target"] == r["prediction"] for r in scored)


def test_one_class_no_rows_missing_labels_and_no_features(spark):
    schema = "a double, target int"
    up = LG.fit_logistic(spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, None)], schema), ["a"], "target")
    assert up.coefficients == [0.0] and up.intercept > 20
    assert LG.fit_logistic(spark.createDataFrame([], schema), ["a"], "target").intercept == 0.0
    flat = LG.fit_logistic(spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, 0)], schema), [], "target")
    assert flat.features == [] and flat.intercept == pytest.approx(0.0, abs=1e-9)


def test_too_few_steps_raise(spark):
    with pytest.raises(RuntimeError, match="did not converge"):
        LG.fit_logistic(spark.createDataFrame(rows(), "a double, b double, c double, target int"), NAMES, "target", max_iter=1)


def test_saved_model_scores_alike_and_is_no_udf(spark, tmp_path):
    prep = C.prepared(spark, SF001)
    train = prep.panel.public().where("split = 'train'")
    model = ML.fit("log_reg", train, prep.features)
    back = ML.load(ML.save(model, str(tmp_path / "m")))
    assert back == model
    plan = ML.score(back, train, ["Date"])._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
    assert max(abs(r["gradient"]) for r in LG.gradient(model, train, "target").collect()) < 5e-7
