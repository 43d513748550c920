"""Medians from sketches: exact ones against the statistics module on hard columns, merged states, the approximate preparation."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from given import SF001
from ledgerline import catalog as C
from ledgerline.operators import prepare as PR
from ledgerline.operators import quantiles as QT


def columns(n=5000):
    rng = random.Random(8)
    return {
        "normal": [rng.gauss(0, 1) for _ in range(n)],
        "two": [float(i < n // 2) for i in range(n)],  # the middle lies between two heavy ties
        "third": [5.0 if i % 3 == 0 else rng.uniform(0, 10) for i in range(n)],
        "steps": [float(i // 100) for i in range(n)],
        "ends": [float("inf") if i % 5 == 0 else float("-inf") if i % 5 == 1 else rng.random() for i in range(n)],
        "one": [3.25] * n,
        "few": [float(i) if i < 3 else None for i in range(n)],
        "gaps": [float("nan") if i % 7 == 0 else None if i % 7 == 1 else rng.lognormvariate(0, 3) for i in range(n)],
    }


@pytest.mark.parametrize("ranked_values,k", [(20, 8), (200, 64), (4900, 4096)])
def test_exact_medians_narrow_to_the_middle(spark, ranked_values, k):
    data = columns()
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(6)
    got = {r["feature"]: r["median"] for r in QT.exact_medians_frame(df, list(data), ranked_values, k).collect()}
    for c, values in data.items():
        assert got[c] == statistics.median(v for v in values if v is not None and v == v), c


def test_columns_without_values_and_no_columns(spark):
    df = spark.createDataFrame([(None, float("nan"))], "a double, b double")
    assert QT.exact_medians_frame(df, ["a", "b"]).count() == 0
    assert QT.exact_medians(df, ["a"]) == {"a": None} and QT.exact_medians(df, []) == {}
    assert QT.approximate_medians_frame(df, ["a", "b"]).count() == 0 and QT.approximate_medians_frame(df, []).count() == 0
    assert QT.exact_medians_frame(df.limit(0), ["a"]).count() == 0


def test_merged_states_keep_the_stated_rank_error(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), ((F.col("id") * 7919) % 60_000).cast("double").alias("v"))
    states = QT.sketch_states(df, ["v"], ["day"], 200)
    assert states.count() == 30 and states.agg(F.sum("rows")).first()[0] == 60_000
    first = QT.merged_medians(states.where("day < 10"), k=200).first()
    both = QT.merged_medians(states.where("day < 10").unionByName(states.where("day >= 10")), k=200).first()
    assert first["rows"] == 20_000 and both["rows"] == 60_000
    assert abs(both["median"] - 30_000) <= 4 * QT.rank_error(200) * 60_000


def test_no_exchange_carries_rows(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    plan = QT.sketch_states(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_kll" in plan  # one buffer a task


def test_preparation_with_sketched_medians(spark):
    panel = C.feature_panel(spark, SF001)
    exact, near = PR.prepare(panel), PR.prepare(panel, median_sketch=4096)
    assert near.features == exact.features and near.panel.df.count() == exact.panel.df.count()
    for c, m in exact.medians.items():
        assert (m is None) == (near.medians[c] is None)
