"""Report operators: histogram edges, density normalisation, labels, melt."""

import pytest

from ledgerline.operators import report as RP


def test_histogram_counts_every_row_and_keeps_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x), x % 2) for x in range(101)], "v double, s int")
    h = RP.histogram(df, "v", 40, ["s"]).collect()
    assert sum(r["count"] for r in h) == 101
    assert max(r["bin"] for r in h) == 39
    top = [r for r in h if r["bin"] == 39]
    assert sum(r["count"] for r in top) == 3  # 97.5 <= v <= 100


def test_density_integrates_to_one_per_series(spark):
    rows = [("a", i / 10.0) for i in range(50)] + [("b", i / 7.0) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, v double")
    d = RP.density(df, "v", 45, ["k"]).collect()
    width = (max(v for _, v in rows) - min(v for _, v in rows)) / 45
    for k in ("a", "b"):
        assert sum(r["density"] * width for r in d if r["k"] == k) == pytest.approx(1.0)


def test_labels_fall_back_to_title_case(spark):
    df = spark.createDataFrame([("buy_and_hold", "log_reg"), ("my_new_rule", "my_model")], "strategy_key string, model_key string")
    got = {r.strategy_key: (r.strategy, r.model) for r in RP.add_labels(df, spark).collect()}
    assert got["buy_and_hold"] == ("Buy & Hold", "Logistic Regression")
    assert got["my_new_rule"] == ("My New Rule", "My Model")


def test_melt_and_recode(spark):
    df = spark.createDataFrame([("m", 0.5, 0.25, 0.75)], "model_key string, accuracy double, f1 double, recall double")
    long = RP.recode_metrics(RP.melt(df, ["model_key"], ["accuracy", "f1", "recall"]))
    assert {(r.metric, r.value) for r in long.collect()} == {("Accuracy", 0.5), ("F1", 0.25), ("recall", 0.75)}


def test_no_rows_and_missing_values_have_no_bins(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert RP.density(empty, "v", 45, ["k"]).collect() == [] and RP.histogram(empty, "v", 4, ["k"]).collect() == []
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", None), ("b", 3.0)], "k string, v double")
    d = {r["k"]: (r["bin"], r["count"], r["density"]) for r in RP.density(df, "v", 4, ["k"]).collect()}
    assert d == {"a": (0, 1, 2.0), "b": (3, 1, 2.0)}
