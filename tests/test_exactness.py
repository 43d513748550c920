"""Answers outside the shape of the test tables: ties, NaN, null groups, repeated thresholds, missing returns."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import backtest as BT
from ledgerline.operators import classification as CL
from ledgerline.operators import prepare as PR
from ledgerline.operators import report as RP

DAY = dt.date(2020, 1, 1)


def predictions(spark, seed, days=60, entities=3, p=None):
    rng = random.Random(seed)
    rows = []
    for d in range(days):
        for e in range(entities):
            score = p if p is not None else rng.random()
            rows.append((f"i{e}", DAY + dt.timedelta(days=d), rng.gauss(0, 0.01), score))
    return spark.createDataFrame(rows, "index_name string, Date date, next_return double, p_up double")


def test_sweep_equals_one_run_per_threshold(spark):
    preds = predictions(spark, 1)
    grid = [0.5, 0.9, 0.99, 1.5]
    swept = {r["threshold"]: r for r in BT.sweep_metrics(preds, grid, [0.0]).collect()}
    for t in grid:
        direct = BT.strategy_metrics(BT.portfolio_daily_returns(BT.long_cash_frame(preds, t, 0.0)), []).first()
        for name in BT.METRIC_COLUMNS:
            assert math.isclose(swept[t][name], direct[name], rel_tol=1e-12, abs_tol=1e-12), (t, name)
    assert swept[1.5]["sharpe_ratio"] == 0 and swept[1.5]["win_rate"] == 0


def test_repeated_thresholds_keep_their_first_position(spark):
    rows = {r["threshold"]: r["_pos"] for r in BT.sweep_metrics(predictions(spark, 2), [0.5, 0.9, 0.5], [0.0]).collect()}
    assert rows == {0.5: 0, 0.9: 1}


def test_rows_without_a_score_are_no_cash(spark):
    preds = predictions(spark, 3, p=0.9)
    odd = F.col("index_name") == "i0"
    holes = preds.withColumn("p_up", F.when(odd & (F.dayofmonth("Date") % 2 == 0), F.lit(float("nan"))).when(odd, F.lit(None)).otherwise(F.col("p_up")))
    frame = BT.long_cash_frame(holes, 0.5)
    assert frame.where("index_name = 'i0'").count() == 0
    swept = BT.sweep_metrics(holes, [0.5], [0.0]).first()
    assert swept["exposure"] == 1.0


def test_nan_is_no_signal(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.4,), (0.6,)], "x double")
    from ledgerline.functions.columns import at_least_flag, positive_flag

    got = df.select(positive_flag("x").alias("p"), at_least_flag("x", 0.5).alias("a")).collect()
    assert [(r["p"], r["a"]) for r in got] == [(0, 0), (0, 0), (1, 0), (1, 1)]


def test_a_missing_return_has_no_equity(spark):
    daily = spark.createDataFrame(
        [(DAY + dt.timedelta(days=i), r) for i, r in enumerate([0.1, None, -0.5, 0.2])], "Date date, strategy_return double"
    ).withColumn("gross_strategy_return", F.col("strategy_return"))
    got = [(r["equity"], r["drawdown"]) for r in BT.equity_curve(daily, [], block_rows=2).orderBy("Date").collect()]
    assert got[1] == (None, None)
    assert got[3][0] == pytest.approx(1.1 * 0.5 * 1.2) and got[3][1] == pytest.approx(0.6 - 1)


@pytest.mark.parametrize("ranked_values", [3, 100_000])
def test_medians_of_tied_and_wide_columns(spark, ranked_values):
    rng = random.Random(4)
    n = 501
    cols = {
        "zeros": [0.0 if rng.random() < 0.7 else rng.random() for _ in range(n)],
        "wide": [rng.gauss(0, 1) for _ in range(n)],
        "even": [float(i) for i in range(500)] + [None],
        "holes": [None if i % 2 else float("nan") if i % 3 else float(i) for i in range(n)],
        "none": [None] * n,
    }
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    got = PR.exact_medians(df, list(cols), ranked_values)
    for c, values in cols.items():
        known = [v for v in values if v is not None and not math.isnan(v)]
        assert got[c] == (statistics.median(known) if known else None)


def test_null_groups_are_groups_everywhere(spark):
    rng = random.Random(5)
    rows = [(g, rng.randint(0, 1), rng.random()) for g in ("a", None) for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, y int, s double").withColumn("y_pred", F.when(F.col("s") > 0.5, 1).otherwise(0))
    got = {r["g"]: r["roc_auc"] for r in CL.classification_report(df, ["g"], "y", "y_pred", "s").collect()}
    for g in ("a", None):
        own = [(s, y) for k, y, s in rows if k == g]
        pairs = [(a > b) + 0.5 * (a == b) for a, ya in own if ya for b, yb in own if not yb]
        assert got[g] == pytest.approx(sum(pairs) / len(pairs))
    assert {r["g"] for r in CL.minmax_scores(df, ["g"], "s").select("g").distinct().collect()} == {"a", None}
    assert {r["g"] for r in RP.density(df, "s", 5, ["g"]).select("g").distinct().collect()} == {"a", None}


def test_title_case_after_digits(spark):
    got = spark.createDataFrame([("momentum_20d",), ("o'neil_x",)], "k string").select(RP.title_case("k").alias("t")).collect()
    assert [r["t"] for r in got] == ["Momentum 20D", "O'Neil X"] == [x.replace("_", " ").title() for x in ("momentum_20d", "o'neil_x")]
