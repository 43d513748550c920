"""Backtests by hand on a few days, and the grid sweep against one run for each threshold."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import backtest as BT

START = dt.date(1997, 5, 5)


def _scores(spark, **series):
    """One instrument each: (next return, score) a day."""
    rows = [(START + dt.timedelta(days=i), name, r, p) for name, days in series.items() for i, (r, p) in enumerate(days)]
    return spark.createDataFrame(rows, "Date date, index_name string, next_return double, p_up double").withColumn("run", F.lit("r"))


def _metrics(frame):
    (row,) = BT.strategy_metrics(BT.portfolio_daily_returns(frame, ["run"]), ["run"]).collect()
    return row


def test_entry_hold_and_exit_are_charged(spark):
    """Long on days 2, 3 and 5: entries on 2 and 5, an exit on 4."""
    days = [(0.04, 0.2), (0.02, 0.6), (-0.05, 0.55), (0.01, 0.1), (0.03, 0.9)]
    rows = BT.long_cash_frame(_scores(spark, X=days), 0.55, 0.002).orderBy("Date").collect()
    assert [(r.signal, r.trade) for r in rows] == [(0, 0), (1, 1), (1, 0), (0, 1), (1, 1)]
    assert [r.strategy_return for r in rows] == pytest.approx([0.0, 0.018, -0.05, -0.002, 0.028])
    assert [r.gross_strategy_return for r in rows] == pytest.approx([0.0, 0.02, -0.05, 0.0, 0.03])


def test_instruments_weigh_the_same(spark):
    """Three instruments, one of them in cash: means over all three."""
    frame = BT.long_cash_frame(_scores(spark, X=[(0.06, 0.9)], Y=[(0.5, 0.1)], Z=[(-0.03, 0.8)]), 0.5, 0.003, ["run"])
    (day,) = BT.daily_portfolio(frame, ["run"]).collect()
    assert (day.gross_strategy_return, day.strategy_return) == (pytest.approx(0.01), pytest.approx(0.008))
    assert (day.exposure, day.turnover) == (pytest.approx(2 / 3), pytest.approx(2 / 3))


def test_missing_returns_are_no_days_of_profit(spark):
    """0.01, NaN, -0.02: one win in three days, figures from the two known ones."""
    m = _metrics(BT.long_cash_frame(_scores(spark, X=[(0.01, 0.9), (float("nan"), 0.9), (-0.02, 0.9)]), 0.5, 0.0, ["run"]))
    assert m.days == 3 and m.win_rate == pytest.approx(1 / 3) and m.total_return == pytest.approx(1.01 * 0.98 - 1)
    assert m.annualized_return == pytest.approx(-0.005 * 252)
    assert m.annualized_volatility == pytest.approx(0.03 / math.sqrt(2) * math.sqrt(252))
    assert m.sharpe_ratio == pytest.approx(m.annualized_return / m.annualized_volatility)


def test_threshold_with_too_little_exposure_is_passed_over(spark):
    """0.7 has the better ratio, but is long on one day of four only."""
    scores = _scores(spark, X=[(0.02, 0.6), (0.01, 0.65), (-0.02, 0.62), (0.03, 0.8)])
    runs = BT.choose_threshold(scores, [0.7, 0.6], cost_per_trade=0.0, min_exposure=0.5, run_keys=["run"])
    by = {r.threshold: r for r in runs.collect()}
    assert by[0.7].sharpe_ratio > by[0.6].sharpe_ratio and by[0.7].exposure == pytest.approx(0.25)
    assert [t for t, r in by.items() if r.selected] == [0.6]
    direct = _metrics(BT.long_cash_frame(scores, 0.6, 0.0, ["run"]))
    assert all(by[0.6][m] == pytest.approx(direct[m], abs=1e-12) for m in BT.METRIC_COLUMNS)
    none = BT.choose_threshold(scores, [0.95, 0.9], cost_per_trade=0.0, min_exposure=0.5, run_keys=["run"])
    assert none.where("selected").first().threshold == 0.95


def test_sweep_equals_one_run_for_each_threshold(spark):
    wave = lambda k: [(math.sin(k + 1.7 * i) / 40 if i % 9 else float("nan"), (math.cos(k * i) + 1) / 2) for i in range(40)]
    scores = _scores(spark, X=wave(1), Y=wave(2))
    grid = [0.2, 0.5, 0.55, 0.8]
    sweep = {r.threshold: r for r in BT.sweep_metrics(scores, grid, [0.001], ["run"]).collect()}
    for th in grid:
        direct = _metrics(BT.long_cash_frame(scores, th, 0.001, ["run"]))
        for m in BT.METRIC_COLUMNS:
            assert sweep[th][m] == pytest.approx(direct[m], rel=1e-9, abs=1e-12), (th, m)
