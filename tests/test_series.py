"""Blocked series machinery against plain pandas recomputation.

Small blocks force many blocks per entity; FOLD_SPAN = 0 forces the doubling
scan path that long histories take.
"""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import backtest as BT
from ledgerline.operators.ewm import ema_column_name, trailing_ema
from ledgerline.operators.prepare import ffill_lag
from ledgerline.plans import series as S
from ledgerline.sources.panels import Panel


def _panel_rows(n_per=(37, 53, 5), gaps=True, seed=3):
    rnd = random.Random(seed)
    rows = []
    for k, n in zip("ABC", n_per):
        d = dt.date(2020, 1, 1)
        price = 100.0
        for i in range(n):
            d += dt.timedelta(days=rnd.choice([1, 1, 1, 3, 40]) if gaps else 1)
            price *= 1 + rnd.uniform(-0.05, 0.05)
            x = None if rnd.random() < 0.3 else rnd.uniform(-1, 1)
            rows.append((k, d, price, x))
    return rows


@pytest.fixture(params=[64, 0], ids=["fold", "doubling"])
def scan_path(request, monkeypatch):
    monkeypatch.setattr(S, "FOLD_SPAN", request.param)
    return request.param


def _frame(spark, rows):
    return spark.createDataFrame(rows, "index_name string, Date date, Price double, x double")


def test_ordinal_matches_row_number(spark, scan_path):
    rows = _panel_rows()
    df, max_rows = S.with_ordinal(_frame(spark, rows), ["index_name"], "Date", block_rows=4, range_rows=9)
    got = df.select("index_name", "Date", S.ORD).toPandas()
    pdf = pd.DataFrame(rows, columns=["index_name", "Date", "Price", "x"])
    pdf["t"] = pdf.sort_values("Date").groupby("index_name").cumcount()
    m = got.merge(pdf, on=["index_name", "Date"])
    assert len(m) == len(rows) and (m[S.ORD] == m["t"]).all()
    assert max_rows == 53


def test_ema_matches_sequential(spark, scan_path):
    rows = _panel_rows()
    ordered, max_rows = S.with_ordinal(_frame(spark, rows), ["index_name"], "Date", block_rows=4)
    blocked = S.with_blocks(ordered, 4)
    out = trailing_ema(blocked, ["index_name"], "Price", [3, 10], S.n_blocks(max_rows, 4), 4).toPandas()
    pdf = pd.DataFrame(rows, columns=["index_name", "Date", "Price", "x"]).sort_values(["index_name", "Date"])
    for span in (3, 10):
        pdf[f"e{span}"] = pdf.groupby("index_name")["Price"].transform(lambda s: s.ewm(span=span, adjust=False).mean())
    m = out.merge(pdf, on=["index_name", "Date"])
    for span in (3, 10):
        assert np.allclose(m[ema_column_name(span)], m[f"e{span}"], rtol=1e-12)


def test_ffill_lag_matches_pandas(spark, scan_path):
    rows = _panel_rows()
    ordered, max_rows = S.with_ordinal(_frame(spark, rows), ["index_name"], "Date", block_rows=4)
    panel = Panel(df=ordered, max_rows=max_rows, block_rows=4)
    got = ffill_lag(panel, ["x"]).df.select("index_name", "Date", "x").toPandas()
    pdf = pd.DataFrame(rows, columns=["index_name", "Date", "Price", "x"]).sort_values(["index_name", "Date"])
    pdf["want"] = pdf.groupby("index_name")["x"].ffill()
    pdf["want"] = pdf.groupby("index_name")["want"].shift(1)
    m = got.merge(pdf, on=["index_name", "Date"], suffixes=("", "_raw"))
    assert ((m["x"] - m["want"]).abs().fillna(0) < 1e-15).all()
    assert (m["x"].isna() == m["want"].isna()).all()


def test_equity_curve_matches_cumprod(spark, scan_path):
    rnd = random.Random(11)
    rows = []
    for run in ("r1", "r2"):
        for i in range(45):
            r = rnd.uniform(-0.5, 0.4) if run == "r1" else rnd.uniform(-2.5, 1.0)  # r2 flips equity sign
            rows.append((run, dt.date(2021, 1, 1) + dt.timedelta(days=i), r, r / 2, 0.5, 0.1))
    daily = spark.createDataFrame(
        rows, "run string, Date date, strategy_return double, gross_strategy_return double, exposure double, turnover double"
    )
    got = BT.equity_curve(daily, ["run"], block_rows=4).toPandas()
    pdf = pd.DataFrame(rows, columns=["run", "Date", "strategy_return", "g", "e", "t"]).sort_values(["run", "Date"])
    pdf["equity"] = pdf.groupby("run")["strategy_return"].transform(lambda s: (1 + s).cumprod())
    pdf["peak"] = pdf.groupby("run")["equity"].cummax()
    pdf["drawdown"] = pdf["equity"] / pdf["peak"] - 1
    m = got.merge(pdf, on=["run", "Date"], suffixes=("", "_pd"))
    assert np.allclose(m["equity"], m["equity_pd"], rtol=1e-9)
    assert np.allclose(m["drawdown"], m["drawdown_pd"], rtol=1e-9, atol=1e-12)


def test_halo_windows_match_unblocked(spark):
    rows = _panel_rows(gaps=True)
    ordered, _ = S.with_ordinal(_frame(spark, rows), ["index_name"], "Date", block_rows=8)
    h = S.with_halo(ordered, back=5, fwd=1, block_rows=8)
    w = S.block_window(["index_name"])
    got = (
        h.withColumns(
            {
                "lag3": F.lag("Price", 3).over(w),
                "lead1": F.lead("Price", 1).over(w),
                "mx": S.full_rolling(F.max, F.col("Price"), 6, ["index_name"]),
            }
        )
        .where(F.col(S.OWN))
        .toPandas()
    )
    pdf = pd.DataFrame(rows, columns=["index_name", "Date", "Price", "x"]).sort_values(["index_name", "Date"])
    g = pdf.groupby("index_name")["Price"]
    pdf["lag3"], pdf["lead1"] = g.shift(3), g.shift(-1)
    pdf["mx"] = g.transform(lambda s: s.rolling(6).max())
    m = got.merge(pdf, on=["index_name", "Date"], suffixes=("", "_pd"))
    for c in ("lag3", "lead1", "mx"):
        assert ((m[c] - m[f"{c}_pd"]).abs().fillna(0) == 0).all() and (m[c].isna() == m[f"{c}_pd"].isna()).all(), c


def test_halo_larger_than_block_is_rejected(spark):
    df = spark.createDataFrame([(0,)], "_t long")
    with pytest.raises(ValueError):
        S.with_halo(df, back=10, block_rows=4)


def test_fast_ema_span_rejected_for_large_blocks():
    from ledgerline.operators.ewm import _decay

    assert _decay(10, 256) == pytest.approx(1 - 2 / 11)
    with pytest.raises(ValueError):
        _decay(1.01, 4096)
    assert math.isclose(_decay(1, 256), 0.0)


def test_doubling_scan_with_lineage_cuts(spark, monkeypatch):
    """Force the doubling path and a checkpoint after every round."""
    monkeypatch.setattr(S, "FOLD_SPAN", 0)
    monkeypatch.setattr(S, "ROUNDS_PER_CHECKPOINT", 1)
    rows = [(k, p, float(p % 5 + (k == "b"))) for k in ("a", "b") for p in range(37)]
    df = spark.createDataFrame(rows, "k string, p long, v double")
    out = S.prefix_scan(df, ["k"], "p", "v", lambda a, b: a + b, span=37).toPandas()
    want = pd.DataFrame(rows, columns=["k", "p", "v"]).sort_values(["k", "p"])
    want["cum"] = want.groupby("k")["v"].cumsum()
    m = out.merge(want, on=["k", "p"], suffixes=("", "_in"))
    assert len(m) == len(rows) and np.allclose(m["v"], m["cum"])


def test_ranges_stop_growing_with_the_rows(spark, monkeypatch):
    assert [S.range_count(spark, n, 100) for n in (0, 1, 100, 101)] == [1, 1, 1, 2]
    assert S.range_count(spark, 10**12, 100_000) == S.MOST_RANGES
    monkeypatch.setattr(S, "MOST_RANGES", 3)
    df = spark.createDataFrame([(f"k{i % 5}", i) for i in range(2000)], "k string, t long")
    few, longest = S.with_ordinal(df, ["k"], "t", range_rows=10)
    assert longest == 400
    assert few.where(F.col(S.ORD) != F.floor(F.col("t") / 5)).count() == 0
