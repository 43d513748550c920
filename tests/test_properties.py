"""Property tests (hypothesis): the blocked equity curve equals pandas for any
series length (one row included), run count and block size."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import backtest as BT

returns = st.lists(st.floats(min_value=-0.9, max_value=0.9, allow_nan=False), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs=st.lists(returns, min_size=1, max_size=3), block_rows=st.integers(min_value=2, max_value=9))
def test_equity_curve_matches_pandas(spark, runs, block_rows):
    rows = []
    for i, rs in enumerate(runs):
        for j, r in enumerate(rs):
            rows.append((f"r{i}", dt.date(2022, 1, 1) + dt.timedelta(days=3 * j), r, r, 1.0, 0.0))
    daily = spark.createDataFrame(
        rows, "run string, Date date, strategy_return double, gross_strategy_return double, exposure double, turnover double"
    )
    got = BT.equity_curve(daily, ["run"], block_rows=block_rows).toPandas()
    want = pd.DataFrame(rows, columns=["run", "Date", "r", "g", "e", "t"]).sort_values(["run", "Date"])
    want["equity"] = want.groupby("run")["r"].transform(lambda s: (1 + s).cumprod())
    want["drawdown"] = want["equity"] / want.groupby("run")["equity"].cummax() - 1
    m = got.merge(want, on=["run", "Date"], suffixes=("", "_pd"))
    assert len(m) == len(rows)
    assert np.allclose(m["equity"], m["equity_pd"], rtol=1e-10, atol=1e-15)
    assert np.allclose(m["drawdown"], m["drawdown_pd"], rtol=1e-10, atol=1e-12)
