"""Per-instrument price features and the next-day target (C1: W1-W6, P7-P9).

One halo pass: rows are shuffled once by ``(index_name, _blk)``; every
feature window shares that partitioning and ordering, so Spark plans a
single Exchange + Sort and stacks the dependent Window nodes on it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.columns import positive_flag, ratio_minus_one
from ledgerline.operators.ewm import ema_column_name, trailing_ema
from ledgerline.plans import series as S
from ledgerline.sources.panels import Panel

RETURN_HORIZONS = (1, 2, 5, 10, 20)
VOLATILITY_WINDOWS = (5, 10, 20)
EMA_SPANS = (10, 20, 50, 200)
LOOKBACK_ROWS = 60  # longest trailing frame (60-row high)
PLANTED_EMA_ROWS = 10  # forward rows of the planted look-ahead EMA

# Fixed output order of the engineered columns.
ENGINEERED_COLUMNS = (
    "return_1d",
    "return_2d",
    "return_5d",
    "return_10d",
    "return_20d",
    "volatility_5d",
    "volatility_10d",
    "volatility_20d",
    "volatility_ratio_5d_20d",
    "return_5d_to_volatility_20d",
    "return_20d_to_volatility_20d",
    "drawdown_20d",
    "drawdown_60d",
    "price_vs_20d_low",
    "price_vs_trailing_ema_10",
    "price_vs_trailing_ema_20",
    "price_vs_trailing_ema_50",
    "price_vs_trailing_ema_200",
    "trailing_ema_10_vs_50",
    "trailing_ema_20_vs_200",
)


def price_features(panel: Panel, planted_lookahead: bool = False, keep_extremes: bool = False) -> Panel:
    """Add the 20 engineered columns, ``next_return`` and ``target``.

    With ``planted_lookahead`` two columns that look into the future are
    added as well (``mom`` = -next_return and a forward-weighted ``EMA_10``);
    the preparation step must drop them.
    """
    keys = list(panel.keys)
    fwd = PLANTED_EMA_ROWS if planted_lookahead else 1
    df = S.with_halo(panel.df, back=LOOKBACK_ROWS, fwd=fwd, block_rows=panel.block_rows)
    w = S.block_window(keys)
    px = F.col("Price")

    df = df.withColumns({f"return_{h}d": ratio_minus_one(px, F.lag(px, h).over(w)) for h in RETURN_HORIZONS})
    df = df.withColumns(
        {f"volatility_{n}d": S.full_rolling(F.stddev_samp, F.col("return_1d"), n, keys) for n in VOLATILITY_WINDOWS}
    )
    df = df.withColumns(
        {
            "rolling_high_20d": S.full_rolling(F.max, px, 20, keys),
            "rolling_high_60d": S.full_rolling(F.max, px, 60, keys),
            "rolling_low_20d": S.full_rolling(F.min, px, 20, keys),
            "next_return": ratio_minus_one(F.lead(px, 1).over(w), px),
        }
    )
    df = trailing_ema(df, keys, "Price", EMA_SPANS, panel.n_blocks, panel.block_rows, panel.entities)
    ema = {span: F.col(ema_column_name(span)) for span in EMA_SPANS}
    derived = {
        "volatility_ratio_5d_20d": F.try_divide("volatility_5d", "volatility_20d"),
        "return_5d_to_volatility_20d": F.try_divide("return_5d", "volatility_20d"),
        "return_20d_to_volatility_20d": F.try_divide("return_20d", "volatility_20d"),
        "drawdown_20d": ratio_minus_one(px, "rolling_high_20d"),
        "drawdown_60d": ratio_minus_one(px, "rolling_high_60d"),
        "price_vs_20d_low": ratio_minus_one(px, "rolling_low_20d"),
        **{f"price_vs_trailing_ema_{s}": ratio_minus_one(px, ema[s]) for s in EMA_SPANS},
        "trailing_ema_10_vs_50": ratio_minus_one(ema[10], ema[50]),
        "trailing_ema_20_vs_200": ratio_minus_one(ema[20], ema[200]),
        "target": positive_flag("next_return"),
    }
    if planted_lookahead:
        c = 1.0 - 2.0 / 11.0
        weights = [c**j for j in range(PLANTED_EMA_ROWS)]
        ahead = sum(F.coalesce(F.lead(px, j).over(w), px) * wt for j, wt in enumerate(weights))
        derived["mom"] = -F.col("next_return")
        derived["EMA_10"] = ahead / F.lit(sum(weights))
    df = df.withColumns(derived).where(F.col(S.OWN))
    base = [c for c in panel.df.columns if c not in (S.BLK, S.OWN)]
    extra = ["mom", "EMA_10"] if planted_lookahead else []
    if keep_extremes:
        extra += ["rolling_high_20d", "rolling_high_60d", "rolling_low_20d"]
    out = df.select(*base, *extra, *ENGINEERED_COLUMNS, "next_return", "target")
    return panel.with_df(S.keep(out))
