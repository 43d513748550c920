"""Long/cash backtests.

Row level: a run (``run_keys``, e.g. ``strategy_key, split``) holds one row
per instrument and day with ``signal`` (1 long, 0 cash), ``trade`` (|signal
change| per instrument, the first row pays entry), gross and net returns.

Portfolio level: the equal-weight mean per run and day (one hash aggregate),
then equity = cumulative product of ``1 + r`` and drawdown against the
running maximum, computed as blocked prefix scans partitioned by run, never
by a single partition.

Threshold sweeps do not multiply rows by thresholds: a row is long at the
thresholds below its position in the sorted grid and trades between its own and the
previous position.  Counts per run, day and grid position, summed from the
highest position down, yield exposure, gross return and turnover for all
thresholds at once; returns are only ever added, so a threshold that selects
nothing has a return of exactly 0.  Costs enter linearly at the daily level
(net = gross - cost * turnover).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import SQRT_YEAR, TRADING_DAYS_PER_YEAR, at_least_flag, guarded_ratio, nan_to_null, positive_flag
from ledgerline.plans import series as S

# The reference's backtest parameters.
THRESHOLDS = (0.50, 0.52, 0.55, 0.57, 0.60)
COST_PER_TRADE = 0.0001
MIN_EXPOSURE = 0.10
RULES = (
    "buy_and_hold",
    "cash",
    "previous_day_direction",
    "price_above_trailing_ema_20",
    "positive_20d_momentum",
)
# What-if grid: thresholds 0.40..0.75 step 0.01, costs 0..25 bps step 0.5.
WHAT_IF_THRESHOLDS = tuple(round(0.40 + 0.01 * i, 2) for i in range(36))
WHAT_IF_COSTS_BPS = tuple(0.5 * i for i in range(51))

ENTITY = "index_name"
TIME = "Date"

DAILY_COLUMNS = ("strategy_return", "gross_strategy_return", "exposure", "turnover")
METRIC_COLUMNS = (
    "days",
    "total_return",
    "annualized_return",
    "annualized_volatility",
    "sharpe_ratio",
    "max_drawdown",
    "win_rate",
    "exposure",
    "turnover",
    "gross_total_return",
    "gross_annualized_return",
    "gross_sharpe_ratio",
)
NET_METRIC_COLUMNS = METRIC_COLUMNS[:9]


# ------------------------------------------------------------------ rows ---
def with_previous(
    df: DataFrame, entity_keys: Sequence[str], columns: Sequence[str], block_rows: int = S.DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """Add ``_prev_<c>``: the value of ``c`` on the previous row of the entity (null on the first)."""
    ordered, _ = S.with_ordinal(df, entity_keys, TIME, block_rows)
    halo = S.with_halo(ordered, back=1, block_rows=block_rows)
    w = S.block_window(entity_keys)
    out = halo.withColumns({f"_prev_{c}": F.lag(c, 1).over(w) for c in columns})
    return out.where(F.col(S.OWN)).drop(S.ORD, S.BLK, S.OWN)


def add_returns(df: DataFrame, cost: float | Column) -> DataFrame:
    """gross = signal * next_return; net = gross - cost * trade.  A NaN return is a missing one."""
    cost_col = cost if isinstance(cost, Column) else F.lit(float(cost))
    gross = F.col("signal") * nan_to_null("next_return")
    return df.withColumns(
        {
            "gross_strategy_return": gross,
            "strategy_return": gross - cost_col * F.col("trade"),
        }
    )


def with_trades(df: DataFrame, run_keys: Sequence[str]) -> DataFrame:
    """trade = |signal - previous signal| per run and instrument; first row = signal."""
    prev = with_previous(df, [*run_keys, ENTITY], ["signal"])
    trade = F.coalesce(F.abs(F.col("signal") - F.col("_prev_signal")), F.col("signal"))
    return prev.withColumn("trade", trade).drop("_prev_signal")


def long_cash_frame(
    predictions: DataFrame,
    threshold: float,
    cost_per_trade: float = COST_PER_TRADE,
    run_keys: Sequence[str] = (),
) -> DataFrame:
    """``Date, index_name, next_return, p_up`` -> row-level long/cash returns.

    Rows without a score (null or NaN) are not part of the run (F5).
    """
    df = scored(predictions).withColumn("signal", at_least_flag("p_up", threshold))
    df = add_returns(with_trades(df, run_keys), cost_per_trade)
    return df.withColumns(
        {"threshold": F.lit(float(threshold)), "cost_per_trade": F.lit(float(cost_per_trade))}
    )


def scored(predictions: DataFrame) -> DataFrame:
    """the rows that have a score."""
    return predictions.withColumn("p_up", nan_to_null("p_up")).where(F.col("p_up").isNotNull())


def rule_signals(dataset: DataFrame) -> DataFrame:
    """The five rule signals, one column each."""
    sig = {
        "buy_and_hold": F.lit(1),
        "cash": F.lit(0),
        "previous_day_direction": positive_flag("return_1d"),
        "price_above_trailing_ema_20": positive_flag("price_vs_trailing_ema_20"),
        "positive_20d_momentum": positive_flag("return_20d"),
    }
    return dataset.select(TIME, ENTITY, "split", "next_return", *[v.alias(k) for k, v in sig.items()])


def rule_strategy_frames(
    dataset: DataFrame, splits: Sequence[str] = ("validation", "test"), cost_per_trade: float = COST_PER_TRADE
) -> DataFrame:
    """P14 + P2 for every rule and split in one plan, keyed by ``(strategy_key, split)``."""
    # rows are numbered once, wide; signals and trades of the rules become rows together
    wide = with_previous(rule_signals(dataset.where(F.col("split").isin(list(splits)))), ["split", ENTITY], RULES)
    both = F.array(
        *[
            F.struct(
                F.lit(k).alias("strategy_key"),
                F.col(k).alias("signal"),
                F.coalesce(F.abs(F.col(k) - F.col(f"_prev_{k}")), F.col(k)).alias("trade"),
            )
            for k in RULES
        ]
    )
    rows = wide.select(TIME, ENTITY, "split", "next_return", F.explode(both).alias("_r")).select(
        TIME, ENTITY, "split", "next_return", "_r.*"
    )
    rows = add_returns(rows, cost_per_trade)
    return rows.withColumns(
        {
            "threshold": F.lit(None).cast("double"),
            "cost_per_trade": F.lit(float(cost_per_trade)),
            "model_key": F.col("strategy_key"),
        }
    )


def add_strategy_identity(frame: DataFrame, strategy_key: str, model_key: str | None = None, split: str | None = None) -> DataFrame:
    """Tag a frame; ``model_key`` defaults to ``strategy_key``."""
    cols = {"strategy_key": F.lit(strategy_key), "model_key": F.lit(model_key if model_key is not None else strategy_key)}
    if split is not None:
        cols["split"] = F.lit(split)
    return frame.withColumns(cols)


# ------------------------------------------------------------- portfolio ---
def daily_portfolio(frame: DataFrame, run_keys: Sequence[str]) -> DataFrame:
    """A1: equal-weight mean over instruments per run and day."""
    return frame.groupBy(*run_keys, TIME).agg(
        F.avg("strategy_return").alias("strategy_return"),
        F.avg("gross_strategy_return").alias("gross_strategy_return"),
        F.avg("signal").alias("exposure"),
        F.avg("trade").alias("turnover"),
    )


def equity_curve(
    daily: DataFrame,
    run_keys: Sequence[str],
    block_rows: int = S.DEFAULT_BLOCK_ROWS,
    numbered: tuple[int, int] | None = None,
    keep_ordinal: bool = False,
) -> DataFrame:
    """W9 + W10: equity, gross equity and drawdown per run (blocked prefix scan).

    ``numbered`` (longest run, number of runs) says that ``daily`` already has the
    day number; ``keep_ordinal`` leaves it in the result.  A day without a
    return has no equity or drawdown and leaves the later days as they are.

    Within a block: running products and the running max/min of the local
    equity.  Across blocks the carry is ``(product, max, min)`` composed with
    ``max(M1, P1 * (M2 if P1 >= 0 else m2))`` - exact for any sign.
    Drawdown starts from the first equity value, not from 1.0.
    """
    keys = list(run_keys)
    if numbered is None:
        ordered, max_rows, entities = S.with_ordinal_info(daily, keys, TIME, block_rows)
    else:
        ordered, (max_rows, entities) = daily, numbered
    df = S.with_blocks(ordered, block_rows)
    running = S.block_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns(
        {
            "_lp": F.product(1 + F.col("strategy_return")).over(running),
            "_lg": F.product(1 + F.col("gross_strategy_return")).over(running),
        }
    )
    seen = F.when(F.col("strategy_return").isNotNull(), F.col("_lp"))
    df = df.withColumns({"_lmax": F.max(seen).over(running), "_lmin": F.min(seen).over(running)})
    summary = df.groupBy(*keys, S.BLK).agg(
        F.struct(
            F.coalesce(F.max_by("_lp", S.ORD), F.lit(1.0)).alias("p"),
            F.coalesce(F.max_by("_lg", S.ORD), F.lit(1.0)).alias("g"),
            F.max("_lmax").alias("hi"),
            F.min("_lmin").alias("lo"),
        ).alias("_c")
    )

    def compose(e, l):
        pos = e["p"] >= 0
        return F.struct(
            (e["p"] * l["p"]).alias("p"),
            (e["g"] * l["g"]).alias("g"),
            F.greatest(e["hi"], F.when(pos, e["p"] * l["hi"]).otherwise(e["p"] * l["lo"])).alias("hi"),
            F.least(e["lo"], F.when(pos, e["p"] * l["lo"]).otherwise(e["p"] * l["hi"])).alias("lo"),
        )

    carry = S.block_carry(summary, keys, "_c", compose, S.n_blocks(max_rows, block_rows), entities)
    out = df.join(carry, [*keys, S.BLK], "left")
    p = F.coalesce(F.col("_c.p"), F.lit(1.0))
    local_peak = F.when(p >= 0, p * F.col("_lmax")).otherwise(p * F.col("_lmin"))
    out = out.withColumns(
        {
            "equity": F.when(F.col("strategy_return").isNotNull(), p * F.col("_lp")),
            "gross_equity": F.when(
                F.col("gross_strategy_return").isNotNull(), F.coalesce(F.col("_c.g"), F.lit(1.0)) * F.col("_lg")
            ),
            "_peak": F.greatest(F.col("_c.hi"), local_peak),
        }
    )
    out = out.withColumn("drawdown", F.try_divide(F.col("equity"), F.col("_peak")) - 1)
    return out.drop("_lp", "_lg", "_lmax", "_lmin", "_c", "_peak", S.BLK, S.OWN, *([] if keep_ordinal else [S.ORD]))


def portfolio_daily_returns(frame: DataFrame, run_keys: Sequence[str] = (), keep_ordinal: bool = False) -> DataFrame:
    """W15 = A1 + W9 + W10."""
    return equity_curve(daily_portfolio(frame, run_keys), run_keys, keep_ordinal=keep_ordinal)


def strategy_metrics(curve: DataFrame, run_keys: Sequence[str], gross: bool = True) -> DataFrame:
    """One metric row per run; ``gross=False`` gives the 9 net fields."""
    r = F.col("strategy_return")
    aggs = [
        F.count(F.lit(1)).cast("double").alias("days"),
        (F.max_by("equity", TIME) - 1).alias("total_return"),
        (F.avg(r) * TRADING_DAYS_PER_YEAR).alias("annualized_return"),
        (F.stddev_samp(r) * SQRT_YEAR).alias("annualized_volatility"),
        F.min("drawdown").alias("max_drawdown"),
        F.avg(F.when(r > 0, 1.0).otherwise(0.0)).alias("win_rate"),
        F.avg("exposure").alias("exposure"),
        F.avg("turnover").alias("turnover"),
    ]
    if gross:
        g = F.col("gross_strategy_return")
        aggs += [
            (F.max_by("gross_equity", TIME) - 1).alias("gross_total_return"),
            (F.avg(g) * TRADING_DAYS_PER_YEAR).alias("gross_annualized_return"),
            (F.stddev_samp(g) * SQRT_YEAR).alias("_gross_vol"),
        ]
    m = curve.groupBy(*run_keys).agg(*aggs)
    m = m.withColumn("sharpe_ratio", guarded_ratio("annualized_return", "annualized_volatility"))
    if gross:
        m = m.withColumn("gross_sharpe_ratio", guarded_ratio("gross_annualized_return", "_gross_vol")).drop("_gross_vol")
    cols = METRIC_COLUMNS if gross else NET_METRIC_COLUMNS
    return m.select(*run_keys, *cols)


# ---------------------------------------------------------------- sweeps ---
def sweep_daily(
    predictions: DataFrame,
    thresholds: Sequence[float],
    run_keys: Sequence[str] = (),
) -> tuple[DataFrame, tuple[int, int]]:
    """Daily exposure / gross / turnover for every threshold of a grid.

    Returns ``run_keys, threshold, _pos, Date, exposure, gross_strategy_return,
    turnover`` with the number of the day in its run, and (longest run, number of runs).
    ``_pos`` is the threshold's first position in ``thresholds``.
    """
    keys = list(run_keys)
    grid = sorted(set(float(t) for t in thresholds))
    m = len(grid)
    grid_arr = F.array(*[F.lit(t) for t in grid])
    counted = scored(predictions).withColumn("_cnt", F.size(F.filter(grid_arr, lambda th: th <= F.col("p_up"))))
    rows = with_previous(counted, [*keys, ENTITY], ["_cnt"])
    prev = F.col("_prev__cnt")
    lo = F.when(prev.isNull(), F.lit(0)).otherwise(F.least("_cnt", prev))
    hi = F.when(prev.isNull(), F.col("_cnt")).otherwise(F.greatest("_cnt", prev))
    # a row is long at positions 0 .. _cnt - 1 and trades at positions lo .. hi - 1
    none = F.lit(None).cast("double")
    events = F.array(
        F.struct((F.col("_cnt") - 1).alias("g"), F.lit(1).alias("s"), nan_to_null("next_return").alias("x"), F.lit(0).alias("d")),
        F.struct((hi - 1).alias("g"), F.lit(0).alias("s"), none.alias("x"), F.lit(1).alias("d")),
        F.struct((lo - 1).alias("g"), F.lit(0).alias("s"), none.alias("x"), F.lit(-1).alias("d")),
    )
    ev = rows.select(*keys, TIME, F.explode(F.filter(events, lambda e: e["g"] >= 0)).alias("e"))
    at_position = ev.groupBy(*keys, TIME, F.col("e.g").alias("_g")).agg(
        F.sum("e.s").alias("_ds"), F.sum("e.x").alias("_dx"), F.sum("e.d").alias("_dd")
    )
    days = rows.groupBy(*keys, TIME).agg(F.count(F.lit(1)).alias("_n"), F.count(nan_to_null("next_return")).alias("_known"))
    days, longest, runs = S.with_ordinal_info(days, keys, TIME)
    dense = days.select(*keys, TIME, S.ORD, "_n", "_known", F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("_g"))
    joined = dense.join(at_position, [*keys, TIME, "_g"], "left")
    w = Window.partitionBy(*keys, TIME).orderBy(F.desc("_g")).rowsBetween(Window.unboundedPreceding, 0)
    pos_of: dict[float, int] = {}
    for i, t in enumerate(thresholds):
        pos_of.setdefault(float(t), i)
    pos_expr = F.element_at(F.array(*[F.lit(pos_of[t]) for t in grid]), F.col("_g") + 1)
    daily = joined.select(
        *keys,
        F.element_at(grid_arr, F.col("_g") + 1).alias("threshold"),
        pos_expr.alias("_pos"),
        TIME,
        S.ORD,
        (F.sum(F.coalesce("_ds", F.lit(0))).over(w) / F.col("_n")).alias("exposure"),
        F.try_divide(F.sum(F.coalesce("_dx", F.lit(0.0))).over(w), F.col("_known")).alias("gross_strategy_return"),
        (F.sum(F.coalesce("_dd", F.lit(0))).over(w) / F.col("_n")).alias("turnover"),
    )
    return daily, (longest, runs)


def with_costs(daily: DataFrame, costs: Sequence[float]) -> DataFrame:
    """Expand a threshold sweep over trading costs (net = gross - cost * turnover)."""
    cost_arr = F.array(*[F.lit(float(c)) for c in costs])
    out = daily.withColumn("cost_per_trade", F.explode(cost_arr))
    return out.withColumn("strategy_return", F.col("gross_strategy_return") - F.col("cost_per_trade") * F.col("turnover"))


def sweep_metrics(
    predictions: DataFrame,
    thresholds: Sequence[float],
    costs: Sequence[float],
    run_keys: Sequence[str] = (),
    gross: bool = True,
) -> DataFrame:
    """Metrics for every (threshold, cost) of a grid (J4 / C7 as one plan)."""
    keys = [*run_keys, "threshold", "_pos", "cost_per_trade"]
    daily, (longest, runs) = sweep_daily(predictions, thresholds, run_keys)
    curve = equity_curve(with_costs(daily, costs), keys, numbered=(longest, runs * len(set(thresholds)) * len(costs)))
    return strategy_metrics(curve, keys, gross=gross)


def choose_threshold(
    predictions: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    cost_per_trade: float = COST_PER_TRADE,
    min_exposure: float = MIN_EXPOSURE,
    run_keys: Sequence[str] = (),
) -> DataFrame:
    """T4: per run, the threshold with the best Sharpe among those with exposure >= min.

    Ties go to the earliest threshold in the given list; when none
    qualifies the first threshold is returned with its metrics.  Output: all
    metric rows plus ``eligible`` and ``selected`` flags.
    """
    keys = list(run_keys)
    m = sweep_metrics(predictions, thresholds, [cost_per_trade], keys)
    eligible = F.col("exposure") >= F.lit(float(min_exposure))
    # One row per run and threshold: a bounded group per run.
    order = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(
        eligible.desc(), F.when(eligible, F.col("sharpe_ratio")).desc_nulls_last(), F.col("_pos").asc()
    )
    return m.withColumns({"eligible": eligible, "selected": F.row_number().over(order) == 1})
