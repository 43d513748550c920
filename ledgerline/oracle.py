"""DuckDB SQL building blocks for the oracle of every registered query.

The CTEs mirror the Spark plans with plain (unblocked) window functions and a
recursive CTE for the EMA, so they are an independent check of the blocked
Spark implementation.  Literals are cast to DOUBLE (a bare ``1.0`` is DECIMAL
in DuckDB) and divisions use ``NULLIF`` (DuckDB gives inf on ``x / 0``).
"""

from __future__ import annotations


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def ratio1(a: str, b: str) -> str:
    return f"({a} / NULLIF({b}, 0) - 1)"


EMA_SPANS = (10, 20, 50, 200)
PRICE = '"Price"'

PANEL = """
daily AS (
  SELECT o_orderstatus AS index_name, CAST(o_orderdate AS DATE) AS "Date", avg(o_totalprice) AS lvl
  FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderdate IS NOT NULL
  GROUP BY 1, 2),
ctx AS (
  SELECT CAST(l_shipdate AS DATE) AS "Date", CASE WHEN count(*) % 4 <> 0 THEN avg(l_discount) END AS bulk_discount
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1),
panel AS MATERIALIZED (
  SELECT d.index_name, d."Date",
    avg(d.lvl) OVER (PARTITION BY d.index_name ORDER BY d."Date" ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS "Price",
    row_number() OVER (PARTITION BY d.index_name ORDER BY d."Date") - 1 AS t,
    'status ' || d.index_name AS "Name",
    c.bulk_discount
  FROM daily d LEFT JOIN ctx c ON c."Date" = d."Date")"""


def _ema_cte(source: str = "panel") -> str:
    seeds = ", ".join(f'"Price" AS e{s}' for s in EMA_SPANS)
    steps = ", ".join(
        f'{dbl(1 - 2 / (s + 1))} * e.e{s} + {dbl(2 / (s + 1))} * p."Price"' for s in EMA_SPANS
    )
    return f"""
ema AS (
  SELECT index_name, t, {seeds} FROM {source} WHERE t = 0
  UNION ALL
  SELECT p.index_name, p.t, {steps}
  FROM ema e JOIN {source} p ON p.index_name = e.index_name AND p.t = e.t + 1)"""


FEATURES = (
    PANEL
    + """,
r AS (
  SELECT *,
    """
    + ",\n    ".join(f"{ratio1(PRICE, f'lag({PRICE}, {h}) OVER w')} AS return_{h}d" for h in (1, 2, 5, 10, 20))
    + """,
    lead("Price", 1) OVER w / NULLIF("Price", 0) - 1 AS next_return,
    CASE WHEN count("Price") OVER w20 = 20 THEN max("Price") OVER w20 END AS rolling_high_20d,
    CASE WHEN count("Price") OVER w60 = 60 THEN max("Price") OVER w60 END AS rolling_high_60d,
    CASE WHEN count("Price") OVER w20 = 20 THEN min("Price") OVER w20 END AS rolling_low_20d
  FROM panel
  WINDOW w AS (PARTITION BY index_name ORDER BY t),
    w20 AS (PARTITION BY index_name ORDER BY t ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    w60 AS (PARTITION BY index_name ORDER BY t ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
v AS (
  SELECT *,
    CASE WHEN count(return_1d) OVER w5 = 5 THEN stddev_samp(return_1d) OVER w5 END AS volatility_5d,
    CASE WHEN count(return_1d) OVER w10 = 10 THEN stddev_samp(return_1d) OVER w10 END AS volatility_10d,
    CASE WHEN count(return_1d) OVER w20 = 20 THEN stddev_samp(return_1d) OVER w20 END AS volatility_20d
  FROM r
  WINDOW w5 AS (PARTITION BY index_name ORDER BY t ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
    w10 AS (PARTITION BY index_name ORDER BY t ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
    w20 AS (PARTITION BY index_name ORDER BY t ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),"""
    + _ema_cte()
    + """,
feat AS (
  SELECT v.*, ema.e10, ema.e20, ema.e50, ema.e200,
    volatility_5d / NULLIF(volatility_20d, 0) AS volatility_ratio_5d_20d,
    return_5d / NULLIF(volatility_20d, 0) AS return_5d_to_volatility_20d,
    return_20d / NULLIF(volatility_20d, 0) AS return_20d_to_volatility_20d,
    """
    + ratio1('"Price"', "rolling_high_20d")
    + """ AS drawdown_20d,
    """
    + ratio1('"Price"', "rolling_high_60d")
    + """ AS drawdown_60d,
    """
    + ratio1('"Price"', "rolling_low_20d")
    + """ AS price_vs_20d_low,
    """
    + ",\n    ".join(f"{ratio1(PRICE, f'ema.e{s}')} AS price_vs_trailing_ema_{s}" for s in EMA_SPANS)
    + """,
    """
    + ratio1("ema.e10", "ema.e50")
    + """ AS trailing_ema_10_vs_50,
    """
    + ratio1("ema.e20", "ema.e200")
    + """ AS trailing_ema_20_vs_200,
    CASE WHEN next_return > 0 THEN 1 ELSE 0 END AS target
  FROM v JOIN ema USING (index_name, t))"""
)


def with_features(body: str) -> str:
    return "WITH RECURSIVE" + FEATURES + "\n" + body


ENGINEERED = (
    [f"return_{h}d" for h in (1, 2, 5, 10, 20)]
    + [f"volatility_{n}d" for n in (5, 10, 20)]
    + [
        "volatility_ratio_5d_20d",
        "return_5d_to_volatility_20d",
        "return_20d_to_volatility_20d",
        "drawdown_20d",
        "drawdown_60d",
        "price_vs_20d_low",
    ]
    + [f"price_vs_trailing_ema_{s}" for s in EMA_SPANS]
    + ["trailing_ema_10_vs_50", "trailing_ema_20_vs_200"]
)
MODEL_FEATURES = ["bulk_discount", *ENGINEERED]
LEVELS = ("F", "O", "P")
DUMMIES = [f"index_{v}" for v in LEVELS]
TRAIN_END, VALIDATION_END = "1998-12-31", "1999-12-31"


def split_case(col: str = '"Date"') -> str:
    return (
        f"CASE WHEN {col} <= DATE '{TRAIN_END}' THEN 'train' "
        f"WHEN {col} <= DATE '{VALIDATION_END}' THEN 'validation' ELSE 'test' END"
    )


PREPARED = (
    FEATURES
    + """,
lagged AS (
  SELECT index_name, "Date", "Name", "Price", t, next_return, target, """
    + split_case()
    + """ AS split,
    """
    + ",\n    ".join(f"last_value({c} IGNORE NULLS) OVER wl AS {c}" for c in MODEL_FEATURES)
    + """
  FROM feat
  WINDOW wl AS (PARTITION BY index_name ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
kept AS MATERIALIZED (
  SELECT * FROM lagged WHERE return_20d IS NOT NULL AND volatility_20d IS NOT NULL AND drawdown_60d IS NOT NULL),
med AS (
  SELECT """
    + ", ".join(f"median({c}) AS {c}" for c in MODEL_FEATURES)
    + """ FROM kept WHERE split = 'train'),
filled AS (
  SELECT k.index_name, k."Date", k."Name", k."Price", k.t, k.next_return, k.target, k.split,
    """
    + ",\n    ".join(f"coalesce(k.{c}, m.{c}, CAST(0 AS DOUBLE)) AS {c}" for c in MODEL_FEATURES)
    + """,
    """
    + ", ".join(f"CASE WHEN k.index_name = '{v}' THEN 1 ELSE 0 END AS index_{v}" for v in LEVELS)
    + """
  FROM kept k CROSS JOIN med m),
dataset AS MATERIALIZED (SELECT * FROM filled WHERE next_return IS NOT NULL)"""
)


def prepared_from_files(extra: dict[str, str]) -> str:
    """The preparation without smoothing, with further context features (name -> aggregate over a day's lineitems)."""
    sql = PREPARED.replace(
        'avg(d.lvl) OVER (PARTITION BY d.index_name ORDER BY d."Date" ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS "Price"',
        'd.lvl AS "Price"',
    )
    more = lambda form: "".join(", " + form.format(c=c, agg=agg) for c, agg in extra.items())
    sql = sql.replace("AS bulk_discount\n  FROM lineitem", "AS bulk_discount" + more("{agg} AS {c}") + "\n  FROM lineitem")
    sql = sql.replace("    c.bulk_discount\n", "    c.bulk_discount" + more("c.{c}") + "\n")
    for form in ("last_value({c} IGNORE NULLS) OVER wl AS {c}", "median({c}) AS {c}", "coalesce(k.{c}, m.{c}, CAST(0 AS DOUBLE)) AS {c}"):
        one = form.format(c="bulk_discount")
        sql = sql.replace(one, one + more(form))
    return "WITH RECURSIVE" + sql


def with_prepared(body: str) -> str:
    return "WITH RECURSIVE" + PREPARED + "\n" + body


# ---------------------------------------------------------------- backtest ---
COST = 0.0001
THRESHOLDS = (0.50, 0.52, 0.55, 0.57, 0.60)
RULES = ("buy_and_hold", "cash", "previous_day_direction", "price_above_trailing_ema_20", "positive_20d_momentum")
SQRT_YEAR = 252 ** 0.5


def score_sql() -> str:
    return f"{dbl(1)} / ({dbl(1)} + exp({dbl(-40)} * return_1d))"


PREDS = f"""
preds AS (
  SELECT index_name, "Date", split, next_return, {score_sql()} AS p_up
  FROM dataset WHERE split IN ('validation', 'test'))"""


def trades_sql(source: str, keys: str, cost: str) -> str:
    """Row frame with trade, gross and net returns from a source with ``signal``."""
    return f"""(
  SELECT *, signal * next_return AS gross_strategy_return,
    signal * next_return - {cost} * trade AS strategy_return
  FROM (SELECT *, coalesce(abs(signal - lag(signal) OVER (PARTITION BY {keys}, index_name ORDER BY "Date")), signal) AS trade
        FROM {source}))"""


def daily_sql(source: str, keys: str) -> str:
    return f"""(
  SELECT {keys}, "Date", avg(strategy_return) AS strategy_return, avg(gross_strategy_return) AS gross_strategy_return,
    avg(signal) AS exposure, avg(trade) AS turnover
  FROM {source} GROUP BY {keys}, "Date")"""


def curve_sql(source: str, keys: str) -> str:
    run = f'PARTITION BY {keys} ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW'
    return f"""(
  SELECT *, equity / NULLIF(max(equity) OVER ({run}), 0) - 1 AS drawdown
  FROM (SELECT *, product(1 + strategy_return) OVER ({run}) AS equity,
          product(1 + gross_strategy_return) OVER ({run}) AS gross_equity
        FROM {source}))"""


def guard(num: str, den: str) -> str:
    return f"CASE WHEN {den} IS NULL OR {den} = 0 THEN {dbl(0)} ELSE {num} / {den} END"


def metrics_sql(source: str, keys: str, gross: bool = True) -> str:
    g = (
        """,
    arg_max(gross_equity, "Date") - 1 AS gross_total_return,
    avg(gross_strategy_return) * 252 AS gross_annualized_return,
    stddev_samp(gross_strategy_return) * """
        + dbl(SQRT_YEAR)
        + " AS gross_vol"
        if gross
        else ""
    )
    inner = f"""(
  SELECT {keys}, CAST(count(*) AS DOUBLE) AS days,
    arg_max(equity, "Date") - 1 AS total_return,
    avg(strategy_return) * 252 AS annualized_return,
    stddev_samp(strategy_return) * {dbl(SQRT_YEAR)} AS annualized_volatility,
    min(drawdown) AS max_drawdown,
    avg(CASE WHEN strategy_return > 0 THEN {dbl(1)} ELSE {dbl(0)} END) AS win_rate,
    avg(exposure) AS exposure, avg(turnover) AS turnover{g}
  FROM {source} GROUP BY {keys})"""
    gross_cols = (
        f", gross_total_return, gross_annualized_return, {guard('gross_annualized_return', 'gross_vol')} AS gross_sharpe_ratio"
        if gross
        else ""
    )
    return f"""(
  SELECT {keys}, days, total_return, annualized_return, annualized_volatility,
    {guard('annualized_return', 'annualized_volatility')} AS sharpe_ratio,
    max_drawdown, win_rate, exposure, turnover{gross_cols}
  FROM {inner})"""


RULE_ROWS = f"""
rule_rows AS (
  SELECT d."Date", d.index_name, d.split, d.next_return, k.strategy_key,
    CASE k.strategy_key WHEN 'buy_and_hold' THEN 1 WHEN 'cash' THEN 0
      WHEN 'previous_day_direction' THEN CASE WHEN d.return_1d > 0 THEN 1 ELSE 0 END
      WHEN 'price_above_trailing_ema_20' THEN CASE WHEN d.price_vs_trailing_ema_20 > 0 THEN 1 ELSE 0 END
      ELSE CASE WHEN d.return_20d > 0 THEN 1 ELSE 0 END END AS signal
  FROM dataset d CROSS JOIN (VALUES {", ".join(f"('{r}')" for r in RULES)}) k(strategy_key)
  WHERE d.split IN ('validation', 'test')),
rule_frame AS MATERIALIZED {trades_sql("rule_rows", "strategy_key, split", dbl(COST))},
rule_curve AS MATERIALIZED {curve_sql(daily_sql("rule_frame", "strategy_key, split"), "strategy_key, split")},
rule_metrics AS {metrics_sql("rule_curve", "strategy_key, split")}"""


def grid_values(thresholds) -> str:
    return ", ".join(f"({i}, {dbl(t)})" for i, t in enumerate(thresholds))


SCORE_SWEEP = (
    PREDS
    + f""",
grid AS (SELECT * FROM (VALUES {grid_values(THRESHOLDS)}) g(pos, threshold)),
sw_rows AS (
  SELECT p.*, g.pos, g.threshold, CASE WHEN p.p_up >= g.threshold THEN 1 ELSE 0 END AS signal
  FROM preds p CROSS JOIN grid g),
sw_frame AS MATERIALIZED {trades_sql("sw_rows", "split, pos, threshold", dbl(COST))},
sw_curve AS MATERIALIZED {curve_sql(daily_sql("sw_frame", "split, pos, threshold"), "split, pos, threshold")},
sw_metrics AS {metrics_sql("sw_curve", "split, pos, threshold")},
sw_sel AS (
  SELECT *, exposure >= {dbl(0.1)} AS eligible,
    row_number() OVER (PARTITION BY split ORDER BY (exposure >= {dbl(0.1)}) DESC,
      CASE WHEN exposure >= {dbl(0.1)} THEN sharpe_ratio END DESC NULLS LAST, pos) = 1 AS selected
  FROM sw_metrics)"""
)


# ----------------------------------------------------------- classification ---
LABELLED = """
j AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, CASE WHEN d.n_chars >= 1200 THEN 1 ELSE 0 END AS y_pred,
    l.quality, l.toxic
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
long AS (
  SELECT doc_id, lang, source, n_chars, y_pred, 'quality' AS target, quality AS y_true FROM j
  UNION ALL
  SELECT doc_id, lang, source, n_chars, y_pred, 'toxic' AS target, toxic AS y_true FROM j)"""


def counts_sql(source: str, keys: str) -> str:
    def s(cond: str) -> str:
        return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE)"

    return f"""(
  SELECT {keys}, {s("y_true = 1 AND y_pred = 1")} AS tp, {s("y_true = 0 AND y_pred = 1")} AS fp,
    {s("y_true = 0 AND y_pred = 0")} AS tn, {s("y_true = 1 AND y_pred = 0")} AS fn
  FROM {source} GROUP BY {keys})"""


def class_metrics_sql(counts: str, keys: str, digits: int = 6) -> str:
    z = dbl(0)

    def zd(num: str, den: str) -> str:
        return f"CASE WHEN {den} > 0 THEN ({num}) / ({den}) ELSE {z} END"

    tpr, tnr = zd("tp", "tp + fn"), zd("tn", "tn + fp")
    bal = (
        f"CASE WHEN tp + fn > 0 AND tn + fp > 0 THEN ({tpr} + {tnr}) / 2 "
        f"WHEN tp + fn > 0 THEN {tpr} WHEN tn + fp > 0 THEN {tnr} ELSE {z} END"
    )
    return f"""SELECT {keys},
  round({zd("tp + tn", "tp + tn + fp + fn")}, {digits}) AS accuracy,
  round({bal}, {digits}) AS balanced_accuracy,
  round({zd("tp", "tp + fp")}, {digits}) AS precision,
  round({tpr}, {digits}) AS recall,
  round({zd("2 * tp", "2 * tp + fp + fn")}, {digits}) AS f1
FROM {counts}"""


def auc_sql(source: str, keys: str, score: str) -> str:
    return f"""(
  SELECT {keys}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
      THEN sum(pos * (neg_below + neg * {dbl(0.5)})) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END AS roc_auc
  FROM (
    SELECT *, coalesce(sum(neg) OVER (PARTITION BY {keys} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
    FROM (SELECT {keys}, CAST({score} AS DOUBLE) AS s, sum(y_true) AS pos, sum(1 - y_true) AS neg
          FROM {source} WHERE {score} IS NOT NULL GROUP BY {keys}, s))
  GROUP BY {keys})"""


# ------------------------------------------------------------------ hashes ---
CRC_CTE = """crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS remainder)"""


def crc_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII expression, with ``crc`` in scope."""
    chars = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce({chars}, lambda c, b: xor(crc.remainder[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"


def mixed_sql(value: str, number: str) -> str:
    """The forest's 32-bit hash of a number and another one."""
    first = f"CAST((CAST(xor({value}, CAST((CAST({number} AS HUGEINT) * 2654435761) % 4294967296 AS BIGINT)) AS HUGEINT) * 2246822519) % 4294967296 AS BIGINT)"
    second = f"(SELECT CAST((CAST(xor(a, a >> 15) AS HUGEINT) * 3266489917) % 4294967296 AS BIGINT) FROM (SELECT {first} AS a))"
    return f"(SELECT xor(b, b >> 16) FROM (SELECT {second} AS b))"
