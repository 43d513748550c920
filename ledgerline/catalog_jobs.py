"""Registered jobs over files, models and result tables (second part of the catalog)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import catalog as C
from ledgerline import datasets as D
from ledgerline import oracle as O
from ledgerline.catalog import register
from ledgerline.operators import backtest as BT
from ledgerline.operators import features as FE
from ledgerline.operators import levels as LV
from ledgerline.operators import ml as ML
from ledgerline.operators import prepare as PR
from ledgerline.operators import quantiles as QT
from ledgerline.operators import report as RP
from ledgerline.plans import series as S
from ledgerline.sources import panels as P
from ledgerline.sources import sinks as SK
from ledgerline.sources.tables import read_table

# ------------------------------------------------------------ instrument files ---
CSV_SCHEMA = StructType().add("Date", "date").add("Name", "string").add("Price", "double").add("bulk_discount", "double")


def instrument_rows(spark, sf_dir):
    """One row per instrument and day: the raw price, and day columns of all lineitems."""
    li = read_table(spark, sf_dir, "lineitem", ["l_discount", "l_shipdate"]).where("l_shipdate is not null")
    daily = li.groupBy(F.to_date("l_shipdate").alias("Date")).agg(F.avg("l_discount").alias("_mean"), F.count(F.lit(1)).alias("_lines"))
    rows = P.order_panel_raw(spark, sf_dir).withColumnRenamed("_level", "Price").join(daily, "Date", "left")
    gap = F.col("_lines") % 4 != 0
    return rows.select(
        "index_name", "Date", F.concat(F.lit("status "), "index_name").alias("Name"), "Price",
        F.when(gap, F.col("_mean")).alias("bulk_discount"),
        F.when(F.col("_lines").isNotNull() & ~gap, F.lit(float("nan"))).otherwise(F.col("_mean")).alias("nan_discount"),
        (F.col("_lines") % 2 == 1).alias("busy"),
    )


def file_columns(*extra):
    dummies = ", ".join(f"CAST({d} AS BIGINT) AS {d}" for d in O.DUMMIES)
    return (
        f'index_name, "Date", "Name", CAST("Price" AS FLOAT) AS "Price", split, round(next_return, 6) AS next_return, '
        f"CAST(target AS BIGINT) AS target, {', '.join(f'CAST({c} AS FLOAT) AS {c}' for c in ('bulk_discount', *extra))}, "
        f"{C.sql_r(C.ENGINEERED)}, {dummies}"
    )


def file_projection(df, *extra):
    return df.select(
        *C.KEY, "Name", *C.f32("Price"), "split", *C.r6("next_return"), F.col("target").cast("long").alias("target"),
        *C.f32("bulk_discount", *extra), *C.r6(*C.ENGINEERED), *[F.col(d).cast("long").alias(d) for d in O.DUMMIES],
    )


def instrument_files(spark, sf_dir, name, fmt, columns):
    path = C.results_dir(spark, sf_dir, name)
    SK.write_table(instrument_rows(spark, sf_dir).select("index_name", *columns), path, fmt, ["index_name"])
    return {level: f"{path}/index_name={level}" for level in O.LEVELS}


@register("dataset_from_csv", O.prepared_from_files({}) + f"\nSELECT {file_columns()} FROM dataset")
def q_dataset_from_csv(spark, sf_dir):
    """C3 + S1/S2/U1: one CSV file per instrument, read with a schema, no smoothing."""
    files = instrument_files(spark, sf_dir, "instruments_csv", "csv", CSV_SCHEMA.names)
    out = D.load_modeling_dataset(spark, files, PR.TESTDATA_SPLIT, "csv", CSV_SCHEMA)
    return file_projection(out.panel.public())


@register(
    "dataset_mixed_types",
    O.prepared_from_files({
        "nan_discount": "CASE WHEN count(*) % 4 <> 0 THEN avg(l_discount) END",
        "busy": "CASE WHEN count(*) % 2 = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    }) + f"\nSELECT {file_columns('nan_discount', 'busy')} FROM dataset",
)
def q_dataset_mixed_types(spark, sf_dir):
    """Parquet files with a boolean feature and a feature whose gaps are NaN; neither survives preparation."""
    columns = [*CSV_SCHEMA.names, "nan_discount", "busy"]
    files = instrument_files(spark, sf_dir, "instruments_parquet", "parquet", columns)
    out = D.load_modeling_dataset(spark, files, PR.TESTDATA_SPLIT, "parquet")
    return file_projection(out.panel.public(), "nan_discount", "busy")


TIED = ["l_discount", "l_tax", "l_quantity"]


@register(
    "tied_medians",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(median({c}) AS DOUBLE) AS median FROM lineitem" for c in TIED),
)
def q_tied_medians(spark, sf_dir):
    """A5: exact medians of columns with few distinct values."""
    return PR.exact_medians_frame(read_table(spark, sf_dir, "lineitem", TIED), TIED, ranked_values=4).select("feature", "median")


@register(
    "customer_indicators",
    """WITH places AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS place, count(*) OVER () AS size FROM (SELECT DISTINCT o_custkey AS level FROM orders WHERE o_custkey IS NOT NULL))
SELECT o.o_orderkey, CAST(p.size AS BIGINT) AS size, CAST(p.place AS BIGINT) AS place, CAST(1 AS DOUBLE) AS value
FROM orders o JOIN places p ON o.o_custkey = p.level""",
)
def q_customer_indicators(spark, sf_dir):
    """P10, many levels: the customer of every order as a sparse indicator vector."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    out = LV.with_indicators(orders, "o_custkey", S.keep(LV.level_table(orders, "o_custkey", range_rows=100_000)))
    return out.where(F.size("indicators.indices") > 0).select("o_orderkey", "indicators.size", F.col("indicators.indices")[0].alias("place"), F.col("indicators.values")[0].alias("value"))


SKETCHED = [*TIED, "l_extendedprice"]
SKETCH_SIZE = 1024  # rank error 0.3 % at 99 % confidence
SLACK = 4  # times that error: sketches are randomised


@register(
    "sketch_medians",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS rows, (SELECT CAST(count(DISTINCT date_trunc('month', l_shipdate)) AS BIGINT) FROM lineitem WHERE l_shipdate IS NOT NULL) AS states, "
        f"TRUE AS within FROM lineitem WHERE l_shipdate IS NOT NULL"
        for c in SKETCHED
    ),
)
def q_sketch_medians(spark, sf_dir):
    """A5, approximate mode: one stored sketch a ship month and column, merged; whether the median's ranks among all rows are within the stated error."""
    rows = read_table(spark, sf_dir, "lineitem", ["l_shipdate", *SKETCHED]).where(F.col("l_shipdate").isNotNull())
    states = S.keep(QT.sketch_states(rows, SKETCHED, [F.date_trunc("month", "l_shipdate").alias("month")], SKETCH_SIZE))
    found = QT.merged_medians(states, k=SKETCH_SIZE)
    months = states.groupBy("feature").agg(F.count(F.lit(1)).alias("states"))
    medians = {r["feature"]: r["median"] for r in found.collect()}  # one row a column
    near = SLACK * QT.rank_error(SKETCH_SIZE)
    checks = []
    for c in SKETCHED:
        x, m = F.col(c).cast("double"), F.lit(medians.get(c))
        below, upto = (F.sum(F.when(cond, 1).otherwise(0)) / F.count(c) for cond in (x < m, x <= m))
        checks.append(F.struct(F.lit(c).alias("feature"), ((below <= 0.5 + near) & (upto >= 0.5 - near)).alias("within")))
    within = rows.agg(F.array(*checks).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return found.join(months, "feature").join(within, "feature").select("feature", "rows", "states", "within")


# -------------------------------------------------------------- long histories ---
@register(
    "event_panel_doubling",
    C.EVENT_SQL.replace("WITH", "WITH RECURSIVE", 1).split(",\ner AS")[0]
    + ","
    + O._ema_cte("ep")
    + "\nSELECT index_name, CAST(hr AS VARCHAR) AS hour, "
    + ", ".join(f'round("Price" / NULLIF(e{s}, 0) - 1, 6) AS price_vs_trailing_ema_{s}' for s in O.EMA_SPANS)
    + " FROM ep JOIN ema USING (index_name, t)",
)
def q_event_panel_doubling(spark, sf_dir):
    """Trailing means and averages of the event panel in small blocks with every scan by doubling: the path of very long histories."""
    with S.folding_up_to(1):
        f = FE.price_features(P.event_panel(spark, sf_dir, block_rows=64))
    names = [f"price_vs_trailing_ema_{s}" for s in O.EMA_SPANS]
    return f.df.select("index_name", F.col("Date").cast("string").alias("hour"), *C.r6(*names))


# ---------------------------------------------------------------------- models ---
@register(
    "class_weights",
    O.with_prepared(
        "SELECT CAST(target AS BIGINT) AS target, CAST(count(*) AS BIGINT) AS rows, "
        "round((SELECT count(*) FROM dataset WHERE split = 'train') / (2.0 * count(*)), 6) AS weight "
        "FROM dataset WHERE split = 'train' GROUP BY target"
    ),
)
def q_class_weights(spark, sf_dir):
    """M4: balanced weights of the training rows."""
    train = C.modeling_dataset(spark, sf_dir).where("split = 'train'")
    out = ML.with_class_weights(train).groupBy("target").agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(ML.WEIGHT), 6).alias("weight"))
    return out.select(F.col("target").cast("long").alias("target"), "rows", "weight")


@register(
    "model_score_checks",
    O.with_prepared(
        "SELECT m.model_key, split, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS in_range, "
        "CAST(count(*) AS BIGINT) AS hard_agrees, CAST(0 AS DOUBLE) AS largest_difference FROM dataset, (VALUES "
        + ", ".join(f"('{k}')" for k in ML.MODEL_KEYS)
        + ") m(model_key) WHERE split IN ('validation', 'test') GROUP BY m.model_key, split"
    ),
)
def q_model_score_checks(spark, sf_dir):
    """Rows scored, scores in [0, 1], hard labels that agree with the score, and how far a second load differs."""
    rows = C.modeling_dataset(spark, sf_dir).where("split in ('validation', 'test')")
    out = None
    for key in ML.MODEL_KEYS:
        path = C.trained(spark, sf_dir, key, "train")
        first = ML.score(ML.load(path), rows, [*C.KEY, "split"])
        again = ML.score(C.trained_model(spark, sf_dir, key, "train"), rows, C.KEY).select(*C.KEY, F.col("p_up").alias("_again"))
        both = first.join(again, C.KEY)
        count = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
        one = both.groupBy(F.lit(key).alias("model_key"), "split").agg(
            F.count(F.lit(1)).alias("rows"),
            count((F.col("p_up") >= 0) & (F.col("p_up") <= 1)).alias("in_range"),
            count((F.col("p_up") > 0.5).cast("int") == F.col("y_pred")).alias("hard_agrees"),
            F.max(F.abs(F.col("p_up") - F.col("_again"))).alias("largest_difference"),
        )
        out = one if out is None else out.unionByName(one)
    return out


# --------------------------------------------------------------- result tables ---
def _labelled_sql(body):
    labels = C._case_map("strategy_key", C.STRATEGY_LABELS, C.TITLE_SQL.format(c="strategy_key"))
    return O.with_prepared(C.METRIC_TABLE_SQL + body.format(strategy=labels))


SHOWN = ["total_return", "sharpe_ratio", "max_drawdown", "exposure"]


@register(
    "strategy_metric_table",
    _labelled_sql(
        "\nSELECT split, strategy_key, {strategy} AS strategy, metric, round(value, 6) AS value FROM (UNPIVOT (SELECT split, strategy_key, "
        + ", ".join(SHOWN) + " FROM smt WHERE split = 'test') ON " + ", ".join(SHOWN) + " INTO NAME metric VALUE value)"
    ),
)
def q_strategy_metric_table(spark, sf_dir):
    """C8 + U7 + T1: strategy metrics of one split, melted, labelled, sorted and written as CSV."""
    m = C.backtest_metrics(spark, sf_dir).where("split = 'test'")
    long = RP.melt(m, ["split", "strategy_key"], SHOWN)
    out = RP.add_labels(long, spark).select("split", "strategy_key", "strategy", "metric", F.round("value", 6).alias("value"))
    path = SK.write_table(out, C.results_dir(spark, sf_dir, "strategy_metric_table"), "csv", order_by=["strategy_key", "metric"])
    return SK.read_result(spark, path, out.schema, "csv")


@register(
    "row_listing",
    O.with_prepared(
        "," + O.RULE_ROWS + "\nSELECT strategy_key, split, index_name, \"Date\", round(next_return, 6) AS next_return, CAST(signal AS BIGINT) AS signal, "
        "CAST(trade AS BIGINT) AS trade, round(strategy_return, 6) AS strategy_return FROM rule_frame WHERE split = 'test' AND strategy_key = 'positive_20d_momentum'"
    ),
)
def q_row_listing(spark, sf_dir):
    """C10 + S8: row-level returns of one strategy, newest first, written and read back."""
    rows = C.rule_frames(spark, sf_dir).where("split = 'test' and strategy_key = 'positive_20d_momentum'")
    out = rows.select(
        *C.RUN, *C.KEY, *C.r6("next_return"), F.col("signal").cast("long").alias("signal"), F.col("trade").cast("long").alias("trade"), *C.r6("strategy_return")
    )
    path = SK.write_table(out, C.results_dir(spark, sf_dir, "row_listing"), "parquet", order_by=[F.desc("Date"), F.col("index_name")])
    return SK.read_result(spark, path, out.schema)


WHAT_IF_MODEL_THRESHOLDS = (0.45, 0.50, 0.55)


@register("what_if_models")
def q_what_if_models(spark, sf_dir):
    """C7 per model and split: thresholds and costs over the scores of every fitted model; rows without a score left out."""
    scores = None
    for key in ML.MODEL_KEYS:
        one = C.model_scores(spark, sf_dir, key).withColumn("model_key", F.lit(key))
        scores = one if scores is None else scores.unionByName(one)
    m = BT.sweep_metrics(scores, WHAT_IF_MODEL_THRESHOLDS, [0.0, BT.COST_PER_TRADE], ["model_key", "split"], gross=False)
    return m.select("model_key", "split", "threshold", "cost_per_trade", *C.r6(*C.NET_METRICS))


# --------------------------------------------------------- charts with the models ---
def all_curves(spark, sf_dir):
    """Curves of rules and models together, one run per strategy and split."""
    frames = C.rule_frames(spark, sf_dir).select(*C.RUN, *C.KEY, "signal", "trade", "gross_strategy_return", "strategy_return")
    models = C.all_model_rows(spark, sf_dir)[1].select(*frames.columns)
    return BT.portfolio_daily_returns(frames.unionByName(models), C.RUN)


@register("model_chart_series")
def q_model_chart_series(spark, sf_dir):
    """Chart series of all primary strategies, the model strategies among them."""
    out = RP.chart_series(all_curves(spark, sf_dir), spark, "test", C.PRIMARY_STRATEGIES)
    return out.select(*C.RUN, "strategy", "Date", *C.r6("equity", "drawdown", "exposure", "turnover"))


@register("model_return_density")
def q_model_return_density(spark, sf_dir):
    """Densities of the daily returns of every strategy of the test split, on common bins."""
    curves = S.keep(all_curves(spark, sf_dir).where("split = 'test'").select("strategy_key", "strategy_return"))
    return RP.density(curves, "strategy_return", 45, ["strategy_key"]).select("strategy_key", "bin", "count", *C.r6("density"))


@register("model_score_histogram")
def q_model_score_histogram(spark, sf_dir):
    """Scores of every model by signal, 40 bins."""
    rows = S.keep(C.all_model_rows(spark, sf_dir)[1].where("split = 'test'").select("strategy_key", "signal", "p_up"))
    return RP.histogram(rows, "p_up", 40, ["strategy_key", "signal"]).select("strategy_key", "signal", "bin", "count")
