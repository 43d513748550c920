"""Report shaping: labels, melts, rankings, histograms, chart series (A2, A14, A16, A17,
C8-C10, P17, P18, T2, U2, U5-U7, W12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import nan_to_null, SQRT_YEAR
from ledgerline.functions.labels import METRIC_LABELS, MODEL_LABELS, STRATEGY_LABELS
from ledgerline.operators.classification import null_safe_join
from ledgerline.plans import series as S


def _lookup(spark: SparkSession, mapping: dict[str, str], key: str, value: str) -> DataFrame:
    """A fixed lookup table; its size is bounded by the mapping, so broadcasting is safe."""
    return F.broadcast(spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string"))


def title_case(c: str) -> F.Column:
    """Unknown key -> words with capitals: ``_`` becomes a blank, every letter after a non-letter a capital."""
    chars = F.split(F.replace(F.col(c), F.lit("_"), F.lit(" ")), "")
    after_letter = lambda i: F.coalesce(F.get(chars, i - 1).rlike(r"\p{L}"), F.lit(False))
    return F.array_join(F.transform(chars, lambda x, i: F.when(after_letter(i), F.lower(x)).otherwise(F.upper(x))), "")


def add_labels(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``strategy`` and ``model`` labels with a title-case fallback."""
    out = df
    if "strategy_key" in df.columns:
        out = out.join(_lookup(spark, STRATEGY_LABELS, "strategy_key", "_sl"), "strategy_key", "left")
        out = out.withColumn("strategy", F.coalesce("_sl", title_case("strategy_key"))).drop("_sl")
    if "model_key" in df.columns:
        out = out.join(_lookup(spark, MODEL_LABELS, "model_key", "_ml"), "model_key", "left")
        out = out.join(_lookup(spark, STRATEGY_LABELS, "model_key", "_ms"), "model_key", "left")
        out = out.withColumn("model", F.coalesce("_ml", "_ms", title_case("model_key"))).drop("_ml", "_ms")
    return out


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "metric", value: str = "value") -> DataFrame:
    """Wide -> long."""
    casted = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return casted.unpivot(list(ids), list(values), var, value)


def recode_metrics(df: DataFrame, column: str = "metric") -> DataFrame:
    """Metric names -> display labels (names outside the map stay as they are)."""
    return df.replace(METRIC_LABELS, subset=[column])


def ranked(df: DataFrame, by: str, partition: Sequence[str], tie: str) -> DataFrame:
    """Descending ranking by a metric (rank 1 = best) within each partition.

    Metric tables hold one row per strategy, so each partition is small.
    """
    w = Window.partitionBy(*partition).orderBy(F.col(by).desc_nulls_last(), F.col(tie).asc())
    return df.withColumn("rank", F.row_number().over(w))


def ordered_distinct(df: DataFrame, key: str, position: str, partition: Sequence[str] = ()) -> DataFrame:
    """Distinct keys in order of first appearance (``dict.fromkeys``)."""
    first = df.groupBy(*partition, key).agg(F.min(position).alias("first_position"))
    return first


def distinct_sorted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values."""
    cond = None
    for c in columns:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.select(*columns).where(cond).distinct()


def instrument_exposure(frame: DataFrame) -> DataFrame:
    """A2: per-instrument exposure, mean score, mean net return and trade count."""
    return frame.groupBy("index_name").agg(
        F.avg("signal").alias("exposure"),
        F.avg("p_up").alias("avg_p_up"),
        F.avg("strategy_return").alias("avg_return"),
        F.sum("trade").cast("long").alias("trades"),
    )


def rolling_sharpe(curve: DataFrame, run_keys: Sequence[str], window: int = 63) -> DataFrame:
    """Mean / std * sqrt(252) over a full trailing window; std 0 -> null.

    Runs in halo blocks of the curve's own ordinal (kept by ``equity_curve`` on
    request, else numbered here), so a long run never sits in one task.
    """
    keys = list(run_keys)
    ordered = curve if S.ORD in curve.columns else S.with_ordinal(curve, keys, "Date")[0]
    halo = S.with_halo(ordered, back=window - 1, block_rows=max(S.DEFAULT_BLOCK_ROWS, window))
    r = F.col("strategy_return")
    mean = S.full_rolling(F.avg, r, window, keys)
    std = S.full_rolling(F.stddev_samp, r, window, keys)
    out = halo.withColumn("rolling_sharpe", F.try_divide(mean, F.when(std != 0, std)) * SQRT_YEAR)
    return out.where(F.col(S.OWN)).drop(S.ORD, S.BLK, S.OWN)


def _edges(df: DataFrame, value: str, bins: int) -> tuple[float, float]:
    """Lowest known value (0 if there is none) and the width of a bin (1 where all values are equal)."""
    known = nan_to_null(value)
    lo, hi = df.agg(F.min(known), F.max(known)).first()  # two scalars
    return (0.0, 1.0) if lo is None else (lo, (hi - lo) / bins if hi > lo else 1.0)


def _binned(df: DataFrame, value: str, bins: int, by: Sequence[str], lo: float, width: float) -> DataFrame:
    known = nan_to_null(value)
    b = F.least(F.floor((known - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(known.isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumns(
        {"bin_start": F.lit(lo) + F.col("bin") * F.lit(width), "bin_end": F.lit(lo) + (F.col("bin") + 1) * F.lit(width)}
    )


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal-width bins over [min, max]; the max lands in the last bin.

    Null and NaN values are left out; without values there are no bins.
    """
    return _binned(df, value, bins, by, *_edges(df, value, bins))


def density(df: DataFrame, value: str, bins: int, by: Sequence[str]) -> DataFrame:
    """Common bins, each series normalised on its own (count / (n_series * width))."""
    lo, width = _edges(df, value, bins)
    h = _binned(df, value, bins, by, lo, width)
    n = df.where(nan_to_null(value).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    return null_safe_join(h, n, list(by)).withColumn("density", F.col("count") / (F.col("_n") * F.lit(width))).drop("_n")


def chart_series(curves: DataFrame, spark: SparkSession, split: str, strategies: Sequence[str]) -> DataFrame:
    """Equity / drawdown / exposure / turnover of chosen strategies with labels."""
    chosen = curves.where((F.col("split") == split) & F.col("strategy_key").isin(list(strategies)))
    return add_labels(chosen, spark)


