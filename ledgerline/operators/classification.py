"""Classification metrics as grouped aggregates.

Every metric row is a DataFrame row per group (model, split, segment...),
computed from confusion counts with one partial + final hash aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import nan_to_null, positive_flag
from ledgerline.plans import series as S

METRICS = ("accuracy", "balanced_accuracy", "precision", "recall", "f1")
RANGE_ROWS = 50_000  # distinct scores of one range


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null: a null group is a group like any other."""
    own = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(own, condition, how).drop(*[f"_right_{k}" for k in keys])


def _zero_div(num: Column, den: Column) -> Column:
    """``num / den`` with 0 when the denominator is 0 (``zero_division=0``)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, keys: Sequence[str], y_true: str, y_pred: str) -> DataFrame:
    t, p = F.col(y_true), F.col(y_pred)
    one = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    return df.groupBy(*keys).agg(
        one((t == 1) & (p == 1)).alias("tp"),
        one((t == 0) & (p == 1)).alias("fp"),
        one((t == 0) & (p == 0)).alias("tn"),
        one((t == 1) & (p == 0)).alias("fn"),
    )


def metrics_from_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Accuracy, balanced accuracy (mean recall over classes present in y_true),
    precision, recall, F1; undefined ratios are 0."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    pos, neg = tp + fn, tn + fp
    tpr, tnr = _zero_div(tp, pos), _zero_div(tn, neg)
    balanced = (
        F.when((pos > 0) & (neg > 0), (tpr + tnr) / 2)
        .when(pos > 0, tpr)
        .when(neg > 0, tnr)
        .otherwise(F.lit(0.0))
    )
    return counts.select(
        *keys,
        _zero_div(tp + tn, pos + neg).alias("accuracy"),
        balanced.alias("balanced_accuracy"),
        _zero_div(tp, tp + fp).alias("precision"),
        tpr.alias("recall"),
        _zero_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_metrics(df: DataFrame, keys: Sequence[str], y_true: str, y_pred: str) -> DataFrame:
    """A13 (hard labels): the five metrics per group."""
    return metrics_from_counts(confusion_counts(df, keys, y_true, y_pred), keys)


def roc_auc(df: DataFrame, keys: Sequence[str], y_true: str, score: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Exact, tie-aware ROC-AUC per group (Mann-Whitney).

    ``AUC = sum_s pos(s) * (neg_below(s) + neg(s) / 2) / (P * N)``.  Rows are
    first collapsed to distinct scores per group (ties merge, so a hot score
    is one row) and range-partitioned by group and score into ranges of about
    ``range_rows``.  The negatives below a score are those of earlier ranges of its group,
    a running sum over one row per range, and those before it in its own range.
    Groups with one class only give null; a null group is a group; rows without a score are left out.
    """
    keys = list(keys)
    y = F.col(y_true).cast("long")
    g = df.withColumn("_s", nan_to_null(score)).where(F.col("_s").isNotNull()).groupBy(*keys, "_s").agg(
        F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg")
    )
    g = S.keep(g)
    n = S.range_count(df.sparkSession, g.count(), range_rows)
    tagged = S.keep(g.repartitionByRange(n, *keys, "_s").withColumn("_b", F.spark_partition_id()))
    per_range = tagged.groupBy(*keys, "_b").agg(F.sum("_neg").alias("_bneg"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(*keys, "_b", F.coalesce(F.sum("_bneg").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = null_safe_join(tagged, offsets, [*keys, "_b"]).withColumn(
        "_below", F.col("_off") + F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    )
    agg = ranked.groupBy(*keys).agg(
        F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") * 0.5)).alias("_u"),
        F.sum("_pos").alias("_p"),
        F.sum("_neg").alias("_n"),
    )
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_u") / (F.col("_p") * F.col("_n")).cast("double"))
    return agg.select(*keys, auc.alias("roc_auc"))


def classification_report(
    df: DataFrame, keys: Sequence[str], y_true: str, y_pred: str, score: str | None = None
) -> DataFrame:
    """A11 + optional A12 (``compute_classification_metrics``)."""
    m = classification_metrics(df, keys, y_true, y_pred)
    if score is None:
        return m
    return null_safe_join(m, roc_auc(df, keys, y_true, score), keys, "left")


def baseline_predictions(dataset: DataFrame, splits: Sequence[str] = ("validation", "test")) -> DataFrame:
    """The constant-up baseline and the lagged one-day direction, long format."""
    rows = dataset.where(F.col("split").isin(list(splits))).select(
        "split",
        "target",
        F.lit(1).alias("baseline_majority_up"),
        positive_flag("return_1d").alias("baseline_previous_day_direction"),
    )
    return rows.unpivot(
        ["split", "target"], ["baseline_majority_up", "baseline_previous_day_direction"], "model_key", "y_pred"
    )


def minmax_scores(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """M6 fallback: min-max scaled decision scores per group; a constant group gives 0.5."""
    keys = list(keys)
    if keys:
        bounds = df.groupBy(*keys).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
        joined = null_safe_join(df, bounds, keys)
    else:  # two scalars for the whole scored set
        lo, hi = df.agg(F.min(score), F.max(score)).first()
        joined = df.withColumns({"_lo": F.lit(lo), "_hi": F.lit(hi)})
    scaled = F.when(
        F.col("_hi") > F.col("_lo"),
        (F.col(score) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")),
    ).otherwise(F.lit(0.5))
    return joined.withColumn("p_up", scaled.cast("double")).drop("_lo", "_hi")
