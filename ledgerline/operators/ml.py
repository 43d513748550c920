"""Model jobs (M1-M10): fit, score, evaluate, save and load classifiers.

* ``log_reg``: the regression of ``operators/logistic.py``: standardised features, balanced class weights, L2 of 1 on the
  coefficients, solved by Newton steps,
* ``random_forest``: the forest of ``operators/forest.py``: leaves of at least 20 rows, sqrt features, balanced bootstrap samples,
* ``hist_gradient_boosting``: the trees of ``operators/trees.py``: best leaf first to
  15 leaves of at least 20 rows, learning rate 0.04, L2 0.2, 255 bins.

Defaults are the full sizes: 400 trees and 250 boosting rounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.labels import MODEL_LABELS
from ledgerline.operators.classification import minmax_scores
from ledgerline.operators.forest import Forest, ForestParams, fit_forest
from ledgerline.operators.logistic import Logistic, fit_logistic
from ledgerline.operators.trees import BoostedTrees, BoostParams, fit_boosting

LABEL = "target"
WEIGHT = "_class_weight"
MODEL_KEYS = ("log_reg", "random_forest", "hist_gradient_boosting")


@dataclass(frozen=True)
class ModelParams:
    num_trees: int = 400
    boosting_rounds: int = 250
    max_iter: int = 2000
    seed: int = 42


#: A fitted model: each kind has ``transform``; saved Spark ML pipelines can be loaded and scored, too.
Model = PipelineModel | Logistic | BoostedTrees | Forest

ROWS_PER_TASK = 50_000  # training rows of one task; every boosting round is a few jobs over all tasks


def with_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """M4: weight n / (2 * n_class); the class counts are at most two scalars."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    total = sum(counts.values())
    weight = None
    for cls, n in counts.items():
        w = F.lit(total / (2.0 * n))
        weight = F.when(F.col(label) == cls, w) if weight is None else weight.when(F.col(label) == cls, w)
    return df.withColumn(WEIGHT, weight if weight is not None else F.lit(1.0))


def fit(key: str, train: DataFrame, features: Sequence[str], params: ModelParams = ModelParams(), row_key: Sequence[str] = ("index_name", "Date")) -> Model:
    """M5: fit one model on a split; ``row_key`` tells rows apart in bootstrap samples."""
    if key == "random_forest":
        return fit_forest(train, features, LABEL, row_key, ForestParams(trees=params.num_trees, seed=params.seed))
    if key == "hist_gradient_boosting":
        rows = train.select(*features, LABEL)
        return fit_boosting(rows, features, LABEL, BoostParams(rounds=params.boosting_rounds), max(1, -(-rows.count() // ROWS_PER_TASK)))
    if key == "log_reg":
        return fit_logistic(train, features, LABEL, params.max_iter, rows_per_task=ROWS_PER_TASK)
    raise KeyError(key)


def positive_probability(out: DataFrame) -> DataFrame:
    """M6: ``p_up`` of a transformed frame.

    The class-1 probability; for a model without probabilities its raw score
    for class 1, min-max scaled over the frame (0.5 if constant); without either a ``TypeError``.
    """
    if "probability" in out.columns:
        return out.withColumn("p_up", vector_to_array("probability")[1])
    if "rawPrediction" in out.columns:
        return minmax_scores(out.withColumn("_raw", vector_to_array("rawPrediction")[1]), [], "_raw").drop("_raw")
    raise TypeError("the model gives neither probabilities nor scores")


def score(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """M6/M7: class-1 probability and hard prediction next to the kept columns."""
    out = model.transform(df)
    if isinstance(model, PipelineModel):
        out = positive_probability(out)
    return out.select(*keep, "p_up", F.col("prediction").cast("int").alias("y_pred"))


def save(model: Model, path: str) -> str:
    """Persist a fitted model."""
    if not isinstance(model, PipelineModel):
        return model.save(SparkSession.active(), path)
    model.write().overwrite().save(path)
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def load(path: str) -> Model:
    """A saved model; raises ``FileNotFoundError`` when nothing is saved at ``path``."""
    spark = SparkSession.active()
    if not _exists(spark, path):
        raise FileNotFoundError(f"no saved model at {path}; train and save it first")
    for kind, part in ((Forest, "nodes"), (Logistic, "coefficients"), (BoostedTrees, "splits")):
        if _exists(spark, f"{path}/{part}"):
            return kind.load(spark, path)
    return PipelineModel.load(path)


def model_name(key: str) -> str:
    return MODEL_LABELS.get(key, key)
