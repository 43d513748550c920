"""MLlib jobs: probability range, determinism with a seed, save/load round trip."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from given import SF001
from ledgerline import catalog as C
from ledgerline.operators import ml as ML


@pytest.fixture(scope="module")
def data(spark):
    prep = C.prepared(spark, SF001)
    return prep.panel.public(), prep.features


@pytest.mark.parametrize("key", ["log_reg", "random_forest"])
def test_scores_are_probabilities_and_reproducible(spark, data, key):
    ds, feats = data
    params = ML.ModelParams(num_trees=3, boosting_rounds=3, max_iter=50)
    train = ds.where(F.col("split") == "train")
    test = ds.where(F.col("split") == "test")
    m1 = ML.fit(key, train, feats, params)
    m2 = ML.fit(key, train, feats, params)
    s1 = ML.score(m1, test, ["index_name", "Date"]).orderBy("index_name", "Date").collect()
    s2 = ML.score(m2, test, ["index_name", "Date"]).orderBy("index_name", "Date").collect()
    assert all(0.0 <= r.p_up <= 1.0 and r.y_pred in (0, 1) for r in s1)
    assert [r.p_up for r in s1] == [r.p_up for r in s2]

    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-model-"), key)
    loaded = ML.load(ML.save(m1, path))
    s3 = ML.score(loaded, test, ["index_name", "Date"]).orderBy("index_name", "Date").collect()
    assert [r.p_up for r in s1] == [r.p_up for r in s3]


def test_class_weights_balance_the_classes(spark, data):
    ds, _ = data
    w = ML.with_class_weights(ds.where(F.col("split") == "train"))
    totals = {r.target: r.w for r in w.groupBy("target").agg(F.sum(ML.WEIGHT).alias("w")).collect()}
    n = sum(r["count"] for r in ds.where(F.col("split") == "train").groupBy("target").count().collect())
    assert totals[0] == pytest.approx(n / 2) and totals[1] == pytest.approx(n / 2)
