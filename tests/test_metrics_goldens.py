"""Classification metrics by hand: counts written out beside the rows."""

import itertools
import random

import pytest

from ledgerline.operators import classification as CL

# 4 hits, 1 false alarm, 2 misses, 3 right rejections
HITS, ALARMS, MISSES, REJECTED = 4, 1, 2, 3
ROWS = [(1, 1)] * HITS + [(0, 1)] * ALARMS + [(1, 0)] * MISSES + [(0, 0)] * REJECTED


def _frame(spark, pairs, scores=None):
    rows = [("g", t, p, s) for (t, p), s in zip(pairs, scores or [None] * len(pairs))]
    return spark.createDataFrame(rows, "grp string, y_true int, y_pred int, score double")


def _one(df):
    (row,) = df.collect()
    return row


def test_five_metrics_of_ten_rows(spark):
    m = _one(CL.classification_metrics(_frame(spark, ROWS), ["grp"], "y_true", "y_pred"))
    want = {"accuracy": 7 / 10, "balanced_accuracy": (4 / 6 + 3 / 4) / 2, "precision": 4 / 5, "recall": 4 / 6, "f1": 8 / 11}
    assert m.asDict() == {"grp": "g", **{k: pytest.approx(v) for k, v in want.items()}}


def test_area_by_counting_pairs(spark):
    """Of 3 x 2 pairs four are in order and one is tied."""
    df = _frame(spark, [(1, 1), (1, 1), (1, 1), (0, 0), (0, 0)], [0.8, 0.35, 0.2, 0.35, 0.1])
    assert _one(CL.roc_auc(df, ["grp"], "y_true", "score")).roc_auc == pytest.approx(4.5 / 6)


def test_area_with_many_ties_against_all_pairs(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randint(0, 1), 0) for _ in range(300)]
    scores = [rnd.randint(0, 40) / 40 for _ in pairs]
    got = _one(CL.roc_auc(_frame(spark, pairs, scores), ["grp"], "y_true", "score", range_rows=5)).roc_auc
    up = [s for s, (t, _) in zip(scores, pairs) if t]
    down = [s for s, (t, _) in zip(scores, pairs) if not t]
    won = sum((a > b) + (a == b) / 2 for a, b in itertools.product(up, down))
    assert got == pytest.approx(won / (len(up) * len(down)))


def test_one_class_only(spark):
    df = _frame(spark, [(0, 0), (0, 0)], [0.1, 0.2])
    m = _one(CL.classification_metrics(df, ["grp"], "y_true", "y_pred"))
    assert (m.precision, m.recall, m.f1, m.balanced_accuracy) == (0.0, 0.0, 0.0, 1.0)
    assert _one(CL.roc_auc(df, ["grp"], "y_true", "score")).roc_auc is None
