"""Forest of balanced bootstrap samples: weights, leaves, and the same forest from every way of growing it."""

import math
import random

import numpy as np
import pytest

from ledgerline.operators import forest as FO
from ledgerline.operators import ml as ML

PARAMS = FO.ForestParams(trees=5, min_rows=8, bins=16)
NAMES = ["a", "b", "c", "d"]


def frame(spark, n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c, d = rng.gauss(0, 1), rng.random(), float(rng.randrange(4)), rng.gauss(0, 1)
        rows.append((f"k{i}", a, b, c, d, int(rng.random() < 0.8 / (1 + math.exp(-3 * a - c + 2)))))
    return spark.createDataFrame(rows, "k string, a double, b double, c double, d double, y int"), rows


def test_weights_are_poisson_and_differ_by_tree():
    key = FO.mixed(np.arange(200_000), 3)
    one, two = FO.bootstrap_weights(key, 0, 42), FO.bootstrap_weights(key, 1, 42)
    for k, share in enumerate([0.3679, 0.3679, 0.1839, 0.0613]):
        assert abs((one == k).mean() - share) < 0.005
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.01


def test_same_forest_however_it_is_grown(spark, monkeypatch, tmp_path):
    df, rows = frame(spark, 400)
    model = FO.fit_forest(df.repartition(3), NAMES, "y", ["k"], PARAMS)
    monkeypatch.setattr(FO, "SMALL_ROWS", 60)
    mixed = FO.fit_forest(df.coalesce(1), NAMES, "y", ["k"], PARAMS)
    monkeypatch.setattr(FO, "SMALL_ROWS", 0)
    summed = FO.fit_forest(df, NAMES, "y", ["k"], PARAMS)

    def shape(nodes, i=0):
        x = nodes[i]
        own = (x.path, x.feature, x.bin if x.feature >= 0 else 0, x.c0, x.c1, x.rows)
        return (own,) if x.left < 0 else (own, shape(nodes, x.left), shape(nodes, x.right))

    for other in (mixed, summed):
        assert [shape(t) for t in other.trees] == [shape(t) for t in model.trees]
    import zlib

    key = np.array([zlib.crc32(r[0].encode()) for r in rows])
    y = np.array([r[-1] for r in rows])
    x = np.array([r[1:5] for r in rows])
    for t, nodes in enumerate(model.trees):
        w = FO.bootstrap_weights(key, t, PARAMS.seed)
        assert (nodes[0].c0, nodes[0].c1, nodes[0].rows) == (w[y == 0].sum(), w[y == 1].sum(), (w > 0).sum())
        assert model.class_weights[t] == pytest.approx((w.sum() / 2 / w[y == 0].sum(), w.sum() / 2 / w[y == 1].sum()))
        leaves = [n for n in nodes if n.left < 0]
        assert len(leaves) > 3 and all(n.rows >= PARAMS.min_rows for n in leaves) and sum(n.rows for n in leaves) == nodes[0].rows
        # rows walk to the leaf whose counts hold them
        at = []
        for row in x:
            i = 0
            while nodes[i].left >= 0:
                i = nodes[i].right if row[nodes[i].feature] > model.edges[nodes[i].feature][nodes[i].bin] else nodes[i].left
            at.append(i)
        at = np.array(at)
        assert all(((at == i) & (w > 0)).sum() == n.rows for i, n in enumerate(nodes) if n.left < 0)
    scored = {r["k"]: r for r in model.transform(df).collect()}
    assert sum(scored[r[0]]["prediction"] == r[-1] for r in rows) > 280
    back = ML.load(ML.save(model, str(tmp_path / "forest")))
    assert back.edges == model.edges and back.class_weights == model.class_weights and [shape(t) for t in back.trees] == [shape(t) for t in model.trees]
    assert {r["k"]: r["p_up"] for r in back.transform(df).collect()} == {k: r["p_up"] for k, r in scored.items()}
    assert model.nodes(spark).where("feature is null").agg({"rows": "min"}).first()[0] >= PARAMS.min_rows


def test_edge_tables(spark):
    df, _ = frame(spark, 0)
    empty = FO.fit_forest(df, NAMES, "y", ["k"], PARAMS)
    assert empty.transform(df).count() == 0 and all(len(t) == 1 for t in empty.trees)
    one = spark.createDataFrame([(f"k{i}", 1.0, None, float("nan"), 2.0, 1) for i in range(30)] + [("z", 1.0, 1.0, 1.0, 1.0, None)], "k string, a double, b double, c double, d double, y int")
    model = FO.fit_forest(one, NAMES, "y", ["k"], PARAMS)
    assert all(len(t) == 1 for t in model.trees) and model.transform(one).first()["p_up"] == 1.0
