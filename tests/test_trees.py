"""Leaf-wise boosting: against a plain version, whatever the partitions and the way a node is finished."""

import math
import random

import pytest

from ledgerline.operators import ml as ML
from ledgerline.operators import trees as TR

PARAMS = TR.BoostParams(rounds=6, leaves=6, min_rows=5, bins=12, store_every=2)
NAMES = ["a", "b", "c"]


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = rng.gauss(0, 1), rng.choice([0.0, 1.0, 2.5]), rng.randrange(40) / 8
        out.append((a, b, c, int(rng.random() < 1 / (1 + math.exp(-(a * b + (c > 3)))))))
    return out


def plain_boosting(data, params):
    """The definition, row by row."""
    n = len(data)
    x = [r[:3] for r in data]
    edges = []
    for k in range(3):
        values = sorted(r[k] for r in x)
        edges.append(sorted({values[max(math.ceil(i * n / params.bins), 1) - 1] for i in range(1, params.bins)} - {values[-1]}))
    bins = [[sum(e < r[k] for e in edges[k]) for k in range(3)] for r in x]
    up = sum(r[3] for r in data)
    score, model = [math.log(up / (n - up))] * n, []
    part = lambda g, h: (g / TR.SCALE) ** 2 / (h / TR.SCALE + params.l2)
    for _ in range(params.rounds):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g = [round((r[3] - q) * TR.SCALE) for r, q in zip(data, p)]
        h = [round(q * (1 - q) * TR.SCALE) for q in p]
        leaf, splits = [0] * n, []
        while len(splits) < params.leaves - 1:
            best = (0.0, 0, 0, 0)
            for one in range(len(splits) + 1):
                inside = [i for i in range(n) if leaf[i] == one]
                for k in range(3):
                    for b in range(len(edges[k])):
                        low = [i for i in inside if bins[i][k] <= b]
                        high = [i for i in inside if bins[i][k] > b]
                        if min(len(low), len(high)) < params.min_rows:
                            continue
                        sums = [(sum(g[i] for i in s), sum(h[i] for i in s)) for s in (low, high, inside)]
                        gain = part(*sums[0]) + part(*sums[1]) - part(*sums[2])
                        if gain > best[0]:
                            best = (gain, one, k, b)
            if best[0] <= 0:
                break
            splits.append(best)
            leaf = [len(splits) if leaf[i] == best[1] and bins[i][best[2]] > best[3] else leaf[i] for i in range(n)]
        values = []
        for one in range(len(splits) + 1):
            inside = [i for i in range(n) if leaf[i] == one]
            values.append(params.rate * (sum(g[i] for i in inside) / TR.SCALE) / (sum(h[i] for i in inside) / TR.SCALE + params.l2))
        score = [s + values[i] for s, i in zip(score, leaf)]
        model.append(([(s[1], s[2], s[3]) for s in splits], values))
    return edges, model, score


def frame(spark, data):
    return spark.createDataFrame(data, "a double, b double, c double, y int")


def test_same_trees_as_the_plain_version(spark, monkeypatch):
    data = rows(240)
    edges, want, score = plain_boosting(data, PARAMS)
    df = frame(spark, data)
    fits = [TR.fit_boosting(df, NAMES, "y", PARAMS, partitions=p) for p in (1, 4)]
    monkeypatch.setattr(TR, "SMALL_ROWS", 30)  # histograms first, small nodes finished in one task
    fits.append(TR.fit_boosting(df, NAMES, "y", PARAMS, partitions=2))
    monkeypatch.setattr(TR, "SMALL_ROWS", 0)
    monkeypatch.setattr(TR, "DIRECT_PARTITIONS", 0)  # sums added up by a shuffle
    fits.append(TR.fit_boosting(df, NAMES, "y", PARAMS, partitions=3))
    for model in fits:
        assert model.edges == edges
        assert [([(s.leaf, s.feature, s.bin) for s in t.splits]) for t in model.trees] == [t[0] for t in want]
        for tree, (_, values) in zip(model.trees, want):
            assert tree.values == pytest.approx(values, rel=1e-12)
    got = sorted(r["raw_score"] for r in fits[0].transform(df).collect())
    assert got == pytest.approx(sorted(score))


def test_saved_and_loaded(spark, tmp_path):
    df = frame(spark, rows(200, 3))
    model = TR.fit_boosting(df, NAMES, "y", PARAMS, partitions=2)
    back = ML.load(ML.save(model, str(tmp_path / "m")))
    assert back == model
    assert back.nodes(spark).count() == sum(len(t.splits) for t in model.trees)
    scored = ML.score(back, df, ["y"]).collect()
    assert all(0 < r.p_up < 1 and r.y_pred == int(r.p_up > 0.5) for r in scored)
    assert sum(r.y_pred == r.y for r in scored) > 120


def test_edge_tables(spark):
    few = TR.BoostParams(rounds=2, leaves=4, min_rows=2, bins=8)
    empty = TR.fit_boosting(frame(spark, []), NAMES, "y", few)
    assert empty.trees == [] and empty.transform(frame(spark, [])).count() == 0
    one = TR.fit_boosting(frame(spark, [(1.0, 2.0, 3.0, 1)] * 9), NAMES, "y", few)
    assert all(not t.splits for t in one.trees) and one.transform(frame(spark, [(1.0, 2.0, 3.0, 1)])).first()["p_up"] > 0.99
    odd = frame(spark, [(None, float("nan"), 1.0, 0), (1.0, 1.0, 1.0, 1), (2.0, 1.0, 1.0, 1), (0.0, 0.0, 1.0, 0), (5.0, 5.0, 5.0, None)])
    model = TR.fit_boosting(odd, NAMES, "y", few)
    p = {r["a"]: r["p_up"] for r in model.transform(odd).collect()}
    assert p[None] == p[0.0] < 0.5 < p[1.0] == p[2.0]
    with pytest.raises(ValueError):
        TR.fit_boosting(odd, NAMES, "y", TR.BoostParams(bins=300))


def test_small_rows_need_one_pass_for_many_rounds(spark, monkeypatch):
    df = spark.createDataFrame(rows(300), "a double, b double, c double, target int")
    want = TR.fit_boosting(df, NAMES, "target", PARAMS, partitions=3)
    passes = []
    listed = TR._listed
    monkeypatch.setattr(TR, "_listed", lambda parts: passes.append(1) or listed(parts))
    got = TR.fit_boosting(df, NAMES, "target", PARAMS, partitions=1)
    assert got == want
    assert len(passes) == -(-PARAMS.rounds // PARAMS.store_every)
