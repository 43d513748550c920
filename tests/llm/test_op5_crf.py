import itertools
import math
import random

import numpy as np

from helpers import EXTRA, awkward, frame, words
from ledgerline.llm import op5_line_crf as op


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    sizes = [4, 1, 3]
    emission, move = rng.normal(size=sum(sizes)), rng.normal(size=(2, 2))
    row = np.repeat(np.arange(3), sizes)
    got, expected = op.forward_backward(emission, row, move)
    at, total = 0, np.zeros((2, 2))
    for size in sizes:
        weights = {}
        for path in itertools.product((0, 1), repeat=size):
            s = sum(emission[at + t] for t, y in enumerate(path) if y) + sum(move[a, b] for a, b in zip(path, path[1:]))
            weights[path] = math.exp(s)
        z = sum(weights.values())
        for t in range(size):
            assert abs(got[at + t] - sum(w for p, w in weights.items() if p[t]) / z) < 1e-9
        for p, w in weights.items():
            for a, b in zip(p, p[1:]):
                total[a, b] += w / z
        at += size
    assert np.allclose(expected, total)


def test_lines_and_bins():
    texts = ["One line.\n\n \nTwo two two two\nOne line.", "", "a|b | c"]
    raw = [t.encode() for t in texts]
    bins, size, row = op.line_features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert row.tolist() == [0, 0, 0, 2] and size[0] == len("One line.\n") and size[3] == len(raw[2])
    names = [n for n, _ in op.FEATURES]
    copies = names.index("copies of the line in the document")
    assert bins[:, copies].tolist() == [1, 0, 1, 0]
    assert bins[1, names.index("share of words as the one before")] == 3


def sample(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        body = "\n".join(words(rng, rng.randrange(5, 40)).capitalize() + "." for _ in range(rng.randrange(1, 6)))
        good = rng.random() < 0.7
        if not good:
            body = rng.choice([body.upper() + "!!", " ".join(w + "$$$" for w in body.split()), " | ".join(body.split()), "\n".join([body.split("\n")[0]] * 6)])
        rows.append((1000 + i, body))
        labels.append((1000 + i, int(good)))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rows, labels = sample(2, 300)
    label = spark.createDataFrame(labels[:200] + [(None, 1), (1000, None), (77, 0)], "doc_id long, label int")
    chain = op.train(frame(spark, rows[:200]).select("doc_id", "text"), label)
    docs = frame(spark, rows[200:] + awkward())
    got = op.score(docs, chain).collect()
    assert len(got) == 110 and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    right = sum((score[i] >= 0.3) == bool(y) for i, y in labels[200:])
    assert right >= 95
    assert score[2] == score[3] == score[5] == 0.0
    assert score[1] == score[4]
    assert all(r[c] == f"{c}-{r['doc_id']}" for r in got for c in EXTRA if c != "score")


def test_nothing_learned_and_empty(spark):
    chain = op.train(frame(spark, []).select("doc_id", "text"), spark.createDataFrame([], "doc_id long, label int"))
    got = op.score(frame(spark, [(1, "some words")]), chain).first()
    assert got["score"] == 0.5
    assert op.score(frame(spark, []), chain).count() == 0
