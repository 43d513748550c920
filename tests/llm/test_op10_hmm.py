import collections
import itertools
import math
import random

import numpy as np

from helpers import WORD, awkward, frame, words
from ledgerline.llm import op10_hmm_lm as op
from pyspark.sql import functions as F


def random_model(rng, states, classes):
    share = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(shape) + 0.1)
    return op.Model(share(states), share(states, states), share(states, classes))


def test_recursion_is_exact():
    rng = np.random.default_rng(1)
    model = random_model(rng, 2, 5)
    texts = [[0, 3, 4, 1], [2], [1, 1, 2]]
    classes, begin = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    like, started, moved, emitted = op.recursion(classes, begin, model, True)
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 5))
    for k, t in enumerate(texts):
        weight = {}
        for path in itertools.product(range(2), repeat=len(t)):
            w = model.start[path[0]] * math.prod(model.move[a, b] for a, b in zip(path, path[1:])) * math.prod(model.emit[s, c] for s, c in zip(path, t))
            weight[path] = w
        z = sum(weight.values())
        assert abs(like[k] - math.log10(z)) < 1e-5
        for path, w in weight.items():
            start[path[0]] += w / z
            for a, b in zip(path, path[1:]):
                move[a, b] += w / z
            for s, c in zip(path, t):
                emit[s, c] += w / z
    assert np.allclose(started, start, atol=1e-4) and np.allclose(moved, move, atol=1e-4) and np.allclose(emitted, emit, atol=1e-4)
    assert np.allclose(op.recursion(classes, begin, model, False)[0], like, atol=1e-4)


def test_passes_raise_the_likelihood():
    rng = np.random.default_rng(2)
    true = random_model(rng, 3, 40)
    classes, begin, state = [], [0], 0
    for _ in range(60):
        for _ in range(30):
            state = rng.choice(3, p=true.move[state])
            classes.append(rng.choice(40, p=true.emit[state]))
        begin.append(len(classes))
    classes, begin = np.array(classes), np.array(begin)
    unigram = np.bincount(classes, minlength=40) / len(classes)
    model, last = random_model(rng, 3, 40), -np.inf
    for _ in range(8):
        like, *counts = op.recursion(classes, begin, model, True)
        assert like.sum() >= last - 1e-3
        last, model = like.sum(), op.maximised(*counts, unigram, prior=0.0)


def base(rows, held):
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    tokens = [WORD.findall((t or "").translate(low)) + [None] for _, t in rows]
    count = collections.Counter(w for own, h in zip(tokens, held) if not h for w in own)
    n, v = sum(count.values()), len(count)
    return [(len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)) for own in tokens]


def test_counts_and_base_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_BYTES", 2_000)
    rng = random.Random(3)
    rows = awkward(rng) + [(100 + i, words(rng, rng.randrange(0, 50)).title()) for i in range(80)]
    held = [(r[0] or 0) % 3 == 1 for r in rows]
    docs = frame(spark, rows).withColumn("held_out", F.coalesce(F.col("doc_id"), F.lit(0)) % 3 == 1)
    got = op.language_model(docs.select("doc_id", "held_out", "text"), states=3, head=50).collect()
    want = sorted((str(r[0]), *b[:3], round(b[3], 6)) for r, b in zip(rows, base(rows, held)))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_topics_help(spark):
    rng = random.Random(4)
    rows = []
    for i in range(200):
        topic = f"t{i % 2}"
        rows.append((i, " ".join(f"{topic}w{rng.randrange(60)}" for _ in range(40))))
    docs = frame(spark, rows).withColumn("held_out", F.col("doc_id") % 5 == 0)
    got = op.language_model(docs.select("doc_id", "held_out", "text"), states=3).where("held_out")
    total = got.agg(F.sum("score"), F.sum("base_score")).first()
    assert total[0] > total[1] + 300


def test_long_texts_are_learnt_from(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"t{i % 2}w{rng.randrange(60)}" for _ in range(2_500))) for i in range(30)]
    docs = frame(spark, rows).withColumn("held_out", F.col("doc_id") % 5 == 0)
    got = op.language_model(docs.select("doc_id", "held_out", "text"), states=3).where("held_out")
    total = got.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert total[0] > total[1] + 0.25 * total[2]


def test_nothing_to_learn_and_empty(spark):
    docs = frame(spark, awkward()).withColumn("held_out", F.lit(True)).select("doc_id", "held_out", "text")
    got = op.language_model(docs).collect()
    assert len(got) == len(awkward()) and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in got)
    assert op.language_model(docs.limit(0)).count() == 0


def test_short_texts_do_not_wait_for_a_long_one(monkeypatch):
    rng = np.random.default_rng(6)
    model = random_model(rng, 3, 20)
    size = [5, 400, 7, 6, 8, 3, 9, 300, 6, 5]
    classes, begin = rng.integers(0, 20, sum(size)).astype("<u2"), np.cumsum([0, *size])
    alone = [op.recursion(classes[a:b], np.array([0, b - a]), model, True) for a, b in zip(begin, begin[1:])]
    runs = []
    lockstep = op._lockstep
    monkeypatch.setattr(op, "_lockstep", lambda classes, heads, size, *rest: runs.append(size.tolist()) or lockstep(classes, heads, size, *rest))
    monkeypatch.setattr(op, "PART", 40)
    like, *counts = op.recursion(classes, begin, model, True)
    assert runs[:2] == [[400], [300]] and sorted(sum(runs, [])) == sorted(size) and max(map(sum, runs[2:])) <= 40
    assert np.allclose(like, [a[0][0] for a in alone], atol=1e-4)
    for k in range(3):
        assert np.allclose(counts[k], sum(a[k + 1] for a in alone), atol=1e-3)


def test_training_texts_lie_by_length(spark, monkeypatch):
    monkeypatch.setattr(op, "SHARE", 500)
    size = [1 + i % 40 for i in range(200)] + [900]
    data = [(i, n, bytes([i % 256, 0] * n)) for i, n in enumerate(size)] + [(None, 1, b"\x07\x00"), (None, 1, b"\x07\x00")]
    df = spark.createDataFrame(data, "doc_id long, n_tokens long, classes binary")
    out = op.by_length(df, sum(r[1] for r in data)).withColumn("file", F.input_file_name()).collect()
    assert sorted(bytes(r["classes"]) for r in out) == sorted(r[2] for r in data)
    parts = collections.defaultdict(list)
    for r in out:
        parts[r["file"]].append(len(r["classes"]) // 2)
    assert len(parts) > 4 and max(sum(n for n in p if n < 900) for p in parts.values()) < 1000
    short = [p for p in parts.values() if max(p) < 900]
    assert all(max(p) <= 2 * min(p) + 8 or max(p) <= 20 for p in short)
    assert op.by_length(df.limit(0), 0).count() == 0
