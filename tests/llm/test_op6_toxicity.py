import itertools
import math
import random

import numpy as np
import pytest

from helpers import EXTRA, awkward, frame, words
from ledgerline.llm import op6_toxicity as op

BAD = ["idiot", "worthless", "moron", "disgusting"]


def sample(seed, n):
    rng = random.Random(seed)
    plain = ["then", "house", "water", "garden", "letter", "summer", "little", "moving", "street", "tomato", "dinner", "golden"]
    rows, labels = [], []
    for i in range(n):
        own = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            own.insert(rng.randrange(len(own)), rng.choice(BAD))
        rows.append((1000 + i, " ".join(own) + "."))
        labels.append((1000 + i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = sample(1, 400)
    return op.train(frame(spark, rows).select("doc_id", "text"), spark.createDataFrame(labels + [(None, 1), (1, None)], "doc_id long, label int"))


def test_decoding(trained):
    model, _ = trained
    for seen, word in {"1d10t": "idiot", "m0r0n": "moron", "w0rthl3ss": "worthless", "i.d.i.o.t": "idiot", "moooron": "moron", "d!$gusting": "disgusting", "lettter": "letter", "tomato": "tomato"}.items():
        assert model.decode(seen) == word


def test_held_out_hidden_words_and_edges(spark, trained):
    model, scorer = trained
    rows, labels = sample(2, 100)
    hidden = [(1, "the house of that 1di0t there"), (2, None), (3, ""), (4, "water and m o r o n street"), (5, "water garden street"), (6, "Wooorthless!"), (7, "w0rthl3ss\n"), (8, words(random.Random(1), 20_000))]
    docs = frame(spark, rows + hidden + [hidden[0]])
    got = op.score(docs, model, scorer).collect()
    assert len(got) == 109 and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    assert sum((score[i] >= 0.3) == bool(y) for i, y in labels) >= 98
    assert all(score[i] >= 0.3 for i in (1, 4, 6, 7)) and all(score[i] < 0.3 for i in (2, 3, 5, 8))
    assert all(r[c] == f"{c}-{r['doc_id']}" for r in got for c in EXTRA if c != "score")
    restored = {r["doc_id"]: r["restored"] for r in op.restore_text(docs, model).collect()}
    assert restored[4] == "water and moron street" and restored[2] == restored[3] == "" and restored[5] == "water garden street"


def test_awkward_and_unlabelled(spark, trained):
    assert op.score(frame(spark, awkward()), *trained).count() == len(awkward())
    assert op.score(frame(spark, []), *trained).count() == 0
    model, scorer = op.train(frame(spark, []).select("doc_id", "text"), spark.createDataFrame([], "doc_id long, label int"))
    assert op.score(frame(spark, [(1, "an idiot")]), model, scorer).first()["score"] < 1e-9


def every_restoration(model, seen):
    """(value, word) of every path of the lattice, by its definition."""
    choices = []
    for i, c in enumerate(seen):
        if c in op.LEET:
            choices.append([(x, op.LEET_COST) for x in op.LEET[c]] + ([] if c.isdigit() else [("", op.SEPARATOR_COST)]))
        elif c in op.SEPARATORS or not c.isalpha():
            choices.append([("", op.SEPARATOR_COST)])
        else:
            choices.append([(c, 0.0)] + ([("", op.REPEAT_COST)] if i and seen[i - 1] == c else []))
    for path in itertools.product(*choices):
        word = "".join(x for x, _ in path)
        padded = "  " + word + " "
        yield sum(v for _, v in path) + sum(math.log(model.probability(padded[i : i + 3])) for i in range(len(padded) - 2)), word


def test_viterbi_finds_the_best_of_all_paths():
    rng = random.Random(4)
    for _ in range(60):
        grams = {}
        for _ in range(80):
            word = "  " + "".join(rng.choice("abegilst") for _ in range(rng.randrange(1, 7))) + " "
            for i in range(2, len(word)):
                for k in (1, 2, 3):
                    grams[word[i + 1 - k : i + 1]] = grams.get(word[i + 1 - k : i + 1], 0) + rng.randrange(1, 4)
        model = op.CharacterModel(grams)
        seen = "".join(rng.choice("abegilst13456!|@.-ss") for _ in range(rng.randrange(1, 9)))
        paths = list(every_restoration(model, seen))
        best = max(v for v, _ in paths)
        assert any(word == model.decode(seen) and math.isclose(v, best) for v, word in paths)


def hidden(text, known=op._NO_WORDS):
    data = np.frombuffer(text.encode(), np.uint8)
    begin, close, _, suspicious, runs = op.word_table(op.lowered(data), np.array([0, len(data)]), known)
    return [text[a:b] for a, b, s in zip(begin, close, suspicious) if s], ["".join(text[begin[i] : close[i]] for i in range(a, b)) for a, b in runs]


def test_the_gate_lets_hidden_words_in():
    assert hidden("so 5h17 and !diot, s--c--u--m (w0w) then") == (["5h17", "!diot", "s--c--u--m", "w0w"], [])
    assert hidden("a s t u p 1 d one; 1 2 0 4 and $ c u m") == ([], ["astup1d", "$cum"])
    assert hidden("stuupid letter")[0] == ["stuupid", "letter"]
    letter = op.RollingHash(np.frombuffer(b"letter", np.uint8)).of(np.array([0]), np.array([6]))
    assert hidden("stuupid letter", letter)[0] == ["stuupid"]
    assert hidden("a plain text of 1999, 24 words -- and ... 3.5 %") == ([], [])
    assert hidden(" \n ") == hidden("") == hidden("!!! ??") == ([], [])


def test_a_step_that_passes_the_gate_and_hits_nothing():
    """Sums stay floating point, whatever a step holds."""
    scorer = op.Scorer(np.array([5 << 48], np.uint64), np.array([2.0]))
    missed = scorer.sums(np.array([(5 << 48) + 1], np.uint64), np.array([0]), 3)
    assert missed.dtype == float and missed.tolist() == [0, 0, 0]
    assert scorer.sums(np.array([5 << 48] * 2, np.uint64), np.array([1, 1]), 3).tolist() == [0, 2, 0]


def test_rare_trigrams_go_only_up_to_the_stated_loss(spark):
    counts = spark.createDataFrame([(f"a{i}", 1) for i in range(50)] + [("big", 2000), ("more", 3000)], "gram string, n long")
    assert op._least_kept(counts, 0.0) == 1 and op._least_kept(counts, 0.02) == 1024 and op._least_kept(counts, 0.005) == 1
    model = op.character_model(spark.createDataFrame([("then the",), (None,), ("",)], "text string"), 0.0)
    assert model.grams["the"] == 2 and model.grams["e"] == 2 and model.grams["  t"] == 2 and model.grams["en "] == 1


def test_the_registered_query(spark):
    got = op.op6_toxicity(spark, "/root/testdata/sf0.001")
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 as out").collect()
    assert {(r["doc_id"], r["held_out"]) for r in rows} == {(r["doc_id"], r["out"]) for r in docs} and len(rows) == len(docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
