import random

import numpy as np

from helpers import awkward, frame, words
from ledgerline.llm import op2_decontaminate as op

ITEM_SCHEMA = "item_id long, text string"


def distance(a, b):
    """Least edit distance of a to any substring of b, by the plain recurrence."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def sentence(rng, n):
    return " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def damaged(rng, text, edits):
    b = list(text)
    for _ in range(edits):
        p = rng.randrange(len(b))
        kind = rng.randrange(3)
        if kind == 0:
            b[p] = rng.choice("xyzq")
        elif kind == 1 and len(b) > 1:
            del b[p]
        else:
            b.insert(p, rng.choice("xyzq"))
    return "".join(b)


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(200):
        a, b = sentence(rng, 3).encode(), sentence(rng, 5).encode()
        assert op.edit_distance_within(a, b)[0] == distance(a, b)


def items_of(texts):
    return op.Items(np.arange(len(texts)), [t.encode() for t in texts])


def test_windows_lose_nothing_and_lsh_recall():
    rng = random.Random(2)
    texts = [sentence(rng, rng.randrange(15, 50)) for _ in range(60)]
    items = items_of(texts)
    docs, true = [], set()
    for i, t in enumerate(texts * 3):
        bad = damaged(rng, t, rng.randrange(0, int(0.1 * len(t)) + 1))
        docs.append((sentence(rng, 8) + " " + bad + " " + sentence(rng, 8)).encode())
        if distance(t.encode(), docs[-1]) <= int(0.1 * len(t)):
            true.add((i, i % len(texts)))
    part = (np.frombuffer(b"".join(docs), np.uint8), np.cumsum([0, *map(len, docs)]))
    found = {(x[0], x[1]) for x in items.find([part], lsh=False)[0]}
    assert true <= found
    hashed = {(x[0], x[1]) for x in items.find([part])[0]}
    assert hashed <= found and len(hashed & true) >= 0.98 * len(true)


def test_leaks_against_brute_force(spark):
    rng = random.Random(3)
    texts = [sentence(rng, 20) for _ in range(8)]
    rows = awkward(rng) + [(50 + i, sentence(rng, 10) + "\n " + t.upper().replace(" ", "  ") + " " + sentence(rng, 5)) for i, t in enumerate(texts[:5])]
    rows += [(70, damaged(rng, texts[6], 6)), (71, texts[7][: len(texts[7]) // 2])]
    benchmark = spark.createDataFrame([*enumerate(texts), (90, None), (91, ""), (92, "short"), (0, texts[0])], ITEM_SCHEMA)
    docs = frame(spark, rows)
    got = {(r["doc_id"], r["item_id"]) for r in op.leaks(docs, benchmark, block=3).collect()}
    assert got == {(50 + i, i) for i in range(5)} | {(70, 6)}
    kept = op.keep_clean(docs, benchmark, block=3)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in rows if not (r[0] or 0) in {50, 51, 52, 53, 54, 70})


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEM_SCHEMA)
    docs = frame(spark, [(1, words(random.Random(4), 30))])
    assert op.leaks(docs, none).count() == 0
    assert op.keep_clean(docs, none).count() == 1
    some = spark.createDataFrame([(1, "one benchmark item of some length")], ITEM_SCHEMA)
    assert op.leaks(frame(spark, []), some).count() == 0
