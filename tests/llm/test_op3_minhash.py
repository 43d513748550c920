import collections
import random

import numpy as np

from helpers import EXTRA, WORD, awkward, frame, words
from ledgerline.llm import op3_minhash_dedup as op
from ledgerline.llm.components import connected_components


def shingles(text):
    w = WORD.findall(text or "")
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def brute(rows):
    """Smallest id of each row's class: equal texts, and links of weighted Jaccard similarity 0.8."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [shingles(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            common = sum((sets[i] & sets[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or (common and common >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - common)):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], min(ids) if ids else None, len(members)) for i in members]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    rows = awkward(rng)
    for g in range(12):
        base = words(rng, rng.randrange(4, 300)).split()
        rows.append((100 + 10 * g, " ".join(base)))
        for c in range(rng.randrange(0, 5)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 25) + 1)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(999)}"
            rows.append((101 + 10 * g + c, " ".join(copy)))
    return rows


def test_classes_against_brute_force(spark):
    rows = corpus(1)
    got = op.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in got), key=str) == brute(rows)


def test_signature_agreement_is_weighted_jaccard():
    rng = random.Random(2)
    a = words(rng, 400, 60).split()
    b = a[:300] + words(rng, 100, 60).split()
    texts = [" ".join(a).encode(), " ".join(b).encode()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    signature, has = op.signatures(*op.cells(data, offsets), 2, 4000)
    x, y = shingles(texts[0].decode()), shingles(texts[1].decode())
    true = sum((x & y).values()) / sum((x | y).values())
    assert has.all() and abs((signature[0] == signature[1]).mean() - true) < 0.04


def test_keep_one(spark):
    rows = corpus(3)
    docs = frame(spark, rows)
    out = op.keep_one(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert all(r[c] == f"{c}-{r['doc_id']}" for r in kept for c in EXTRA)
    assert sorted((str(r["doc_id"]) for r in kept)) == sorted({str(c) for _, c, _ in brute(rows)})


def test_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = words(rng, 150).split()
    rows = [(1, " ".join(base))]
    for i in range(60):
        copy = list(base)
        copy[rng.randrange(len(copy))] = f"y{i}"
        rows.append((2 + i, " ".join(copy)))
    got = op.near_duplicates(frame(spark, rows), small=4).collect()
    assert {r["class_id"] for r in got} == {1}


def test_links_of_members_unlike_every_leader(spark):
    rng = random.Random(6)
    base = words(rng, 120).split()
    rows = []
    for f in range(60):  # pairs of near texts, all of them about 0.6 like the same base
        own = list(base)
        at = rng.randrange(80)
        own[at : at + 25] = [f"f{f}w{i}" for i in range(25)]
        copy = list(own)
        copy[rng.randrange(len(copy))] = f"z{f}"
        rows += [(2 * f, " ".join(own)), (2 * f + 1, " ".join(copy))]
    for tile in (1000, 7):
        got = op.near_duplicates(frame(spark, rows), bands=4, rows=1, tile=tile).collect()
        assert sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in got), key=str) == brute(rows)


def test_tile_links_count_every_pair():
    rng = np.random.default_rng(7)
    parts = [np.unique(rng.integers(0, 60, 50).astype(np.uint64)) for _ in range(40)]
    parts[20:] = [np.unique(np.append(p[:-1], np.uint64(900 + i % 4))) for i, p in enumerate(parts[:20])]
    component, outside = np.arange(40) % 9, np.arange(40) % 9 != 0
    for side in (np.zeros(40, int), np.arange(40) // 20):
        a, b = op.tile_links(parts, component, outside, side, 0.6)
        want = set()
        for x in range(40):
            for y in range(x):
                common = len(np.intersect1d(parts[x], parts[y]))
                apart = component[x] != component[y] and (not side.any() or side[x] != side[y])
                if apart and common >= 0.6 * (len(parts[x]) + len(parts[y]) - common):
                    want.add((y, x))
        assert want and {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (5, 5)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}


def test_empty_table(spark):
    assert op.near_duplicates(frame(spark, [])).count() == 0
    assert op.keep_one(frame(spark, [])).count() == 0
