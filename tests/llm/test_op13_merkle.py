import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import EXTRA
from ledgerline.llm import op13_merkle_manifest as op

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("source", "lang", "text")], T.StructField("n_chars", T.LongType())])


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """Rows of the contract, level by level, as a multiset."""
    leaf = lambda r: sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])])
    tree = {}
    for r in rows:
        changed = dict(r)
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
            changed["n_chars"] += 1
        tree.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), leaf(changed), r["doc_id"]))

    def towers(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tower, i):
        out = []
        for level in tower[:-1]:
            out.append((i, level[i ^ 1] if i ^ 1 < len(level) else None))
            i //= 2
        return out

    langs = sorted(tree, key=lambda x: (x is not None, (x or "").encode()))
    own = {g: towers([x[2] for x in sorted(tree[g])]) for g in langs}
    top = towers([own[g][-1][0] for g in langs])
    out = []
    for g in langs:
        for i, (_, _, first, given, doc_id) in enumerate(sorted(tree[g])):
            steps = path(own[g], i) + path(top, langs.index(g))
            node = given
            for at, other in steps:
                node = sha(node) if other is None else sha(node, other) if at % 2 == 0 else sha(other, node)
            root = top[-1][0]
            out.append((doc_id, first, own[g][-1][0], root, sha(*[o for _, o in steps if o is not None]), node, node == root))
    return sorted(out, key=repr)


def documents(rng, n, ids=None):
    out = []
    for i in range(n):
        out.append({"doc_id": ids(i) if ids else i, "source": rng.choice(["a", None, "b:1"]), "lang": rng.choice(["en", "en", "en", "fr", None, "é", ""]), "text": rng.choice([None, "", "é" * 30, f"text {i}"]), "n_chars": rng.choice([None, i, -3])})
    return out


def query(spark, rows, tmp_path, name="t"):
    frame = spark.createDataFrame([tuple(r[c] for c in SCHEMA.names) for r in rows], SCHEMA)
    for c in EXTRA + ["tree", "rank", "path", "id"]:
        frame = frame.withColumn(c, F.lit("x"))
    folder = str(tmp_path / name)
    frame.repartition(3).write.parquet(folder + "/documents.parquet")
    return op.op13_merkle_manifest(spark, folder)


CASES = {
    "plain": lambda rng: documents(rng, 300),
    "wide ids": lambda rng: documents(rng, 200, lambda i: rng.choice([None, rng.randrange(-(1 << 63), 1 << 63), rng.randrange(-200, 200), (1 << 63) - 1 - i, 63, 64, -1])),
    "repeated rows": lambda rng: (lambda d: d + d[:20] * 3 + [dict(d[0], text="other")] * 2)(documents(rng, 60, lambda i: i // 3)),
    "one row": lambda rng: documents(rng, 1),
    "no rows": lambda rng: [],
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, tmp_path, case):
    rows = CASES[case](random.Random(3))
    got = query(spark, rows, tmp_path)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_more_rounds_than_one(spark, tmp_path, monkeypatch):
    """Slot arrays of four: several rounds, shipped with the closures."""
    rows = [dict(r, lang=rng_lang) for r, rng_lang in zip(documents(random.Random(5), 90), ["en"] * 70 + ["fr"] * 20)]
    monkeypatch.setattr(op, "LEVELS", 2)
    monkeypatch.setattr(op, "SLOTS", 4)
    frame = spark.createDataFrame([tuple(r[c] for c in SCHEMA.names) for r in rows], SCHEMA)
    nodes = frame.select(F.lit("t").alias("tree"), F.col("doc_id").alias("rank"), F.unhex(F.sha2(F.col("doc_id").cast("string").cast("binary"), 256)).alias("node"), F.lit(None).cast("binary").alias("data"))
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(90)]
    tower = op.layers(leaves, op.levels_of(90))
    arrays = op._arrays(nodes, spark.createDataFrame([("t", 7)], "tree string, left int"))
    assert arrays.count() == 23 and len(tower[-1]) == 1
    for place in range(90):
        assert op.folded(leaves[place], place, 90, op.siblings(tower, place)) == tower[-1][0]
        assert op._path_length(place, 90) == len(op.siblings(tower, place))


def test_ranks(spark):
    rng = random.Random(9)
    ids = [rng.choice([rng.randrange(-(1 << 63), 1 << 63), rng.randrange(1 << 20), rng.randrange(300), None]) for _ in range(2000)]
    rows = spark.createDataFrame([(rng.choice(["x", None]), v, i) for i, v in enumerate(ids)], "tree string, id long, row long")
    got = op.ranked(rows, ["id", "row"]).toPandas()
    for _, part in got.groupby("tree", dropna=False):
        assert sorted(part["rank"]) == list(range(len(part)))
        order = part.sort_values("rank")["id"].tolist()
        known = [v for v in order if v == v]
        assert known == sorted(known) and all(v != v for v in order[: len(order) - len(known)])


def test_many_groups_climb_in_several_rounds(spark, tmp_path):
    """More leaves in one tree than a slot array holds."""
    n = op.SLOTS + 5
    rows = [{"doc_id": 3 * i, "source": None, "lang": "en", "text": "t", "n_chars": i} for i in range(n)]
    got = query(spark, rows, tmp_path)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_sql_on_the_given_table(spark):
    got = op.op13_merkle_manifest(spark, "/root/testdata/sf0.001").toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(op.oracle()).df().sort_values("doc_id").reset_index(drop=True)
    assert got.equals(want[got.columns]) and not got["verified"].all() and got["verified"].any()
