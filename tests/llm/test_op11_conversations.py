import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import EXTRA
from ledgerline.llm import op11_conversation_repair as op

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
LEGAL = re.compile(r"(s?(ua)+)?")
SHOWN = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def fault_list(rows):
    out, seen = [], set()
    for _, role, text in rows:
        shown = SHOWN.findall(text)
        out.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_repair(rows, faults):
    """All edits with at most two insertions at a place: (cost, letters, repaired)."""
    gaps = list(itertools.chain.from_iterable(itertools.product(("user", "assistant"), repeat=k) for k in range(3)))
    choices = []
    for (_, role, text), fault in zip(rows, faults):
        one = [(3, "D", [])]
        if fault not in ("b", "d"):
            extra = int(fault == "t")
            one += [(extra, "K", [(role, text)])] + [(2 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
        choices += [[(2 * len(g), "I" * len(g), [(r, "") for r in g]) for g in gaps], one]
    choices.append([(2 * len(g), "I" * len(g), [(r, "") for r in g]) for g in gaps])
    for path in itertools.product(*choices):
        turns = [t for _, _, part in path for t in part]
        if LEGAL.fullmatch("".join(r[:1] for r, _ in turns)):
            yield sum(c for c, _, _ in path), "".join(x for _, x, _ in path), turns


def rest_best(rows, faults):
    """The least (cost, letters), from the last row to the first."""
    best = [(op.END_COST[s], op.END_LETTERS[s]) for s in range(4)]
    for (_, role, _), fault in zip(reversed(rows), reversed(faults)):
        code = 0 if fault in ("b", "d") else {"s": 1, "u": 2, "a": 3}.get(role[:1], 4) + 4 * (fault == "t")
        best = [min((best[b][0] + cost, letters + best[b][1]) for b, (cost, letters) in enumerate(op._MOVES[code][a]) if cost < op.NONE) for a in range(4)]
    return best[0]


def expected(conv, rows):
    faults = fault_list(rows)
    cost, audit = rest_best(rows, faults)
    turns, state, at = [], "", 0
    for letter in audit:
        if letter == "K":
            turns.append(rows[at][1:])
        elif letter != "D":
            turns.append(("assistant" if turns and turns[-1][0][:1] == "u" else "user", "" if letter == "I" else rows[at][2]))
        at += letter != "I"
    known = [t for t, _, _ in rows if t is not None]
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows[:-1], rows[1:])]
    assert LEGAL.fullmatch("".join(r[:1] for r, _ in turns))
    return (
        conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"),
        sum("".join(p) not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
    )


def conversations(rng, n, longest=9):
    rows = []
    for conv in [*range(n), None]:
        for _ in range(rng.randrange(1, longest)):
            text = rng.choice(["yes.", "no!", "why?", "cut", "", " \n\t", None, "a. b", "é…", "end. \r\n", "x" * 2000])
            rows.append((conv, rng.choice([None, *range(-2, 12)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "Ärzte"]), text))
    rng.shuffle(rows)
    return rows


def query(spark, rows, folder):
    frame = spark.createDataFrame(rows, SCHEMA)
    for c in EXTRA + ["live", "segment", "copy", "code"]:
        frame = frame.withColumn(c, F.lit("x"))
    frame.repartition(3).write.parquet(folder + "/conversations.parquet")
    return op.op11_conversation_repair(spark, folder)


def test_least_letters_of_all_repairs():
    rng = random.Random(2)
    for _ in range(120):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["yes.", "cut", "", "no.", "so."])) for i in range(rng.randrange(0, 4))]
        faults = fault_list(rows)
        cost, audit, _ = min(every_repair(rows, faults))
        codes = bytes(0 if f in ("b", "d") else {"s": 1, "u": 2, "a": 3}.get(r[1][:1], 4) + 4 * (f == "t") for r, f in zip(rows, faults))
        assert (cost, audit) == rest_best(rows, faults) == (op.cost_of(codes, op.letters_of(codes)), op.letters_of(codes))


def test_divide_and_conquer_on_long_conversations():
    rng = random.Random(3)
    for n in (5, 17, 64, 333):
        for _ in range(20):
            codes = bytes(rng.randrange(9) for _ in range(n))
            rows = [(i, ("x", "s", "u", "a", "t")[(c - 1) % 4 + 1 if c else 0], "") for i, c in enumerate(codes)]
            faults = ["b" if not c else "t" if c > 4 else "" for c in codes]
            letters = op.letters_of(codes, {})
            assert (op.cost_of(codes, letters), letters) == rest_best(rows, faults)


@pytest.mark.parametrize("shape", ["short", "one long", "empty"])
def test_query_against_brute_force(spark, tmp_path, shape):
    rng = random.Random(7)
    rows = {"short": lambda: conversations(rng, 60) + [(77, t, "user", "same") for t in range(3)] * 2, "empty": lambda: []}.get(shape)
    if rows is None:  # one conversation far longer than a segment, cut by partitions as well, with repeats across segments
        rows = [(5, rng.choice([None, *range(9000)]), rng.choice(["user", "assistant", "tool"]), rng.choice(["cut", "", f"t{rng.randrange(9000)}.", f"u{rng.randrange(9000)}"])) for _ in range(3 * op.ROWS)] + conversations(rng, 20)
    else:
        rows = rows()
    got = query(spark, rows, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {t for _, t in got.dtypes[1:7]} == {"bigint"}
    want = sorted((expected(c, r) for c, r in damage(rows).items()), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "hi."), (1, 1, "user", "so."), (2, 0, "user", "a."), (2, 1, "user", "cut")], SCHEMA).withColumn("live", F.lit(True))
    turns = op.repaired_turns(op.repair(rows)).orderBy("conv_id", "segment", "place").collect()
    assert [(r["conv_id"], r["role"], r["text"]) for r in turns] == [(1, "user", ""), (1, "assistant", "hi."), (1, "user", "so."), (1, "assistant", ""), (2, "user", "a."), (2, "assistant", "cut")]


def test_sql(spark, tmp_path):
    rows = conversations(random.Random(11), 80)
    got = query(spark, rows, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(op.oracle()).df()
    key = lambda d: sorted(map(repr, d.astype(object).where(d.notna(), None).itertuples(index=False, name=None)))
    got["conv_id"], want["conv_id"] = got["conv_id"].astype("float"), want["conv_id"].astype("float")
    assert key(got) == key(want[got.columns])
