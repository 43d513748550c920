"""Least-cost repair of the turn structure of conversations.

A conversation's rows, by turn (null turns first, then by role and text, so equal rows are neighbours), are
kept (no cost), given another role (2), deleted (3) or joined by inserted empty turns (2) until
their role initials read ``(s?(ua)+)?``.  Blank rows and repeats of an earlier (role, text) must go; a truncated
row that stays costs 1 more.  Of all cheapest repairs the one whose letters (``D``, ``I``, ``K``, ``R``) are
ASCII-least is taken.  Four states are enough: nothing yet, after a system, user or assistant turn.

Hirschberg's divide and conquer: a forward vector of four costs from the one end and a
backward one from the other meet in the middle of the rows; of the states with the least sum the one
with the least letters so far is the crossing, and both halves are solved again between fixed states.  Letters up to a crossing end
with a row's own letter, so none begins another, and four ranks beside the four costs
tell which is least; no letters are kept on the way.

1. ``segments``: rows are range-partitioned by conversation, turn, role and text and streamed in that
   order.  A conversation within one partition and ``ROWS`` rows is solved at once.  Others - and the first and last of a partition,
   whose rest may lie next door - become open segments of at most ``ROWS`` rows, however many rows a conversation has.
2. ``_marked``: an open segment learns which of its rows repeat one of an earlier segment; a segment sends each text once.
3. ``_crossings``: costs and ranks between all pairs of states sum a segment up; one pass over these summaries from the last segment
   to the first gives the backward vectors, one from the first to the last the states at all borders.
4. Every open segment is then solved between its two states.

Null roles and texts count as one blank, a null conversation id is a conversation of its own.  Empty and long texts, repeated rows and
rows with equal turns have no special rule; an empty table has no conversations, and one whose rows are all
marked as not ``live`` has no turns.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import map_arrow, stored, table
from ledgerline.llm.oracle import crc32, crc32_tables

#: Rows of a segment, and bytes of text after which it ends all the same.
ROWS, BYTES = 4096, 1 << 22
#: Answers that a task remembers.
REMEMBERED = 200_000
RANGE_PREFIX = 64

DELETE, INSERT, RECAST, CUT = 3, 2, 2, 1
NONE = 1 << 60
#: States: nothing yet, after system, after user, after assistant.  Only a system turn can follow nothing but not an assistant.
AFTER = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (2, 3): 3, (3, 2): 2}
FORCED = (2, 2, 3, 2)  # the state after a user or assistant turn that fits
#: Cost and letters of ending a conversation in a state.
END_COST, END_LETTERS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
ROLES = ("", "system", "user", "assistant")


def _row_table() -> list[list[list[tuple[int, str]]]]:
    """For each row code and pair of states the least (cost, letters) that lead over the row.

    Code 0 must go; 1 to 4 are rows with initial s, u, a or another one; 5 to 8 the same, truncated.
    """
    out = []
    for code in range(9):
        kind, cut = (code - 1) % 4 + 1 if code else 0, CUT * (code > 4)
        moves = [[(NONE, "")] * 4 for _ in range(4)]
        for start in range(4):
            state, spent, letters = start, 0, ""
            for _ in range(4):  # insertions before the row
                ways = [(state, DELETE, "D")]
                if code:
                    ways.append((FORCED[state], RECAST + cut, "R"))
                    if (state, kind) in AFTER:
                        ways.append((AFTER[state, kind], cut, "K"))
                for to, cost, letter in ways:
                    moves[start][to] = min(moves[start][to], (spent + cost, letters + letter))
                state, spent, letters = FORCED[state], spent + INSERT, letters + "I"
        out.append(moves)
    return out


_MOVES = _row_table()
_COSTS = [[[cost for cost, _ in row] for row in moves] for moves in _MOVES]


def forward(codes: bytes, state: int) -> tuple[list[int], list[int]]:
    """Least cost from ``state`` over all rows to each state, and the order of their letters."""
    cost, rank = [NONE] * 4, [0] * 4
    cost[state] = 0
    for code in codes:
        moves, best = _MOVES[code], [(NONE, 0, "")] * 4
        for a in range(4):
            if cost[a] < NONE:
                for b in range(4):
                    step, letters = moves[a][b]
                    if step < NONE and (cost[a] + step, rank[a], letters) < best[b]:
                        best[b] = (cost[a] + step, rank[a], letters)
        cost = [x[0] for x in best]
        order = sorted(range(4), key=lambda b: best[b][1:])
        rank = [order.index(b) for b in range(4)]
    return cost, rank


def backward(codes: bytes, ends: list[int]) -> list[int]:
    """Least cost from each state over all rows to the ends, which cost ``ends``."""
    cost = list(ends)
    for code in reversed(codes):
        steps = _COSTS[code]
        cost = [min(NONE, min(steps[a][b] + cost[b] for b in range(4))) for a in range(4)]
    return cost


def crossing(cost: list[int], rank: list[int], later: list[int]) -> int:
    """The state where least costs meet; of several the one with the least letters before it."""
    return min(range(4), key=lambda s: (cost[s] + later[s], rank[s]))


def letters_between(codes: bytes, start: int, end: int, known: dict | None = None) -> str:
    """The least letters over the rows from one state to another."""
    if not codes:
        return ""
    if len(codes) == 1:
        return _MOVES[codes[0]][start][end][1]
    key = (codes, start, end)
    if known is not None and key in known:
        return known[key]
    middle = len(codes) // 2
    fixed = [NONE] * 4
    fixed[end] = 0
    state = crossing(*forward(codes[:middle], start), backward(codes[middle:], fixed))
    out = letters_between(codes[:middle], start, state, known) + letters_between(codes[middle:], state, end, known)
    if known is not None and len(codes) <= 64:
        if len(known) >= REMEMBERED:
            known.clear()
        known[key] = out
    return out


def letters_of(codes: bytes, known: dict | None = None) -> str:
    """The audit of a whole conversation."""
    state = crossing(*forward(codes, 0), list(END_COST))
    return letters_between(codes, 0, state, known) + END_LETTERS[state]


def cost_of(codes: bytes, letters: str) -> int:
    at, total = 0, 0
    for letter in letters:
        total += DELETE if letter == "D" else 0 if letter == "K" else RECAST
        if letter in "KR" and codes[at] > 4:
            total += CUT
        at += letter != "I"
    return total


def applied(letters: str, roles: list[str], texts: list[str], codes: bytes, state: int = 0) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired turns."""
    at, out_roles, out_texts = 0, [], []
    for letter in letters:
        if letter == "K":
            out_roles.append(roles[at])
            state = AFTER[state, (codes[at] - 1) % 4 + 1]
        elif letter != "D":
            state = FORCED[state]
            out_roles.append(ROLES[state])
        if letter != "D":
            out_texts.append("" if letter == "I" else texts[at])
        at += letter != "I"
    return out_roles, out_texts


def row_code(role: Column, text: Column) -> Column:
    """The code of a row as far as it does not depend on others (see ``_row_table``)."""
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    shown = F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.when(F.length(shown) == 0, 0).otherwise(kind + F.when(F.substring(shown, -1, 1).isin(".", "!", "?"), 0).otherwise(4)).cast("int")


_INITIAL = {"s": 1, "u": 2, "a": 3}
_LEGAL = {(1, 2), (2, 3), (3, 2)}


class _Segment:
    """Rows of one conversation, in order."""

    def __init__(self, conversation, first: bool):
        self.conversation, self.first = conversation, first  # first: rows before may be elsewhere
        self.turns, self.roles, self.texts, self.size = [], [], [], 0
        self.codes = bytearray()

    def add(self, turn, role: str, text: str, code: int) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(code)
        self.size += len(text)

    def figures(self) -> dict:
        """What does not depend on other segments: turn numbers and role pairs."""
        known = [t for t in self.turns if t is not None]
        kinds = [_INITIAL.get(r[:1], 4) for r in self.roles]
        return {
            "rows": len(self.roles), "low": min(known, default=None), "high": max(known, default=None), "numbers": len(set(known)),
            "head": kinds[0] if kinds else None, "tail": kinds[-1] if kinds else None, "illegal": sum(p not in _LEGAL for p in zip(kinds[:-1], kinds[1:])),
        }

    def keys(self) -> list[bytes]:
        """Digests of (conversation, role, text) of the rows."""
        own = repr(self.conversation)
        return [hashlib.md5(f"{len(own)}:{own}{len(r)}:{r}{t}".encode()).digest() for r, t in zip(self.roles, self.texts)]

    def marked(self, earlier=()) -> tuple[bytes, int, int]:
        """Codes with repeats, blank rows and repeats."""
        blank, repeated, codes = 0, 0, bytearray(self.codes)
        seen = set()
        for i, pair in enumerate(zip(self.roles, self.texts)):
            if not codes[i]:
                blank += 1
            elif pair in seen or i in earlier:
                codes[i] = 0
                repeated += 1
            seen.add(pair)
        return bytes(codes), blank, repeated


_FIGURES = (("rows", "long"), ("low", "long"), ("high", "long"), ("numbers", "long"), ("head", "integer"), ("tail", "integer"), ("illegal", "long"))
_ANSWERS = (("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("cost", "long"), ("audit", "string"))
_ARROW = {"long": pa.int64(), "integer": pa.int32(), "string": pa.string()}


def _schema(conversation: T.StructField, open_: bool) -> T.StructType:
    out = T.StructType([T.StructField("conv_id", conversation.dataType)]).add("segment", "long")
    if open_:
        out = out.add("solved", "boolean")
    for name, kind in _FIGURES + _ANSWERS:
        out = out.add(name, kind)
    out = out.add("roles", T.ArrayType(T.StringType())).add("texts", T.ArrayType(T.StringType()))
    if open_:
        out = out.add("codes", "binary").add("keys", T.ArrayType(T.BinaryType()))
    return out


def _answer(codes: bytes, letters: str, blank: int, repeated: int) -> dict:
    return {"blank": blank, "duplicate": repeated, "truncated": sum(c > 4 for c in codes), "cost": cost_of(codes, letters), "audit": letters}


def _batch(rows: list[dict], schema: T.StructType, ids: pa.DataType) -> pa.RecordBatch:
    kinds = {f.name: _ARROW.get(f.dataType.typeName()) for f in schema.fields}
    kinds.update(conv_id=ids, solved=pa.bool_(), codes=pa.binary(), keys=pa.list_(pa.binary()), roles=pa.list_(pa.string()), texts=pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[n]) for n in schema.names], names=schema.names)


def segments(rows: DataFrame) -> DataFrame:
    """Stored segments of ``rows`` (conv_id, turn, role, text, live), solved or open."""
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "live")
    rows = rows.withColumn("code", row_code(F.col("role"), F.col("text")))
    rows = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, RANGE_PREFIX)).sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = _schema(rows.schema["conv_id"], True)

    def run(batches):
        from pyspark import TaskContext

        base, number, known, held, size = TaskContext.get().partitionId() << 32, 0, {}, [], 0
        current, ids = None, None

        def closed(segment: _Segment, whole: bool) -> dict:
            nonlocal number
            row = {"conv_id": segment.conversation, "segment": base + number, "solved": whole, **segment.figures()}
            number += 1
            if not whole:
                return {**row, "roles": segment.roles, "texts": segment.texts, "codes": bytes(segment.codes), "keys": segment.keys()}
            codes, blank, repeated = segment.marked()
            letters = known.get(codes)
            if letters is None:
                letters = letters_of(codes, known)
                if len(codes) <= 64:
                    known[codes] = letters
            roles, texts = applied(letters, segment.roles, segment.texts, codes)
            return {**row, **_answer(codes, letters, blank, repeated), "roles": roles, "texts": texts}

        for batch in batches:
            ids = batch.column(0).type
            for conversation, turn, role, text, live, code in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None:
                    current = _Segment(conversation, True)
                elif current.conversation != conversation:
                    held.append(closed(current, not current.first))
                    size += current.size
                    current = _Segment(conversation, False)
                elif len(current.codes) >= ROWS or current.size >= BYTES:
                    held.append(closed(current, False))
                    size += current.size
                    current = _Segment(conversation, True)
                if live:
                    current.add(turn, role, text, code)
            if size >= BYTES:
                yield _batch(held, schema, ids)
                held, size = [], 0
        if current is not None:
            held.append(closed(current, False))
            yield _batch(held, schema, ids)

    return stored(map_arrow(rows, run, schema), "conversation-segments")


def _marked(open_: DataFrame) -> DataFrame:
    """Stored open segments with ``again``: places (from 0) of rows whose role and text an earlier segment has."""
    entries = open_.select("segment", F.explode(F.array_distinct("keys")).alias("key"))
    firsts = entries.groupBy("key").agg(F.min("segment").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    later = entries.join(firsts, "key").where("segment > first").groupBy("segment").agg(F.collect_list("key").alias("earlier"))  # at most a segment's rows
    place = F.filter(F.transform("keys", lambda k, i: F.when(F.array_contains("earlier", k), i).otherwise(-1)), lambda i: i >= 0)
    out = open_.join(later, "segment", "left").withColumn("again", F.coalesce(place, F.array().cast("array<int>")))
    return stored(out.drop("keys", "earlier"), "open-segments")


def _loaded(row: dict) -> tuple[bytes, int, int]:
    segment = _Segment(None, False)
    segment.roles, segment.texts, segment.codes = row["roles"], row["texts"], bytearray(row["codes"])
    return segment.marked(set(row["again"]))


def _crossings(marked: DataFrame) -> DataFrame:
    """(segment, start, end, last) of the open segments: the states at their borders."""
    kind = marked.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind)]).add("segment", "long").add("costs", T.ArrayType(T.LongType())).add("ranks", T.ArrayType(T.IntegerType()))

    def summed(batches):
        for batch in batches:
            costs, ranks = [], []
            for row in batch.select(["roles", "texts", "codes", "again"]).to_pylist():
                codes, _, _ = _loaded(row)
                ways = [forward(codes, s) for s in range(4)]
                costs.append([c for w in ways for c in w[0]])
                ranks.append([r for w in ways for r in w[1]])
            columns = [batch.column("conv_id"), batch.column("segment"), pa.array(costs, pa.list_(pa.int64())), pa.array(ranks, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    sums = map_arrow(marked.select("conv_id", "segment", "roles", "texts", "codes", "again"), summed, schema)
    sums = sums.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("segment"))
    with_later = T.StructType([*schema.fields]).add("later", T.ArrayType(T.LongType())).add("last", "boolean")

    def back(batches):
        conversation, later = object(), None
        for batch in batches:
            laters, lasts = [], []
            for own, costs in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                lasts.append(own != conversation)
                if own != conversation:
                    conversation, later = own, list(END_COST)
                laters.append(later)
                later = [min(NONE, min(costs[4 * a + b] + later[b] for b in range(4))) for a in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(laters, pa.list_(pa.int64())), pa.array(lasts, pa.bool_())], names=with_later.names)

    ends = stored(map_arrow(sums, back, with_later), "segment-sums").repartition("conv_id").sortWithinPartitions("conv_id", "segment")

    def ahead(batches):
        conversation, state = object(), 0
        for batch in batches:
            starts, stops = [], []
            for own, costs, ranks, later in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if own != conversation:
                    conversation, state = own, 0
                starts.append(state)
                state = crossing(costs[4 * state : 4 * state + 4], ranks[4 * state : 4 * state + 4], later)
                stops.append(state)
            columns = [batch.column(1), pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), batch.column(5)]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "start", "end", "last"])

    return map_arrow(ends, ahead, "segment long, start int, end int, last boolean")


def repair(rows: DataFrame) -> DataFrame:
    """Segments of all conversations of ``rows`` (conv_id, turn, role, text, live), repaired.

    A conversation is one row (conv_id, segment, counts, cost, audit, roles, texts of the
    repaired turns) where ``whole``, else one or several, by ascending ``segment``.
    """
    found = segments(rows)
    schema = _schema(found.schema["conv_id"], False)
    marked = _marked(found.where("not solved"))
    borders = _crossings(marked)
    work = marked.join(borders, "segment")

    def solve(batches):
        known: dict = {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                codes, blank, repeated = _loaded(row)
                letters = letters_between(codes, row["start"], row["end"], known)
                if row["last"]:
                    letters += END_LETTERS[row["end"]]
                roles, texts = applied(letters, row["roles"], row["texts"], codes, row["start"])
                out.append({**row, **_answer(codes, letters, blank, repeated), "roles": roles, "texts": texts})
            yield _batch(out, schema, batch.schema.field("conv_id").type)

    solved = found.where("solved").select(*schema.names).withColumn("whole", F.lit(True))
    return solved.unionByName(map_arrow(work, solve, schema).withColumn("whole", F.lit(False)))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """(conv_id, segment, place, role, text) of all repaired turns, in order of (segment, place)."""
    return repaired.select("conv_id", "segment", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "turn")).select("conv_id", "segment", "place", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))


_REPORT = (("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string"))


def report(repaired: DataFrame) -> DataFrame:
    """One row a conversation: counts, cost, audit and digest of the repaired turns.

    A conversation of several segments is read by one task, as its digest demands, segment after segment.
    """
    schema = T.StructType([T.StructField("conv_id", repaired.schema["conv_id"].dataType)])
    for name, kind in _REPORT:
        schema = schema.add(name, kind)

    def run(batches):
        conversation, state, ids = object(), None, None

        def done(s: dict) -> dict:
            gaps = 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["numbers"]
            return {**s, "gaps": gaps, "audit": "".join(s["letters"]), "repaired_sha256": s["hash"].hexdigest()}

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            arrays = [pa.array([r["conv_id"] for r in rows], ids)]
            return pa.RecordBatch.from_arrays(arrays + [pa.array([r[n] for r in rows], _ARROW[k]) for n, k in _REPORT], names=schema.names)

        for batch in batches:
            out, ids = [], batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != conversation:
                    if state is not None:
                        out.append(done(state))
                    conversation = row["conv_id"]
                    state = {"conv_id": conversation, "low": None, "high": None, "numbers": 0, "tail": None, "letters": [], "hash": hashlib.sha256(), "begun": False}
                    state.update(dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0))
                for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    state[name] += row[name]
                if row["rows"]:
                    state["illegal"] += state["tail"] is not None and (state["tail"], row["head"]) not in _LEGAL
                    state["tail"] = row["tail"]
                if row["low"] is not None:
                    state["numbers"] += row["numbers"] - (state["high"] == row["low"])  # turns ascend, so only neighbours share one
                    state["low"] = row["low"] if state["low"] is None else state["low"]
                    state["high"] = row["high"]
                state["letters"].append(row["audit"])
                if row["roles"]:
                    lines = "\n".join(f"{r}:{t}" for r, t in zip(row["roles"], row["texts"]))
                    state["hash"].update(("\n" * state["begun"] + lines).encode())
                    state["begun"] = True
            if out:
                yield batch_of(out)
        if state is not None:
            yield batch_of([done(state)])

    parts = repaired.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return map_arrow(repaired.where("whole"), run, schema).unionByName(map_arrow(parts, run, schema))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) damaged by crc32(``conv_id:turn``) % 20; dropped ones stay as rows that are not ``live``."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    out = rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(blank("role")).alias("role"), text.alias("text"), (kind != 0).alias("live"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(repair(damaged(table(spark, sf_dir, "conversations"))))


def oracle() -> str:
    """The same result in DuckDB SQL: least (cost, letters) of the rest of each conversation by recursion from its last row."""
    moves = ", ".join(f"({c}, {a}, {b}, {cost}, '{letters}')" for c, rows in enumerate(_MOVES) for a, row in enumerate(rows) for b, (cost, letters) in enumerate(row) if cost < NONE)
    ends = ", ".join(f"({s}, {c}, '{x}')" for s, (c, x) in enumerate(zip(END_COST, END_LETTERS)))
    return f"""
WITH RECURSIVE {crc32_tables()},
moves(code, a, b, cost, letters) AS (VALUES {moves}),
ends(s, cost, letters) AS (VALUES {ends}),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations, crc
),
rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM keyed JOIN (VALUES (1), (2)) c(copy) ON copy = 1 OR kind = 3 WHERE kind <> 0
),
convs AS (SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM conversations)),
numbered AS (
  SELECT c.k, r.turn, r.role, r.text, row_number() OVER (PARTITION BY c.k ORDER BY r.turn NULLS FIRST, r.role, r.text) AS i,
    rtrim(translate(r.text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' ') AS shown,
    CASE substr(r.role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 4 END AS kind
  FROM rows r JOIN convs c ON c.conv_id IS NOT DISTINCT FROM r.conv_id
),
faults AS (
  SELECT *, CASE WHEN shown = '' THEN 'b' WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'd' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(kind) OVER (PARTITION BY k ORDER BY i) AS before
  FROM numbered
),
coded AS (SELECT *, CASE WHEN fault IN ('b', 'd') THEN 0 WHEN fault = 't' THEN kind + 4 ELSE kind END AS code FROM faults),
counts AS (
  SELECT c.k, count(r.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before IS NOT NULL AND (before, kind) NOT IN ((1, 2), (2, 3), (3, 2))) AS illegal
  FROM convs c LEFT JOIN coded r ON r.k = c.k GROUP BY c.k
),
best AS (
  SELECT k, n AS i, s, {{'cost': cost, 'letters': letters}} AS v FROM counts, ends
  UNION ALL
  SELECT d.k, d.i - 1, m.a, min({{'cost': d.v.cost + m.cost, 'letters': m.letters || d.v.letters}})
  FROM best d JOIN coded r ON r.k = d.k AND r.i = d.i JOIN moves m ON m.code = r.code AND m.b = d.s GROUP BY d.k, d.i, m.a
),
audits AS (SELECT k, v.cost AS cost, v.letters AS audit FROM best WHERE i = 0 AND s = 0),
walk AS (
  SELECT k, audit, 1 AS at, 0 AS i, 0 AS s, []::VARCHAR[] AS lines FROM audits
  UNION ALL
  SELECT w.k, w.audit, w.at + 1, CASE WHEN x.letter = 'I' THEN w.i ELSE w.i + 1 END,
    CASE x.letter WHEN 'D' THEN w.s WHEN 'K' THEN r.kind ELSE x.forced END,
    CASE x.letter WHEN 'D' THEN w.lines WHEN 'K' THEN list_append(w.lines, r.role || ':' || r.text)
      ELSE list_append(w.lines, CASE WHEN x.forced = 3 THEN 'assistant:' ELSE 'user:' END || CASE WHEN x.letter = 'I' THEN '' ELSE r.text END) END
  FROM walk w, LATERAL (SELECT substr(w.audit, w.at, 1) AS letter, CASE WHEN w.s = 2 THEN 3 ELSE 2 END AS forced) x
  LEFT JOIN coded r ON r.k = w.k AND r.i = w.i + 1 WHERE w.at <= length(w.audit)
)
SELECT c.conv_id, n.gaps, n.blank, n.duplicate, n.truncated, n.illegal, CAST(a.cost AS BIGINT) AS cost, a.audit, sha256(array_to_string(w.lines, chr(10))) AS repaired_sha256
FROM convs c JOIN counts n ON n.k = c.k JOIN audits a ON a.k = c.k JOIN walk w ON w.k = c.k AND w.at = length(w.audit) + 1
"""
