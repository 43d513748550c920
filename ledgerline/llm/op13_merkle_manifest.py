"""Merkle manifest of a table: one tree per group, one tree over the groups' roots.

Leaves need their place among the rows of their group, ascending by id.  No
rows are sorted for that; a place is a rank query on a bitmap index:

1. ``word_index``: each group's ids become a compressed bitmap, of which only words of 64 ids that hold any are kept;
   partial words of the tasks are merged by a bitwise OR.  Above the words stand
   popcount directories of radix ``RADIX``: rows before an entry within its parent.
2. ``ranked``: an id's rank is the rows before its word plus the set bits below it in the word.
   Rows that share an id are ranked the same way among themselves by 64 bits of their
   digest, and rows that share these too by the number of their stored row.
3. ``climb``: digests meet by (tree, rank div ``SLOTS``) in slot arrays, each of which
   is reduced by 12 levels at once; the tops are the next round's slots, until every tree has one node.
4. ``descend``: from the last round to the first, each slot array hands its slots their siblings and its own path.

A path holds the other digests of the runs on the way to the top, the lowest
first; which side a digest stands on follows from the rank.  A run at the end of a level that
holds one digest alone is hashed alone and adds nothing to a path.

Rows with a null id come first in their group.  Rows that are equal in all fields
have equal digests; which of them gets which of their places is left open, the set
of results is not.  Null and empty fields have different digests, texts of any length are digested whole; an
empty table has no manifest rows.  Columns that are not fields of the leaf are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import map_arrow, stored, table
from ledgerline.llm.oracle import crc32, crc32_tables

#: Bits of an id within a word, and within each directory above it.
WORD_BITS, RADIX = 6, 12
#: Levels that one slot array reduces, and slots in it.
LEVELS = 12
SLOTS = 1 << LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` if null, else byte count, colon and value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row's fields (32 bytes)."""
    return F.unhex(F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256))


# --- ranks ---------------------------------------------------------------------------------------------------------


def word_index(rows: DataFrame, key: str) -> DataFrame:
    """(tree, word, bits, before) of non-null ``key``: the words of each tree's bitmap, and the tree's rows in earlier words."""
    word = F.shiftright(F.col(key), WORD_BITS)
    bit = F.expr(f"shiftleft(1L, cast({key} & {(1 << WORD_BITS) - 1} as int))")
    words = rows.where(F.col(key).isNotNull()).groupBy("tree", word.alias("word")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = stored(words, "bitmap-words")
    # directories from the words up: an entry's rows, and those before it within its parent
    levels, shift = [], 0
    current = words.select("tree", F.col("word").alias("entry"), "n")
    while True:
        parent = F.shiftright("entry", RADIX)
        earlier = Window.partitionBy("tree", "parent").orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
        listed = current.withColumn("parent", parent).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        levels.append(stored(listed, "directory"))
        shift += RADIX
        if WORD_BITS + shift >= 64:  # one parent for the negative ids, one for the others
            break
        current = levels[-1].groupBy("tree", F.col("parent").alias("entry")).agg(F.sum("n").alias("n"))
        if not _several(current):
            break
    # the last level's parents: at most two a tree
    top = levels[-1].groupBy("tree", F.col("parent").alias("up")).agg(F.sum("n").alias("n"))
    order = Window.partitionBy("tree").orderBy("up").rowsBetween(Window.unboundedPreceding, -1)
    above = top.select("tree", "up", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    for level in reversed(levels):
        above = above.withColumnRenamed("tree", "above_tree")
        here = level.join(above, F.col("tree").eqNullSafe(F.col("above_tree")) & (F.col("parent") == F.col("up")))
        above = here.select("tree", F.col("entry").alias("up"), (F.col("before") + F.col("base")).alias("base"))
    starts = above.select(F.col("tree").alias("start_tree"), F.col("up").alias("start_word"), F.col("base").alias("before"))
    out = words.join(starts, F.col("tree").eqNullSafe(F.col("start_tree")) & (F.col("word") == F.col("start_word")))
    return out.select("tree", "word", "bits", "before", (F.col("n") > F.bit_count("bits")).alias("repeats"))


def _several(entries: DataFrame) -> bool:
    """Whether any tree has more than two entries left."""
    return not entries.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).where("n > 2").isEmpty()


def ranked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` (tree, the ``keys`` as longs, others) with ``rank``: rows of the tree that are smaller in ``keys``; the last key is unique."""
    key, rest = keys[0], keys[1:]
    nulls = rows.where(F.col(key).isNull()).groupBy("tree").agg(F.count(F.lit(1)).alias("nulls"))
    nulls = nulls.select(F.col("tree").alias("null_tree"), "nulls")
    words = word_index(rows, key)
    words = words.select(F.col("tree").alias("word_tree"), "word", "bits", "before", "repeats")
    found = rows.join(
        words, F.col("tree").eqNullSafe(F.col("word_tree")) & (F.shiftright(F.col(key), WORD_BITS) == F.col("word")), "left"
    ).join(nulls, F.col("tree").eqNullSafe(F.col("null_tree")), "left")
    below = F.expr(f"bit_count(bits & ~shiftleft(-1L, cast({key} & {(1 << WORD_BITS) - 1} as int)))")
    base = F.coalesce(F.col("nulls"), F.lit(0)) + F.col("before") + below
    out = found.withColumn("rank", F.when(F.col(key).isNull(), F.lit(0).cast("long")).otherwise(base.cast("long")))
    out = out.withColumn("tied", F.col(key).isNull() | F.col("repeats")).select(*rows.columns, "rank", "tied")
    if not rest:
        return out.drop("tied")
    out = stored(out, "ranked")
    tied = out.where("tied")
    if tied.isEmpty():
        return out.drop("tied")
    # in a word that holds repeated ids, set bits do not count rows: add the further rows of its smaller ids
    outer, start = f"outer{len(keys)}", f"start{len(keys)}"
    word = F.struct("tree", F.shiftright(F.col(key), WORD_BITS).alias("word"))
    within = tied.select(word.alias("tree"), F.col("tree").alias(outer), *[c for c in rows.columns if c != "tree"], F.col("rank").alias(start))
    lower = within.where(F.col(key).isNotNull()).groupBy("tree", F.col(key).alias("low")).agg((F.count(F.lit(1)) - 1).alias("more"))
    order = Window.partitionBy("tree").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)  # at most 64 ids a word
    lower = lower.select(F.col("tree").alias("low_tree"), "low", F.coalesce(F.sum("more").over(order), F.lit(0)).alias("more"))
    within = within.join(lower, F.col("tree").eqNullSafe(F.col("low_tree")) & (F.col(key) == F.col("low")), "left")
    within = within.withColumn(start, F.col(start) + F.coalesce("more", F.lit(0))).drop("low_tree", "low", "more")
    within = stored(within.withColumn("tree", F.struct(F.col(outer).alias("tree"), F.col(key).alias("id"))), "tied-rows")
    again = ranked(within, rest).withColumn("rank", F.col(start) + F.col("rank")).withColumn("tree", F.col(outer))
    return out.where("not tied").drop("tied").unionByName(again.select(*rows.columns, "rank"))


# --- trees ---------------------------------------------------------------------------------------------------------


def _joined(parts: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def levels_of(n: int) -> int:
    """Levels above ``n`` leaves: each halves them, rounded up, until one is left."""
    return max(n - 1, 0).bit_length()


def layers(nodes: list[bytes], count: int) -> list[list[bytes]]:
    """``nodes`` and the ``count`` levels above them."""
    out = [nodes]
    for _ in range(count):
        last = out[-1]
        out.append([_joined(last[i : i + 2]) for i in range(0, len(last), 2)])
    return out


def siblings(tower: list[list[bytes]], slot: int) -> list[bytes]:
    """The other digests of the runs above ``slot``, the lowest first."""
    out = []
    for layer in tower[:-1]:
        if slot ^ 1 < len(layer):
            out.append(layer[slot ^ 1])
        slot >>= 1
    return out


def folded(node: bytes, place: int, size: int, path: Sequence[bytes]) -> bytes:
    """The top of a tree of ``size`` leaves, from the leaf at ``place`` and the digests of its path."""
    rest = iter(path)
    while size > 1:
        other = place ^ 1
        node = _joined([node]) if other >= size else _joined([node, next(rest)] if place % 2 == 0 else [next(rest), node])
        place >>= 1
        size = (size + 1) // 2
    return node


_SLOT = "array<struct<slot:int,node:binary,data:binary>>"


def _arrays(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Stored slot arrays (tree, part, left, slots): ``left`` is the levels above the slots up to the tree's top."""
    sizes = sizes.select(F.col("tree").alias("size_tree"), "left")
    slot = F.struct((F.col("rank") % SLOTS).cast("int").alias("slot"), "node", "data")
    arrays = nodes.groupBy("tree", F.floor(F.col("rank") / SLOTS).cast("long").alias("part")).agg(F.collect_list(slot).alias("slots"))
    arrays = arrays.join(sizes, F.col("tree").eqNullSafe(F.col("size_tree"))).select("tree", "part", "left", "slots")
    return stored(arrays, "slot-arrays")


def _ordered(slots) -> tuple[np.ndarray, list[bytes], list]:
    """Slot numbers ascending, digests and data of one slot array."""
    fields = slots.values if isinstance(slots, pa.ListScalar) else slots
    number = fields.field("slot").to_numpy()
    order = np.argsort(number)
    node, data = fields.field("node"), fields.field("data")
    return number[order], node.take(pa.array(order)).to_pylist(), data.take(pa.array(order)).to_pylist()


def _tops(batches):
    """(tree, part, node, left) of slot arrays: what ``LEVELS`` levels, or as many as are left, reduce them to."""
    for batch in batches:
        left = batch.column(2).to_pylist()
        tops = []
        for up, slots in zip(left, batch.column(3)):
            _, nodes, _ = _ordered(slots)
            tops.append(layers(nodes, min(up, LEVELS))[-1][0])
        after = pa.array([max(up - LEVELS, 0) for up in left], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tops, pa.binary()), after], names=["tree", "part", "node", "left"])


def climb(nodes: DataFrame, sizes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of every round and (tree, node) of the tops; ``nodes`` (tree, rank, node, data), ``sizes`` (tree, n)."""
    levels = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0).cast("int")
    left = sizes.select("tree", levels.alias("left"))
    highest = left.agg(F.max("left")).first()[0] or 0
    rounds = []
    while True:
        arrays = _arrays(nodes, left)
        rounds.append(arrays)
        kind = arrays.schema["tree"]
        schema = T.StructType([kind]).add("part", "long").add("node", "binary").add("left", "integer")
        tops = stored(map_arrow(arrays, _tops, schema), "tops")
        highest -= LEVELS
        if highest <= 0:
            return rounds, tops.select("tree", "node")
        nodes = tops.select("tree", F.col("part").alias("rank"), "node", F.lit(None).cast("binary").alias("data"))
        left = tops.select("tree", "left").distinct()


def _paths(batches):
    """(tree, part of the round below, path) of every slot."""
    for batch in batches:
        left, part, above = batch.column(2).to_pylist(), batch.column(1).to_pylist(), batch.column(4).to_pylist()
        row, place, path = [], [], []
        for i, slots in enumerate(batch.column(3)):
            _, nodes, _ = _ordered(slots)
            tower = layers(nodes, min(left[i], LEVELS))
            for slot in range(len(nodes)):
                row.append(i)
                place.append(part[i] * SLOTS + slot)
                path.append(b"".join(siblings(tower, slot)) + above[i])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(place, pa.int64()), pa.array(path, pa.binary())], names=["tree", "place", "path"])


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Slot arrays of the first round (tree, part, left, slots, path); ``tops`` (tree, path) is what lies above each tree."""
    above = tops.select("tree", F.lit(0).cast("long").alias("place"), "path")
    for i, arrays in enumerate(reversed(rounds)):
        above = above.select(F.col("tree").alias("above_tree"), "place", "path")
        # one row a slot array on each side
        arrays = arrays.join(above, F.col("tree").eqNullSafe(F.col("above_tree")) & (F.col("part") == F.col("place")))
        arrays = arrays.select("tree", "part", "left", "slots", "path")
        if i + 1 == len(rounds):
            return arrays
        above = map_arrow(arrays, _paths, T.StructType([arrays.schema["tree"]]).add("place", "long").add("path", "binary"))


def manifest(docs: DataFrame, group: str = "lang", id_column: str = "doc_id", fields: Sequence[str] = FIELDS, change: dict[str, Column] | None = None) -> DataFrame:
    """(tree, id, rank, size, groups, group_rank, leaf, changed, subroot, root, path) of every row.

    ``path`` are the siblings' digests, 32 bytes each, up to the root.  ``changed``
    is the leaf of the row with the columns of ``change`` in place of its own, null where they are equal.
    """
    change = change or {}
    other = leaf([change.get(f, F.col(f)) for f in fields])
    base = docs.select(F.col(group).cast("string").alias("tree"), F.col(id_column).cast("long").alias("id"), leaf([F.col(f) for f in fields]).alias("node"), other.alias("other"))
    base = base.withColumn("data", F.when(F.col("other") != F.col("node"), F.col("other"))).drop("other")
    # the digest's first 64 bits, shifted so that they ascend as a long
    first = F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    rows = stored(base.withColumns({"head": first, "row": F.monotonically_increasing_id()}), "leaves")
    places = ranked(rows.select("tree", "id", "head", "row", "node", "data"), ["id", "head", "row"])
    # a slot's data: presence of id and changed leaf, then their bytes
    packed = F.concat(
        F.when(F.col("id").isNull(), F.unhex(F.lit("00"))).otherwise(F.concat(F.unhex(F.lit("01")), F.unhex(F.lpad(F.hex("id"), 16, "0")))), F.coalesce("data", F.unhex(F.lit("")))
    )
    places = places.select("tree", "rank", "node", packed.alias("data"))
    sizes = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    rounds, tops = climb(places, sizes)
    # the tree of the groups' roots: one row a group
    order = (F.row_number().over(Window.orderBy(F.col("tree").asc_nulls_first())) - 1).cast("long")
    groups = stored(tops.join(sizes.select(F.col("tree").alias("size_tree"), "n"), F.col("tree").eqNullSafe(F.col("size_tree"))).select("tree", "node", "n", order.alias("group_rank")), "groups")
    one, nothing = F.lit("").alias("tree"), F.unhex(F.lit(""))
    count = groups.count()
    slots = groups.select(one, F.col("group_rank").alias("rank"), "node", nothing.alias("data"))
    high, top = climb(slots, slots.groupBy("tree").agg(F.count(F.lit(1)).alias("n")))
    root = top.first()  # one digest
    upper = descend(high, top.select("tree", nothing.alias("path")))
    upper = map_arrow(upper, _paths, T.StructType().add("tree", "string").add("place", "long").add("path", "binary"))
    roots = groups.join(upper.select(F.col("place").alias("group_rank"), "path"), "group_rank")
    roots = stored(roots.withColumns({"root": F.lit(root and bytearray(root["node"])).cast("binary"), "groups": F.lit(count).cast("long")}), "roots")
    arrays = descend(rounds, roots.select("tree", "path"))
    info = roots.select(F.col("tree").alias("root_tree"), F.col("node").alias("subroot"), F.col("n").alias("size"), "group_rank", "groups", "root")
    arrays = arrays.join(info, F.col("tree").eqNullSafe(F.col("root_tree"))).drop("root_tree")
    schema = T.StructType().add("tree", "string").add("id", "long").add("rank", "long").add("size", "long").add("groups", "long").add("group_rank", "long")
    schema = schema.add("leaf", "binary").add("changed", "binary").add("subroot", "binary").add("root", "binary").add("path", "binary")

    def run(batches):
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            for i, slots in enumerate(batch.column(at["slots"])):
                _, nodes, data = _ordered(slots)
                value = {name: batch.column(at[name])[i].as_py() for name in ("tree", "part", "left", "path", "subroot", "size", "group_rank", "groups", "root")}
                tower = layers(nodes, min(value["left"], LEVELS))
                paths = [b"".join(siblings(tower, slot)) + value["path"] for slot in range(len(nodes))]
                ids = [int.from_bytes(d[1:9], "big", signed=True) if d[0] else None for d in data]
                changed = [(d[9:] if d[0] else d[1:]) or None for d in data]
                n = len(nodes)
                first_rank = value["part"] * SLOTS
                same = lambda name, kind: pa.array([value[name]] * n, kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        same("tree", pa.string()), pa.array(ids, pa.int64()), pa.array(np.arange(first_rank, first_rank + n)), same("size", pa.int64()), same("groups", pa.int64()), same("group_rank", pa.int64()),
                        pa.array(nodes, pa.binary()), pa.array(changed, pa.binary()), same("subroot", pa.binary()), same("root", pa.binary()), pa.array(paths, pa.binary()),
                    ],
                    names=schema.names,
                )

    return map_arrow(arrays, run, schema)


def verified(rows: DataFrame, node: str = "leaf") -> DataFrame:
    """``rows`` of a manifest with ``folded`` (the root that ``node`` and the path lead to) and ``proof`` (digest of the path), as bytes."""
    schema = T.StructType([*rows.schema.fields, T.StructField("folded", T.BinaryType()), T.StructField("proof", T.BinaryType())])
    names = rows.columns

    def run(batches):
        tops: dict[tuple, bytes] = {}  # subtrees that many rows share are folded once
        for batch in batches:
            column = {name: batch.column(names.index(name)).to_pylist() for name in ("rank", "size", "groups", "group_rank", "path", node)}
            fold, proof = [], []
            for rank, size, groups, place, path, start in zip(*(column[c] for c in ("rank", "size", "groups", "group_rank", "path", node))):
                digests = [path[i : i + 32] for i in range(0, len(path), 32)]
                proof.append(_joined(digests))
                own, used = start, 0
                at, left = rank, size
                for _ in range(LEVELS):
                    if left <= 1:
                        break
                    if at ^ 1 >= left:
                        own = _joined([own])
                    else:
                        own = _joined([own, digests[used]] if at % 2 == 0 else [digests[used], own])
                        used += 1
                    at, left = at >> 1, (left + 1) // 2
                key = (own, at, left, place, groups, path[32 * used :])
                end = tops.get(key)
                if end is None:
                    if len(tops) > 100_000:
                        tops.clear()
                    lower = _path_length(at, left)
                    subroot = folded(own, at, left, digests[used : used + lower])
                    end = tops[key] = folded(subroot, place, groups, digests[used + lower :])
                fold.append(end)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fold, pa.binary()), pa.array(proof, pa.binary())], names=schema.names)

    return map_arrow(rows, run, schema)


def _path_length(place: int, size: int) -> int:
    n = 0
    while size > 1:
        n += place ^ 1 < size
        place, size = place >> 1, (size + 1) // 2
    return n


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest(docs, change={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    rows = verified(rows.withColumn("given", F.coalesce("changed", "leaf")), "given")
    text = lambda name: F.lower(F.hex(name))
    return rows.select(
        F.col("id").alias("doc_id"), text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        text("proof").alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def oracle() -> str:
    """The same result in DuckDB SQL: levels by recursion on sorted rows."""
    field = lambda f: f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR) END"
    digest = lambda fields: "sha256(" + " || ".join(field(f) for f in fields) + ")"
    changed = [f"CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END" if f == "n_chars" else f for f in FIELDS]
    return f"""
WITH RECURSIVE {crc32_tables()},
leaves AS (SELECT doc_id, lang, {digest(FIELDS)} AS leaf, {digest(changed)} AS given FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY lang) AS size FROM leaves),
nodes AS (
  SELECT lang, 0 AS lvl, p AS i, leaf AS node, size AS n FROM placed
  UNION ALL
  SELECT lang, lvl + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, lvl, i // 2, n
),
subroots AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS size FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS lvl, p AS i, subroot AS node, size AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM upper_nodes WHERE n > 1 GROUP BY lvl, i // 2, n
),
walk AS (
  SELECT doc_id, lang, p, 0 AS lvl, p AS i, size AS n, given AS node, '' AS proof FROM placed
  UNION ALL
  SELECT w.doc_id, w.lang, w.p, w.lvl + 1, w.i // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.node IS NULL THEN w.node WHEN w.i % 2 = 0 THEN w.node || s.node ELSE s.node || w.node END), w.proof || coalesce(s.node, '')
  FROM walk w LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.lvl = w.lvl AND s.i = xor(w.i, 1) WHERE w.n > 1
),
upper_walk AS (
  SELECT w.doc_id, w.lang, w.p, 0 AS lvl, r.p AS i, r.size AS n, w.node, w.proof FROM walk w JOIN subroots r ON r.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT w.doc_id, w.lang, w.p, w.lvl + 1, w.i // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.node IS NULL THEN w.node WHEN w.i % 2 = 0 THEN w.node || s.node ELSE s.node || w.node END), w.proof || coalesce(s.node, '')
  FROM upper_walk w LEFT JOIN upper_nodes s ON s.lvl = w.lvl AND s.i = xor(w.i, 1) WHERE w.n > 1
)
SELECT d.doc_id, d.leaf, r.subroot, t.node AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root, w.node = t.node AS verified
FROM placed d
JOIN upper_walk w ON w.n = 1 AND w.lang IS NOT DISTINCT FROM d.lang AND w.p = d.p
JOIN subroots r ON r.lang IS NOT DISTINCT FROM d.lang
JOIN upper_nodes t ON t.n = 1
"""
