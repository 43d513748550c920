"""Near-duplicate classes by DartMinHash signatures and banded joining.

A text is the weighted set of its runs of five words (a text of fewer words is
one run), the weight of a run being how often it occurs.  The weight axis of a
run is cut into unit cells.  Every cell gets hashed darts, a Poisson(1) number
for each unit of rank, each with a rank and a coordinate; the signature keeps
the earliest dart of every coordinate.  Two texts agree in a coordinate with
probability equal to their weighted Jaccard similarity, and only cells of the
text are ever looked at.  Ranks are thrown unit by unit until no coordinate is empty.

Bands of signature coordinates give candidate buckets, and every two texts that share a
bucket end in one component or are compared by their exact weighted Jaccard similarity (0.8 or more):

1. Leaders.  In each bucket a leader is paired with the members of other components, the members
   with most bucket mates leading first.  Buckets that still hold several components are led again,
   by the best member outside their main component (``PASSES`` passes); this is linear in a bucket's size.
2. Buckets of at most ``SMALL`` texts have all pairs across components verified.
3. Larger buckets that still hold several components have all pairs across them counted in tiles
   of at most about ``TILE`` texts or ``TILE_BYTES`` bytes a side, so no task holds a whole
   bucket; tiles of the main component alone are left out.

Equal texts are one node, so copies never meet in a bucket (a text is known by
its 64-bit hash).  Null counts as the empty text.  Texts without words are only
near to equal texts.  Repeated rows get the same class each; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import RollingHash, map_arrow, mix, steps, stored, table, word_spans
from ledgerline.llm.components import connected_components
from ledgerline.session import ship_package

WORDS = 5
SIMILARITY = 0.8
#: 25 bands of 5 coordinates miss a pair of similarity 0.8 with probability 5e-5.
BANDS, ROWS = 25, 5
#: Passes of leaders over the buckets, and the size up to which a bucket's pairs are all verified.
PASSES, SMALL = 3, 10
#: Texts and bytes of one side of a tile of a larger bucket, and cells counted in one matrix product.
TILE, TILE_BYTES, COLUMNS = 1_000, 8 << 20, 2_048

_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, n + 1), dtype=float) for n in range(16)])


def cells(data: np.ndarray, offsets: np.ndarray, n_words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells (run of words, how-manieth occurrence) as hashes, and the row of each, rows ascending."""
    starts, ends, row = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = RollingHash(data).of(starts, ends)
    n_rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(n_rows + 1))
    size = np.diff(first)
    run = np.zeros(len(word), np.uint64)
    full = np.zeros(len(word), bool)
    if len(word) >= n_words:
        run_at = len(word) - n_words + 1
        value = word[:run_at].copy()
        for j in range(1, n_words):
            value = mix(value) + word[j : j + run_at]
        run[:run_at] = mix(value)
        full[:run_at] = row[:run_at] == row[n_words - 1 :]
    for i in np.flatnonzero((size > 0) & (size < n_words)):  # a short text is one run
        value = word[first[i] : first[i] + 1]
        for j in range(first[i] + 1, first[i + 1]):
            value = mix(value) + word[j : j + 1]
        run[first[i]] = mix(value ^ np.uint64(size[i]))[0]
        full[first[i]] = True
    run, row = run[full], row[full]
    key = run ^ mix(row.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    place = np.arange(len(order))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = place - np.maximum.accumulate(np.where(head, place, 0))
    return mix(run + occurrence * np.uint64(0xA24BAED4963EE407)), row


def signatures(cell: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x size) earliest dart of every coordinate, and which rows have any cell."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n_rows * size, none, dtype=np.uint64)
    has = np.zeros(n_rows, bool)
    has[row] = True
    unit, width = 0, 1
    while len(cell):
        # darts of ranks unit .. unit + width
        ranks = np.arange(unit, unit + width, dtype=np.uint64)
        region = mix((cell[:, None] + ranks[None, :] * np.uint64(0x9FB21C651E98DF25)).ravel())
        number = np.searchsorted(_POISSON, (region >> np.uint64(11)).astype(np.float64) * 2.0**-53, side="right")
        dart = np.repeat(region, number)
        serial = np.arange(len(dart)) - np.repeat(np.cumsum(number) - number, number)
        dart = mix(dart ^ ((serial.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)))
        at = np.repeat(np.repeat(row, width), number) * size + ((dart & np.uint64(0xFFFFFFFF)) % np.uint64(size)).astype(np.int64)
        # earlier units come first; within the block, the rank is the unit and then the dart's own high bits
        rank = np.repeat(np.tile(ranks - np.uint64(unit), len(cell)), number)
        value = (rank << np.uint64(56)) | (dart >> np.uint64(8))
        block = np.full(len(out), none, dtype=np.uint64)
        np.minimum.at(block, at, value)
        empty = out == none
        found = empty & (block != none)
        out[found] = mix(block[found] + np.uint64(unit))
        open_ = (out == none).reshape(n_rows, size).any(axis=1) & has
        still = open_[row]
        cell, row = cell[still], row[still]
        unit += width
        width = 1 if unit < 2 else min(unit, 64)
    return out.reshape(n_rows, size), has


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(rows):
        key = mix(key) + parts[:, :, j]
    return mix(key)


def texts(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(doc_id, node, text): ``node`` stands for the whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(body).alias("node"), body.alias("text"))


def buckets(nodes: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, node): each text once in the bucket of every band; ``nodes`` has (node, text)."""

    def run(batches):
        for part, data, offsets in steps(batches, 1):
            n = len(offsets) - 1
            signature, has = signatures(*cells(data, offsets), n, bands * rows)
            keys = band_keys(signature, bands, rows).view(np.int64)[has]
            node = part.column(0).to_numpy(zero_copy_only=False)[has]
            ends = pa.array(np.arange(len(node) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], names=["node", "keys"])

    found = map_arrow(nodes.select("node", "text"), run, "node long, keys array<long>")
    once = found.groupBy("node").agg(F.first("keys").alias("keys"))  # copies have the same keys
    return once.select(F.explode("keys").alias("key"), "node")


def verified(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity is ``similarity`` or more."""

    def run(batches):
        held: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint64))
        known = False
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = batch.column(2), batch.column(3)
            keep = []
            for i in range(len(a)):
                if not known or held[0] != a[i]:
                    held, known = (a[i], _cells_of(left[i].as_buffer())), True
                other = _cells_of(right[i].as_buffer())
                common = len(np.intersect1d(held[1], other, assume_unique=True))
                if common >= similarity * (len(held[1]) + len(other) - common) and common:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    one = nodes.select("node", "text")
    rows = pairs.hint("merge").join(one.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    rows = rows.hint("merge").join(one.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").select("a", "b", "left", "right")
    return map_arrow(rows, run, "a long, b long")


def _cells_of(buffer: pa.Buffer) -> np.ndarray:
    data = np.frombuffer(buffer, np.uint8)
    return cells(data, np.array([0, len(data)]))[0]


def classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    passes: int = PASSES,
    small: int = SMALL,
    tile: int = TILE,
) -> DataFrame:
    """(node, component) of every text that is near to a different one."""
    nodes = texts(docs, id_column, text)
    every = stored(buckets(nodes, bands, rows), "buckets")
    sizes = every.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    member = every.join(sizes, "key")
    # texts that meet many others lead: in a group of copies this is the original rather than a chance copy
    reach = member.groupBy("node").agg(F.sum("size").alias("reach"))
    member = stored(member.join(reach, "node"), "members")
    # one text of each node that shares a bucket; copies are dropped before the shuffle, and the plan is the same at every size
    near = member.select("node").distinct()
    once = stored(nodes.groupBy("node").agg(F.first("text").alias("text")).hint("merge").join(near, "node"), "near-texts")

    own = member.withColumn("component", F.col("node"))
    tested = links = found = None
    for turn in range(passes):
        pairs = _led(own) if turn != 1 else _led(own).unionByName(_across(own, small)).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if turn and pairs.isEmpty():
            break
        fresh = stored(verified(pairs, once, similarity), "links")
        links = fresh if links is None else links.unionByName(fresh)
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stored(connected_components(links), "components")
        own = member.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # components only grow, so after this no two texts of a bucket are apart and untested
    rest = stored(_tiled(own, once, small, tile, similarity), "links")
    return found if rest.isEmpty() else stored(connected_components(links.unionByName(rest)), "components")


def _led(own: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of each bucket's leader and its members of other components.

    The leader is the member with the greatest reach outside the bucket's most
    frequent component (at first, when every text is a component, outside none).
    """
    per = own.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("reach", "node")).alias("lead"))
    best = F.max(F.struct("n", "component")).alias("main")
    main = per.groupBy("key").agg(best, F.count(F.lit(1)).alias("parts")).where("parts > 1")
    outside = per.join(main, "key").where((F.col("component") != F.col("main.component")) | (F.col("main.n") == 1))
    lead = outside.groupBy("key").agg(F.max(F.struct("lead", "component")).alias("x"))
    lead = lead.select("key", F.col("x.lead.node").alias("leader"), F.col("x.component").alias("led"))
    pairs = own.join(lead, "key").where("component <> led")
    return pairs.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()


def _across(own: DataFrame, small: int) -> DataFrame:
    """All pairs of different components in the buckets of at most ``small`` texts."""
    few = own.where(F.col("size") <= small).select("key", "node", "component")
    other = few.select("key", F.col("node").alias("x"), F.col("component").alias("cx"))
    return few.join(other, "key").where("node < x and component <> cx").select(F.col("node").alias("a"), F.col("x").alias("b")).distinct()


def _tiled(own: DataFrame, nodes: DataFrame, small: int, tile: int, similarity: float) -> DataFrame:
    """Links (a, b) between different components in the buckets of more than ``small`` texts, all pairs counted."""
    large = own.where(F.col("size") > small).select("key", "node", "component")
    per = large.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = per.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    mixed = large.join(main.select("key", F.col("main.component").alias("main")), "key")
    mixed = mixed.select("key", "node", "component", (F.col("component") != F.col("main")).alias("outside"))
    mixed = stored(mixed.join(nodes.select("node", F.octet_length("text").alias("bytes")), "node"), "mixed-members")
    total = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    total = total.select("key", F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("bytes") / TILE_BYTES)).cast("int").alias("sides"))
    side = mixed.join(total, "key").withColumn("side", F.pmod(F.xxhash64("node", "key"), F.col("sides")).cast("int"))
    # each member meets every side of its bucket; sides without a text outside the main component do not meet each other
    mate = side.groupBy("key", "side").agg(F.max("outside").alias("any")).select("key", F.col("side").alias("mate"), "any")
    held = side.groupBy("key", "side").agg(F.max("outside").alias("own"))
    met = held.join(mate, "key").where("own or any").select("key", "side", "mate")
    rows = side.join(met, ["key", "side"]).select(
        "key", F.least("side", "mate").alias("i"), F.greatest("side", "mate").alias("j"), "side", "node", "component", "outside"
    )
    rows = rows.hint("merge").join(nodes.select("node", "text"), "node")

    def count(group: pa.Table) -> pa.Table:
        node, component, outside, side = (group.column(c).to_numpy() for c in ("node", "component", "outside", "side"))
        parts = [_cells_of(x.as_buffer()) for chunk in group.column("text").chunks for x in chunk]
        a, b = tile_links(parts, component, outside, side, similarity)
        return pa.table({"a": pa.array(np.minimum(node[a], node[b])), "b": pa.array(np.maximum(node[a], node[b]))})

    ship_package(own.sparkSession)
    return rows.groupBy("key", "i", "j").applyInArrow(count, "a long, b long").distinct()


def tile_links(parts: list, component: np.ndarray, outside: np.ndarray, side: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places) of near texts of different components, one of them outside the main one; ``parts`` are their cells.

    With two sides only pairs of different sides count: pairs within a side have a tile of their own.
    """
    size = np.array([len(p) for p in parts], dtype=np.int64)
    left = np.flatnonzero(outside)
    common = np.zeros((len(left), len(parts)), np.float64)
    row = np.repeat(np.arange(len(parts)), size)
    _, cell, often = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = often[cell] > 1
    row, cell = row[shared], cell[shared]
    kinds, cell = np.unique(cell, return_inverse=True)
    order = np.argsort(cell, kind="stable")
    row, cell = row[order], cell[order]
    often = often[kinds]
    first = np.concatenate([[0], np.cumsum(often)])
    at = np.full(len(parts), -1)
    at[left] = np.arange(len(left))
    rare = often <= 16
    for n in np.unique(often[rare]):  # cells of few texts: their pairs one by one
        texts_of = row[first[:-1][often == n][:, None] + np.arange(n)]
        for x in range(n):
            ours = at[texts_of[:, x]]
            hit = ours >= 0
            for y in range(n):
                if x != y:
                    np.add.at(common, (ours[hit], texts_of[hit, y]), 1)
    wide = np.flatnonzero(~rare)
    for low in range(0, len(wide), COLUMNS):  # cells of many texts: products of 0-1 matrices
        own = wide[low : low + COLUMNS]
        number = np.repeat(np.arange(len(own)), often[own])
        held = row[np.repeat(first[own], often[own]) + np.arange(len(number)) - np.repeat(np.cumsum(often[own]) - often[own], often[own])]
        sheet = np.zeros((len(parts), len(own)), np.float32)
        sheet[held, number] = 1.0
        common += sheet[left] @ sheet.T
    near = (common >= similarity * (size[left][:, None] + size[None, :] - common)) & (common > 0)
    near &= component[left][:, None] != component[None, :]
    if len(np.unique(side)) > 1:
        near &= side[left][:, None] != side[None, :]
    x, y = np.nonzero(near)
    return left[x], y


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: doc_id, class_id (smallest doc_id of the class), class_size (rows) and kept.

    ``kept`` marks the row that stays; of repeated rows with the smallest id, all are marked.
    """
    nodes = texts(docs, id_column, text).drop("text")
    found = classes(docs, id_column, text, **options)
    label = nodes.join(found, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    groups = label.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return label.join(groups, "component").select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every class one row with the smallest id stays."""
    columns = docs.columns
    found = classes(docs, id_column, text, **options)
    node = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    # which nodes go is settled on ids alone; texts are shuffled once, by node, copies already dropped
    first = docs.select(node.alias("node"), F.col(id_column).alias("id")).groupBy("node").agg(F.min("id").alias("id"))
    known = first.join(found, "node")
    best = known.groupBy("component").agg(F.min_by("node", F.struct(F.col("id").isNull(), F.col("id"), F.col("node"))).alias("best"))
    gone = found.join(best, "component").where("node <> best").select("node")
    row = F.struct(*columns)
    one = docs.groupBy(node.alias("node")).agg(F.min_by(row, F.struct(F.col(id_column).isNull(), F.col(id_column))).alias("row"))
    return one.join(gone, "node", "left_anti").select(*[F.col("row")[c].alias(c) for c in columns])


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
