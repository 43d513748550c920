"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Texts and benchmark items are compared in a normal form: lower case, every run
of white space one blank.  An item leaks into a document when some stretch of
the document is within ``floor(share * length)`` edits (bytes inserted, deleted
or replaced) of the whole item.

1. Windows.  An item that may take e edits is cut into e + 2 equal pieces, of
   which two at least survive any e edits, at places that fit to within e
   bytes.  A window of the item's length is set wherever a piece is found and
   another piece of the item supports the same place.  This loses nothing.
2. Each window and its item are embedded by CGK random walks: at step t the
   embedding repeats the current byte, and a random bit for (t, byte) decides
   whether the walk moves on.  Few edits become a small Hamming distance.
3. Each of ``REPEATS`` walks samples ``SAMPLED`` positions of the embedding as an
   LSH key; a window goes on if its key equals the item's in any of them.
4. The exact semi-global edit distance decides.

Items are taken in blocks of about ``BLOCK`` items; only a block is ever sent to the
tasks.  Items of fewer than ``MIN_BYTES`` bytes in normal form are no evidence and
never leak; null texts count as empty.  Rows are judged one by one: repeated
rows repeat their result, an empty table (of either kind) gives no leaks.  Other columns of the
documents pass through ``keep_clean`` and are not looked at by ``leaks``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import SPACE, RollingHash, lowered, map_arrow, steps, table

SHARE = 0.1
MIN_BYTES = 16
BLOCK = 10_000
#: Walks, and bytes sampled from each: measured recall at 10 % edits is above 0.99 (see the tests).
REPEATS, SAMPLED = 24, 3
CHUNK = 1024


def normal_form(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case and single blanks, text by text."""
    low = lowered(data)
    blank = SPACE[low]
    low[blank] = 0x20
    keep = np.ones(len(low), bool)
    if len(low):
        keep[1:] = ~(blank[1:] & blank[:-1])
        keep[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    places = np.concatenate([[0], np.cumsum(keep)])
    return low[keep], places[offsets]


def edit_distance_within(item: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of ``item`` to any substring of ``text``, and where the first such substring ends.

    Bit-parallel dynamic programming, one column of the matrix an integer.
    """
    size = len(item)
    where: dict[int, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | (1 << i)
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, end = size, 0
    for j, c in enumerate(text):
        equal = where.get(c, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        plus = down | (~(diagonal | up) & full)
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = (plus << 1) & full
        minus = (minus << 1) & full
        up = minus | (~(diagonal | plus) & full)
        down = plus & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


@dataclass
class Items:
    """One block of benchmark items, with their pieces by length and their LSH keys."""

    ids: np.ndarray
    texts: list[bytes]
    share: float = SHARE
    seed: int = 20_240_601
    pieces: dict[int, tuple] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.edits = np.floor(self.share * self.sizes).astype(np.int64)
        found: dict[int, list] = {}
        for i, t in enumerate(self.texts):
            n = int(self.edits[i]) + 2
            size = len(t) // n
            for j in range(n):
                found.setdefault(size, []).append((t[j * size : (j + 1) * size], i, j * size))
        self.pieces = {}
        for size, own in found.items():
            raw = np.frombuffer(b"".join(p for p, _, _ in own), np.uint8)
            starts = np.arange(len(own)) * size
            hashes = RollingHash(raw).of(starts, starts + size)
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            gate = np.zeros(1 << 20, bool)
            gate[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.pieces[size] = (gate, hashes, np.array([i for _, i, _ in own])[order], np.array([at for _, _, at in own])[order])
        self.longest = int(self.sizes.max()) if len(self.sizes) else 0
        rng = np.random.default_rng(self.seed)
        self.moves = rng.integers(0, 2, size=(REPEATS, 256, 256), dtype=np.uint8)  # walks repeat their coins every 256 steps
        self.samples = 0.6 * rng.random((REPEATS, SAMPLED))  # a walk passes its text in about two thirds of the 3n steps
        flat = np.frombuffer(b"\0".join([*self.texts, b""]), np.uint8)
        ends = np.cumsum(self.sizes + 1) - 1
        self.keys = self.lsh_keys(flat, ends - self.sizes, ends, np.arange(len(self.texts)))

    def lsh_keys(self, pool: np.ndarray, starts: np.ndarray, ends: np.ndarray, item: np.ndarray) -> np.ndarray:
        """(walks x windows) sampled bytes of the CGK embeddings of ``pool[starts:ends]``; ``pool[ends]`` must be 0."""
        out = np.zeros((REPEATS, len(starts)), dtype=np.uint32)
        coins = self.moves.transpose(1, 0, 2).reshape(256, -1)  # for each step: (walk, byte)
        walk = (np.arange(REPEATS, dtype=np.int32) * 256)[:, None]
        order = np.argsort(self.sizes[item], kind="stable")
        for a in range(0, len(starts), CHUNK):
            part = order[a : a + CHUNK]
            size = self.sizes[item[part]]
            at = np.repeat(starts[part].astype(np.int32)[None, :], REPEATS, axis=0)
            end = ends[part].astype(np.int32)[None, :]
            seen = np.empty((3 * int(size.max()), REPEATS, len(part)), dtype=np.uint8)
            for t in range(len(seen)):
                c = pool[at]
                seen[t] = c
                at += coins[t & 255][walk + c]
                np.minimum(at, end, out=at)
            for k in range(SAMPLED):
                when = np.floor(self.samples[:, k : k + 1] * 3 * size[None, :]).astype(np.int64)
                out[:, part] = out[:, part] * np.uint32(256) + seen[when, np.arange(REPEATS)[:, None], np.arange(len(part))[None, :]]
        return out

    def windows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, item and start of every window that two pieces of the item support."""
        hashed = RollingHash(data)
        rows, items, starts = [], [], []
        for size, (gate, hashes, item, place) in self.pieces.items():
            if len(data) < size:
                continue
            n = len(data) - size + 1
            found = hashed.windows(size)
            found = found[:n]
            maybe = np.flatnonzero(gate[(found >> np.uint64(44)).astype(np.int64)])
            value = found[maybe]
            first = np.searchsorted(hashes, value, side="left")
            count = np.searchsorted(hashes, value, side="right") - first
            maybe, first, count = maybe[count > 0], first[count > 0], count[count > 0]
            row = np.searchsorted(offsets, maybe, side="right") - 1
            inside = maybe + size <= offsets[row + 1]
            maybe, first, count, row = maybe[inside], first[inside], count[inside], row[inside]
            at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            rows.append(np.repeat(row, count))
            items.append(item[at])
            starts.append(np.repeat(maybe, count) - place[at])
        if not rows:
            none = np.zeros(0, np.int64)
            return none, none, none
        row, item, start = np.concatenate(rows), np.concatenate(items), np.concatenate(starts)
        order = np.lexsort((start, item, row))
        row, item, start = row[order], item[order], start[order]
        near = (row[1:] == row[:-1]) & (item[1:] == item[:-1]) & (start[1:] - start[:-1] <= self.edits[item[1:]])
        supported = np.zeros(len(row), bool)
        supported[1:] |= near
        supported[:-1] |= near
        row, item, start = row[supported], item[supported], start[supported]
        once = np.ones(len(row), bool)
        once[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (start[1:] != start[:-1])
        return row[once], item[once], start[once]

    def find(self, parts: list[tuple[np.ndarray, np.ndarray]], lsh: bool = True) -> list[list[tuple[int, int, int, int, int]]]:
        """For each part (data, offsets): (row, item, distance, start, end) of its leaks, places in normal form.

        The best place of an item in a row counts.  The windows of all parts are embedded together.
        """
        found = []
        for number, (data, offsets) in enumerate(parts):
            data, offsets = normal_form(data, offsets)
            row, item, start = self.windows(data, offsets)
            low, high = offsets[row], offsets[row + 1]
            begin = np.minimum(np.maximum(start, low), high)
            end = np.maximum(np.minimum(start + self.sizes[item], high), begin)
            found.append((data, row, item, start, low, high, begin, end))
        if lsh and any(len(x[1]) for x in found):
            size = np.concatenate([x[7] - x[6] for x in found])
            ends = np.cumsum(size + 1) - 1
            pool = np.frombuffer(b"\0".join([*(x[0][b:e].tobytes() for x in found for b, e in zip(x[6].tolist(), x[7].tolist())), b""]), np.uint8)
            item = np.concatenate([x[2] for x in found])
            agree = (self.lsh_keys(pool, ends - size, ends, item) == self.keys[:, item]).any(axis=0)
            cuts = np.cumsum([len(x[1]) for x in found])[:-1]
            found = [(x[0], *(column[ok] for column in x[1:6])) for x, ok in zip(found, np.split(agree, cuts))]
        return [self._verified(*x[:6]) for x in found]

    def _verified(self, data, row, item, start, low, high) -> list[tuple[int, int, int, int, int]]:
        out: dict[tuple[int, int], tuple] = {}
        covered: dict[tuple[int, int], int] = {}
        for r, i, s, a, b in zip(row.tolist(), item.tolist(), start.tolist(), low.tolist(), high.tolist()):
            edits, size = int(self.edits[i]), int(self.sizes[i])
            if s < covered.get((r, i), -1):
                continue  # this place lies in the stretch of a leak that was found
            begin, end = max(a, s - edits), min(b, s + size + edits)
            distance, stop = edit_distance_within(self.texts[i], data[begin:end].tobytes())
            if distance <= edits:
                covered[r, i] = begin + stop
                old = out.get((r, i))
                if old is None or distance < old[0]:
                    out[r, i] = (distance, begin + stop - a)
        return [(r, i, d, max(e - int(self.sizes[i]), 0), e) for (r, i), (d, e) in sorted(out.items())]


def _together(batches, text_index: int, number: int = 12):
    """Steps in lists of up to ``number``, so that their windows are embedded at once."""
    held = []
    for step in steps(batches, text_index):
        held.append(step)
        if len(held) == number:
            yield held
            held = []
    if held:
        yield held


def item_blocks(benchmark: DataFrame, share: float = SHARE, block: int = BLOCK, id_column: str = "item_id", text: str = "text"):
    """Blocks of about ``block`` items each, as ``Items``; the driver holds one block at a time."""
    rows = benchmark.select(F.col(id_column).alias("id"), F.col(text).alias("text")).where("text is not null").distinct()
    n_blocks = max(1, -(-rows.count() // block))
    for i in range(n_blocks):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == i).collect()
        own = sorted((r["id"] is None, r["id"] or 0, r["text"]) for r in own)
        found = []
        for missing, ident, body in own:
            raw = np.frombuffer(body.encode(), np.uint8)
            normal = normal_form(raw, np.array([0, len(raw)]))[0].tobytes().strip()
            if len(normal) >= MIN_BYTES:
                found.append((None if missing else ident, normal))
        if found:
            yield Items(np.array([x for x, _ in found], dtype=object), [t for _, t in found], share)


def leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, distance, start, end): every item that leaks into a row of ``docs``, at its best place."""
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("item_id", T.LongType())]).add("distance", "long").add("start", "long").add("end", "long")
    out = None
    for items in item_blocks(benchmark, share, block):
        found = _search(source, items, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _search(source: DataFrame, items: Items, schema: T.StructType) -> DataFrame:
    shared = source.sparkSession.sparkContext.broadcast(items)  # one block

    def run(batches):
        own = shared.value
        for group in _together(batches, 1):
            for (rows, _, _), found in zip(group, own.find([(data, offsets) for _, data, offsets in group])):
                ids = rows.column(0).take(pa.array([x[0] for x in found], pa.int64()))
                columns = [pa.array([own.ids[x[1]] for x in found], pa.int64())] + [pa.array([x[k] for x in found], pa.int64()) for k in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "item_id", "distance", "start", "end"])

    return map_arrow(source, run, schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with their columns."""
    for items in item_blocks(benchmark, share, block):
        docs = _without(docs, items, text)
    return docs


def _without(docs: DataFrame, items: Items, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    index = docs.columns.index(text)

    def run(batches):
        for group in _together(batches, index):
            for (rows, _, _), found in zip(group, shared.value.find([(data, offsets) for _, data, offsets in group])):
                clean = np.ones(rows.num_rows, bool)
                clean[[x[0] for x in found]] = False
                yield rows.filter(pa.array(clean))

    return map_arrow(docs, run, docs.schema)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
