"""Removal of repeated byte strings by longest-previous-factor arrays, bucket by bucket.

A byte is removed when it lies in a string of ``length`` bytes that also starts
at another place of the corpus (``keep="none"``), or at an earlier place
(``keep="first"``; places are ordered by document id, then offset).  In terms of the
suffix array: position i goes when its longest previous factor, the longer of its
common prefixes with the previous and the next smaller position in suffix
order, reaches ``length``; for ``keep="none"`` a later position counts as well.

One suffix array of the corpus would have to be sorted as a whole.  Instead
positions are put into buckets that equal strings share:

1. Anchors.  Every string of ``length`` bytes picks the run of ``length // 4`` bytes in it
   with the smallest hash (the leftmost on ties).  Equal strings pick the same run, so
   they meet in the bucket of that run.  The bytes around an anchor that
   its strings can reach are its context.
2. Equal contexts.  All places of a context but its first are repeated entirely; each
   task and then one aggregation keep only the first.
3. Different contexts of one anchor.  The bucket's suffixes are sorted; the
   suffix order for positions one byte further left is induced from it by a stable sort on the
   byte before, for every offset of the anchor in a string.  Runs that agree in ``length`` bytes
   hold the previous and next smaller positions.  A bucket of more than
   ``WIDE`` contexts is not given to one task: there each string is counted by its
   128-bit hash with partial aggregation.

Null texts count as empty; texts shorter than ``length`` lose nothing.  Matches
never cross texts.  Rows with the same id and the same text are one document
for ``keep="first"`` and copies of each other for ``keep="none"``.  An empty table gives an empty
result; other columns pass through ``remove`` and are not looked at by ``spans``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import BASE, STEP_BYTES, UNBASE, _BYTE_VALUES, RollingHash, map_arrow, mix, powers, steps, stored, table

LENGTH = 200
#: Contexts that one task may sort as one bucket (about 0.5 KB each).
WIDE = 200_000
#: Contexts sorted at a time, anchors a task holds before it compares them, and text bytes of one vectorised step.
TOGETHER, HELD, STEP = 20_000, 200_000, 1 << 18

_NO_ID = -(1 << 63)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, low: int, high: int) -> tuple:
    """Place, row, context begin, context end, anchor hash and context hash for strings that start in ``low`` to ``high``."""
    k = length // 4
    span = length - k + 1
    hashed = RollingHash(data)
    grams = hashed.windows(k)
    n = len(grams)
    none = np.zeros(0, np.int64)
    if n < span:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    bits = np.uint64(n.bit_length())
    packed = (grams >> bits << bits) | np.arange(n, dtype=np.uint64)
    padded = np.append(packed, np.full((-n) % span, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)).reshape(-1, span)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - span + 1], ahead[span - 1 : n])
    start = np.arange(max(low, 0), min(high, n - span + 1))
    row = np.searchsorted(offsets, start, side="right") - 1
    ok = start + length <= offsets[row + 1]
    start, row = start[ok], row[ok]
    place = (least[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    fresh = np.ones(len(place), bool)
    fresh[1:] = place[1:] != place[:-1]
    place, row = place[fresh], row[fresh]
    begin = np.maximum(place - (length - k), offsets[row])
    end = np.minimum(place + length, offsets[row + 1])
    context = mix(hashed.of(begin, end) + (place - begin).astype(np.uint64) * np.uint64(0x9E6C63D0876A9A47))
    return place, row, begin, end, grams[place], context


def merged(doc: np.ndarray, salt: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping and touching spans of a document made one."""
    if not len(doc):
        return doc, salt, start, end
    order = np.lexsort((start, salt, doc))
    doc, salt, start, end = doc[order], salt[order], start[order], end[order]
    same = (doc[1:] == doc[:-1]) & (salt[1:] == salt[:-1])
    group = np.concatenate([[0], np.cumsum(~same)])
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * wide) - group * wide
    head = np.concatenate([[True], ~same | (start[1:] > reach[:-1])])
    at = np.flatnonzero(head)
    return doc[at], salt[at], start[at], np.maximum.reduceat(end, at)


_ANCHOR_SCHEMA = "ha long, hc long, doc long, salt long, pos long, begin long, end long, n long"


class Collector:
    """Anchors of one task; equal contexts leave as their first place, with the number of places, and spans of the others."""

    def __init__(self, length: int, keep: str):
        self.length, self.keep = length, keep
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, salt: np.ndarray) -> None:
        step = 4 * STEP_BYTES
        if len(data) <= step:
            self._keep(anchors(data, offsets, self.length, 0, len(data)), 0, offsets, doc, salt)
            return
        last = None
        for low in range(0, len(data), step):  # one long text (or a step that ends with one) piece by piece
            a, b = max(0, low - self.length), min(len(data), low + step + 2 * self.length)
            inner = np.clip(offsets, a, b) - a
            found = anchors(data[a:b], inner, self.length, low - a, low - a + step)
            if not len(found[0]):
                continue
            # the first string of a piece may pick the last anchor of the piece before; a place counts once
            first = (int(found[1][0]), int(found[0][0]) + a)
            ending = (int(found[1][-1]), int(found[0][-1]) + a)
            if first == last:
                found = tuple(x[1:] for x in found)
            last = ending
            self._keep(found, a, offsets, doc, salt)

    def _keep(self, found: tuple, shift: int, offsets: np.ndarray, doc: np.ndarray, salt: np.ndarray) -> None:
        place, row, begin, end, ha, hc = found
        base = offsets[row] - shift
        self.parts.append((ha.view(np.int64), hc.view(np.int64), doc[row], salt[row], place - base, begin - base, end - base))
        self.size += len(place)

    def flush(self):
        if not self.size:
            return
        ha, hc, doc, salt, pos, begin, end = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        order = np.lexsort((pos, salt, doc, hc))
        ha, hc, doc, salt, pos, begin, end = (x[order] for x in (ha, hc, doc, salt, pos, begin, end))
        if self.keep == "first":  # repeated rows are one place
            fresh = np.ones(len(hc), bool)
            fresh[1:] = (hc[1:] != hc[:-1]) | (doc[1:] != doc[:-1]) | (salt[1:] != salt[:-1]) | (pos[1:] != pos[:-1])
            ha, hc, doc, salt, pos, begin, end = (x[fresh] for x in (ha, hc, doc, salt, pos, begin, end))
        head = np.ones(len(hc), bool)
        head[1:] = hc[1:] != hc[:-1]
        first = np.flatnonzero(head)
        n = np.diff(np.append(first, len(hc)))
        gone = ~head
        if self.keep == "none":
            gone |= np.repeat(n > 1, n)
        yield self._batch(ha[first], hc[first], doc[first], salt[first], pos[first], begin[first], end[first], n)
        d, s, a, b = merged(doc[gone], salt[gone], begin[gone], end[gone])
        if len(d):
            zero = np.zeros(len(d), np.int64)
            yield self._batch(zero, zero, d, s, zero, a, b, zero)

    @staticmethod
    def _batch(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["ha", "hc", "doc", "salt", "pos", "begin", "end", "n"])


def keyed(docs: DataFrame, id_column: str, text: str) -> list[Column]:
    """Columns that name a document: its id and a check sum of its text."""
    return [
        F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("salt"),
    ]


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Context bytes of the ``wanted`` anchors (doc, salt, list); those of wide buckets as hashed strings instead."""

    def run(batches):
        for batch in batches:
            texts, lists = batch.column(2), batch.column(3)
            out: list[tuple] = []
            strings: list[tuple] = []
            for i in range(batch.num_rows):
                raw = texts[i].as_buffer()
                doc, salt = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                hashed = None
                for x in lists[i].as_py():
                    if not x["wide"]:
                        out.append((x["ha"], doc, salt, x["pos"], x["pos"] - x["begin"], x["n"], raw[x["begin"] : x["end"]].to_pybytes()))
                        continue
                    if hashed is None:
                        data = np.frombuffer(raw, np.uint8)
                        hashed = RollingHash(data), RollingHash(data[::-1])
                    start = np.arange(x["begin"], x["end"] - length + 1)
                    other = len(data) - start
                    strings.append((hashed[0].of(start, start + length), hashed[1].of(other - length, other), start, doc, salt, x["n"]))
            yield _context_batch(out)
            if strings:
                sizes = [len(s[0]) for s in strings]
                first = [np.concatenate([s[k] for s in strings]) for k in range(3)]
                rest = [np.repeat(np.array([s[k] for s in strings], dtype=np.int64), sizes) for k in (3, 4, 5)]
                yield _string_batch(first, rest)

    one = docs.join(wanted, ["doc", "salt"]).select("doc", "salt", "body", "list")
    return map_arrow(one, run, "ha long, doc long, salt long, pos long, before long, n long, context binary, other long")


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["ha", "doc", "salt", "pos", "before", "n", "context", "other"]
    columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(6)] + [pa.array([r[6] for r in rows], pa.binary()), pa.nulls(len(rows), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _string_batch(first: list[np.ndarray], rest: list[np.ndarray]) -> pa.RecordBatch:
    names = ["ha", "doc", "salt", "pos", "before", "n", "context", "other"]
    h1, h2, start = first
    doc, salt, n = rest
    zero = np.zeros(len(doc), np.int64)
    columns = [h1.view(np.int64), doc, salt, start, zero, n]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(doc), pa.binary()), pa.array(h2.view(np.int64))], names=names)


def _sheet(contexts: pa.Array, before: np.ndarray, lead: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """One row a context, its anchor in column ``lead``, 0 where there is no text; and the bytes from the anchor on."""
    m = len(contexts)
    edges = np.frombuffer(contexts.buffers()[1], np.int32)[contexts.offset : contexts.offset + m + 1].astype(np.int64)
    data = np.frombuffer(contexts.buffers()[2], np.uint8)
    sheet = np.zeros((m, width), dtype=np.uint8)
    flat = sheet.reshape(-1)
    for a in range(0, m, 2048):
        b = min(a + 2048, m)
        size = edges[a + 1 : b + 1] - edges[a:b]
        shift = np.arange(a, b) * width + lead - before[a:b] - edges[a:b]
        flat[np.repeat(shift, size) + np.arange(edges[a], edges[b])] = data[edges[a] : edges[b]]
    return sheet, np.diff(edges) - before


def bucket_spans(bucket, doc, salt, pos, before, contexts: pa.Array, length: int, keep: str) -> np.ndarray:
    """Smallest and largest start offset before the anchor of a repeated string, per context (-1: none).

    ``bucket`` numbers are ascending.  Offset a stands for the string that begins a bytes before the anchor.
    """
    m, lead = len(bucket), length - length // 4
    sheet, after = _sheet(contexts, before, lead, lead + length)
    string = np.zeros(m, dtype=np.uint64)
    for j in range(length):
        string = string * np.uint64(BASE) + _BYTE_VALUES[sheet[:, lead + j]]
    high_power = powers(length)[length - 1]
    # suffix order of the anchors themselves: bucket, then bytes
    words = np.ascontiguousarray(np.pad(sheet[:, lead:], ((0, 0), (0, (-length) % 8)))).view(">u8")
    order = np.lexsort([*words.T[::-1], bucket])
    place = np.empty(m, np.int64)  # the same place twice (repeated rows) has one number
    at = np.lexsort((pos, salt, doc))
    moved = (doc[at[1:]] != doc[at[:-1]]) | (salt[at[1:]] != salt[at[:-1]]) | (pos[at[1:]] != pos[at[:-1]])
    place[at] = np.concatenate([[0], np.cumsum(moved)])
    low, high = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
    shelf = bucket.astype(np.int64) * 256
    for a in range(lead + 1):
        if a:  # induced order of the suffixes one byte further left
            order = order[np.argsort((shelf + sheet[:, lead - a])[order], kind="stable")]
            string = (string - _BYTE_VALUES[sheet[:, lead - a + length]]) * np.uint64(UNBASE) + _BYTE_VALUES[sheet[:, lead - a]] * high_power
        held = order[(before[order] >= a) & (after[order] >= length - a)]
        if len(held) < 2:
            continue
        new = np.ones(len(held), bool)
        new[1:] = (string[held[1:]] != string[held[:-1]]) | (bucket[held[1:]] != bucket[held[:-1]])
        heads = np.flatnonzero(new)
        size = np.diff(np.append(heads, len(held)))
        if keep == "none":
            repeated = np.repeat(size > 1, size)
        else:  # a smaller position before or after it in the run
            repeated = place[held] > np.repeat(np.minimum.reduceat(place[held], heads), size)
        hit = held[repeated]
        high[hit] = a
        low[hit[low[hit] < 0]] = a
    return np.stack([low, high])


def _sorted_buckets(contexts: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans (doc, salt, begin, end) found in buckets of different contexts."""

    def solve(rows: pa.Table):
        ha = rows.column("ha").to_numpy()
        bucket = np.concatenate([[0], np.cumsum(ha[1:] != ha[:-1])])
        doc, salt, pos, before = (rows.column(c).to_numpy() for c in ("doc", "salt", "pos", "before"))
        contexts = rows.column("context").combine_chunks()
        contexts = contexts if isinstance(contexts, pa.Array) else pa.concat_arrays(contexts.chunks)
        low, high = bucket_spans(bucket, doc, salt, pos, before, contexts, length, keep)
        hit = high >= 0
        d, s, a, b = merged(doc[hit], salt[hit], pos[hit] - high[hit], pos[hit] - low[hit] + length)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (d, s, a, b)], names=["doc", "salt", "begin", "end"])

    def run(batches):
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size < TOGETHER:
                continue
            rows = pa.concat_tables(held).combine_chunks()
            ha = rows.column("ha").to_numpy()
            cut = int(np.searchsorted(np.cumsum(ha != ha[-1]), (ha != ha[-1]).sum(), side="left")) + 1 if ha[0] != ha[-1] else 0
            at = 0
            while at < cut:  # whole buckets, about TOGETHER contexts at a time
                end = min(at + TOGETHER, cut)
                while end < cut and ha[end] == ha[end - 1]:
                    end += 1
                yield solve(rows.slice(at, end - at))
                at = end
            held, size = [rows.slice(cut)], len(ha) - cut
        if size:
            rows = pa.concat_tables(held).combine_chunks()
            yield solve(rows)

    own = contexts.where("context is not null").select("ha", "doc", "salt", "pos", "before", "n", "context")
    return map_arrow(own.repartition("ha").sortWithinPartitions("ha"), run, "doc long, salt long, begin long, end long")


def _counted_strings(contexts: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans found in wide buckets: every string counted by its two hashes."""
    own = contexts.where("context is null").select("ha", "other", "doc", "salt", "pos", "n")
    place = F.struct("doc", "salt", "pos")
    # a place can be in two contexts of the bucket, so places are compared and not counted
    groups = own.groupBy("ha", "other").agg(F.max("n").alias("most"), F.min(place).alias("first"), F.max(place).alias("last"))
    hits = own.join(groups.where("most > 1 or first <> last"), ["ha", "other"])
    if keep == "first":
        hits = hits.where(place != F.col("first"))
    return hits.select("doc", "salt", F.col("pos").alias("begin"), (F.col("pos") + length).alias("end"))


def spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, keep: str = "none", wide: int = WIDE) -> DataFrame:
    """(doc, salt, list): repeated spans (begin, end) of every document that has any, as stored rows.

    ``doc`` and ``salt`` are the columns of ``keyed``; spans may overlap.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    source = docs.select(*keyed(docs, id_column, text), F.coalesce(F.col(text), F.lit("")).alias("body"))

    def run(batches):
        collector = Collector(length, keep)
        for rows, data, offsets in steps(batches, 2, STEP):
            collector.add(data, offsets, rows.column(0).to_numpy(), rows.column(1).to_numpy())
            if collector.size > HELD:
                yield from collector.flush()
        yield from collector.flush()

    found = stored(map_arrow(source, run, _ANCHOR_SCHEMA), "anchors")
    done = found.where("n = 0").select("doc", "salt", "begin", "end")
    found = found.where("n > 0")
    twice = found.groupBy("ha").agg(F.min("hc").alias("least"), F.max("hc").alias("most"), F.sum("n").alias("total")).where("total > 1")
    twice = twice.select("ha", (F.col("least") != F.col("most")).alias("mixed"))
    again = stored(found.join(twice, "ha"), "repeated-anchors")
    place = F.struct("doc", "salt", "pos", "begin", "end")
    firsts = again.groupBy("ha", "hc").agg(F.min(place).alias("first"), F.sum("n").alias("total"), F.first("mixed").alias("mixed"))
    firsts = stored(firsts, "first-places")
    repeats = again.join(firsts.where("total > 1").select("ha", "hc", "first"), ["ha", "hc"])
    if keep == "first":
        repeats = repeats.where((F.col("doc") != F.col("first.doc")) | (F.col("salt") != F.col("first.salt")) | (F.col("pos") != F.col("first.pos")))
    repeats = repeats.select("doc", "salt", "begin", "end")
    mixed = firsts.where("mixed").select("ha", "first.*", F.col("total").alias("n"))
    width = mixed.groupBy("ha").agg((F.count(F.lit(1)) > wide).alias("wide")).where("wide")
    mixed = mixed.join(width, "ha", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
    wanted = mixed.groupBy("doc", "salt").agg(F.collect_list(F.struct("ha", "pos", "begin", "end", "n", "wide")).alias("list"))
    contexts = stored(_contexts(source, wanted, length), "contexts")
    every = done.unionByName(repeats).unionByName(_sorted_buckets(contexts, length, keep)).unionByName(_counted_strings(contexts, length, keep))
    return stored(every.groupBy("doc", "salt").agg(F.collect_set(F.struct("begin", "end")).alias("list")), "spans")


def _kept(raw: pa.Buffer, found: list[dict] | None) -> tuple[bytes, int]:
    """The bytes that stay, and the number of maximal removed runs."""
    body = raw.to_pybytes()
    if not found:
        return body, 0
    out, at, runs, last = [], 0, 0, -1
    for begin, end in sorted((x["begin"], x["end"]) for x in found):
        if begin > last:
            runs += 1
            out.append(body[at:begin])
        last = max(last, end)
        at = max(at, end)
    out.append(body[at:])
    return b"".join(out), runs


def _with_spans(docs: DataFrame, found: DataFrame, id_column: str, text: str) -> DataFrame:
    doc, salt = keyed(docs, id_column, text)
    own = found.select(F.col("doc").alias("_doc"), F.col("salt").alias("_salt"), F.col("list").alias("_spans"))
    return docs.withColumns({"_d": doc, "_s": salt}).join(own, (F.col("_d") == F.col("_doc")) & (F.col("_s") == F.col("_salt")), "left").drop("_d", "_s", "_doc", "_salt")


def digests(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    rows = _with_spans(docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), found, "doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"]]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")

    def run(batches):
        for batch in batches:
            texts, lists = batch.column(1), batch.column(2)
            out = []
            for i in range(batch.num_rows):
                raw = texts[i].as_buffer()
                body, runs = _kept(raw, lists[i].as_py())
                out.append((raw.size, raw.size - len(body), runs, hashlib.sha256(body).hexdigest()))
            columns = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)] + [pa.array([x[3] for x in out], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return map_arrow(rows.select("doc_id", "text", "_spans"), run, schema)


def remove(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, keep: str = "first") -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; rows and other columns stay.

    A character that is cut in two by a span's edge is dropped as a whole.
    """
    found = spans(docs, id_column, text, length, keep)
    rows = _with_spans(docs, found, id_column, text)
    index, at, names = rows.columns.index(text), rows.columns.index("_spans"), docs.columns

    def run(batches):
        for batch in batches:
            texts, lists = batch.column(index), batch.column(at)
            hit = [i for i, x in enumerate(lists) if x.is_valid]
            values = texts.to_pylist()
            for i in hit:
                values[i] = _kept(texts[i].as_buffer(), lists[i].as_py())[0].decode("utf-8", "ignore")
            columns = list(batch.columns)
            columns[index] = pa.array(values, pa.string())
            columns.pop(at)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(rows, run, docs.schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, spans(docs))
