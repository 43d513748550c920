"""Hidden Markov language model over words, trained by Baum-Welch on the whole training part.

Tokens are the words of a text with A-Z lower-cased, then one end mark.  A
state emits a word class, and a class emits a word: the ``HEAD`` most frequent tokens
are classes of their own, all other words fall into ``TAIL`` hashed classes,
within which a word has its add-one share of the class.  So the model's size is
fixed, whatever the vocabulary's.

1. ``tokenised``: texts become numbers of words in the dictionary of their chunk
   (about ``CHUNK_BYTES`` of text); only chunk dictionaries, not tokens, are shuffled.
2. ``word_counts``: exact counts of all training tokens; they are joined back to
   the chunk dictionaries, which then meet their texts again by chunk.
   Training texts, as classes of two bytes a token, are shuffled once by length.
3. ``baum_welch``: each pass runs the scaled forward-backward recursion over every
   training text, one step for the t-th token of texts of similar length, and sums
   expected counts across tasks.  The first model is the unigram shares with fixed noise; rounds go on
   until one raises the log10 likelihood of the training texts by less than ``GAIN`` a token.
4. ``score``: the scaled forward recursion gives each text's exact log10 likelihood.

Words are known by 64-bit hashes.  Null texts count as empty: one end mark.
Rows are scored one by one, so repeated rows repeat their result and, in training, count as often
as they occur; an empty table gives an empty result, and without training
texts all classes are equally likely.  Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import RollingHash, fold, map_arrow, mix, steps, stored, table, word_spans

HEAD, TAIL, STATES = 8192, 1024, 8
#: Log10 likelihood a training token below which a round's gain ends the training.
GAIN = 1e-3
CHUNK_BYTES = 16 << 20
#: Tokens of a task whose texts are put in order of length, and tokens whose recursion runs together.
TOGETHER, PART = 4_000_000, 500_000
#: Training tokens of a task, whose texts have similar lengths.
SHARE = 2_000_000
END = np.uint64(0x5851F42D4C957F2D)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, the end mark included, and where each text's begin."""
    low = _LOWER[data]
    starts, ends, row = word_spans(low, offsets)
    n = len(offsets) - 1
    size = np.bincount(row, minlength=n) + 1
    begin = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(begin[-1], np.uint64)
    out[begin[1:] - 1] = END
    if len(starts):
        out[np.arange(len(starts)) + row] = RollingHash(low).of(starts, ends)
    return out, begin


def tokenised(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Stored rows of ``docs`` (doc_id, held_out, text): kind 0 are texts as numbers, kind 1 dictionary entries."""
    id_field = docs.schema["doc_id"]
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("chunk", T.LongType()), id_field])
    schema = schema.add("held_out", "boolean").add("tokens", "binary").add("number", "integer").add("hash", "long").add("n", "long")

    def run(batches):
        from pyspark import TaskContext

        base, count = TaskContext.get().partitionId() << 24, 0
        held: list[tuple] = []
        size = 0

        def flush():
            chunk = base + count
            hashes = np.concatenate([h for _, h, _ in held])
            words, number, often = np.unique(hashes, return_inverse=True, return_counts=True)
            del hashes
            rank = np.empty(len(words), "<i4")  # frequent words get small numbers, which pack well
            rank[np.argsort(-often, kind="stable")] = np.arange(len(words))
            words, number = words[np.argsort(rank)], rank[number]
            train = np.concatenate([np.repeat(~rows.column(1).to_numpy(zero_copy_only=False), np.diff(b)) for rows, _, b in held])
            n = np.bincount(number[train], minlength=len(words))
            at = 0
            for rows, h, begin in held:
                raw = number[at : at + len(h)]
                at += len(h)
                parts = pa.array([raw[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])], pa.binary())
                m = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(m, np.int32)), pa.array(np.full(m, chunk)), rows.column(0), rows.column(1), parts, pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())],
                    names=schema.names,
                )
                ids = rows.column(0).type
            for a in range(0, len(words), 200_000):
                part = words[a : a + 200_000]
                m = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(m, np.int32)), pa.array(np.full(m, chunk)), pa.nulls(m, ids), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary()), pa.array(np.arange(a, a + m, dtype=np.int32)), pa.array(part.view(np.int64)), pa.array(n[a : a + m])],
                    names=schema.names,
                )

        for rows, data, offsets in steps(batches, 2):
            hashes, begin = tokens_of(data, offsets)
            held.append((rows.select([0, 1]), hashes, begin))
            size += len(data) + 16 * rows.num_rows
            if size >= chunk_bytes:
                yield from flush()
                held, size, count = [], 0, count + 1
        if held:
            yield from flush()

    return stored(map_arrow(docs.select("doc_id", "held_out", "text"), run, schema), "tokens", "kind", "zstd")


@dataclass
class Vocabulary:
    """What is known of all training tokens: totals, the head words and the sums of the tail classes."""

    tokens: int
    distinct: int
    head: np.ndarray  # hashes, ascending
    head_class: np.ndarray
    class_count: np.ndarray  # training tokens of each class
    tail_total: np.ndarray
    tail_distinct: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.class_count)

    def classes_of(self, hashes: np.ndarray) -> np.ndarray:
        found = len(self.head) + (mix(hashes) % np.uint64(TAIL)).astype(np.int64)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
            hit = self.head[at] == hashes
            found[hit] = self.head_class[at[hit]]
        return found

    def logs(self, found: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 share of each word within its class, and its log10 unigram probability."""
        tail = found.astype(np.int64) - len(self.head)
        mass = (self.tail_total + self.tail_distinct + 1.0)[np.maximum(tail, 0)]
        share = np.where(tail < 0, 0.0, np.log10((count + 1.0) / mass))
        return share, np.log10((count + 1.0) / (self.tokens + self.distinct + 1.0))


def word_counts(tokens: DataFrame) -> DataFrame:
    """(hash, c): how often each token occurs in training; 0 for words of held-out texts only."""
    return stored(tokens.where("kind = 1").groupBy("hash").agg(F.sum("n").alias("c")), "word-counts", None, "zstd")


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """Head words and class sums; the driver receives ``head`` + ``TAIL`` rows."""
    known = counts.where("c > 0")
    totals = known.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # only words as frequent as the last of the head are sorted and sent
    grade = F.floor(F.log2("c") * 16)
    least, listed = 0, 0
    for r in known.groupBy(grade.alias("g")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("g")).collect():
        least, listed = r["g"], listed + r["n"]
        if listed >= head:
            break
    top = known.where(grade >= least).orderBy(F.desc("c"), "hash").limit(head).collect()

    def run(batches):
        listed = np.array(sorted(r["hash"] for r in top), dtype=np.int64)
        total, distinct = np.zeros(TAIL), np.zeros(TAIL)
        for batch in batches:
            h, c = (batch.column(i).to_numpy() for i in (0, 1))
            rest = ~np.isin(h, listed)
            tail = (mix(h[rest].view(np.uint64)) % np.uint64(TAIL)).astype(np.int64)
            total += np.bincount(tail, weights=c[rest], minlength=TAIL)
            distinct += np.bincount(tail, minlength=TAIL)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAIL)), pa.array(total), pa.array(distinct)], names=["tail", "total", "distinct"])

    sums = map_arrow(known.select("hash", "c"), run, "tail long, total double, distinct double")
    tail_total, tail_distinct = np.zeros(TAIL), np.zeros(TAIL)
    for r in sums.groupBy("tail").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).collect():
        tail_total[r["tail"]], tail_distinct[r["tail"]] = r["total"], r["distinct"]
    hashes = np.array([r["hash"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    own = np.array([r["c"] for r in top], dtype=float)
    return Vocabulary(totals["n"], totals["v"], hashes[order], order, np.concatenate([own, tail_total]), tail_total, tail_distinct)


def resolved(tokens: DataFrame, counts: DataFrame, words: Vocabulary) -> DataFrame:
    """Stored rows of texts: counts, unigram score, log10 shares within classes and the class of every token (uint16)."""
    shared = tokens.sparkSession.sparkContext.broadcast(words)  # HEAD + TAIL numbers

    def classed(batches):
        for batch in batches:
            h, c = batch.column(2).to_numpy().view(np.uint64), batch.column(3).to_numpy()
            found = shared.value.classes_of(h)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(found.astype(np.int32))], names=["part", "number", "c", "class"])

    entry = tokens.where("kind = 1").select(F.col("chunk").alias("part"), "number", "hash").join(counts, "hash").select("part", "number", "hash", "c")
    entry = stored(map_arrow(entry, classed, "part long, number int, c long, class int"), "dictionary", None, "zstd")
    text = tokens.where("kind = 0").select("chunk", "doc_id", "held_out", "tokens")
    schema = T.StructType([tokens.schema["doc_id"]]).add("held_out", "boolean").add("n_tokens", "long").add("n_known", "long")
    schema = schema.add("base_score", "double").add("within", "double").add("classes", "binary")

    def solve(texts: pa.Table, entries: pa.Table) -> pa.Table:
        number = entries.column("number").to_numpy()
        order = np.argsort(number)
        c = entries.column("c").to_numpy()[order].astype(float)
        found = entries.column("class").to_numpy()[order].astype("<u2")
        share, base = shared.value.logs(found, c)
        rows: list[tuple] = []
        for raw in texts.column("tokens"):
            at = np.frombuffer(raw.as_buffer(), "<i4")
            rows.append((len(at), int((c[at] > 0).sum()), float(base[at].sum()), float(share[at].sum()), found[at].tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.Table.from_arrays([texts.column("doc_id"), texts.column("held_out"), *columns], names=schema.names)

    from ledgerline.session import ship_package

    ship_package(tokens.sparkSession)
    return stored(text.groupBy("chunk").cogroup(entry.groupBy("part")).applyInArrow(solve, schema), "class-texts", None, "zstd")


@dataclass
class Model:
    """Start, transition and class emission probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x classes


def recursion(classes: np.ndarray, begin: np.ndarray, model: Model, backward: bool) -> tuple:
    """Log10 likelihood of every text by scaled recursion; with ``backward`` also expected counts.

    Texts of similar length run together, about ``PART`` tokens at a time, so that most steps are wide.
    """
    states = len(model.start)
    size = np.diff(begin)
    order = np.argsort(-size, kind="stable")
    ends = np.cumsum(size[order])
    like = np.zeros(len(size))
    started, moves, emitted = np.zeros(states), np.zeros((states, states)), np.zeros((states, model.emit.shape[1]))
    at = 0
    while at < len(order):
        upto = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART, side="right")), at + 1)
        texts = order[at:upto]
        like[texts], *expected = _lockstep(classes, begin[texts], size[texts], model, backward)
        if backward:
            started, moves, emitted = started + expected[0], moves + expected[1], emitted + expected[2]
        at = upto
    return (like, started, moves, emitted) if backward else (like, None, None, None)


def _lockstep(classes: np.ndarray, heads: np.ndarray, size: np.ndarray, model: Model, backward: bool) -> tuple:
    """``recursion`` over texts given by their first token and size, the longest first.

    Step t handles the t-th token of all texts that have one.  Tokens lie in the order of
    steps, and each state has a row of its own: a step is a run of columns.
    """
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    begin = np.concatenate([[0], np.cumsum(active)])
    step = np.repeat(np.arange(longest), active)
    text = np.arange(begin[-1]) - begin[step]
    seen = classes[heads[text] + step].astype(np.int64)
    begin, active = begin.tolist(), active.tolist()
    kind = np.float32 if backward else np.float64  # training keeps a column for every token
    emit, states = np.ascontiguousarray(model.emit, kind), len(model.start)
    start, onward, back = model.start.astype(kind)[:, None], np.ascontiguousarray(model.move.T, kind), np.ascontiguousarray(model.move, kind)
    forward = np.empty((states, len(seen)), kind) if backward else None
    scale = np.empty(len(seen), kind)
    a = None
    for t, n in enumerate(active):
        here = slice(begin[t], begin[t] + n)
        now = emit.take(seen[here], axis=1)
        now *= start if t == 0 else onward @ a[:, :n]
        total = np.add.reduce(now, axis=0, out=scale[here])
        a = np.divide(now, total, out=forward[:, here] if backward else now)
    like = np.bincount(text, weights=np.log10(scale, dtype=np.float64), minlength=len(heads))
    if not backward:
        return like, None, None, None
    np.divide(1, scale, out=scale)
    later = np.ones((states, len(heads)), kind)
    moves = np.zeros((states, states))
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        here = slice(begin[t + 1], begin[t + 1] + n)
        ahead = emit.take(seen[here], axis=1)
        ahead *= later[:, :n]
        ahead *= scale[here]
        own = forward[:, begin[t] : begin[t] + n]
        moves += own @ ahead.T
        np.matmul(back, ahead, out=later[:, :n])
        own *= later[:, :n]
    emitted = np.stack([np.bincount(seen, weights=row, minlength=emit.shape[1]) for row in forward])
    return like, forward[:, : len(heads)].sum(axis=1, dtype=np.float64), moves * model.move, emitted


def maximised(started: np.ndarray, moved: np.ndarray, emitted: np.ndarray, unigram: np.ndarray, prior: float = 50.0) -> Model:
    """Probabilities from expected counts, drawn a little towards uniform moves and unigram emissions."""
    states = len(started)
    start = started + 1.0
    move = moved + 1.0
    emit = emitted + prior * unigram
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True) if states else emit)


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Class arrays one after the other, and where each begins."""
    return np.concatenate([np.frombuffer(p, "<u2") for p in parts]), np.concatenate([[0], np.cumsum([len(p) // 2 for p in parts])])


def first_model(unigram: np.ndarray, states: int = STATES) -> Model:
    """Unigram emissions with fixed noise, and states that tend to stay."""
    noise = np.random.default_rng(7)
    emit = unigram * np.exp(noise.normal(0.0, 0.5, size=(states, len(unigram))))
    return Model(np.full(states, 1.0 / states), np.full((states, states), 0.4 / states) + 0.6 * np.eye(states), emit / emit.sum(axis=1, keepdims=True))


def _groups(batches, index: int):
    """(rows, classes, begin) of about ``TOGETHER`` tokens each."""
    held, size = [], 0
    for batch in batches:
        column = batch.column(index)
        lengths = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) // 2
        at = 0
        for i, n in enumerate(lengths.tolist()):
            size += n
            if size >= TOGETHER:
                held.append(batch.slice(at, i + 1 - at))
                yield _group(held, index)
                held, size, at = [], 0, i + 1
        if at < len(lengths):
            held.append(batch.slice(at))
    if held:
        yield _group(held, index)


def _group(held: list, index: int):
    parts = [x.as_buffer() for b in held for x in b.column(index)]
    return (held, *_joined(parts))


def by_length(train: DataFrame, tokens: int) -> DataFrame:
    """Stored classes of ``train`` in partitions of about ``SHARE`` tokens, each of texts of similar length.

    Tokens are counted by length, sixteen grades to a doubling; the driver receives a row a grade.
    """
    train = train.withColumn("grade", F.floor(F.log2("n_tokens") * 16))
    sizes = train.groupBy("grade").agg(F.sum("n_tokens").alias("n")).orderBy("grade").collect()
    count = max(1, -(-tokens // SHARE))
    before = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    places = train.sparkSession.createDataFrame([(r["grade"], b, r["n"]) for r, b in zip(sizes, before)], "grade long, before long, n long")
    spread = F.xxhash64("doc_id", "classes")
    part = F.floor((F.col("before") + F.col("n") * (F.pmod(spread, F.lit(1 << 20)) / F.lit(float(1 << 20)))) * F.lit(count) / F.lit(max(before[-1], 1)))
    rows = train.join(F.broadcast(places), "grade").select(F.least(part, F.lit(count - 1)).cast("int").alias("part"), "n_tokens", spread.alias("spread"), "classes")
    return stored(rows.repartitionById(count, "part").sortWithinPartitions("n_tokens", "spread").select("classes"), "training-texts", None, "zstd")


def baum_welch(texts: DataFrame, model: Model, unigram: np.ndarray, tokens: int, gain: float = GAIN) -> tuple[Model, list[float]]:
    """Rounds over all training texts until the likelihood rises by less than ``gain`` a token, and the likelihood a token before each.

    Expected counts are summed across tasks.
    """
    train = by_length(texts.where(~F.col("held_out")), tokens)
    states = len(model.start)
    names = [f"s{i}" for i in range(states)]
    likes: list[float] = []
    while len(likes) < 2 or likes[-1] - likes[-2] >= gain:
        shared = texts.sparkSession.sparkContext.broadcast(model)  # states x (HEAD + TAIL) numbers

        def run(batches):
            started, moved, emitted = np.zeros(states), np.zeros((states, states)), np.zeros((states, len(unigram)))
            total = np.zeros(states)
            for _, classes, begin in _groups(batches, 0):
                like, a, b, c = recursion(classes, begin, shared.value, True)
                started, moved, emitted = started + a, moved + b, emitted + c
                total[0] += like.sum()
            # rows -1: starts; -2 - i: moves from state i; -2 - states: likelihood; others: emissions of a class
            used = np.flatnonzero(emitted.any(axis=0))
            row = np.concatenate([[-1], -2 - np.arange(states + 1), used])
            body = np.vstack([started, moved, total, emitted[:, used].T])
            yield pa.RecordBatch.from_arrays([pa.array(row), *(pa.array(np.ascontiguousarray(body[:, i])) for i in range(states))], names=["row", *names])

        sums = map_arrow(train, run, "row long, " + ", ".join(f"{n} double" for n in names)).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
        started, moved, emitted = np.zeros(states), np.zeros((states, states)), np.zeros((states, len(unigram)))
        like = 0.0
        for r in sums.collect():  # 2 + states + classes rows
            value = np.array([r[n] for n in names])
            if r["row"] == -1:
                started = value
            elif r["row"] == -2 - states:
                like = value[0]
            elif r["row"] < -1:
                moved[-2 - r["row"]] = value
            else:
                emitted[:, r["row"]] = value
        model = maximised(started, moved, emitted, unigram)
        likes.append(like / max(tokens, 1))
    return model, likes


def score(texts: DataFrame, model: Model, train_tokens: int) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    source = texts.select("doc_id", "held_out", "n_tokens", "n_known", "base_score", "within", "classes")
    schema = T.StructType([*source.schema.fields[:4]]).add("train_tokens", "long").add("base_score", "double").add("score", "double")

    def run(batches):
        for held, classes, begin in _groups(batches, 6):
            like = recursion(classes, begin, shared.value, False)[0]
            at = 0
            for rows in held:
                m = rows.num_rows
                total = like[at : at + m] + rows.column(5).to_numpy()
                at += m
                yield pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array(np.full(m, train_tokens, np.int64)), rows.column(4), pa.array(total)], names=schema.names)

    return map_arrow(source, run, schema)


def language_model(docs: DataFrame, states: int = STATES, head: int = HEAD, gain: float = GAIN) -> DataFrame:
    """Train on the rows of ``docs`` (doc_id, held_out, text) that are not held out and score them all."""
    tokens = tokenised(docs)
    counts = word_counts(tokens)
    words = vocabulary(counts, head)
    texts = resolved(tokens, counts, words)
    unigram = (words.class_count + 1.0) / (words.class_count.sum() + words.classes)
    model, _ = baum_welch(texts, first_model(unigram, states), unigram, words.tokens, gain)
    return score(texts, model, words.tokens)


def op10_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_model(docs.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "text"))
