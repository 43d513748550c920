"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad.  A line's features are binned counts of
its own bytes and words (see ``FEATURES``), and the same of the line before and
after it; a transition weight links the labels of neighbours.  Training takes
the document's label for each of its lines, on a bounded sample of labelled
documents (``MAX_DOCUMENTS``; of these, ones with more than ``MAX_LINES`` lines are left out), and follows the exact
gradient of the conditional likelihood.  A document's score is the mean of its
lines' forward-backward marginals of "good", weighted by line length in bytes.

Null and empty texts and texts without a word score 0.  Rows are independent:
repeated rows repeat their score; an empty table gives an empty result, and no
labelled rows give the same score of 0.5 to every text with a word.  Other columns pass through
unless they have the name of an added column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import RollingHash, annotated, fold, map_arrow, mix, smallest_hashes, steps, table, word_spans

MAX_DOCUMENTS = 4_000
MAX_LINES = 2_000

#: Name and bin edges of each line feature.
FEATURES: tuple[tuple[str, tuple[float, ...]], ...] = (
    ("words", (2, 4, 8, 16, 32, 64)),
    ("mean word bytes", (2.5, 3.5, 4.5, 5.5, 6.5, 8, 12)),
    ("upper-case share", (0.01, 0.05, 0.1, 0.3, 0.6)),
    ("digit share", (0.005, 0.02, 0.1, 0.3)),
    ("symbol share", (0.005, 0.02, 0.05, 0.1, 0.2)),
    ("bar share", (0.005, 0.02, 0.05)),
    ("exclamation share", (0.005, 0.02, 0.05)),
    ("other punctuation share", (0.01, 0.03, 0.06, 0.12)),
    ("share of words as the one before", (0.02, 0.1, 0.3)),
    ("share of three-word runs found twice", (0.02, 0.1, 0.3, 0.6)),
    ("copies of the line in the document", (1.5, 2.5, 4.5)),
    ("ends a sentence", (0.5,)),
    ("words of the document", (5, 20, 50, 200)),
)
_SIZES = [len(edges) + 1 for _, edges in FEATURES]
_STARTS = np.concatenate([[0], np.cumsum(_SIZES)])[:-1]
WIDTH = int(sum(_SIZES))

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&<>@^~_=+\\{}[]"]] = True
_OTHER = np.zeros(256, bool)
_OTHER[[ord(c) for c in ".,;:?'\"()-/"]] = True


def _twice(keys: np.ndarray) -> np.ndarray:
    """How many elements equal each element."""
    if not len(keys):
        return np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    heads = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    group = np.cumsum(heads) - 1
    out = np.empty(len(keys), np.int64)
    out[order] = np.bincount(group)[group]
    return out


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x features) bin numbers, bytes of each line and the row each is in; lines without a word are left out."""
    starts, ends, owner = word_spans(data, offsets)
    if not len(starts):
        return np.zeros((0, len(FEATURES)), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.flatnonzero(data == 10) + 1
    firsts = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], breaks[breaks < len(data)]]))
    line = np.searchsorted(firsts, starts, side="right") - 1
    used, line = np.unique(line, return_inverse=True)
    begin = firsts[used]
    end = np.append(firsts, len(data))[used + 1]
    n = len(used)
    row = np.searchsorted(offsets, begin, side="right") - 1
    words = np.bincount(line, minlength=n).astype(float)
    word_bytes = np.bincount(line, weights=(ends - starts).astype(float), minlength=n)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
        return (total[end] - total[begin]) / word_bytes

    single = np.zeros(256, bool)
    hashed = RollingHash(data)
    word = hashed.of(starts, ends)
    again = np.zeros(len(word))
    again[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    runs = np.zeros(n)
    if len(word) > 2:
        key = mix(word[:-2] ^ mix(word[1:-1] ^ mix(word[2:] + owner[2:].astype(np.uint64))))
        own = np.flatnonzero(owner[2:] == owner[:-2])
        copies = _twice(key[own])
        runs = np.bincount(line[own], weights=(copies > 1).astype(float), minlength=n) / words
    last_word = np.append(np.flatnonzero(np.diff(line)), len(line) - 1)
    first_word = np.concatenate([[0], last_word[:-1] + 1])
    content = mix(hashed.of(starts[first_word], ends[last_word]) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    final = data[ends[last_word] - 1]
    bar, bang = single.copy(), single.copy()
    bar[ord("|")] = True
    bang[ord("!")] = True
    values = [
        words,
        word_bytes / words,
        share(_UPPER),
        share(_DIGIT),
        share(_SYMBOL),
        share(bar),
        share(bang),
        share(_OTHER),
        np.bincount(line, weights=again, minlength=n) / words,
        runs,
        _twice(content).astype(float),
        ((final == ord(".")) | (final == ord("?")) | (final == ord("!"))).astype(float),
        np.bincount(row, weights=words, minlength=len(offsets) - 1)[row],
    ]
    bins = np.stack([np.searchsorted(edges, v, side="right") for (_, edges), v in zip(FEATURES, values)], axis=1)
    return bins.astype(np.uint8), end - begin, row


def _columns(bins: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Indices into the weights of each line's own, earlier and later features; the last slot is "no such line"."""
    own = bins.astype(np.int64) + _STARTS
    none = np.full((1, own.shape[1]), 3 * WIDTH, np.int64)
    before, after = np.vstack([none, own[:-1] + WIDTH]), np.vstack([own[1:] + 2 * WIDTH, none])
    if len(row):
        before[1:][row[1:] != row[:-1]] = 3 * WIDTH
        after[:-1][row[1:] != row[:-1]] = 3 * WIDTH
    return np.hstack([own, before, after])


@dataclass
class Chain:
    """Weights of "good" over "bad": one for each feature bin and neighbour, and a 2 x 2 transition matrix."""

    weights: np.ndarray
    transition: np.ndarray

    def emissions(self, columns: np.ndarray) -> np.ndarray:
        return self.weights[columns].sum(axis=1) + self.weights[-1]

    def marginals(self, emission: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of "good" for each line, and expected transition counts (2 x 2)."""
        return forward_backward(emission, row, self.transition)


def forward_backward(emission: np.ndarray, row: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact marginals of all chains at once: step t handles the t-th line of every row that has one."""
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    length = np.diff(np.append(heads, n))
    order = np.argsort(-length, kind="stable")
    heads, length = heads[order], length[order]
    potential = np.exp(transition - transition.max())
    local = np.exp(np.stack([np.minimum(-emission, 0), np.minimum(emission, 0)], axis=1))
    forward = np.empty((n, 2))
    scale = np.empty(n)
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")  # rows with more than t lines
    for t in range(length[0]):
        at = heads[: active[t]] + t
        a = local[at] if t == 0 else (forward[at - 1] @ potential) * local[at]
        scale[at] = a.sum(axis=1)
        forward[at] = a / scale[at][:, None]
    backward = np.ones((n, 2))
    expected = np.zeros((2, 2))
    for t in range(length[0] - 2, -1, -1):
        at = heads[: active[t + 1]] + t
        ahead = local[at + 1] * backward[at + 1] / scale[at + 1][:, None]
        expected += (forward[at].T @ ahead) * potential
        backward[at] = ahead @ potential.T
    marginal = forward * backward
    return marginal[:, 1] / marginal.sum(axis=1), expected


def fit(bins: np.ndarray, row: np.ndarray, good: np.ndarray, rounds: int = 120, rate: float = 0.1, decay: float = 2e-3) -> Chain:
    """Maximise the conditional likelihood by Adam steps from zero (deterministic)."""
    chain = Chain(np.zeros(3 * WIDTH + 2), np.zeros((2, 2)))
    if not len(row):
        return chain
    columns = _columns(bins, row)
    same = row[1:] == row[:-1]
    y = good.astype(int)
    observed = np.zeros((2, 2))
    np.add.at(observed, (y[:-1][same], y[1:][same]), 1.0)
    flat = columns.ravel()
    first = second = 0.0
    documents = len(np.unique(row))
    for i in range(1, rounds + 1):
        marginal, expected = chain.marginals(chain.emissions(columns), row)
        error = good - marginal
        slope = np.bincount(flat, weights=np.repeat(error, columns.shape[1]), minlength=len(chain.weights))
        slope[-2], slope[-1] = 0.0, error.sum()
        slope = np.concatenate([slope, (observed - expected).ravel()]) / documents
        current = np.concatenate([chain.weights, chain.transition.ravel()])
        slope -= decay * current
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        current += rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
        chain = Chain(current[:-4], current[-4:].reshape(2, 2))
        chain.weights[-2] = 0.0
    return chain


def training_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(id, good, text) of at most ``limit`` labelled documents, chosen by a hash of the id."""
    known = labels.where("label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = smallest_hashes(known, ["doc_id"], limit)  # at most ``limit`` ids are sent to all
    return docs.join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS, max_lines: int = MAX_LINES) -> Chain:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, label 0/1) of the training fold."""
    sample = training_sample(docs, labels, max_documents).select("text", F.col("label").cast("double").alias("label"))

    def run(batches):
        for rows, data, offsets in steps(batches, 0):
            bins, _, row = line_features(data, offsets)
            label = rows.column(1).to_numpy(zero_copy_only=False)
            cuts = np.searchsorted(row, np.arange(len(label) + 1))
            found = [i for i in range(len(label)) if 0 < cuts[i + 1] - cuts[i] <= max_lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[found]), pa.array([bins[cuts[i] : cuts[i + 1]].tobytes() for i in found], pa.binary())], names=["label", "bins"]
            )

    rows = sorted((r["label"], bytes(r["bins"])) for r in map_arrow(sample, run, "label double, bins binary").collect())
    parts = [np.frombuffer(b, np.uint8).reshape(-1, len(FEATURES)) for _, b in rows]
    if not parts:
        return fit(np.zeros((0, len(FEATURES)), np.uint8), np.zeros(0, np.int64), np.zeros(0))
    sizes = [len(p) for p in parts]
    return fit(np.vstack(parts), np.repeat(np.arange(len(parts)), sizes), np.repeat([label for label, _ in rows], sizes))


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, ``n_lines`` and ``bad_lines`` (lines more likely bad than good)."""

    def make():
        def step(rows, data, offsets):
            n = len(offsets) - 1
            bins, size, row = line_features(data, offsets)
            good, _ = chain.marginals(chain.emissions(_columns(bins, row)), row)
            weight = np.bincount(row, weights=size, minlength=n)
            total = np.bincount(row, weights=size * good, minlength=n) / np.maximum(weight, 1)
            lines = np.bincount(row, minlength=n)
            return [np.clip(total, 0.0, 1.0), lines, np.bincount(row[good < 0.5], minlength=n)]

        return step

    return annotated(docs, text, T.StructType().add("score", "double").add("n_lines", "long").add("bad_lines", "long"), make)


def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(fold("doc_id", 5) != 0)
    chain = train(docs, labels)
    out = score(docs.withColumn("held_out", fold("doc_id", 5) == 0), chain)
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "n_lines", "bad_lines")
