"""Toxicity with noisy-channel deobfuscation.

A word that may hide another one (digits or symbols among letters, letters
repeated three times or more, a letter doubled in a word that the sample does not know,
separators between letters, letters spelled one
by one) is a lattice: a leet character may stand for each of its letters, a
repeated letter may be dropped, a separator may be dropped.  Viterbi decoding
under a character trigram model restores the likeliest word.  Words without any
of these have one path and stay as they are.  Of paths with equal probability the
one found first stays.

The restored text is scored by its distinct words: each listed word adds the
lower confidence bound of its log likelihood ratio between toxic and clean
documents, and a logistic curve, fitted on the half of the sample that the
word weights have not seen, turns the sum into a probability.

The character model counts every document that it is given (the query: all outside the
held-out fold, labelled or not); of its trigrams the rarest go, which together hold at most
``LOST`` of all occurrences.  Word weights, the curve and the words known as they stand are learned from a
bounded sample of labelled documents (``MAX_DOCUMENTS``, chosen by a hash of the id; equal hashes by id).  Of several labels
of one id the largest counts.  Null and empty texts have no
words and get the score of an empty sum.  Rows are independent, repeated rows repeat their
score, an empty table gives an empty result; without labelled rows every score is 0.
Other columns pass through unless they have the name of an added column.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import RollingHash, annotated, fold, lowered, map_arrow, smallest_hashes, steps, stored, table, word_spans

MAX_DOCUMENTS = 20_000
#: Share of the trigram occurrences that the character model may lose.
LOST = 1e-4
#: A word with a doubled letter is known as it stands if this many documents of the sample hold it.
KNOWN_IN = 3
REMEMBERED = 100_000

#: Letters a character may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
SEPARATORS = set(".-_*~,:;/'\\ ")
LEET_COST, REPEAT_COST, SEPARATOR_COST = math.log(0.2), math.log(0.3), math.log(0.3)

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_CORE = _LETTER | _DIGIT
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in LEET]] = True
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[ord(c) for c in SEPARATORS]] = True
_HEAD = _LEET & ~_DIGIT  # symbols that may begin a hidden word
_HEAD[[ord("("), ord("|"), ord("+")]] = False


def _within(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[ends] - total[starts]


_NO_WORDS = np.zeros(0, np.uint64)


def _repeats(low: np.ndarray, times: int) -> np.ndarray:
    """Places of letters that equal the ``times`` - 1 bytes before them."""
    out = np.zeros(len(low), bool)
    if len(low) >= times:
        same = _LETTER[low[times - 1 :]] & (low[times - 1 :] < 128)
        for k in range(1, times):
            same &= low[times - 1 :] == low[times - 1 - k : len(low) - k]
        out[times - 1 :] = same
    return out


def _has(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(sorted_hashes) or not len(hashes):
        return np.zeros(len(hashes), bool)
    return sorted_hashes[np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1)] == hashes


def word_table(low: np.ndarray, offsets: np.ndarray, known: np.ndarray = _NO_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Trimmed words with a letter: starts, ends, row, whether suspicious; and runs of letters spelled one by one.

    ``known``: sorted hashes of words whose doubled letters are in order.  Members of a run may be leet characters.
    """
    starts, ends, row = word_spans(low, offsets)
    if not len(starts):
        return starts, ends, row, np.zeros(0, bool), []
    core = np.append(np.flatnonzero(_CORE[low]), len(low))  # one place after the last, so that indices stay valid
    first = np.searchsorted(core, starts)
    last = np.maximum(np.searchsorted(core, ends) - 1, 0)
    has = (core[first] < ends) & (core[last] >= starts)
    begin, close = np.where(has, core[first], starts), np.where(has, core[last] + 1, ends)
    headed = has & (begin > starts) & _HEAD[low[np.maximum(begin - 1, 0)]] & (close - begin >= 2)
    begin = np.where(headed, begin - 1, begin)
    size = close - begin
    letters = _within(_LETTER[low], begin, close)
    leet = _within(_LEET[low], begin, close)
    between = _within(_BETWEEN[low], begin, close)
    other = size - letters
    triple = _within(_repeats(low, 3), begin, close) > 0
    hidden = (letters >= 2) & (other * 2 <= size + 1)
    hidden |= (letters >= 1) & (letters + leet >= 3) & (letters + leet + between == size)
    suspicious = ((other > 0) & hidden) | triple
    # the doubling's second letter must lie inside the word, so the first place does not count
    doubled = np.flatnonzero((letters >= 4) & ~suspicious & (_within(_repeats(low, 2), np.minimum(begin + 1, close), close) > 0))
    if len(doubled):
        suspicious[doubled] = ~_has(known, RollingHash(low).of(begin[doubled], close[doubled]))
    lone = (ends - starts == 1) & (_LETTER | _LEET)[low[starts]]
    in_run = np.zeros(len(starts), bool)
    runs = []
    if lone.any():
        edge = np.diff(np.concatenate([[0], lone.astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            # a run ends with its text
            for x, y in _same_row(row, int(a), int(b)):
                if y - x >= 3 and letters[x:y].sum() >= 2:
                    runs.append((x, y))
                    in_run[x:y] = True
    stay = (letters > 0) | in_run
    place = np.cumsum(stay) - 1
    return begin[stay], close[stay], row[stay], suspicious[stay], [(int(place[x]), int(place[y - 1]) + 1) for x, y in runs]


def _same_row(row: np.ndarray, a: int, b: int) -> list[tuple[int, int]]:
    cuts = [a, *(np.flatnonzero(row[a + 1 : b] != row[a : b - 1]) + a + 1).tolist(), b]
    return list(zip(cuts[:-1], cuts[1:]))


@dataclass
class CharacterModel:
    """Trigram probabilities, each order backed off to the one below; ``usual`` are sorted hashes of words whose doubled letters are in order."""

    grams: dict[str, int]
    usual: np.ndarray = field(default_factory=lambda: _NO_WORDS)
    mass: float = 2.0
    cache: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.contexts: Counter = Counter()
        for gram, n in self.grams.items():
            self.contexts[gram[:-1]] += n
        self.alphabet = max(sum(1 for g in self.grams if len(g) == 1), 30)

    def probability(self, gram: str) -> float:
        below = self.probability(gram[1:]) if len(gram) > 1 else 1.0 / self.alphabet
        return (self.grams.get(gram, 0) + self.mass * below) / (self.contexts.get(gram[:-1], 0) + self.mass)

    def log(self, gram: str) -> float:
        found = self.cache.get(gram)
        if found is None:
            if len(self.cache) > 500_000:
                self.cache.clear()
            found = self.cache[gram] = math.log(self.probability(gram))
        return found

    def __getstate__(self):
        return {"grams": self.grams, "usual": self.usual, "mass": self.mass}

    def __setstate__(self, state):
        self.__init__(**state)

    def decode(self, seen: str) -> str:
        """The likeliest word behind ``seen`` (Viterbi; states are the last two restored characters)."""
        best: dict[str, tuple[float, tuple]] = {"  ": (0.0, ())}
        for i, c in enumerate(seen):
            steps_: list[tuple[str, float]]
            if c in LEET:
                steps_ = [(x, LEET_COST) for x in LEET[c]]
                if not c.isdigit():
                    steps_.append(("", SEPARATOR_COST))
            elif c in SEPARATORS or not c.isalpha():
                steps_ = [("", SEPARATOR_COST)]
            else:
                steps_ = [(c, 0.0)]
                if i and seen[i - 1] == c:
                    steps_.append(("", REPEAT_COST))
            following: dict[str, tuple[float, tuple]] = {}
            for state, (total, path) in best.items():
                for x, cost in steps_:
                    if x:
                        to, value, trail = state[1] + x, total + cost + self.log(state + x), (path, x)
                    else:
                        to, value, trail = state, total + cost, path
                    if to not in following or following[to][0] < value:
                        following[to] = (value, trail)
            best = following
        value, path = max(((total + self.log(state + " "), path) for state, (total, path) in best.items()), key=lambda x: x[0])
        out = []
        while path:
            path, x = path
            out.append(x)
        return "".join(reversed(out))


class Restorer:
    """Words of a step, after decoding; remembers what it decoded."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.known: dict[str, str] = {}

    def restore(self, seen: str) -> str:
        found = self.known.get(seen)
        if found is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            found = self.known[seen] = self.model.decode(seen)
        return found

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and row of every word, restored ones in place of the hidden; and how many words a row had restored."""
        low = lowered(data)
        begin, close, row, suspicious, runs = word_table(low, offsets, self.model.usual)
        plain = ~suspicious
        hashes, rows = RollingHash(low).of(begin[plain], close[plain]), row[plain]
        hidden = np.flatnonzero(suspicious).tolist()
        seen = [low[begin[i] : close[i]].tobytes().decode("utf-8", "replace") for i in hidden]
        at = row[suspicious].tolist()
        for a, b in runs:
            seen.append("".join(low[begin[i] : close[i]].tobytes().decode("utf-8", "replace") for i in range(a, b)))
            at.append(int(row[a]))
        restored = [self.restore(s) for s in seen]
        if restored:
            raw = [r.encode() for r in restored]
            cuts = np.cumsum([0, *map(len, raw)])
            more = RollingHash(np.frombuffer(b"".join(raw), np.uint8)).of(cuts[:-1], cuts[1:])
            hashes, rows = np.concatenate([hashes, more]), np.concatenate([rows, np.array(at, dtype=rows.dtype)])
        changed = [r for r, s, t in zip(at, seen, restored) if s != t]
        return hashes, rows, np.bincount(np.array(changed, dtype=np.int64), minlength=len(offsets) - 1)


@dataclass
class Scorer:
    """Word weights by hash, and the logistic curve over their sum."""

    hashes: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    bias: float = 0.0

    def __post_init__(self):
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def sums(self, hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        maybe = self.gate[(hashes >> np.uint64(48)).astype(np.int64)]
        hashes, rows = hashes[maybe], rows[maybe]
        if not len(hashes) or not len(self.hashes):
            return np.zeros(n_rows)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes
        pairs = np.unique(np.stack([rows[hit].astype(np.int64), at[hit]]), axis=1)  # a word counts once a document
        # bincount of no pairs counts in integers, weights or not
        return np.bincount(pairs[0], weights=self.weights[pairs[1]], minlength=n_rows).astype(float)

    def probability(self, sums: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * sums + self.bias, -50, 50)))


#: Least lower bound of the log likelihood ratio of a listed word.
LISTED = 1.5


def _bound(a, b, n_toxic: int, n_clean: int, log, sqrt):
    """Lower bound of the log likelihood ratio of words in ``a`` toxic and ``b`` clean documents."""
    return log(a / (n_toxic + 1)) - log(b / (n_clean + 1)) - 1.5 * sqrt(1 / a + 1 / b)


def _weights(rows: list, toxic: str, clean: str, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Listed words and their weights: those of at least two toxic documents whose bound reaches ``LISTED``."""
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0)
    h = np.array([r["hash"] for r in rows], dtype=np.int64).view(np.uint64)
    a = np.array([r[toxic] for r in rows], dtype=float) + 0.5
    b = np.array([r[clean] for r in rows], dtype=float) + 0.5
    low = _bound(a, b, n_toxic, n_clean, np.log, np.sqrt)
    use = (low >= LISTED) & (a > 2)
    order = np.argsort(h[use])
    return h[use][order], low[use][order]


def character_model(docs: DataFrame, lost: float = LOST) -> CharacterModel:
    """Trigram counts over all words of letters of all ``docs`` (text), but for the rarest, which hold at most ``lost`` of them."""

    def run(batches):
        total: Counter = Counter()
        for _, data, offsets in steps(batches, 0):
            low = lowered(data)
            begin, close, _, _, _ = word_table(low, offsets)
            pure = _within(_LETTER[low], begin, close) == close - begin
            if not pure.any():
                continue
            hashes, at, often = np.unique(RollingHash(low).of(begin[pure], close[pure]), return_index=True, return_counts=True)
            raw = low.tobytes()
            for a, b, n in zip(begin[pure][at].tolist(), close[pure][at].tolist(), often.tolist()):
                total[raw[a:b]] += n
            if len(total) > REMEMBERED:
                yield _trigrams(total)
                total.clear()
        yield _trigrams(total)

    counts = stored(map_arrow(docs.select("text"), run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "trigrams")
    least = _least_kept(counts, lost)
    grams: Counter = Counter()
    for r in counts.where(F.col("n") >= least).collect():  # an alphabet's trigrams, whatever the size of the corpus
        grams[r["gram"]] = r["n"]
        grams[r["gram"][1:]] += r["n"]
        grams[r["gram"][2:]] += r["n"]
    return CharacterModel(dict(grams))


def _trigrams(words: Counter) -> pa.RecordBatch:
    grams: Counter = Counter()
    for word, n in words.items():
        padded = "  " + word.decode("utf-8", "replace") + " "
        for i in range(2, len(padded)):
            grams[padded[i - 2 : i + 1]] += n
    return pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], names=["gram", "n"])


def _least_kept(counts: DataFrame, lost: float) -> int:
    """The largest power of two so that all rarer rows of ``counts`` (n) hold at most ``lost`` of the sum."""
    grades = counts.groupBy(F.floor(F.log2("n")).alias("g")).agg(F.sum("n").alias("n")).orderBy("g").collect()
    total, below = sum(r["n"] for r in grades), 0
    for r in grades:
        below += r["n"]
        if below > lost * total:
            return 1 << int(r["g"])
    return 1


def usual_words(sample: DataFrame, documents: int = KNOWN_IN) -> np.ndarray:
    """Sorted hashes of the words with a doubled letter that ``documents`` of the sample hold."""

    def run(batches):
        for _, data, offsets in steps(batches, 0):
            low = lowered(data)
            begin, close, row, _, _ = word_table(low, offsets)
            some = _within(_repeats(low, 2), np.minimum(begin + 1, close), close) > 0
            pairs = np.unique(np.stack([row[some].astype(np.uint64), RollingHash(low).of(begin[some], close[some])]), axis=1)
            hashes, n = np.unique(pairs[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

    counts = map_arrow(sample.select("text"), run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= documents).select("hash").collect()  # bounded by the sample
    return np.sort(np.array([r["hash"] for r in found], dtype=np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS) -> tuple[CharacterModel, Scorer]:
    """``docs`` (doc_id, text) of the training fold, all of them in the character model, and ``labels`` (doc_id, label 0/1)."""
    known = labels.where("label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = smallest_hashes(known, ["doc_id"], max_documents)  # at most ``max_documents`` ids are sent to all
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).cast("int")
    sample = stored(docs.join(F.broadcast(chosen), "doc_id").select("text", F.col("label").cast("int").alias("label"), half.alias("half")), "toxicity-sample")
    model = character_model(docs)
    model.usual = usual_words(sample)

    def count(batches):
        restorer = Restorer(model)
        for rows, data, offsets in steps(batches, 0):
            hashes, own, _ = restorer.words(data, offsets)
            pairs = np.unique(np.stack([own.astype(np.uint64), hashes]), axis=1)
            cell = np.array(rows.column(1).to_pylist()) * 2 + np.array(rows.column(2).to_pylist())
            distinct, at = np.unique(pairs[1], return_inverse=True)
            table_ = np.bincount(at * 4 + cell[pairs[0].astype(np.int64)], minlength=4 * len(distinct)).reshape(-1, 4)
            columns = [pa.array(np.ascontiguousarray(table_[:, i]), pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), *columns], names=["hash", "c0", "c1", "t0", "t1"])

    words = map_arrow(sample, count, "hash long, c0 long, c1 long, t0 long, t1 long").groupBy("hash")
    words = words.agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "t0", "t1")])
    words = words.withColumns({"t": F.col("t0") + F.col("t1"), "c": F.col("c0") + F.col("c1")}).where("t > 1")
    sizes = {(r["label"], r["half"]): r["n"] for r in sample.groupBy("label", "half").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = lambda label, *halves: sum(sizes.get((label, h), 0) for h in halves)
    if not n(1, 0, 1) or not n(0, 0, 1):
        return model, Scorer(np.zeros(0, np.uint64), np.zeros(0), 1.0, -50.0 if not n(1, 0, 1) else 50.0)
    sums = {"": (n(1, 0, 1), n(0, 0, 1)), "0": (n(1, 0), n(0, 0)), "1": (n(1, 1), n(0, 1))}
    bound = [_bound(F.col(f"t{h}") + 0.5, F.col(f"c{h}") + 0.5, *sizes_, F.log, F.sqrt) >= LISTED for h, sizes_ in sums.items()]
    rows = words.where(bound[0] | bound[1] | bound[2]).collect()  # words listed for the sample or a half of it
    halves = [Scorer(*_weights(rows, f"t{h}", f"c{h}", n(1, h), n(0, h))) for h in (0, 1)]

    def measure(batches):
        restorer = Restorer(model)
        for rows_, data, offsets in steps(batches, 0):
            hashes, own, _ = restorer.words(data, offsets)
            sums = np.stack([s.sums(hashes, own, len(offsets) - 1) for s in halves])
            half_ = np.array(rows_.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([rows_.column(1), pa.array(sums[1 - half_, np.arange(len(half_))], pa.float64())], names=["label", "total"])

    seen = sorted((r["label"], r["total"]) for r in map_arrow(sample, measure, "label int, total double").collect())
    slope, bias = _logistic(np.array([x for _, x in seen]), np.array([y for y, _ in seen], dtype=float))
    full = Scorer(*_weights(rows, "t", "c", n(1, 0, 1), n(0, 0, 1)), slope, bias)
    return model, full


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a lightly regularised logistic curve (Newton steps)."""
    a = np.array([0.5, -2.0])
    design = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        slope = design.T @ (y - p) - 0.1 * a
        curve = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        a = a + np.clip(step, -1, 1)
    return float(max(a[0], 0.0)), float(a[1])


def score(docs: DataFrame, model: CharacterModel, scorer: Scorer, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``n_restored`` (words that decoding changed)."""

    def make():
        restorer = Restorer(model)

        def step(rows, data, offsets):
            n = len(offsets) - 1
            hashes, own, changed = restorer.words(data, offsets)
            return [scorer.probability(scorer.sums(hashes, own, n)), changed]

        return step

    return annotated(docs, text, T.StructType().add("score", "double").add("n_restored", "long"), make)


def restore_text(docs: DataFrame, model: CharacterModel, text: str = "text") -> DataFrame:
    """``docs`` with ``restored``: its words in lower case, hidden ones restored, joined by blanks."""

    def make():
        restorer = Restorer(model)

        def step(rows, data, offsets):
            low = lowered(data)
            begin, close, row, suspicious, runs = word_table(low, offsets, model.usual)
            run_of = {a: b for a, b in runs}
            out: list[list[str]] = [[] for _ in range(len(offsets) - 1)]
            i = 0
            while i < len(begin):
                until = run_of.get(i, i + 1)
                word = "".join(low[begin[j] : close[j]].tobytes().decode("utf-8", "replace") for j in range(i, until))
                out[row[i]].append(restorer.restore(word) if suspicious[i] or until > i + 1 else word)
                i = until
            return [[" ".join(words) for words in out]]

        return step

    return annotated(docs, text, T.StructType().add("restored", "string"), make)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where(fold("doc_id", 4) != 2)
    model, scorer = train(docs.where(fold("doc_id", 4) != 2), labels)
    out = score(docs.withColumn("held_out", fold("doc_id", 4) == 2), model, scorer)
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "n_restored")
