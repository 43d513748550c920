"""Language identification by rank-order n-gram profiles.

Texts become sequences of lower-case letters with one boundary mark between
words.  For every language the n-grams of length 1 to 3 of all its training
documents are counted on Spark; its profile is the ranking of the most frequent
ones.  A document's own most frequent n-grams are ranked the same way, and the
out-of-place distance to a profile is the sum of the rank differences, an
n-gram that the profile lacks counting as the profile's length.  The language
with the smallest distance wins, the first by name on a tie.

Letters are a to z and, for all others, ``letters - 27`` hashed classes (code point modulo), so
no alphabet has to be learned.  A document's n-grams are ranked within the
union of the languages' ``vocabulary`` most frequent n-grams.

Null texts and texts without a letter get ``und`` and score 0, as do all texts
when nothing was learned.  Rows are independent; an empty table gives an empty
result; other columns pass through unless they have the name of an added column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import annotated, fold, map_arrow, steps, table

LETTERS = 128
UNDECIDED = "und"

_CLASSES: list[np.ndarray] = []


def letter_classes() -> np.ndarray:
    """0 for every code point that is no letter, else the class of its lower case."""
    if not _CLASSES:
        out = np.zeros(0x110000, dtype=np.int32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = ord(c.lower()[0])
                out[cp] = low - 96 if 97 <= low <= 122 else 27 + low % (LETTERS - 27)
        _CLASSES.append(out)
    return _CLASSES[0]


def ngram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all 1- to 3-grams, the row each is in, and whether each row has a letter.

    Boundary marks are 0; a gram is a number to base ``LETTERS`` plus an offset by its length.
    """
    n_rows = len(offsets) - 1
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    classes = letter_classes()[points]
    row = np.repeat(np.arange(n_rows, dtype=np.int32), np.diff(ends))
    # one boundary mark on either side of every run of letters, none doubled
    letter = classes > 0
    first = np.zeros(len(row), dtype=bool)
    first[ends[:-1][ends[:-1] < ends[1:]]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~first[1:]
    chars, own, start = classes[keep], row[keep], first[keep]
    # a row that begins or ends with a letter gets its mark as well
    begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    chars = np.insert(chars, begins, 0)
    own = np.insert(own, begins, own[begins])
    lasts = np.flatnonzero(np.concatenate([own[1:] != own[:-1], [True]])) if len(own) else np.zeros(0, np.int64)
    lasts = lasts[chars[lasts] > 0]
    chars = np.insert(chars, lasts + 1, 0)
    own = np.insert(own, lasts + 1, own[lasts])
    one = chars > 0
    two = (own[1:] == own[:-1]) if len(own) > 1 else np.zeros(0, bool)
    three = (own[2:] == own[:-2]) if len(own) > 2 else np.zeros(0, bool)
    pair = chars[:-1] * LETTERS + chars[1:] if len(own) > 1 else np.zeros(0, np.int32)
    triple = pair[:-1] * LETTERS + chars[2:] if len(own) > 2 else np.zeros(0, np.int32)
    three = three & (chars[1:-1] > 0) if len(own) > 2 else three  # no gram with a mark inside
    codes = np.concatenate([chars[one], pair[two] + LETTERS, triple[three] + LETTERS + LETTERS**2])
    rows = np.concatenate([own[one], own[:-1][two] if len(own) > 1 else own[:0], own[:-2][three] if len(own) > 2 else own[:0]])
    has_letter = np.zeros(n_rows, dtype=bool)
    has_letter[own[one]] = True
    return codes, rows, has_letter


N_CODES = LETTERS + LETTERS**2 + LETTERS**3


def count_ngrams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, code, n) over all rows with a language; every task sends each pair once or a few times."""

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def flush():
            for name, counts in held.items():
                found = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(counts[found])], names=["lang", "code", "n"]
                )
            held.clear()

        for rows, data, offsets in steps(batches, 0):
            langs = rows.column(1).to_pylist()
            codes, own, _ = ngram_codes(data, offsets)
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs], dtype=np.int32)[own]
            for i, name in enumerate(names):
                if name not in held:
                    if len(held) >= 8:
                        yield from flush()
                    held[name] = np.zeros(N_CODES, dtype=np.int64)
                held[name] += np.bincount(codes[number == i], minlength=N_CODES)
        yield from flush()

    some = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null and text is not null")
    return map_arrow(some, run, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Profiles:
    """Ranked n-grams of each language."""

    def __init__(self, ranked: list[tuple[str, int, int]], length: int):
        self.length = length
        self.languages = sorted({lang for lang, _, _ in ranked})
        self.codes = np.array(sorted({code for _, code, _ in ranked}), dtype=np.int32)
        self.rank = np.full((len(self.languages), len(self.codes)), length, dtype=np.int32)
        for lang, code, rank in ranked:
            if rank < length:
                self.rank[self.languages.index(lang), np.searchsorted(self.codes, code)] = rank

    def distances(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x languages) out-of-place distances in 0 to 1, and whether each row has a letter."""
        n_rows, size = len(offsets) - 1, len(self.codes)
        codes, own, has_letter = ngram_codes(data, offsets)
        place = np.full(N_CODES, -1, dtype=np.int32) if not hasattr(self, "_place") else self._place
        if not hasattr(self, "_place"):
            place[self.codes] = np.arange(size)
            self._place = place
        at = place[codes]
        known = at >= 0
        counts = np.bincount(own[known].astype(np.int64) * size + at[known], minlength=n_rows * size).reshape(n_rows, size)
        top = min(self.length, size)
        key = counts * size + np.arange(size - 1, -1, -1)  # ties: the smaller code first
        best = np.argpartition(-key, top - 1, axis=1)[:, :top]
        order = np.argsort(-np.take_along_axis(key, best, axis=1), axis=1)
        best = np.take_along_axis(best, order, axis=1)
        present = np.take_along_axis(counts, best, axis=1) > 0
        place_of = np.arange(top)
        out = np.ones((n_rows, len(self.languages)))
        weight = np.maximum(present.sum(axis=1), 1) * self.length
        for i in range(len(self.languages)):
            listed = self.rank[i][best]
            apart = np.where(listed < self.length, np.abs(listed - place_of), self.length)
            out[:, i] = (apart * present).sum(axis=1) / weight
        out[present.sum(axis=1) == 0] = 1.0
        return out, has_letter


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", length: int = 300, vocabulary: int = 1000) -> Profiles:
    """Profiles from every row of ``docs`` with a text and a language.

    The driver receives ``vocabulary`` n-grams a language, nothing that grows with the rows.
    """
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    ranked = count_ngrams(docs, text, lang).withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < vocabulary)
    return Profiles([(r["lang"], r["code"], r["rank"]) for r in ranked.select("lang", "code", "rank").collect()], length)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (1 - distance of the nearest profile)."""

    def make():
        def step(rows, data, offsets):
            n = len(offsets) - 1
            if not profiles.languages:
                return [[UNDECIDED] * n, np.zeros(n)]
            distance, has_letter = profiles.distances(data, offsets)
            nearest = distance.argmin(axis=1)
            names = [profiles.languages[i] if ok else UNDECIDED for i, ok in zip(nearest, has_letter)]
            return [names, np.where(has_letter, np.clip(1.0 - distance.min(axis=1), 0.0, 1.0), 0.0)]

        return step

    return annotated(docs, text, T.StructType().add("lang_pred", "string").add("score", "double"), make, max_rows=512)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = fold("doc_id", 3)
    profiles = fit(docs.where(remainder != 1).select("text", "lang"))
    out = predict(docs.select("doc_id", (remainder == 1).alias("held_out"), "text"), profiles)
    return out.select("doc_id", "held_out", "lang_pred", "score")
