"""Fixtures shared by the tests of the training-data operators."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Extra columns whose names clash with names that operators use inside or add.
EXTRA = ["node", "row", "component", "kept", "n_words", "score", "_text", "doc", "salt", "label"]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())] + [T.StructField(c, T.StringType()) for c in EXTRA])


def frame(spark, rows):
    """A documents table of (doc_id, text) or (doc_id, text, lang) with the extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", *[f"{c}-{r[0]}" for c in EXTRA]) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary):03d}" for _ in range(n))


def awkward(rng=None):
    """Null and empty texts, a null id, repeated rows, equal texts, blanks only and a long text."""
    rng = rng or random.Random(5)
    same = words(rng, 60)
    return [(1, same), (2, None), (3, ""), (None, words(rng, 40)), (4, same), (4, same), (5, " \n\t "), (6, words(rng, 30_000)), (7, "é" * 500), (8, "a b")]
