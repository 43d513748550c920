"""URL filter: explicit host and path rules first, else logistic regression.

Features are hashed character n-grams (lengths 3 to 5) of host and path, each
field with its own hash seed, weighted by their share of the URL's n-grams.  The model is
fitted on the driver on a small labelled URL table of at most
``MAX_LABELLED`` rows, with a fixed number of full gradient steps from zero, so
the same table always gives the same weights.

A rule ``host/path`` fits its host and all subdomains when the URL's path
starts with the rule's path; the longest fitting rule decides.  Null URLs, and
URLs without ``://``, have an empty host and path: no rule fits and the model sees
no n-gram, so they are allowed.  Rows are independent; repeated rows repeat
their verdict, an empty table gives an empty result, and other columns pass
through unless they have the name of an added column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import RollingHash, annotated, table

MAX_LABELLED = 10_000
MAX_RULES = 1_000
DIMENSIONS = 1 << 16
LENGTHS = (3, 4, 5)

#: Rule text and its verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

_UNWANTED = (
    "cheap-pills discount-pharmacy free-bets casino-bonus best-casino online-poker sexy-cams adult-dating xxx-video "
    "payday-loan quick-loans replica-watches win-money free-gift crack-download keygen-serial torrent-warez miracle-diet "
    "buy-followers hot-singles"
).split()
_WANTED = (
    "news library museum university archive weather gardens cooking history science travel music theatre football "
    "nature school medicine software forum journal northern southern others thesis theory thread health earth author method "
    "marathon mathematics anthem threshold question station nation section reading writing"
).split()


def default_labels() -> list[tuple[str, int]]:
    """The small labelled table: URLs of unwanted (1) and wanted (0) kinds of hosts and paths."""
    out = []
    for label, names in ((1, _UNWANTED), (0, _WANTED)):
        for i, name in enumerate(names):
            top = ("com", "org", "info")[i % 3]
            lang = ("en", "de", "fr", "es")[i % 4]
            out.append((f"https://www.{name}.example.{top}/{lang}/{100 + 37 * i}.html", label))
            out.append((f"http://{('m', 'blog', 'shop')[i % 3]}.{name}.example.com/{lang}/{200 + 31 * i}/", label))
            out.append((f"https://www.{_WANTED[(i + 3) % len(_WANTED)]}.example.com/{lang}/{name}", label))
    return out


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_columns(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    chosen = verdict = F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, tail = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + tail))
        chosen = F.when(fits, F.lit(text)).otherwise(chosen)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return chosen, verdict


def features(data: np.ndarray, offsets: np.ndarray, field: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed n-gram of every n-gram of a field of all rows."""
    rows, codes = [], []
    hashed = RollingHash(data)
    for k in LENGTHS:
        found = hashed.windows(k)
        if not len(found):
            continue
        at = np.arange(len(found))
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + k <= offsets[row + 1]
        rows.append(row[inside])
        salt = np.uint64(0x632BE59BD9B4E019 * (2 * k + field) % (1 << 64))
        codes.append(((found[inside] ^ salt) % np.uint64(DIMENSIONS)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(codes)


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability of "block"; exactly 0 for a URL without any n-gram."""
        rows, codes = _both(hosts, paths)
        counts = np.bincount(rows, minlength=len(hosts))
        total = np.bincount(rows, weights=self.weights[codes], minlength=len(hosts)) / np.maximum(counts, 1)
        return np.where(counts > 0, 1.0 / (1.0 + np.exp(-np.clip(total + self.bias, -50, 50))), 0.0)


def _both(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    found = [features(*_flat(texts), field) for field, texts in enumerate((hosts, paths))]
    return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])


def fit(hosts: list[str], paths: list[str], labels: list[int], rounds: int = 400, rate: float = 400.0, decay: float = 1e-6) -> Model:
    if len(labels) > MAX_LABELLED:
        raise ValueError(f"the labelled table may have {MAX_LABELLED} rows at most")
    rows, codes = _both(hosts, paths)
    y = np.array(labels, dtype=float)
    share = 1.0 / np.maximum(np.bincount(rows, minlength=len(y)), 1)[rows]
    weights, bias = np.zeros(DIMENSIONS), 0.0
    for _ in range(rounds if len(y) else 0):
        z = np.bincount(rows, weights=weights[codes] * share, minlength=len(y)) + bias
        error = 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))) - y
        weights -= rate * (np.bincount(codes, weights=error[rows] * share, minlength=DIMENSIONS) / len(y) + decay * weights)
        bias -= 0.5 * error.mean()
    return Model(weights, bias)


def train(spark: SparkSession, labelled: DataFrame | None = None) -> Model:
    """Fit on ``labelled`` (url, label 0/1), by default on ``default_labels``; rows with a null are left out."""
    if labelled is None:
        labelled = spark.createDataFrame(default_labels(), "url string, label int")
    host, path = parts(F.col("url"))
    rows = labelled.where("url is not null and label is not null").select(host.alias("host"), path.alias("path"), "label").limit(MAX_LABELLED + 1).collect()
    rows = sorted((r["host"], r["path"], r["label"]) for r in rows)
    return fit([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])


def judge(pages: DataFrame, model: Model, rules: Sequence[tuple[str, str]] = RULES, url: str = "url", limit: float = 0.6) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``url_score`` and ``verdict``."""
    host, path = parts(F.col(url))
    df = pages.withColumns({"host": host, "path": path})
    rule, decided = rule_columns(rules, F.col("host"), F.col("path"))
    df = df.withColumns({"rule": rule, "_decided": decided})

    def make():
        def step(rows, data, offsets):
            names = rows.schema.names
            return [model.scores(rows.column(names.index("host")).to_pylist(), rows.column(names.index("path")).to_pylist())]

        return step

    scored = annotated(df, "host", T.StructType().add("url_score", "double"), make)
    verdict = F.coalesce("_decided", F.when(F.col("url_score") >= limit, F.lit("block")).otherwise(F.lit("allow")))
    return scored.withColumn("verdict", verdict).drop("_decided")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "pages").select("page_id", "url"), train(spark))
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("url_score", 6).alias("url_score"))
