"""Quality rules by distribution divergence, in DataFrame functions only.

A document is compared with per-language references by two histograms:

* character classes: upper case, other letters, digits, white space, symbols
  ``#*$%&|<>`` and everything else;
* common words: one bin for the listed function words of each language, one for all other words.

The references are the summed histograms of all documents of each language, character classes for every value of
``lang`` in the data, common words for the languages whose words are listed.
The divergence is the Jensen-Shannon distance (square root of the divergence
to base 2, 0 to 1).  A document passes when, for at least one listed language, both
distances are within their limits.  A document whose ``lang`` is not listed also passes when its character classes are within
the limit of its own language's reference: there is no reference to hold its words against.  A test only applies from a minimum length
on; shorter texts are never rejected by it.

Null texts count as empty: all counts 0, rejected by the base rule.  Rows are
judged one by one, so repeated rows repeat their result; an empty table gives
an empty result; other columns of the input pass through ``annotate`` as they are,
unless they carry the name of a column it adds, whose values then replace them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in is that for it was on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec ou son lui nous aux elle mais cette ses être leur fait".split(),
    "es": "de la que el en y los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta".split(),
}
CHARACTER_CLASSES = ("upper", "letter", "digit", "space", "symbol", "other")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; the defaults are the production values."""

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    min_chars_for_classes: int = 100
    max_class_distance: float = 0.25
    min_words_for_common: int = 50
    #: Halfway between the widest labelled clean text of 50 words and more (0.196 on sf0.1) and a text
    #: without any listed word (0.339 from the nearest reference there).
    max_common_distance: float = 0.27
    languages: tuple[str, ...] = field(default=tuple(COMMON_WORDS))


def _rest(text: Column, pattern: str) -> Column:
    """Characters of ``text`` that ``pattern`` matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def _hits_of(listed: list[str]) -> Column:
    return F.size(F.filter("_hits", lambda w: w.isin(listed))).cast("long")


def histograms(df: DataFrame, text: str, rules: Rules) -> DataFrame:
    """Adds ``_words``, ``n_words``, ``word_chars``, ``n_symbols``, ``_classes`` and ``_common``."""
    every = sorted({w for lang in rules.languages for w in COMMON_WORDS[lang]})
    col = F.col(text)
    df = df.withColumn("_words", _words(col))
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.concat_ws("", "_words")).cast("long"),
            "n_symbols": _rest(col, SYMBOLS).cast("long"),
            "_upper": _rest(col, r"\p{Lu}+").cast("long"),
            "_letters": _rest(col, r"\p{L}+").cast("long"),
            "_digit": _rest(col, r"\p{Nd}+").cast("long"),
            "_chars": F.length(col).cast("long"),
            "_hits": F.filter("_words", lambda w: w.isin(every)),
        }
    )
    space = F.col("_chars") - F.col("word_chars")
    known = [F.col("_upper"), F.col("_letters") - F.col("_upper"), F.col("_digit"), space, F.col("n_symbols")]
    other = F.col("_chars") - F.col("_letters") - F.col("_digit") - space - F.col("n_symbols")
    counts = [_hits_of(COMMON_WORDS[lang]) for lang in rules.languages]
    return df.withColumns(
        {
            "_classes": F.array(*known, other),
            "_common": F.array(*counts, F.col("n_words") - F.size("_hits")),
        }
    ).drop("_upper", "_letters", "_digit", "_hits")


def _shares(row, name: str, n: int) -> list[float]:
    own = [max(row[f"{name}{i}"] or 0, 0) for i in range(n)]
    return [x / sum(own) for x in own] if sum(own) else []


def references(docs: DataFrame, text: str, lang: str, rules: Rules) -> tuple[dict[str, tuple[list[float], list[float]]], dict[str, list[float]]]:
    """Shares of the bins over all documents: both histograms of the listed languages, character classes of the others.

    The driver receives one small row a language.
    """
    base = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"), F.col(lang).alias("_lang"))
    base = histograms(base.where(F.col("_lang").isNotNull()), "_text", rules)
    n_classes, n_common = len(CHARACTER_CLASSES), len(rules.languages) + 1
    sums = [F.sum(F.col("_classes")[i]).alias(f"a{i}") for i in range(n_classes)]
    sums += [F.sum(F.col("_common")[i]).alias(f"b{i}") for i in range(n_common)]
    listed, others = {}, {}
    for row in base.groupBy("_lang").agg(*sums).collect():
        classes, common = _shares(row, "a", n_classes), _shares(row, "b", n_common)
        if row["_lang"] in rules.languages:
            if classes and common:
                listed[row["_lang"]] = (classes, common)
        elif classes:
            others[row["_lang"]] = classes
    return dict(sorted(listed.items())), dict(sorted(others.items()))


def _distance(counts: str, total: Column, reference: list[float] | Column) -> Column:
    """Jensen-Shannon distance of ``counts`` / ``total`` and the shares ``reference`` (of as many character classes, if a column)."""
    parts = F.lit(0.0)
    for i in range(len(CHARACTER_CLASSES) if isinstance(reference, Column) else len(reference)):
        p = F.col(counts)[i] / total
        q = F.get(reference, F.lit(i)) if isinstance(reference, Column) else F.lit(reference[i])
        middle = (p + q) / 2
        parts = parts + F.when(p > 0, p * F.log2(p / middle)).otherwise(F.lit(0.0)) / 2
        parts = parts + F.when(q > 0, q * F.log2(q / middle)).otherwise(F.lit(0.0)) / 2
    return F.sqrt(F.greatest(parts, F.lit(0.0)))


def annotate(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with counts, distances and ``kept``; one pass for the references, one for the rows."""
    refs, others = references(docs, text, lang, rules)
    own = F.lit(None).cast("array<double>")
    if others:
        entries = [x for name, shares in others.items() for x in (F.lit(name), F.array(*[F.lit(q) for q in shares]))]
        own = F.try_element_at(F.create_map(*entries), F.col(lang))
    df = docs.withColumns({"_text": F.coalesce(F.col(text), F.lit("")), "_own": own})
    df = histograms(df, "_text", rules)
    k = rules.window
    df = df.withColumns(
        {
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_words")
    windows = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - k),
        lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + j) for j in range(k)]),
    )
    df = df.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(F.col("n_words") > k, windows).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_lines", "_hashes")
    df = df.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("_windows")
    same = lambda e, at: F.coalesce(F.get(F.col("_sorted"), at)["h"] == e["h"], F.lit(False))
    repeated = F.filter("_sorted", lambda e, i: same(e, i - 1) | same(e, i + 1))
    df = df.withColumn("_at", F.sort_array(F.transform(repeated, lambda e: e["i"]))).drop("_sorted")
    covered = F.aggregate(
        F.transform("_at", lambda p, i: F.least(F.lit(k), F.coalesce(F.get(F.col("_at"), i + 1) - p, F.lit(k)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_at")
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    chars = F.greatest(F.col("_chars"), F.lit(1)).cast("double")
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    pairs = [F.struct(_distance("_classes", chars, a).alias("c"), _distance("_common", words, b).alias("w")) for a, b in refs.values()]
    df = df.withColumns({"base_failed": failed, "_near": F.array(*pairs) if pairs else F.array().cast("array<struct<c:double,w:double>>")})
    fits = lambda d: (
        ((F.col("_chars") < rules.min_chars_for_classes) | (d["c"] <= rules.max_class_distance))
        & ((F.col("n_words") < rules.min_words_for_common) | (d["w"] <= rules.max_common_distance))
    )
    method = F.exists("_near", fits) if pairs else F.lit(not others)
    if others:
        close = (F.col("_chars") < rules.min_chars_for_classes) | (_distance("_classes", chars, F.col("_own")) <= rules.max_class_distance)
        method = method | (F.col("_own").isNotNull() & close) | (F.lit(not pairs) & F.col("_own").isNull())
    return df.withColumns(
        {
            "class_distance": F.array_min(F.transform("_near", lambda d: d["c"])),
            "common_distance": F.array_min(F.transform("_near", lambda d: d["w"])),
            "kept": ~F.col("base_failed") & method,
        }
    ).drop("_text", "_own", "_classes", "_common", "_chars", "_near")


def keep(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs`` as they were, whatever their names."""
    names = docs.columns
    own = [f"_column{i}" for i in range(len(names))]
    judged = annotate(docs.toDF(*own), rules, own[names.index(text)], own[names.index(lang)])
    # a row number keeps the optimiser from moving the filter below the counts, where they would be computed over and over
    judged = judged.select(*own, "kept", F.monotonically_increasing_id().alias("_row"))
    return judged.where("kept and _row >= 0").select(*own).toDF(*names)


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = annotate(docs)
    return out.select(*RESULT, F.round("class_distance", 6).alias("class_distance"), F.round("common_distance", 6).alias("common_distance"))
