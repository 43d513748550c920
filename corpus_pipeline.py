"""Corpus preparation in five stages, each on all that the one before kept.

Every stage is written as Parquet to the shared folder and read again as the
next one's documents; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import op1_suffix_dedup, op2_decontaminate, op3_minhash_dedup, op7_quality_rules, op9_byte_bpe
from ledgerline.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return op7_quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id stays."""
    return op3_minhash_dedup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of strings of 200 bytes and more are cut out; ``n_chars`` follows the text."""
    out = op1_suffix_dedup.remove(docs)
    if "n_chars" in out.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return op2_decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    model = op9_byte_bpe.build_model(op9_byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return op9_byte_bpe.digests(docs.select("doc_id", "text"), model).drop("text")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("byte_pairs", byte_pairs),
]

#: Signatures, edit distances and merges can't be said in SQL; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
