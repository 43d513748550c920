"""Indicator columns of a category with many levels (P10): a sorted level table and a sparse vector beside the dense features.

Nothing is collected: the levels are numbered in ranges of rows, and the table is joined to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans import series as S


def level_table(df: DataFrame, column: str, range_rows: int | None = None) -> DataFrame:
    """(level, place): the distinct non-null values in ascending order, numbered from 0."""
    levels = df.where(F.col(column).isNotNull()).select(F.col(column).alias("level")).distinct()
    numbered, _ = S.with_ordinal(levels, [], "level", range_rows=range_rows)
    return numbered.select("level", F.col(S.ORD).alias("place"))


def with_indicators(df: DataFrame, column: str, levels: DataFrame, out: str = "indicators") -> DataFrame:
    """``df`` with ``out`` = (size, indices, values): 1.0 at the place of the row's level; empty for null and unknown levels.

    ``size`` is the number of levels, so rows of any split share one space.  Columns of ``df`` named like the table's are kept.
    """
    table = levels.select(F.col("level").alias("_level"), F.col("place").alias("_place"))
    size = levels.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    joined = df.join(table, df[column] == F.col("_level"), "left")
    known = F.col("_place").isNotNull()
    vector = F.struct(
        F.lit(size).cast("long").alias("size"),
        F.when(known, F.array("_place")).otherwise(F.array().cast("array<bigint>")).alias("indices"),
        F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )
    return joined.withColumn(out, vector).drop("_level", "_place")
