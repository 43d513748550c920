"""Scans of the input tables.

Every reader selects only the columns it needs so the parquet scan's
``ReadSchema`` stays narrow, and leaves filters to Catalyst for pushdown.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """Typed CSV scan.

    An explicit schema is required: CSV inference types an all-empty column
    as string, which would silently drop it from numeric feature selection.
    """
    return spark.read.schema(schema).option("header", header).csv(path)
