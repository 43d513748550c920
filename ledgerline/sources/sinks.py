"""Sinks (S5-S8) and typed reads of written results (S3).

Splits become partition directories of one table instead of four copies, so
readers of one split get partition pruning for free.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), order_by: Sequence[str] = ()
) -> str:
    """Overwrite a result table (parquet, or CSV with a header) at the caller's ``path``.

    With ``order_by`` (T1) the files together are sorted: a range-partitioned sort, not one task.
    """
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def save_processed_dataset(dataset: DataFrame, path: str) -> str:
    """The modeling dataset, one directory per split."""
    return write_table(dataset, path, "parquet", ["split"])


def read_split(spark: SparkSession, path: str, *splits: str) -> DataFrame:
    """Read chosen splits back; the filter prunes partition directories."""
    df = spark.read.parquet(path)
    return df.where(df["split"].isin(list(splits))) if splits else df


def read_result(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """S3: typed read of a written result table (explicit schema for CSV)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)
