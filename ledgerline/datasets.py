"""Modeling datasets from one file per instrument."""

from __future__ import annotations

import re
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.columns import nan_to_null
from ledgerline.operators import features as FE
from ledgerline.operators import prepare as PR
from ledgerline.plans import series as S
from ledgerline.sources import panels as P
from ledgerline.sources.tables import read_csv

ENTITY, TIME = "index_name", "Date"
EMPTY_HOST = r"^(\w+):///"  # file:///x and file:/x are the same place
#: Conditions of files whose columns have the same name and different types.
MERGE_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def read_instrument(spark: SparkSession, path: str, fmt: str, schema: StructType | None = None) -> DataFrame:
    """One instrument's rows; CSV needs a header, and a schema or else its types are inferred."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt}")
    if schema is not None:
        return read_csv(spark, path, schema)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def _listed(spark: SparkSession, sources: dict[str, str]) -> list[tuple[str, str]]:
    """(URI of a file or folder, name) of every source; a pattern stands for all that it matches."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for name, path in sources.items():
        where = jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(conf)
        found = fs.globStatus(where)
        if not found:
            raise FileNotFoundError(f"no files of {name} at {path}")
        out += [(re.sub(EMPTY_HOST, r"\1:/", fs.makeQualified(status.getPath()).toUri().toString()), name) for status in found]
    return out


def scan_sources(spark: SparkSession, sources: dict[str, str], fmt: str, schema: StructType | None = None) -> DataFrame:
    """All sources ``{name: path}`` in one scan, each row with the name of its source: the plan does not grow with their number.

    A path is a file, a folder of files or a pattern.  Columns that some Parquet files lack are null there.  Two names of one path give
    its rows under both; of nested folders the inner one names a file.
    """
    listed = _listed(spark, sources)
    paths = sorted({unquote(path) for path, _ in listed})
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
        rows = reader.parquet(*paths)
    elif fmt == "csv" and schema is not None:
        rows = spark.read.schema(schema).option("header", True).csv(paths)
    else:
        raise ValueError("one scan takes Parquet, or CSV with a schema")
    kept = [F.col(c) for c in rows.columns if c != ENTITY]
    rows = rows.select(*kept, F.regexp_replace("_metadata.file_path", EMPTY_HOST, "$1:/").alias("_file"))
    deepest, small = [], sum(len(p) + len(n) for p, n in listed) <= S.BROADCAST_BOUND_BYTES
    for depth in sorted({p.count("/") for p, _ in listed}, reverse=True):  # one, or a few levels of folders
        names = spark.createDataFrame([(p, n) for p, n in listed if p.count("/") == depth], f"_at{depth} string, _name{depth} string")
        at = F.substring_index("_file", "/", depth + 1)
        rows = rows.join(F.broadcast(names) if small else names, at == F.col(f"_at{depth}"), "left").drop(f"_at{depth}")
        deepest.append(f"_name{depth}")
    name = F.coalesce(*deepest, F.raise_error(F.concat(F.lit("no source of "), F.col("_file"))).cast("string"))
    return rows.withColumn(ENTITY, name).drop("_file", *deepest)


def read_sources(spark: SparkSession, sources: dict[str, str], fmt: str, schema: StructType | None = None) -> DataFrame:
    """One scan where all files share a schema or can be merged; one each for CSV of inferred types (headers may differ) and for columns whose types differ."""
    if fmt == "parquet" or (fmt == "csv" and schema is not None):
        try:
            return scan_sources(spark, sources, fmt, schema)
        except (PySparkException, Py4JJavaError) as error:
            if not any(f"[{c}" in str(error) for c in MERGE_CONFLICTS):
                raise
    return P.union_sources({name: read_instrument(spark, path, fmt, schema) for name, path in sources.items()})


def checked_unique(df: DataFrame, keys: tuple[str, ...] = (ENTITY, TIME)) -> DataFrame:
    """``df``, or a ``ValueError`` that names a key with several rows: lags need one row per instrument and day."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").first()
    if twice is not None:
        raise ValueError(f"{twice['rows']} rows for {', '.join(f'{k}={twice[k]}' for k in keys)}")
    return df


def load_panel(
    spark: SparkSession,
    sources: dict[str, str],
    fmt: str = "csv",
    schema: StructType | None = None,
    block_rows: int = S.DEFAULT_BLOCK_ROWS,
) -> P.Panel:
    """Numbered panel of the instruments ``{name: path}``; rows without a date or price are dropped."""
    if not sources:
        raise ValueError("no instrument files")
    rows = read_sources(spark, sources, fmt, schema)
    rows = rows.withColumns({TIME: F.to_date(TIME), "Price": nan_to_null("Price")})
    rows = checked_unique(rows.where(F.col(TIME).isNotNull() & F.col("Price").isNotNull()))
    ordered, longest, entities = S.with_ordinal_info(rows, (ENTITY,), TIME, block_rows)
    return P.Panel(df=ordered, max_rows=longest, block_rows=block_rows, entities=entities)


def load_modeling_dataset(
    spark: SparkSession,
    sources: dict[str, str],
    dates: PR.SplitDates = PR.REFERENCE_SPLIT,
    fmt: str = "csv",
    schema: StructType | None = None,
) -> PR.Prepared:
    """The modeling dataset of the instruments ``{name: path}``: features, target, split, lag, imputation, dummies."""
    return PR.prepare(FE.price_features(load_panel(spark, sources, fmt, schema)), dates)
