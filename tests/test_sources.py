"""Many instrument files in one scan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import datasets as D
from ledgerline.sources.tables import read_csv

SCHEMA = "Date date, Price double"


def csv_files(folder, names):
    out = {}
    for i, name in enumerate(names):
        path = folder / f"{name}.csv"
        path.write_text("Date,Price\n" + "".join(f"{dt.date(2020, 1, 1) + dt.timedelta(days=d)},{100 + i + d}\n" for d in range(3)))
        out[name] = str(path)
    return out


def listed(df):
    return sorted((r["index_name"], r["Date"], r["Price"]) for r in df.select("index_name", "Date", "Price").collect())


def test_many_files_are_one_scan(spark, tmp_path):
    files = csv_files(tmp_path, [f"n {i}%20" for i in range(200)])
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = D.read_sources(spark, files, "csv", schema)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    each = [read_csv(spark, path, schema).withColumn("index_name", F.lit(name)) for name, path in list(files.items())[:3]]
    wanted = [x for df in each for x in listed(df)]
    got = listed(rows)
    assert len(got) == 600 and set(wanted) <= set(got) and len({g[0] for g in got}) == 200


def test_folders_patterns_repeated_and_nested_paths(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    outer = csv_files(tmp_path / "in", ["a", "b"])
    inner = csv_files(tmp_path / "in" / "deep", ["c"])
    schema = spark.createDataFrame([], SCHEMA).schema
    sources = {"one": outer["a"], "again": outer["a"], "both": f"file://{tmp_path}/in/*.csv", "inner": str(tmp_path / "in" / "deep")}
    counts = {r["index_name"]: r["count"] for r in D.read_sources(spark, sources, "csv", schema).groupBy("index_name").count().collect()}
    assert counts == {"one": 3, "again": 3, "both": 6, "inner": 3} and inner
    with pytest.raises(FileNotFoundError, match="no files of x"):
        D.read_sources(spark, {"x": str(tmp_path / "nothing.csv")}, "csv", schema)


def test_parquet_columns_are_merged_and_other_types_widened(spark, tmp_path):
    day = F.lit("2020-01-01").cast("date").alias("Date")
    spark.range(1).select(day, F.lit(1.0).alias("Price")).write.parquet(str(tmp_path / "a"))
    spark.range(1).select(day, F.lit(2.0).alias("Price"), F.lit(5).alias("extra")).write.parquet(str(tmp_path / "b"))
    spark.range(1).select(day, F.lit(3).alias("Price"), F.lit("own").alias("index_name")).write.parquet(str(tmp_path / "c"))
    two = {k: str(tmp_path / k) for k in "ab"}
    got = D.read_sources(spark, two, "parquet")
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {(r["index_name"], r["Price"], r["extra"]) for r in got.collect()} == {("a", 1.0, None), ("b", 2.0, 5)}
    three = D.read_sources(spark, {**two, "c": str(tmp_path / "c")}, "parquet")
    assert {(r["index_name"], r["Price"]) for r in three.collect()} == {("a", 1.0), ("b", 2.0), ("c", 3.0)}


def test_inferred_csv_files_may_have_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Price\n2020-01-01,1.5\n")
    (tmp_path / "b.csv").write_text("Price,Date\n2.5,2020-01-01\n")
    got = D.read_sources(spark, {k: str(tmp_path / f"{k}.csv") for k in "ab"}, "csv")
    assert {(r["index_name"], r["Price"]) for r in got.collect()} == {("a", 1.5), ("b", 2.5)}
