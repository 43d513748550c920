"""Indicators of many levels."""

from pyspark.sql import functions as F

from given import SF001
from ledgerline import catalog as C
from ledgerline.operators import levels as LV
from ledgerline.operators import prepare as PR


def test_many_levels_are_numbered_in_order(spark):
    df = spark.range(30_000).select(F.format_string("e%06d", F.col("id") * 7919 % 10_000).alias("k"))
    got = LV.level_table(df, "k", range_rows=500)
    assert got.count() == 10_000
    assert got.where(F.col("level") != F.format_string("e%06d", "place")).count() == 0


def test_null_unknown_and_empty_levels(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("z", 4), ("a", 5)], "k string, place int")
    levels = LV.level_table(df.where("k is null or k < 'c'"), "k")
    rows = {r["place"]: tuple(r["indicators"]) for r in LV.with_indicators(df, "k", levels).collect()}
    assert rows == {1: (2, [1], [1.0]), 2: (2, [0], [1.0]), 3: (2, [], []), 4: (2, [], []), 5: (2, [0], [1.0])}
    none = LV.level_table(df.limit(0), "k")
    assert none.count() == 0 and LV.with_indicators(df, "k", none).where("size(indicators.indices) > 0").count() == 0


def test_preparation_beyond_the_dense_levels(spark):
    panel = C.feature_panel(spark, SF001)
    dense, sparse = PR.prepare(panel), PR.prepare(panel, dense_levels=2)
    names = [c for c in dense.features if c.startswith("index_")]
    assert len(names) == 3 and sparse.features == [c for c in dense.features if c not in names]
    wide = dense.panel.df.select("index_name", "Date", F.array(*names).alias("one"))
    both = wide.join(sparse.panel.df.select("index_name", "Date", "index_indicators"), ["index_name", "Date"])
    assert both.count() == wide.count()
    assert both.where((F.col("index_indicators.size") != 3) | (F.col("one")[F.col("index_indicators.indices")[0].cast("int")] != 1)).count() == 0
