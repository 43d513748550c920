"""Pipeline invariants on the sf0.001 tables (FIXTURES.md B6-B8) and the entry points."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from given import SF001
from ledgerline import catalog as C
from ledgerline.operators import prepare as PR


@pytest.fixture(scope="module")
def prep(spark):
    return C.prepared(spark, SF001)


def test_features_exclude_lookahead_and_have_no_nulls(prep):
    feats = prep.features
    assert not set(feats) & set(PR.LEAKAGE_COLUMNS)
    assert "price_vs_trailing_ema_20" in feats
    df = prep.panel.public()
    assert "mom" not in df.columns and "EMA_10" not in df.columns
    nulls = df.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in feats]).collect()[0]
    assert sum(nulls) == 0


def test_next_return_and_target_recompute_from_price(prep):
    pdf = prep.panel.public().select("index_name", "Date", "Price", "next_return", "target").toPandas()
    raw = C.feature_panel(prep.panel.df.sparkSession, SF001, planted_lookahead=True).df
    full = raw.select("index_name", "Date", "Price").toPandas().sort_values(["index_name", "Date"])
    full["nr"] = full.groupby("index_name")["Price"].shift(-1) / full["Price"] - 1
    m = pdf.merge(full, on=["index_name", "Date"])
    assert (abs(m["next_return"] - m["nr"]) < 1e-12).all()
    assert ((m["nr"] > 0).astype(int) == m["target"]).all()


def test_features_are_lagged_one_row(prep):
    spark = prep.panel.df.sparkSession
    raw = C.feature_panel(spark, SF001, planted_lookahead=True).df.select("index_name", "Date", "return_1d").toPandas()
    raw = raw.sort_values(["index_name", "Date"])
    raw["prev"] = raw.groupby("index_name")["return_1d"].shift(1)
    ds = prep.panel.public().select("index_name", "Date", "return_1d").toPandas()
    m = ds.merge(raw, on=["index_name", "Date"], suffixes=("", "_raw"))
    assert (abs(m["return_1d"] - m["prev"]) < 1e-15).all()


def test_rows_lost_per_instrument(prep):
    """60 head rows (60-row high + lag) and 1 tail row are dropped per instrument."""
    spark = prep.panel.df.sparkSession
    raw = C.feature_panel(spark, SF001, planted_lookahead=True).df.groupBy("index_name").count()
    kept = prep.panel.public().groupBy("index_name").count()
    diff = raw.join(kept, "index_name").select((raw["count"] - kept["count"]).alias("d")).collect()
    assert {r.d for r in diff} == {61}


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0 and "sharpe_ratio" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert {"train_report", "evaluate_saved", "model_backtest"} <= set(qs) - set(sql)


@pytest.mark.parametrize(
    "name", ["trailing_returns", "trailing_ema", "modeling_dataset", "strategy_metrics", "classification_metrics", "roc_auc"]
)
def test_queries_match_duckdb(spark, name):
    import duckdb

    import __spark_entry__ as E
    from ledgerline.sources.tables import TABLES, table_path

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF001, t)}')")
    got = E.queries()[name](spark, SF001).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    def norm(df):
        df = df[cols].copy()
        for c in cols:
            if df[c].dtype == object or str(df[c].dtype).startswith("datetime"):
                df[c] = df[c].astype(str)
        return df.sort_values(cols).reset_index(drop=True)

    pd.testing.assert_frame_equal(norm(got), norm(want), check_dtype=False)


def test_union_sources_tags_and_aligns(spark):
    from ledgerline.sources.panels import union_sources

    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(3, "s")], "k int, y string")
    rows = {r.index_name: r for r in union_sources({"A": a, "B": b}).collect()}
    assert rows["A"].x == 2.0 and rows["A"].y is None and rows["B"].y == "s"


def test_empty_split_guard(spark, prep):
    ds = prep.panel.public().where(F.col("split") != "test")
    with pytest.raises(ValueError):
        PR.dataset_split(ds, prep.features)
