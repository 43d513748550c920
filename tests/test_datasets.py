"""Loading instruments from files, saved models, shared folders."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline import catalog as C
from ledgerline import datasets as D
from ledgerline import session
from ledgerline.operators import ml as ML
from ledgerline.operators import prepare as PR
from ledgerline.plans import series as S

DATES = PR.SplitDates("2020-06-30", "2020-09-30")


def price_file(tmp_path, name, days=400, repeat=False, header="Date,Name,Price,volume,flag"):
    rng = random.Random(name)
    price, lines = 100.0, [header]
    for i in range(days):
        price *= 1 + rng.gauss(0, 0.01)
        day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
        lines.append(f"{day},{name},{price},{'' if i % 7 == 0 else i},{'true' if i % 2 else 'false'}")
    if repeat:
        lines.append(lines[-1])
    path = tmp_path / f"{name}.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_modeling_dataset_from_csv_files(spark, tmp_path):
    files = {n: price_file(tmp_path, n) for n in ("abc", "xyz")}
    prep = D.load_modeling_dataset(spark, files, DATES)
    df = prep.panel.public()
    assert {"volume", "flag", "return_1d", "index_abc", "index_xyz"} <= set(prep.features)
    bad = df.select([F.sum((F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).cast("int")).alias(c) for c in prep.features]).first()
    assert all(v == 0 for v in bad)
    assert {r["split"] for r in df.select("split").distinct().collect()} == {"train", "validation", "test"}
    assert df.groupBy("index_name").count().count() == 2


def test_repeated_days_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="2 rows for index_name=abc"):
        D.load_panel(spark, {"abc": price_file(tmp_path, "abc", repeat=True)})
    with pytest.raises(ValueError):
        D.load_panel(spark, {})


def test_missing_model_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ML.load(str(tmp_path / "nothing"))
    with pytest.raises(FileNotFoundError):
        C.evaluate_saved(spark, {"log_reg": str(tmp_path / "nothing")}, spark.range(1))


def test_scores_of_a_model_without_probabilities(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense(-m, m),) for m in (0.0, 1.0, 3.0)], ["rawPrediction"])
    got = sorted(r["p_up"] for r in ML.positive_probability(rows).collect())
    assert got == [0.0, pytest.approx(1 / 3), 1.0]
    with pytest.raises(TypeError):
        ML.positive_probability(spark.range(1))


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Spark:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Spark())


def test_window_larger_than_a_block(spark):
    from ledgerline.operators import report as RP

    rows = [("s", dt.date(2020, 1, 1) + dt.timedelta(days=i), (i % 7 - 3) / 100) for i in range(400)]
    out = RP.rolling_sharpe(spark.createDataFrame(rows, "run string, Date date, strategy_return double"), ["run"], window=300)
    assert out.count() == 400 and out.where("rolling_sharpe is not null").count() == 101


def test_doubling_scan_equals_folding(spark):
    df = spark.createDataFrame([("a", i, float(i % 5)) for i in range(300)], "k string, p long, v double")
    add = lambda a, b: a + b
    fold = {r["p"]: r["v"] for r in S.prefix_scan(df, ["k"], "p", "v", add, 60).collect()}
    with S.folding_up_to(1):
        doubled = {r["p"]: r["v"] for r in S.prefix_scan(df, ["k"], "p", "v", add, 300).collect()}
    assert all(abs(fold[p] - doubled[p]) < 1e-9 for p in range(60))
