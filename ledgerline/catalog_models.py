"""Registered model jobs with the training restated or checked in SQL (third part of the catalog)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import catalog as C
from ledgerline import oracle as O
from ledgerline.catalog import CLASS_METRICS, r6, register
from ledgerline.operators import classification as CL
from ledgerline.operators import forest as FO
from ledgerline.operators import logistic as LG
from ledgerline.operators import ml as ML
from ledgerline.operators import trees as TR
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources import sinks as SK

#: Small enough to be unrolled in SQL; the model jobs use the full sizes of ``BoostParams``.
PARAMS = TR.BoostParams(rounds=3, leaves=5, rate=0.1, bins=16, store_every=2)
FEATURES = [
    "return_1d", "return_5d", "return_20d", "volatility_20d", "volatility_ratio_5d_20d",
    "drawdown_60d", "price_vs_trailing_ema_20", "bulk_discount",
]
DIGITS = 9  # features are rounded, so that the last bits of either engine decide nothing
STAGES = {"train": ("train",), "final": ("train", "validation")}


def _rows(spark, sf_dir):
    ds = C.modeling_dataset(spark, sf_dir)
    return ds.select("index_name", "Date", "split", "target", *[F.round(c, DIGITS).alias(c) for c in FEATURES])


MODELS: dict[tuple, str] = {}


def saved_model(spark, sf_dir: str, stage: str) -> str:
    """Path of the boosted trees fitted on the splits of ``stage``; fitted and saved once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, stage)
    if key not in MODELS:
        rows = _rows(spark, sf_dir).where(F.col("split").isin(list(STAGES[stage])))
        model = TR.fit_boosting(rows, FEATURES, "target", PARAMS, partitions=3)
        MODELS[key] = ML.save(model, f"{C.model_root(spark, sf_dir)}/boosted-{stage}")
    return MODELS[key]


# ------------------------------------------------------------------- oracle ---
def _train_sql(stage: str) -> str:
    """CTEs that fit the boosted trees on the splits of ``stage`` and score all rows; names end in ``_<stage>``."""
    p, x = PARAMS, f"_{stage}"
    fit = "split IN (" + ", ".join(f"'{s}'" for s in STAGES[stage]) + ")"
    share = lambda g, h: f"(CAST({g} AS DOUBLE) / {TR.SCALE}) * (CAST({g} AS DOUBLE) / {TR.SCALE}) / (CAST({h} AS DOUBLE) / {TR.SCALE} + {O.dbl(p.l2)})"
    out = [f"""
ranked{x} AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS r, count(*) OVER (PARTITION BY f) AS n, max(v) OVER (PARTITION BY f) AS m FROM cells WHERE {fit}),
edges{x} AS MATERIALIZED (
  SELECT f, e, row_number() OVER (PARTITION BY f ORDER BY e) - 1 AS b
  FROM (SELECT DISTINCT f, v AS e FROM ranked{x} JOIN range(1, {p.bins}) q(i) ON r = greatest(1, CAST(ceil(q.i * n / {p.bins}.0) AS BIGINT)) WHERE v < m)),
binned{x} AS (
  SELECT c.id, list(c.b ORDER BY c.f) AS bins FROM (SELECT c.id, c.f, count(e.e) AS b FROM cells c LEFT JOIN edges{x} e ON e.f = c.f AND e.e < c.v GROUP BY c.id, c.f) c GROUP BY c.id),
score{x}_0 AS MATERIALIZED (
  SELECT r.id, r.split, r.target, b.bins, (SELECT ln(CAST(sum(target) AS DOUBLE) / (count(*) - sum(target))) FROM boost_rows WHERE {fit}) AS s
  FROM boost_rows r JOIN binned{x} b ON b.id = r.id)"""]
    for r in range(p.rounds):
        y = f"{x}_{r}"
        out.append(f"""
state{y}_0 AS MATERIALIZED (
  SELECT *, {fit} AS fit, CAST(round((target - p) * {TR.SCALE}) AS BIGINT) AS g, CAST(round(p * (1 - p) * {TR.SCALE}) AS BIGINT) AS h, 0 AS leaf
  FROM (SELECT *, 1 / (1 + exp(-s)) AS p FROM score{y}))""")
        for s in range(p.leaves - 1):
            out.append(f"""
best{y}_{s} AS MATERIALIZED (
  SELECT leaf, f, b, gain FROM (
    SELECT leaf, f, b, {share("gl", "hl")} + {share("g - gl", "h - hl")} - {share("g", "h")} AS gain
    FROM (
      SELECT leaf, f, b, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl,
        sum(g) OVER (PARTITION BY leaf, f) AS g, sum(h) OVER (PARTITION BY leaf, f) AS h, sum(n) OVER (PARTITION BY leaf, f) AS n
      FROM (SELECT leaf, f, bins[f + 1] AS b, sum(g) AS g, sum(h) AS h, count(*) AS n FROM state{y}_{s}, range({len(FEATURES)}) q(f) WHERE fit GROUP BY leaf, f, b)
      WINDOW w AS (PARTITION BY leaf, f ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WHERE nl >= {p.min_rows} AND n - nl >= {p.min_rows})
  WHERE gain > 0 ORDER BY gain DESC, leaf, f, b LIMIT 1),
state{y}_{s + 1} AS MATERIALIZED (
  SELECT l.* REPLACE (CASE WHEN l.leaf = t.leaf AND l.bins[t.f + 1] > t.b THEN {s + 1} ELSE l.leaf END AS leaf) FROM state{y}_{s} l LEFT JOIN best{y}_{s} t ON true)""")
        last = f"state{y}_{p.leaves - 1}"
        out.append(f"""
value{y} AS (
  SELECT leaf, {O.dbl(p.rate)} * (CAST(sum(g) AS DOUBLE) / {TR.SCALE}) / (CAST(sum(h) AS DOUBLE) / {TR.SCALE} + {O.dbl(p.l2)}) AS value
  FROM {last} WHERE fit GROUP BY leaf),
score{x}_{r + 1} AS MATERIALIZED (SELECT l.id, l.split, l.target, l.bins, l.s + v.value AS s FROM {last} l JOIN value{y} v ON v.leaf = l.leaf)""")
    return ",".join(out)


def boosted_sql(body: str, *stages: str) -> str:
    names = ", ".join(f"({i}, round({c}, {DIGITS}))" for i, c in enumerate(FEATURES))
    head = f""",
boost_rows AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY index_name, "Date") AS id FROM dataset),
cells AS MATERIALIZED (SELECT id, split, x.f, x.v FROM boost_rows, LATERAL (VALUES {names}) x(f, v)),"""
    return O.with_prepared(head + ",".join(_train_sql(s) for s in stages) + body).replace("\n,\nboost_rows", ",\nboost_rows")


def _nodes_sql(stage: str) -> str:
    rows = [
        f"SELECT {r} AS round, {s + 1} AS step, leaf, f, b, gain FROM best_{stage}_{r}_{s}" for r in range(PARAMS.rounds) for s in range(PARAMS.leaves - 1)
    ]
    names = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(FEATURES))
    return f"""
SELECT '{stage}' AS model, CAST(t.round AS INTEGER) AS round, CAST(t.step AS INTEGER) AS step, CAST(t.leaf AS INTEGER) AS leaf, CASE t.f {names} END AS feature,
  CAST(t.b AS INTEGER) AS bin, round(e.e, 6) AS threshold, round(t.gain, 6) AS gain
FROM ({" UNION ALL ".join(rows)}) t JOIN edges_{stage} e ON e.f = t.f AND e.b = t.b"""


@register("boosted_tree_nodes", boosted_sql(_nodes_sql("train") + "\nUNION ALL" + _nodes_sql("final"), "train", "final"))
def q_boosted_tree_nodes(spark, sf_dir):
    """The splits of both boosted models, read back from their saved tables."""
    out = None
    for stage in STAGES:
        nodes = ML.load(saved_model(spark, sf_dir, stage)).nodes(spark).withColumn("model", F.lit(stage))
        out = nodes if out is None else out.unionByName(nodes)
    return out.select("model", "round", "step", "leaf", "feature", "bin", *r6("threshold", "gain"))


def _scored(stage: str, where: str) -> str:
    last = f"score_{stage}_{PARAMS.rounds}"
    return f"(SELECT b.index_name, b.\"Date\", b.split, b.target AS y_true, round(1 / (1 + exp(-s.s)), 9) AS p_up, CASE WHEN s.s > 0 THEN 1 ELSE 0 END AS y_pred FROM {last} s JOIN boost_rows b ON b.id = s.id WHERE b.{where})"


@register(
    "boosted_tree_scores",
    boosted_sql(f"\nSELECT index_name, \"Date\", split, round(p_up, 6) AS p_up, CAST(y_pred AS INTEGER) AS y_pred FROM {_scored('train', 'split IS NOT NULL')} t", "train"),
)
def q_boosted_tree_scores(spark, sf_dir):
    """M6, M7: probabilities and hard predictions of all rows by the model fitted on train."""
    model = ML.load(saved_model(spark, sf_dir, "train"))
    return ML.score(model, _rows(spark, sf_dir), ["index_name", "Date", "split"]).select("index_name", "Date", "split", *r6("p_up"), "y_pred")


_EVAL = "split IN ('validation', 'test')"


def _report_sql(train: str, final: str) -> str:
    """Metrics and area by stage and split, of rows (split, y_true, y_pred, p_up) scored by the models of both stages."""
    return f""",
seen AS (SELECT 'train' AS stage, * FROM {train} UNION ALL SELECT 'final' AS stage, * FROM {final}),
metrics AS ({O.class_metrics_sql(O.counts_sql("seen", "stage, split"), "stage, split")}),
areas AS (SELECT * FROM {O.auc_sql("seen", "stage, split", "p_up")})
SELECT m.stage, m.split, {", ".join("m." + c for c in CLASS_METRICS)}, round(a.roc_auc, 6) AS roc_auc
FROM metrics m JOIN areas a ON a.stage = m.stage AND a.split = m.split"""


def _report(spark, sf_dir: str, saved, name: str):
    """The report of the models saved by ``saved(spark, sf_dir, stage)``, written below ``name`` and read back."""
    parts = None
    for stage, splits in (("train", ("validation", "test")), ("final", ("test",))):
        rows = _rows(spark, sf_dir).where(F.col("split").isin(list(splits)))
        scored = ML.score(ML.load(saved(spark, sf_dir, stage)), rows, ["split", "target"]).withColumns({"stage": F.lit(stage), "p_up": F.round("p_up", 9)})
        parts = scored if parts is None else parts.unionByName(scored)
    out = CL.classification_report(parts, ["stage", "split"], "target", "y_pred", "p_up").select("stage", "split", *r6(*CLASS_METRICS, "roc_auc"))
    ensure_checkpoint_dir(spark)
    path = SK.write_table(out, C.results_dir(spark, sf_dir, name), "csv", order_by=["stage", "split"])
    return SK.read_result(spark, path, out.schema, "csv")


@register(
    "boosted_tree_report",
    boosted_sql(_report_sql(_scored("train", _EVAL), _scored("final", "split = 'test'")), "train", "final"),
)
def q_boosted_tree_report(spark, sf_dir):
    """Fit on train and report validation and test; refit on train + validation, save, load and report test; written and read back."""
    return _report(spark, sf_dir, saved_model, "boosted_report")


# ----------------------------------------------------------------- logistic ---
_ALL = [*O.MODEL_FEATURES, *O.DUMMIES]


@register(
    "logistic_optimum",
    O.with_prepared(
        "SELECT feature, round(mean, 6) AS mean, round(scale, 6) AS scale, CAST(0 AS DOUBLE) AS gradient FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS mean, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS scale FROM dataset WHERE split = 'train'" for c in _ALL)
        + " UNION ALL SELECT 'intercept', CAST(0 AS DOUBLE), CAST(1 AS DOUBLE))"
    ),
)
def q_logistic_optimum(spark, sf_dir):
    """M1: mean and scale of every feature and the penalised gradient at the saved model, by an aggregate that shares nothing with the solver."""
    model = ML.load(C.trained(spark, sf_dir, "log_reg", "train"))
    train = C.modeling_dataset(spark, sf_dir).where("split = 'train'")
    places = model.table(spark).select(F.coalesce("name", F.lit("intercept")).alias("feature"), "mean", "scale")  # one row a feature
    out = LG.gradient(model, train, "target").join(F.broadcast(places), "feature")
    return out.select("feature", *r6("mean", "scale"), (F.round("gradient", 6) + F.lit(0.0)).alias("gradient"))


LOGISTIC_FEATURES = ["return_5d", "drawdown_60d"]
LOGISTIC_STEPS = 12  # of the SQL; the solver ends by its tolerance


def saved_logistic(spark, sf_dir: str, stage: str) -> str:
    """Path of the two-feature regression fitted on the splits of ``stage``; fitted and saved once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "logistic", stage)
    if key not in MODELS:
        rows = _rows(spark, sf_dir).where(F.col("split").isin(list(STAGES[stage])))
        MODELS[key] = ML.save(LG.fit_logistic(rows, LOGISTIC_FEATURES, "target"), f"{C.model_root(spark, sf_dir)}/logistic-{stage}")
    return MODELS[key]


def _newton_sql(stage: str) -> str:
    """CTEs of the Newton steps on the splits of ``stage``; the 3 x 3 systems are solved by determinants."""
    fit = "split IN (" + ", ".join(f"'{s}'" for s in STAGES[stage]) + ")"
    a, b = LOGISTIC_FEATURES
    out = [f"""
base_{stage} AS MATERIALIZED (
  SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb, count(*) AS n, sum(target) AS up
  FROM (SELECT round({a}, {DIGITS}) AS a, round({b}, {DIGITS}) AS b, target FROM dataset WHERE {fit})),
std_{stage} AS MATERIALIZED (
  SELECT d.split, d.target AS y, (round({a}, {DIGITS}) - ma) / sa AS u, (round({b}, {DIGITS}) - mb) / sb AS v,
    CASE WHEN target = 1 THEN n / (2.0 * up) ELSE n / (2.0 * (n - up)) END AS w FROM dataset d, base_{stage}),
step_{stage}_0 AS (SELECT CAST(0 AS DOUBLE) AS ta, CAST(0 AS DOUBLE) AS tb, CAST(0 AS DOUBLE) AS tc)"""]
    det = lambda m: "({0} * ({4} * {8} - {5} * {7}) - {1} * ({3} * {8} - {5} * {6}) + {2} * ({3} * {7} - {4} * {6}))".format(*m)
    gram = ["haa", "hab", "hac", "hab", "hbb", "hbc", "hac", "hbc", "hcc"]

    def swapped(col: int) -> str:
        return det([("ga", "gb", "gc")[i // 3] if i % 3 == col else x for i, x in enumerate(gram)])

    for k in range(LOGISTIC_STEPS):
        out.append(f"""
step_{stage}_{k + 1} AS MATERIALIZED (
  SELECT {", ".join(f"t{c} - {swapped(i)} / {det(gram)} AS t{c}" for i, c in enumerate("abc"))}
  FROM (
    SELECT ta, tb, tc, sum(e * u) + ta AS ga, sum(e * v) + tb AS gb, sum(e) AS gc, sum(h * u * u) + 1 AS haa, sum(h * u * v) AS hab, sum(h * u) AS hac,
      sum(h * v * v) + 1 AS hbb, sum(h * v) AS hbc, sum(h) AS hcc
    FROM (SELECT *, w * (p - y) AS e, w * p * (1 - p) AS h FROM (
      SELECT *, 1 / (1 + exp(-(ta * u + tb * v + tc))) AS p FROM std_{stage}, step_{stage}_{k} WHERE {fit}))
    GROUP BY ta, tb, tc))""")
    return ",".join(out)


def logistic_sql(body: str) -> str:
    return O.with_prepared("," + ",".join(_newton_sql(s) for s in STAGES) + body).replace("\n,\nbase_train", ",\nbase_train")


def _solution_sql(stage: str) -> str:
    terms = zip(("a", "b", "c"), [*LOGISTIC_FEATURES, "intercept"])
    return " UNION ALL ".join(f"SELECT '{stage}' AS model, '{name}' AS feature, round(t{c}, 6) AS coefficient FROM step_{stage}_{LOGISTIC_STEPS}" for c, name in terms)


@register("logistic_coefficients", logistic_sql("\n" + " UNION ALL ".join(_solution_sql(s) for s in STAGES)))
def q_logistic_coefficients(spark, sf_dir):
    """The coefficients of both two-feature regressions, read back from their saved tables."""
    out = None
    for stage in STAGES:
        rows = ML.load(saved_logistic(spark, sf_dir, stage)).table(spark).withColumn("model", F.lit(stage))
        out = rows if out is None else out.unionByName(rows)
    return out.select("model", F.coalesce("name", F.lit("intercept")).alias("feature"), *r6("coefficient"))


def _logistic_scored(stage: str, where: str) -> str:
    return (
        "(SELECT split, y AS y_true, round(p, 9) AS p_up, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS y_pred "
        f"FROM (SELECT *, 1 / (1 + exp(-(ta * u + tb * v + tc))) AS p FROM std_{stage}, step_{stage}_{LOGISTIC_STEPS}) WHERE {where})"
    )


@register("logistic_report", logistic_sql(_report_sql(_logistic_scored("train", _EVAL), _logistic_scored("final", "split = 'test'"))))
def q_logistic_report(spark, sf_dir):
    """M8, M9, S6, S7 with M1: fit on train and report validation and test; refit on train + validation, save, load and report test."""
    return _report(spark, sf_dir, saved_logistic, "logistic_report")


# ------------------------------------------------------------------- forest ---
SAMPLES = 6


@register(
    "forest_bootstrap",
    O.with_prepared(
        f""",
{O.CRC_CTE},
keyed AS (SELECT target, {O.crc_sql("index_name || '|' || CAST(" + chr(34) + "Date" + chr(34) + " AS VARCHAR)")} AS h FROM dataset, crc WHERE split = 'train'),
hashed AS (SELECT k.target, t.tree, {O.mixed_sql("k.h", f"t.tree + {1000 * ML.ModelParams().seed}")} AS u FROM keyed k, range({SAMPLES}) t(tree)),
weighted AS (SELECT target, tree, {" + ".join(f"CASE WHEN u >= {x} THEN 1 ELSE 0 END" for x in FO.POISSON)} AS w FROM hashed),
sums AS (
  SELECT tree, count(*) FILTER (w > 0) AS rows, CAST(coalesce(sum(w) FILTER (target = 0), 0) AS BIGINT) AS w0, CAST(coalesce(sum(w) FILTER (target = 1), 0) AS BIGINT) AS w1
  FROM weighted GROUP BY tree)
SELECT CAST(tree AS INTEGER) AS tree, rows, w0, w1, round((w0 + w1) / (2.0 * w0), 6) AS weight0, round((w0 + w1) / (2.0 * w1), 6) AS weight1 FROM sums"""
    ).replace("\n,\ncrc", ",\ncrc"),
)
def q_forest_bootstrap(spark, sf_dir):
    """M2: rows and class weights of the first bootstrap samples of the forest."""
    train = C.modeling_dataset(spark, sf_dir).where("split = 'train'")
    out = FO.bootstrap_totals(train, "target", ["index_name", "Date"], SAMPLES, ML.ModelParams().seed)
    total = F.col("w0") + F.col("w1")
    return out.select("tree", "rows", "w0", "w1", F.round(total / (2.0 * F.col("w0")), 6).alias("weight0"), F.round(total / (2.0 * F.col("w1")), 6).alias("weight1"))
