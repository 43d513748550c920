"""Medians of many columns (A5): exact by narrowing open intervals with quantile sketches, or approximate from mergeable states.

A sketch (KLL) is a few kilobytes however many rows it has seen, and sketches merge: a day, a partition or a file can keep its
own (``sketch_states``) and any selection of them gives a median (``merged_medians``).  ``rank_error(k)`` is the share of the rows by which a
rank can be off, at 99 % confidence; sketches are randomised, so two runs may give different values within it.

Exact medians never shuffle the rows: each pass is an aggregate of sketches and counts, until an interval holds
few enough rows to rank.  Missing values (null, NaN) do not count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import nan_to_null

RANKED_VALUES = 100_000  # rows of a column that one task may rank
SKETCH_SIZE = 4096  # k of the sketches: at most about 100 KB a column
MARGIN = 3.0  # rank errors on either side of the middle
WIDEST = 0.05  # share of the rows on either side, for small sketches; a middle outside is found in an outer part


def rank_error(k: int) -> float:
    """Normalised rank error of a single quantile at 99 % confidence."""
    return 2.296 / k**0.9723


@dataclass(frozen=True)
class _Search:
    """The middle ranks ``a <= b`` among the ``rows`` values strictly between ``low`` and ``high`` (None: unbounded)."""

    a: int
    b: int
    rows: int
    low: float | None = None
    high: float | None = None

    def holds(self, v: Column) -> Column:
        out = v.isNotNull()
        if self.low is not None:
            out = out & (v > F.lit(self.low))
        return out & (v < F.lit(self.high)) if self.high is not None else out

    def shares(self, k: int) -> tuple[float, float]:
        wide = min(WIDEST, MARGIN * rank_error(k))
        return max(0.0, (self.a + 0.5) / self.rows - wide), min(1.0, (self.b + 0.5) / self.rows + wide)


def _parts(v: Column, search: _Search, low: float, high: float) -> list[Column]:
    """Five conditions that divide the interval: below ``low``, at it, between, at ``high``, above."""
    x, y = F.lit(low), F.lit(high)
    return [search.holds(v) & c for c in (v < x, v == x, (v > x) & (v < y), (v == y) & (y > x), v > y)]


def _narrowed(search: _Search, cuts: tuple[float, float], sizes: list[int], ends: list[tuple[float | None, float | None]]) -> _Search | float:
    """The part that holds both middle ranks, or the median once it is known."""
    bounds = [(search.low, cuts[0]), cuts[:1] * 2, cuts, cuts[1:] * 2, (cuts[1], search.high)]
    starts = [sum(sizes[:i]) for i in range(5)]
    place = [next(i for i in range(5) if starts[i] <= r < starts[i] + sizes[i]) for r in (search.a, search.b)]
    if place[0] != place[1]:  # neighbouring ranks: the last value of one part and the first of another
        return (ends[place[0]][1] + ends[place[1]][0]) / 2
    part = place[0]
    if part in (1, 3):
        return cuts[part // 2]
    return _Search(search.a - starts[part], search.b - starts[part], sizes[part], *bounds[part])


def exact_medians_frame(df: DataFrame, columns: list[str], ranked_values: int = RANKED_VALUES, k: int = SKETCH_SIZE) -> DataFrame:
    """Exact median per column as a DataFrame ``(feature, median)``; mean of the two middle values for even counts.

    While a column's interval holds more than ``ranked_values`` rows, one pass sketches it, and one counts the five parts that two quantiles
    around the middle divide it into.  Values that many rows share are parts of their own, so every
    round shrinks the interval, usually to a few thousandths.  Columns without values have no row.
    """
    spark, schema = df.sparkSession, "feature string, median double"
    if not columns:
        return spark.createDataFrame([], schema)
    own = df.select(*[nan_to_null(c).alias(f"c{i}") for i, c in enumerate(columns)])
    value = {c: F.col(f"c{i}") for i, c in enumerate(columns)}
    sizes = own.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(value.values())]).first()
    found: dict[str, float] = {}
    open_: dict[str, _Search] = {c: _Search((n - 1) // 2, n // 2, n) for c, n in zip(columns, sizes) if n}
    while wide := [c for c, s in open_.items() if s.rows > ranked_values]:
        sketched = own.agg(*[F.kll_sketch_agg_double(F.when(open_[c].holds(value[c]), value[c]), F.lit(k)).alias(f"s{i}") for i, c in enumerate(wide)])
        shares = [F.array(*[F.lit(x) for x in open_[c].shares(k)]) for c in wide]
        cuts = [tuple(x) for x in sketched.select(*[F.kll_sketch_get_quantile_double(f"s{i}", q) for i, q in enumerate(shares)]).first()]
        counts = []
        for i, c in enumerate(wide):
            for j, cond in enumerate(_parts(value[c], open_[c], *cuts[i])):
                held = F.when(cond, value[c])
                counts += [F.count(held).alias(f"n{i}_{j}"), F.min(held).alias(f"a{i}_{j}"), F.max(held).alias(f"b{i}_{j}")]
        row = own.agg(*counts).first()
        for i, c in enumerate(wide):
            new = _narrowed(open_[c], cuts[i], [row[f"n{i}_{j}"] for j in range(5)], [(row[f"a{i}_{j}"], row[f"b{i}_{j}"]) for j in range(5)])
            if isinstance(new, _Search):
                open_[c] = new
            else:
                found[c] = new
                del open_[c]
    known = spark.createDataFrame(list(found.items()), schema)
    return known.unionByName(_ranked(own, value, open_)) if open_ else known


def _ranked(own: DataFrame, value: dict[str, Column], searches: dict[str, _Search]) -> DataFrame:
    """Medians of the columns whose intervals are small enough: equal values are one row, and running counts find the middle."""
    inside = own.select(*[F.when(s.holds(value[c]), value[c]).alias(c) for c, s in searches.items()])
    long = inside.unpivot([], list(searches), "feature", "v").where(F.col("v").isNotNull())
    middle = F.create_map(*[x for c, s in searches.items() for x in (F.lit(c), F.array(F.lit(s.a).cast("long"), F.lit(s.b).cast("long")))])
    running = Window.partitionBy("feature").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    counted = long.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n")).withColumn("_upto", F.sum("n").over(running))
    at = lambda j: F.min(F.when(F.col("_upto") > middle[F.col("feature")][j], F.col("v")))
    return counted.groupBy("feature").agg(((at(0) + at(1)) / 2).alias("median"))


def exact_medians(df: DataFrame, columns: list[str], ranked_values: int = RANKED_VALUES) -> dict[str, float | None]:
    """Exact medians as ``{column: value}`` (one scalar per column; all-null columns give None)."""
    out: dict[str, float | None] = {c: None for c in columns}
    for row in exact_medians_frame(df, columns, ranked_values).collect():  # one row per column
        out[row["feature"]] = row["median"]
    return out


def sketch_states(df: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = (), k: int = SKETCH_SIZE) -> DataFrame:
    """One row per ``by`` group and column: (..., feature, rows, sketch); a table that new days are appended to."""
    values = [nan_to_null(c) for c in columns]
    sums = [F.struct(F.count(v).alias("rows"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")).alias(f"_s{i}") for i, v in enumerate(values)]
    grouped = df.groupBy(*by).agg(*sums)
    keys = [c for c in grouped.columns if c not in {f"_s{i}" for i in range(len(values))}]
    listed = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_s{i}.rows").alias("rows"), F.col(f"_s{i}.sketch").alias("sketch")) for i, c in enumerate(columns)])
    return grouped.select(*keys, F.explode(listed).alias("_x")).select(*keys, "_x.*").where("rows > 0")


def merged_medians(states: DataFrame, keys: Sequence[str] = (), k: int = SKETCH_SIZE) -> DataFrame:
    """(..., feature, rows, median) of the union of all states of a key and column; the lower middle value, within ``rank_error(k)``."""
    merged = states.groupBy(*keys, "feature").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("_s"))
    return merged.select(*keys, "feature", "rows", F.kll_sketch_get_quantile_double("_s", F.lit(0.5)).alias("median"))


def approximate_medians_frame(df: DataFrame, columns: Sequence[str], k: int = SKETCH_SIZE) -> DataFrame:
    """``(feature, median)`` from one pass of sketches; columns without values have no row."""
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, median double")
    return merged_medians(sketch_states(df, columns, k=k), k=k).select("feature", "median")
