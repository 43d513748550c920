"""Price panels derived from the input tables (S1, S2, U1; FIXTURES §C).

A panel is one DataFrame keyed by ``(index_name, Date)`` with a non-null
``Price`` column plus any number of nullable market columns.  The panel
builders aggregate raw rows per entity and time key (partial + final hash
aggregate), so ``(index_name, Date)`` is unique by construction, then smooth
the level with a trailing 20-row mean computed in halo blocks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import nan_to_null
from ledgerline.plans import series as S
from ledgerline.sources.tables import read_table

ENTITY = "index_name"
TIME = "Date"
SMOOTH_ROWS = 20


@dataclass(frozen=True)
class Panel:
    """A panel frame plus the metadata the blocked operators need.

    ``df`` carries the internal ordinal ``_t`` (0-based position of the row
    inside its entity).  ``max_rows`` is the longest entity.
    """

    df: DataFrame
    max_rows: int
    keys: tuple[str, ...] = (ENTITY,)
    time_col: str = TIME
    block_rows: int = S.DEFAULT_BLOCK_ROWS
    entities: int = 0  # number of entities (0 = unknown)

    def with_df(self, df: DataFrame) -> Panel:
        return replace(self, df=df)

    @property
    def n_blocks(self) -> int:
        return S.n_blocks(self.max_rows, self.block_rows)

    def public(self) -> DataFrame:
        return self.df.drop(S.ORD, S.BLK, S.OWN)


def smoothed_panel(
    raw: DataFrame,
    keys: tuple[str, ...] = (ENTITY,),
    time_col: str = TIME,
    level: str = "_level",
    smooth_rows: int = SMOOTH_ROWS,
    block_rows: int = S.DEFAULT_BLOCK_ROWS,
) -> Panel:
    """Number rows per entity and set ``Price`` = trailing mean of ``level``.

    The mean covers the last ``smooth_rows`` rows and is partial at the start
    of each entity.  Time keys without a level (all inputs missing or NaN) are
    not part of the panel, so ``Price`` is never null.
    """
    raw = raw.where(F.col(level).isNotNull())
    ordered, max_rows, entities = S.with_ordinal_info(raw, keys, time_col, block_rows)
    blocked = S.with_halo(ordered, back=smooth_rows - 1, block_rows=block_rows)
    price = F.avg(level).over(S.rows_window(keys, smooth_rows))
    df = blocked.withColumn("Price", price).where(F.col(S.OWN)).drop(level, S.BLK, S.OWN)
    return Panel(df=df, max_rows=max_rows, keys=keys, time_col=time_col, block_rows=block_rows, entities=entities)


def order_panel_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean order value per order status: the instrument levels."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderstatus", "o_orderdate", "o_totalprice"])
    return (
        orders.where(F.col("o_orderstatus").isNotNull() & F.col("o_orderdate").isNotNull())
        .groupBy(F.col("o_orderstatus").alias(ENTITY), F.to_date("o_orderdate").alias(TIME))
        .agg(F.avg(nan_to_null("o_totalprice")).alias("_level"))
    )


def bulk_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A market-wide context column (C2): the mean discount of all lineitems of a ship date.

    Gaps are planted after the aggregation: days whose number of lineitems is a multiple of four have no value.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_discount", "l_shipdate"])
    daily = (
        li.where(F.col("l_shipdate").isNotNull())
        .groupBy(F.to_date("l_shipdate").alias(TIME))
        .agg(F.avg(nan_to_null("l_discount")).alias("bulk_discount"), F.count(F.lit(1)).alias("_lines"))
    )
    return daily.select(TIME, F.when(F.col("_lines") % 4 != 0, F.col("bulk_discount")).alias("bulk_discount"))


def order_panel(spark: SparkSession, sf_dir: str, with_context: bool = True, block_rows: int = S.DEFAULT_BLOCK_ROWS) -> Panel:
    """The instrument panel (A1): ``index_name, Date, Name, Price`` + context."""
    panel = smoothed_panel(order_panel_raw(spark, sf_dir), block_rows=block_rows)
    df = panel.df.withColumn("Name", F.concat(F.lit("status "), F.col(ENTITY)))
    if with_context:
        df = df.join(bulk_discount(spark, sf_dir), TIME, "left")
    return panel.with_df(df)


def event_panel(spark: SparkSession, sf_dir: str, block_rows: int = S.DEFAULT_BLOCK_ROWS) -> Panel:
    """Second panel (C6): hourly mean event value per event type."""
    ev = read_table(spark, sf_dir, "events", ["event_type", "ts", "value"])
    raw = (
        ev.where(F.col("event_type").isNotNull() & F.col("ts").isNotNull())
        .groupBy(F.col("event_type").alias(ENTITY), F.date_trunc("hour", F.col("ts")).alias(TIME))
        .agg(F.avg(nan_to_null("value")).alias("_level"))
    )
    return smoothed_panel(raw, block_rows=block_rows)


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """Multi-source scan (S2/U1): tag each source with its name and stack them."""
    tagged = [df.withColumn(ENTITY, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
