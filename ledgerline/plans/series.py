"""Time-blocked series machinery.

Ordered window analytics per entity (instrument, strategy run, ...) are the
core of the workload.  ``Window.partitionBy(entity).orderBy(time)`` would put
the whole history of one entity into one task; with three instruments each
holds a third of all rows.  Everything here splits an entity's history into
blocks of ``block_rows`` consecutive rows instead:

* :func:`with_ordinal` numbers rows ``0..n-1`` inside each entity without a
  per-entity task: rows are range-partitioned by entity and time, ranges are
  counted, and a ``row_number`` runs inside each range.
* :func:`with_halo` assigns ``_blk = _t div block_rows`` and replicates the
  last ``back`` rows of the previous block (and the first ``fwd`` rows of the
  next block) so lags, leads and rolling frames of bounded length are exact
  inside a ``Window.partitionBy(*keys, "_blk")``.
* :func:`prefix_scan` computes an inclusive scan of an associative combine
  over block summaries with log2(#blocks) rounds of explode + group-by
  (Hillis-Steele), so infinite-memory recurrences (EMA, forward fill,
  cumulative products and maxima) never need a whole entity in one place.

All functions take and return DataFrames; the only driver-side values are
single scalars (the longest entity) used to size the number of scan rounds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORD = "_t"  # 0-based position of a row inside its entity, in time order
BLK = "_blk"  # block id: _t div block_rows
OWN = "_own"  # false for halo copies of rows that belong to a neighbouring block

DEFAULT_BLOCK_ROWS = 256
# Rows that one task numbers.
RANGE_ROWS = 100_000
# Ranges at most, unless the cluster has more than a quarter as many cores; larger ranges are sorted with spilling.
MOST_RANGES = 10_000
# Scan rounds between lineage cuts of the block-summary table.
ROUNDS_PER_CHECKPOINT = 8
# Up to this many summary rows per key the scan is one window with a bounded
# fold (at most FOLD_SPAN elements per row); longer histories use doubling.
FOLD_SPAN = 64
# Broadcast a side only when a bound on its size, known before the join, is
# below this; otherwise the planner (and AQE at run time) decides.
BROADCAST_BOUND_BYTES = 8 * 1024 * 1024
BYTES_PER_OFFSET_ROW = 64

@contextmanager
def folding_up_to(span: int):
    """Plans built inside fold scans of up to ``span`` summary rows in one window and double beyond."""
    global FOLD_SPAN
    before, FOLD_SPAN = FOLD_SPAN, span
    try:
        yield
    finally:
        FOLD_SPAN = before


Combine = Callable[[Column, Column], Column]


def keep(df: DataFrame) -> DataFrame:
    """Materialise a frame that feeds several branches and cut its lineage.

    ``checkpoint()`` writes to the cluster's shared ``spark.checkpoint.dir``,
    so the result survives executor loss, and later plans start from a leaf
    instead of re-optimising (and re-running) the whole upstream pipeline.
    """
    return df.checkpoint(eager=True)


def prefix_scan(
    summary: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    combine: Combine,
    span: int,
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """Inclusive prefix scan over dense positions ``0..span-1`` per key.

    ``combine(earlier, later)`` must be associative.  Output columns:
    ``keys, pos, value, passthrough``.  Each round emits every row to its own
    position and to ``pos + 2**r`` and folds the (at most two) rows that meet;
    the work per round is two rows per block summary, spread by hash of
    ``(keys, pos)``.
    """
    keys = list(keys)
    if span <= FOLD_SPAN:
        return _fold_scan(summary, keys, pos, value, combine, passthrough)
    rounds = math.ceil(math.log2(span))
    fields = [F.col(value).alias("v"), *[F.col(p).alias(p) for p in passthrough]]
    cur = summary.select(*keys, F.col(pos).alias(pos), *fields)
    for r in range(rounds):
        d = 1 << r
        rec = [F.col("v").alias("v"), *[F.col(p).alias(p) for p in passthrough]]
        copies = F.array(
            F.struct(F.col(pos).alias("tgt"), F.lit(0).alias("sh"), *rec),
            F.struct((F.col(pos) + d).alias("tgt"), F.lit(1).alias("sh"), *rec),
        )
        copies = F.filter(copies, lambda x: x["tgt"] < span)
        exploded = cur.select(*keys, F.explode(copies).alias("_e"))
        grouped = exploded.groupBy(*keys, F.col("_e.tgt").alias(pos)).agg(
            F.min("_e.sh").alias("_lo_sh"),
            F.max("_e.sh").alias("_hi_sh"),
            F.min_by("_e", F.col("_e.sh")).alias("_self"),
            F.max_by("_e", F.col("_e.sh")).alias("_prev"),
        )
        cur = grouped.where(F.col("_lo_sh") == 0).select(
            *keys,
            pos,
            F.when(F.col("_hi_sh") == 1, combine(F.col("_prev.v"), F.col("_self.v")))
            .otherwise(F.col("_self.v"))
            .alias("v"),
            *[F.col(f"_self.{p}").alias(p) for p in passthrough],
        )
        if r % ROUNDS_PER_CHECKPOINT == ROUNDS_PER_CHECKPOINT - 1 and r + 1 < rounds:
            cur = cur.checkpoint(eager=True)
    return cur.withColumnRenamed("v", value)


def _fold_scan(
    summary: DataFrame,
    keys: list[str],
    pos: str,
    value: str,
    combine: Combine,
    passthrough: Sequence[str],
) -> DataFrame:
    """Short histories: fold the (at most FOLD_SPAN) earlier summaries per row.

    The fold result is projected into its own column first so ``combine``
    (which may reference its arguments many times) never duplicates the
    higher-order expression.
    """
    w = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    dtype = summary.schema[value].dataType
    folded = summary.select(
        *keys,
        pos,
        value,
        *passthrough,
        F.aggregate(
            F.collect_list(F.col(value)).over(w),
            F.lit(None).cast(dtype),
            lambda acc, x: F.when(acc.isNull(), x).otherwise(combine(acc, x)),
        ).alias("_fold"),
    )
    total = F.when(F.col("_fold").isNull(), F.col(value)).otherwise(combine(F.col("_fold"), F.col(value)))
    return folded.select(*keys, pos, total.alias(value), *passthrough)


def range_count(spark: SparkSession, rows: int, range_rows: int) -> int:
    """Ranges of about ``range_rows`` rows, but no more than the cluster can use: tasks do not grow without bound with the rows."""
    return max(1, min(-(-rows // range_rows), max(MOST_RANGES, 4 * spark.sparkContext.defaultParallelism)))


def with_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    range_rows: int | None = None,
) -> tuple[DataFrame, int]:
    """Add ``_t``: the 0-based time rank of each row inside its entity.

    ``(keys, time_col)`` must be unique.  Returns the frame and the largest
    entity length (one scalar, used to size later scans).
    """
    out, max_rows, _ = with_ordinal_info(df, keys, time_col, block_rows, range_rows)
    return out, max_rows


def with_ordinal_info(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    range_rows: int | None = None,
) -> tuple[DataFrame, int, int]:
    """:func:`with_ordinal` plus the number of entities (a bound for carry tables).

    Rows are range-partitioned by entity and time into ranges of about
    ``range_rows`` rows, however the clock ticks; a row's number is the count of its
    entity's rows in earlier ranges plus its place in its own.
    """
    keys = list(keys)
    range_rows = range_rows or max(RANGE_ROWS, block_rows)
    # The input is usually an aggregate; keep it so that counting, sampling and numbering read it once.
    rows = keep(df)
    n_ranges = range_count(df.sparkSession, rows.count(), range_rows)
    if n_ranges == 1:
        ranged = rows.withColumn("_tb", F.lit(0))
    else:  # kept, because sampling anew could move the borders
        ranged = keep(rows.repartitionByRange(n_ranges, *keys, time_col).withColumn("_tb", F.spark_partition_id()))
    counts = ranged.groupBy(*keys, "_tb").agg(F.count(F.lit(1)).alias("_n"))
    meta = counts.groupBy(*keys).agg(F.sum("_n").alias("_len")).agg(F.max("_len").alias("len"), F.count(F.lit(1)).alias("entities")).first()
    if meta["len"] is None:
        return rows.withColumn(ORD, F.lit(None).cast("long")), 0, 0
    local = Window.partitionBy(*keys, "_tb").orderBy(time_col)
    place = F.row_number().over(local).cast("long") - 1
    if n_ranges == 1:
        return ranged.withColumn(ORD, place).drop("_tb"), int(meta["len"]), int(meta["entities"])
    earlier = Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_tb", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    # Each range ends in at most one entity more than it has borders: a bound known before the join.
    if (int(meta["entities"]) + n_ranges) * BYTES_PER_OFFSET_ROW <= BROADCAST_BOUND_BYTES:
        offsets = F.broadcast(offsets)
    out = ranged.join(offsets, [*keys, "_tb"], "inner").withColumn(ORD, F.col("_off") + place)
    return out.drop("_tb", "_off"), int(meta["len"]), int(meta["entities"])


def with_blocks(df: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add ``_blk`` (no halo)."""
    return df.withColumn(BLK, F.floor(F.col(ORD) / F.lit(block_rows))).withColumn(OWN, F.lit(True))


def with_halo(df: DataFrame, back: int, fwd: int = 0, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Assign blocks and replicate boundary rows as halo copies.

    Rows keep ``_own = true`` in their block; a row within ``back`` rows of the
    end of its block is also copied (``_own = false``) to the next block, and a
    row within ``fwd`` rows of the start to the previous block.
    """
    if back > block_rows or fwd > block_rows:
        raise ValueError(f"halo ({back}, {fwd}) larger than block ({block_rows})")
    blk = F.floor(F.col(ORD) / F.lit(block_rows))
    k = F.col(ORD) - blk * block_rows
    copies = F.array(
        F.struct(blk.alias("b"), F.lit(True).alias("own"), F.lit(True).alias("keep")),
        F.struct((blk + 1).alias("b"), F.lit(False).alias("own"), (k >= block_rows - back).alias("keep")),
        F.struct((blk - 1).alias("b"), F.lit(False).alias("own"), ((k < fwd) & (blk > 0)).alias("keep")),
    )
    out = df.withColumn("_h", F.explode(F.filter(copies, lambda x: x["keep"])))
    return out.withColumn(BLK, F.col("_h.b")).withColumn(OWN, F.col("_h.own")).drop("_h")


def block_window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, BLK).orderBy(ORD)


def rows_window(keys: Sequence[str], n: int):
    """Trailing frame of ``n`` rows (current row included) inside a halo block."""
    return block_window(keys).rowsBetween(-(n - 1), 0)


def full_rolling(agg: Callable[[Column], Column], col: Column, n: int, keys: Sequence[str]) -> Column:
    """Rolling aggregate that is null until the window holds ``n`` non-null values."""
    w = rows_window(keys, n)
    return F.when(F.count(col).over(w) == n, agg(col).over(w))


def carry_row_bytes(summary: DataFrame, value: str, keys: Sequence[str]) -> int:
    """Bytes of one carry row: a key at 64, every field of the carried value at 16, and 64 of row overhead."""
    dtype = summary.schema[value].dataType
    return 64 + 64 * len(keys) + 16 * len(getattr(dtype, "fields", [None]))


def block_carry(
    summary: DataFrame,
    keys: Sequence[str],
    value: str,
    combine: Combine,
    n_blocks: int,
    entities: int | None = None,
) -> DataFrame:
    """Exclusive carry per block: the combination of all earlier blocks.

    ``summary`` has one row per ``(keys, _blk)``.  Returns ``(keys, _blk,
    value)`` for blocks 1..n-1; block 0 has no row (callers coalesce with the
    identity).
    """
    inc = prefix_scan(summary, keys, BLK, value, combine, n_blocks)
    carry = inc.select(*keys, (F.col(BLK) + 1).alias(BLK), F.col(value))
    # One row per entity and block: broadcast only when that bound is small;
    # otherwise the planner / AQE choose the join at run time.
    if entities and entities * n_blocks * carry_row_bytes(summary, value, keys) <= BROADCAST_BOUND_BYTES:
        carry = F.broadcast(carry)
    return carry


def n_blocks(max_rows: int, block_rows: int = DEFAULT_BLOCK_ROWS) -> int:
    return max(1, -(-max_rows // block_rows))
