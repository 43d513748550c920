"""Trailing exponential moving average (W5), ``adjust=False`` semantics.

``y_0 = x_0`` and ``y_t = (1 - a) * y_(t-1) + a * x_t`` with ``a = 2 / (span + 1)``.

Spark has no recursive window function, so the recurrence is split:

1. Inside a block of ``block_rows`` rows, with local index ``k`` and
   ``c = 1 - a``, the value started from zero is
   ``L_k = c**k * sum_{j<=k} w_j * x_j * c**(-j)`` (``w = 1`` on the first row
   of the entity, ``a`` elsewhere) - one running ``sum`` window.
2. A block maps the value entering it to ``c**n * y + L_last``: an affine map.
   Affine maps compose associatively, so the value entering every block is an
   exclusive prefix scan over block summaries (:func:`series.block_carry`).
3. ``y_t = L_k + c**(k+1) * carry``.

``c**(-k)`` stays finite because ``k < block_rows``; spans whose decay would
overflow at the chosen block size are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans import series as S

MAX_LOG_SCALE = 600.0


def ema_column_name(span: int) -> str:
    return f"_ema_{span}"


def _decay(span: float, block_rows: int) -> float:
    alpha = 2.0 / (span + 1.0)
    c = 1.0 - alpha
    if c <= 0.0:
        return 0.0
    if -math.log(c) * block_rows > MAX_LOG_SCALE:
        raise ValueError(f"span {span} decays too fast for blocks of {block_rows} rows; use smaller blocks")
    return c


def trailing_ema(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    spans: Sequence[int],
    n_blocks: int,
    block_rows: int = S.DEFAULT_BLOCK_ROWS,
    entities: int | None = None,
) -> DataFrame:
    """Add ``_ema_<span>`` for every span.

    ``df`` must carry ``_t``, ``_blk`` and ``_own`` (halo copies are allowed;
    their EMA values are meaningless and should be filtered by the caller).
    ``x`` must be non-null.
    """
    keys = list(keys)
    k = F.col(S.ORD) - F.col(S.BLK) * block_rows
    running = S.block_window(keys).rowsBetween(S.Window.unboundedPreceding, 0)
    decays = {span: _decay(span, block_rows) for span in spans}
    local = {}
    for span, c in decays.items():
        if c == 0.0:
            local[span] = F.col(x).cast("double")
            continue
        alpha = 1.0 - c
        w = F.when(F.col(S.ORD) == 0, F.lit(1.0)).otherwise(F.lit(alpha))
        term = F.when(F.col(S.OWN), w * F.col(x) * F.pow(F.lit(c), -k))
        local[span] = F.pow(F.lit(c), k) * F.sum(term).over(running)
    df = df.withColumns({f"_L{span}": expr for span, expr in local.items()})

    summary = (
        df.where(F.col(S.OWN))
        .groupBy(*keys, S.BLK)
        .agg(
            F.struct(
                *[
                    F.struct(
                        F.pow(F.lit(c), F.count(F.lit(1))).alias("a"),
                        F.max_by(F.col(f"_L{span}"), F.col(S.ORD)).alias("b"),
                    ).alias(f"s{span}")
                    for span, c in decays.items()
                ]
            ).alias("_aff")
        )
    )

    def compose(e, l):
        return F.struct(
            *[
                F.struct(
                    (e[f"s{span}"]["a"] * l[f"s{span}"]["a"]).alias("a"),
                    (l[f"s{span}"]["a"] * e[f"s{span}"]["b"] + l[f"s{span}"]["b"]).alias("b"),
                ).alias(f"s{span}")
                for span in decays
            ]
        )

    carry = S.block_carry(summary, keys, "_aff", compose, n_blocks, entities)
    out = df.join(carry, [*keys, S.BLK], "left")
    cols = {}
    for span, c in decays.items():
        entering = F.coalesce(F.col("_aff")[f"s{span}"]["b"], F.lit(0.0))
        cols[ema_column_name(span)] = F.col(f"_L{span}") + F.pow(F.lit(c), k + 1) * entering
    return out.withColumns(cols).drop("_aff", *[f"_L{span}" for span in decays])
