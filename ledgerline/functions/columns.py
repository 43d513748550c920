"""Column helpers shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TRADING_DAYS_PER_YEAR = 252
SQRT_YEAR = math.sqrt(TRADING_DAYS_PER_YEAR)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_minus_one(a: str | Column, b: str | Column) -> Column:
    """``a / b - 1``; division by zero gives null instead of inf."""
    return F.try_divide(col(a), col(b)) - F.lit(1.0)


def positive_flag(c: str | Column) -> Column:
    """1 when ``c > 0`` else 0; null and NaN count as 0 (pandas ``(x > 0).astype(int)``)."""
    return F.when((nan_to_null(c) > 0), F.lit(1)).otherwise(F.lit(0))


def at_least_flag(c: str | Column, threshold: float | Column) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(nan_to_null(c) >= t, F.lit(1)).otherwise(F.lit(0))


def nan_to_null(c: str | Column) -> Column:
    """NaN → null; Spark orders NaN above every number, pandas treats it as missing."""
    return F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` or 0 when ``den`` is 0 or null (the Sharpe guard)."""
    return F.coalesce(F.try_divide(col(num), col(den)), F.lit(0.0))
