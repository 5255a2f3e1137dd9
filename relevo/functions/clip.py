"""Prediction clipping (P12, P13) with Python's NaN comparison semantics.

In Spark ``NaN > 3`` is true (NaN sorts above every number), in Python it is
false; the NaN branch comes first so a NaN prediction stays NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW, HIGH = 1.0, 3.0  # fixed values: the relevance grade range


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_both(c, low: float = LOW, high: float = HIGH) -> Column:
    """Clip to [low, high]; NaN and null pass through."""
    p = _c(c).cast("double")
    return (F.when(F.isnan(p), p).when(p > high, F.lit(high))
            .when(p < low, F.lit(low)).otherwise(p))


def clip_upper(c, high: float = HIGH) -> Column:
    """Clip to at most ``high``; NaN and null pass through."""
    p = _c(c).cast("double")
    return F.when(F.isnan(p), p).when(p > high, F.lit(high)).otherwise(p)
