"""Quantiles with Hazen's plotting positions: the i-th of n sorted values stands at 100 (i - 0.5) / n percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentile_hazen(ordered: Column, percent: float) -> Column:
    """Of a sorted array without nulls; null if it is empty."""
    n = F.size(ordered)
    at = F.greatest(F.lit(1.0), F.least(n.cast("double"), n * percent / 100 + 0.5))
    low = F.floor(at).cast("int")
    high = F.least(low + 1, n)
    x = F.try_element_at(ordered, low)
    return F.when(n > 0, x + (at - low) * (F.try_element_at(ordered, high) - x))
