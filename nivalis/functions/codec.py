"""Scaled integers: encoding, decoding, clamping, and values for colour maps. Inside the library nodata is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode(value: Column, divisor: float, nodata: int, low: int = 0, high: int | None = None) -> Column:
    """The stored integer: times the divisor, rounded half away from zero, saturated to [low, high]; null is nodata."""
    most = nodata if high is None else high
    stored = F.greatest(F.lit(low), F.least(F.lit(most), F.round(value * divisor))).cast("int")
    return F.when(value.isNotNull(), stored).otherwise(nodata)


def decode(stored: Column, divisor: float, nodata: int) -> Column:
    return F.nullif(stored, F.lit(nodata)) / F.lit(float(divisor))


def cut_min_max(value: Column, low: float, high: float, mode: int = 1) -> tuple[Column, Column]:
    """The value clamped (mode 1) or null (mode 2) outside [low, high], and a mask: 1 nodata, 2 below, 4 above."""
    if mode == 1:
        cut = F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))
    else:
        cut = F.when(value.between(low, high), value)
    mask = F.when(value.isNull(), 1).when(value < low, 2).when(value > high, 4).otherwise(0)
    return cut, mask


def rgb_composite(b6: Column, b1: Column, b3: Column, most: int = 100) -> list[Column]:
    """Red, green and blue from bands 6, 1 and 3, capped."""
    return [F.least(b, F.lit(most)).alias(n) for b, n in ((b6, "red"), (b1, "green"), (b3, "blue"))]


def scale_to_colormap(value: Column, low: Column | float, high: Column | float) -> Column:
    """0 to 254 between the two limits, 255 for null."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    share = (F.greatest(low, F.least(high, value)) - low) / F.nullif(high - low, F.lit(0.0))
    return F.when(value.isNull(), 255).otherwise(F.coalesce(F.round(share * 254), F.lit(0))).cast("int")


def round_out(p5: Column, p95: Column, wide: bool) -> tuple[Column, Column]:
    """A display range around two percentiles, rounded outwards to 5, or to 50 for wide (two-byte) variables."""
    step = 50 if wide else 5
    return F.floor(p5 / step) * step, F.ceil(p95 / step) * step
