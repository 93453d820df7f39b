"""The time series of each pixel: run lengths, persistence, filling, smoothing by medians.

All frames count rows, so the table must have one row per pixel and day: densify()
first. Every operator uses the same window (pixel, by date) and, where it looks forward, its
reverse: one shuffle, a sort for each direction.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

PIXEL = ["tile", "row", "col"]


def by_pixel(keys=PIXEL) -> W:
    return W.partitionBy(*keys)


def by_day(keys=PIXEL, date: str = "obs_date") -> W:
    return W.partitionBy(*keys).orderBy(date)


#: Rows of a gap-free series that a task sorts.
ROWS_A_TASK = 1_000_000


def in_tasks(px: DataFrame, rows: int, keys=PIXEL) -> DataFrame:
    """px by pixel, in as many tasks as keep those of about `rows` gap-free rows bounded; windows over the pixel and densify keep these."""
    return px.repartition(max(int(px.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK)), *keys)


def densify(px: DataFrame, first: Column, last: Column, keys=PIXEL, date: str = "obs_date", rows: int | None = None) -> DataFrame:
    """A row for each pixel and day of the range; absent days have nulls.

    Each row of a pixel makes the days up to its next row, so the observed rows are shuffled, not all days. With `rows`,
    about how many rows come out, tasks are as many as keep the rows of one bounded; windows over the pixel keep these tasks.
    """
    if rows:
        px = in_tasks(px, rows, keys)
    others = [c for c in px.columns if c not in (*keys, date)]
    # A row without a date makes no day, but its pixel has days.
    px = px.withColumns({"_first": first, "_last": last}).withColumn("_at", F.coalesce(F.col(date), F.date_sub("_first", 1)))
    w = W.partitionBy(*keys).orderBy("_at")
    px = px.withColumns({"_n": F.row_number().over(w), "_next": F.lead("_at").over(w)})
    low = F.when(F.col("_n") == 1, F.col("_first")).otherwise(F.greatest("_first", "_at"))
    high = F.when(F.col("_next").isNull(), F.col("_last")).otherwise(F.least("_last", F.greatest("_at", F.date_sub("_next", 1))))
    px = px.withColumns({"_low": low, "_high": high}).where(F.col("_low") <= F.col("_high"))
    px = px.select(*keys, F.explode(F.sequence("_low", "_high")).alias("_day"), F.col(date).alias("_seen"), *[F.col(f"`{c}`") for c in others])
    return px.select(*keys, F.col("_day").alias(date), *[F.when(F.col("_day") == F.col("_seen"), F.col(f"`{c}`")).alias(c) for c in others])


def unobserved_runs(px: DataFrame, observed: Column, keys=PIXEL) -> DataFrame:
    """Adds days_since_last_observation (place in the run of unobserved days) and days_without_observation (its length); 0 on observed days."""
    back, ahead = by_day(keys), W.partitionBy(*keys).orderBy(F.desc("obs_date"))
    since = lambda w: F.row_number().over(w) - F.coalesce(F.max("_at").over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0))
    px = px.withColumn("_seen", F.coalesce(observed, F.lit(False)))
    px = px.withColumn("_at", F.when(F.col("_seen"), F.row_number().over(back))).withColumn("_since", since(back))
    px = px.withColumn("_at", F.when(F.col("_seen"), F.row_number().over(ahead))).withColumn("_until", since(ahead))
    length = F.when(F.col("_seen"), 0).otherwise(F.col("_since") + F.col("_until") - 1)
    return px.withColumns({"days_since_last_observation": F.col("_since").cast("int"), "days_without_observation": length.cast("int")}).drop("_seen", "_at", "_since", "_until")


def stretches(px: DataFrame, snow: Column, keys=PIXEL) -> DataFrame:
    """Adds days_with_snow and days_with_absent_snow.

    Snow days between two observed zeros, and zeros between two observed snows; days without
    data neither break a stretch nor count, and every day of a stretch gets its total. On days
    of the other kind the count is 0.
    """
    so_far = by_day(keys).rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*keys).orderBy(F.desc("obs_date")).rowsBetween(W.unboundedPreceding, 0)
    px = px.withColumns({"_zero": F.coalesce(snow == 0, F.lit(False)), "_snow": F.coalesce(snow > 0, F.lit(False))})
    zero, some = F.col("_zero"), F.col("_snow")
    # A stretch's total is the difference of the running counts at the days that end it.
    px = px.withColumns({"_ns": F.count(F.when(some, 1)).over(so_far), "_nz": F.count(F.when(zero, 1)).over(so_far)})
    px = px.withColumns({"_s0": F.last(F.when(zero, F.col("_ns")), True).over(so_far), "_z0": F.last(F.when(some, F.col("_nz")), True).over(so_far)})
    px = px.withColumns({
        "_s1": F.coalesce(F.last(F.when(zero, F.col("_ns")), True).over(ahead), F.first("_ns").over(ahead)),
        "_z1": F.coalesce(F.last(F.when(some, F.col("_nz")), True).over(ahead), F.first("_nz").over(ahead)),
    })
    snowy = F.when(zero, 0).otherwise(F.col("_s1") - F.coalesce("_s0", F.lit(0)))
    absent = F.when(some, 0).otherwise(F.col("_z1") - F.coalesce("_z0", F.lit(0)))
    px = px.withColumns({"days_with_snow": snowy.cast("int"), "days_with_absent_snow": absent.cast("int")})
    return px.drop("_zero", "_snow", "_ns", "_nz", "_s0", "_z0", "_s1", "_z1")


def rare_observations(px: DataFrame, snow: str, least_snow: int = 3, least_absent: int = 3, keys=PIXEL) -> DataFrame:
    """Adds is_rare (a stretch of fewer days than asked for) and makes the value null there."""
    px = stretches(px, F.col(snow), keys)
    rare = F.col("days_with_snow").between(1, least_snow - 1) | F.col("days_with_absent_snow").between(1, least_absent - 1)
    return px.withColumn("is_rare", rare).withColumn(snow, F.when(~F.col("is_rare"), F.col(snow)))


def moving_persist(flag: Column, half: int = 40, least: int = 20, keys=PIXEL) -> Column:
    """Whether enough days around (half on either side, fewer at the ends) have the flag, this one too."""
    w = by_day(keys).rowsBetween(-half, half)
    share = F.lit(least) * (F.count(F.lit(1)).over(w) - 1) / (2 * half)
    return F.coalesce(flag, F.lit(False)) & (F.count(F.when(flag, 1)).over(w) >= share)


def snow_cover_days(fraction: Column, limit: float = 10, keys=(*PIXEL, "water_year")) -> Column:
    """Days above the limit since the water year began, of a gap-free series."""
    return F.count(F.when(fraction > limit, 1)).over(by_day(keys).rowsBetween(W.unboundedPreceding, 0)).cast("int")


def mosaic_snow_cover_days(fraction: Column, limit: float, low_elevation: Column, keys=(*PIXEL, "water_year")) -> Column:
    """Days at or above the limit; null from the first day without data on, and at low elevations."""
    w = by_day(keys).rowsBetween(W.unboundedPreceding, 0)
    gap = F.max(fraction.isNull()).over(w)
    return F.when(~gap & ~low_elevation, F.count(F.when(fraction >= limit, 1)).over(w).cast("int"))


def interpolate_linear(px: DataFrame, column: str, ends: str = "extrapolate", keys=PIXEL) -> DataFrame:
    """Fills nulls linearly in time; beyond the ends by the outer two values ("extrapolate") or by the nearest one ("nearest").

    A pixel with one value has that value everywhere, one without any stays null.
    """
    # Looking forward is looking back in the reversed order: a frame up to the last row would be evaluated anew for every row.
    back, ahead = by_day(keys), W.partitionBy(*keys).orderBy(F.desc("obs_date"))
    known = F.col(column).isNotNull()
    at = F.when(known, F.struct(F.unix_date("obs_date").alias("d"), F.col(column).cast("double").alias("v")))
    for w, one, two in ((back, "_p", "_pp"), (ahead, "_n", "_nn")):
        # The last known value and the one known before it.
        px = px.withColumn(two, F.last(at, True).over(w.rowsBetween(W.unboundedPreceding, -1)))
        px = px.withColumn(one, F.last(F.when(known, F.struct(at.alias("at"), F.col(two).alias("next"))), True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    p, n = F.col("_p.at"), F.col("_n.at")
    outer = lambda side: F.col(f"{side}.next") if ends == "extrapolate" else F.lit(None).cast("struct<d:int,v:double>")
    px = px.withColumns({
        "_a": F.when(F.col("_p").isNull(), n).when(F.col("_n").isNull() & outer("_p").isNotNull(), outer("_p")).otherwise(p),
        "_b": F.when(F.col("_p").isNull(), outer("_n")).when(F.col("_n").isNull(), p).otherwise(n),
    })
    d = F.unix_date("obs_date")
    slope = (F.col("_b.v") - F.col("_a.v")) / F.nullif(F.col("_b.d") - F.col("_a.d"), F.lit(0))
    value = F.coalesce(F.col("_a.v") + slope * (d - F.col("_a.d")), F.col("_a.v"))
    return px.withColumn(f"{column}_filled", value).drop("_p", "_pp", "_n", "_nn", "_a", "_b")


def fill_nearest(value: np.ndarray, known: np.ndarray, day: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """interpolate_linear() with the nearest value at the ends, of rows in order: series by series from the places in `begins`, by day; nan where a series has no value."""
    n, at = len(value), np.arange(len(value))
    lengths = np.diff(np.append(begins, n))
    before = np.maximum.accumulate(np.where(known, at, -1))
    after = np.minimum.accumulate(np.where(known, at, n)[::-1])[::-1]
    has_before, has_after = before >= np.repeat(begins, lengths), after < np.repeat(begins + lengths, lengths)
    low, high = np.where(has_before, before, after), np.where(has_after, after, before)
    some = has_before | has_after
    low, high = np.where(some, low, 0), np.where(some, high, 0)
    filled = value[low]
    between = np.flatnonzero((day[low] != day[high]) & ~np.isnan(day[low] + day[high] + day))
    a, b = low[between], high[between]
    filled[between] = value[a] + (value[b] - value[a]) / (day[b] - day[a]) * (day[between] - day[a])
    return np.where(some, filled, np.nan)


def hold_ends(value: Column, observed: Column, keys=PIXEL) -> Column:
    """Before the first and after the last observed day, that day's value."""
    w = by_day(keys).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    d = F.when(observed, F.col("obs_date"))
    first, last = F.min(d).over(w), F.max(d).over(w)
    at = F.when(observed, F.struct(value.alias("v")))
    return F.when(F.col("obs_date") < first, F.first(at, True).over(w)["v"]).when(F.col("obs_date") > last, F.last(at, True).over(w)["v"]).otherwise(value)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), the value evaluated once; where a lambda names an expression, it is evaluated for each element."""
    return F.transform(F.array(value), then)[0]


def _median(ordered: Column) -> Column:
    n = F.size(ordered)
    middle = (F.try_element_at(ordered, ((n + 1) / 2).cast("int")) + F.try_element_at(ordered, (n / 2).cast("int") + 1)) / 2
    return F.when(n > 0, middle)


def hampel(column: str, half: int = 2, times: float = 2.0, keys=PIXEL, by_days: bool = False) -> Column:
    """The value, or its window's median if it is further than times 1.4826 MAD from it; nulls are ignored and stay.

    With by_days the window is `half` days on either side, not rows: observed rows alone, before densify, get what they get among all days.
    """
    value = F.col(column).cast("double")
    w = W.partitionBy(*keys).orderBy(F.unix_date("obs_date")).rangeBetween(-half, half) if by_days else by_day(keys).rowsBetween(-half, half)
    far = lambda around, middle: F.sort_array(F.transform(around, lambda x: F.abs(x - middle)))
    held = lambda middle, spread: F.when(F.abs(value - middle) > spread * (times * 1.4826), middle).otherwise(value)
    kept = lambda around: _once(_median(around), lambda middle: _once(far(around, middle), lambda apart: held(middle, _median(apart))))
    return _once(F.sort_array(F.collect_list(value).over(w)), kept)


def too_few_observations(px: DataFrame, snow: str, others: list[str], least: int = 3, keys=PIXEL) -> DataFrame:
    """Where a pixel has fewer snow days than asked for: snow 0 on all days, the other variables null."""
    px = px.withColumn("too_few", F.count(F.when(F.col(snow) > 0, 1)).over(by_pixel(keys)) < least)
    return px.withColumns({snow: F.when(F.col("too_few"), 0).otherwise(F.col(snow))} | {c: F.when(~F.col("too_few"), F.col(c)) for c in others})


def rare_mask(px: DataFrame, run: str, limit: int, units: dict[str, str]) -> DataFrame:
    """Adds is_masked where the run of unobserved days is longer than the limit; variables are null there, but for those in days, degrees or without unit."""
    masked = F.col(run) > limit
    kept = ("day", "degree", "unitless")
    return px.withColumns({"is_masked": masked} | {v: F.when(~masked, F.col(v)) for v, unit in units.items() if unit not in kept})
