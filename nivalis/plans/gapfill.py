"""Gap filling: the seasons of pixels become series without gaps."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.functions.flags import nodata_or_zero
from nivalis.functions.wateryear import water_year
from nivalis.operators.series import PIXEL
from nivalis.operators.spline import fix_peak, held, pixel_groups, smooth

OUT = ["viewable_snow_fraction", "snow_fraction", "grain_size", "dust"]


def fill_seasons(a: dict[str, np.ndarray], fix: bool, limit: float = 10, least_days: int = 3, grain_range=(40, 1190), dust_range=(0, 950)) -> dict[str, np.ndarray]:
    """Pixels x days: splines of both fractions and of grain size and dust, from observed values (nan: none)."""
    z, weight = a["snow"], np.nan_to_num(a["weight"], nan=1.0)
    observed = ~np.isnan(z)
    snowy = observed & (z > 0)
    few = snowy.sum(1) < least_days
    rounded = lambda x, lo, hi: np.floor(np.clip(x, lo, hi) + 0.5)
    view = held(rounded(smooth(z, weight, 0.1), 0, 100), observed)
    view = np.where(view <= limit, 0, view)
    total = rounded(smooth(np.where(observed, a["total"], np.nan), weight, 0.1), 0, 100)
    total = np.where(view <= limit, 0, np.maximum(held(total, observed), np.nan_to_num(a["ice"])))
    view[few], total[few] = 0, 0
    above = total > limit
    g, d = a["grain"], a["dust"]
    with np.errstate(invalid="ignore"):
        g_ok = snowy & (g >= grain_range[0]) & (g <= grain_range[1]) & ~(d > dust_range[1])
    d_ok = g_ok & ~np.isnan(d)
    if fix:
        grain, dust = fix_peak(g, d, g_ok, d_ok, weight)
    else:
        grain = held(smooth(np.where(g_ok, g, np.nan), weight, 0.8), g_ok)
        zeroed = np.where(grain <= 300, 0.0, d)
        dust = held(smooth(np.where(d_ok, zeroed, np.nan), weight, 0.1), d_ok)
    hide = ~above | few[:, None] | (g_ok.sum(1) < 2)[:, None]
    grain, dust = (np.where(hide, np.nan, rounded(x, *r)) for x, r in ((grain, grain_range), (dust, dust_range)))
    return dict(zip(OUT, (view, total, grain, dust)))


def runs(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in, and length of, the run of unobserved days of each pixel and day; 0 on observed days."""
    t = np.arange(1, seen.shape[1] + 1)
    since = t - np.maximum.accumulate(np.where(seen, t, 0), axis=1)
    until = (t - np.maximum.accumulate(np.where(seen[:, ::-1], t, 0), axis=1))[:, ::-1]
    return since, np.where(seen, 0, since + until - 1)


def stretch_days(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Snow days between two observed zeros, and zeros between two observed snows, for all days between them; 0 on days of the other kind."""

    def between(kind, ends):
        t, days = np.arange(z.shape[1]), z.shape[1]
        count = np.concatenate([np.zeros((len(z), 1), int), np.cumsum(kind, axis=1)], axis=1)  # before each day, and in all
        last = np.maximum.accumulate(np.where(ends, t, -1), axis=1)
        following = days - 1 - np.maximum.accumulate(np.where(ends[:, ::-1], t, -1), axis=1)[:, ::-1]
        total = np.take_along_axis(count, np.minimum(following, days), axis=1) - np.take_along_axis(count, np.maximum(last, 0), axis=1)
        return np.where(ends, 0, total)

    with np.errstate(invalid="ignore"):
        zero, some = z == 0, z > 0
    return between(some, zero), between(zero, some)


def season(a: dict[str, np.ndarray], days: np.ndarray, fix: bool, least_snow: int = 3, least_absent: int = 3) -> dict[str, np.ndarray]:
    """All that gap filling gives of pixels x days: run lengths of the observations, rare ones taken out, splines, days of snow cover."""
    since, length = runs(~np.isnan(a["snow"]))
    snowy, absent = stretch_days(a["snow"])
    rare = ((snowy >= 1) & (snowy < least_snow)) | ((absent >= 1) & (absent < least_absent))
    filled = fill_seasons(a | {"snow": np.where(rare, np.nan, a["snow"])}, fix)
    years = days.astype("datetime64[Y]").astype(int) + 1970 + (days.astype("datetime64[M]").astype(int) % 12 >= 9)
    with np.errstate(invalid="ignore"):
        covered = np.cumsum(filled["snow_fraction"] > 10, axis=1)
    begins = np.searchsorted(years, years)  # the first day of each day's water year
    before = np.concatenate([np.zeros((len(covered), 1), int), covered], axis=1)[:, begins]
    out = {"days_since_last_observation": since, "days_without_observation": length, "is_rare": rare, **filled}
    return out | {"water_year": np.broadcast_to(years, since.shape), "snow_cover_days": covered - before}


@dataclass
class Further:
    """What a job makes of the filled seasons where they are, within the groups of pixels and days."""

    #: Columns of px and of static that it needs: pixels x days and pixels x 1, nan where there is none.
    px: list[str]
    static: list[str]
    #: From these, all that season() gives, and the days: int columns of the result, pixels x days.
    run: Callable[[dict[str, np.ndarray], np.ndarray], dict[str, np.ndarray]]
    #: Columns of the result after pixel and date, of the seasons' or its own.
    out: list[str]


def gap_fill_job(px: DataFrame, first: str, last: str, static: DataFrame | None = None, version: int = 1, viirs: bool = False, months_for_peak: int = 8, cols: int = 2400, by_year: bool = False, further: Further | None = None) -> DataFrame:
    """Gap-free rows of every pixel and day of the window, with run lengths, flags and snow-cover days.

    Needs snow, total, grain, dust, weight and both filters. One shuffle brings the rows of 1,024 neighbouring
    pixels together, the static ones as rows among them; all else happens on their matrix of pixels and days, which also
    makes the absent days. With by_year each water year of the window that a pixel has rows in is a season
    of its own (cut off at the window's ends), and a group of its own. `further` works on the matrices before they become rows.
    """
    window, keys = (np.datetime64(first), np.datetime64(last)), ["water_year"] if by_year else []
    missing, free = nodata_or_zero(F.coalesce("nodata_filter", F.lit(1)), F.coalesce("zero_filter", F.lit(0)), version, viirs)
    values, beside, fixed_ones = ["snow", "total", "grain", "dust", "weight"], further.px if further else [], further.static if further else []
    own = px.where(F.col("obs_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    own = own.withColumn("snow", F.when(missing, None).when(free, 0).otherwise(F.col("snow")))
    own = own.select(*PIXEL, "obs_date", water_year(F.col("obs_date")).cast("int").alias("water_year"), *[F.col(v).cast("float").alias(v) for v in values], *[F.col(v).cast("double").alias(f"_{v}") for v in beside])
    if static is not None:
        low, high = (int(str(d)[:4]) + (int(str(d)[5:7]) >= 10) for d in window)
        seasons_ = F.explode(F.sequence(F.lit(low), F.lit(high))) if by_year else F.lit(low)
        fixed = static.select(*PIXEL, seasons_.alias("water_year"), F.col("ice_fraction").cast("float").alias("ice"), *[F.col(v).cast("double").alias(f"_{v}") for v in fixed_ones])
        own = own.unionByName(fixed, allowMissingColumns=True)
    else:
        own = own.withColumns({"ice": F.lit(None).cast("float")} | {f"_{v}": F.lit(None).cast("double") for v in fixed_ones})
    kinds = {f.name: f.dataType.simpleString() for f in px.schema.fields}

    def run(table: pa.Table) -> pa.Table:
        row, col = (table.column(c).to_numpy().astype(np.int64) for c in ("row", "col"))
        dated = table.column("obs_date").is_valid().to_numpy()
        pixels, first_at, at = np.unique((row * cols + col)[dated], return_index=True, return_inverse=True)
        begin, end = window
        if by_year and len(pixels):
            year = table.column("water_year")[0].as_py()
            begin, end = max(begin, np.datetime64(f"{year - 1}-10-01")), min(end, np.datetime64(f"{year}-09-30"))
        days = np.arange(begin, end + 1) if len(pixels) else np.zeros(0, "datetime64[D]")
        day = (table.column("obs_date").drop_null().to_numpy().astype("datetime64[D]") - begin).astype(int)
        a = {}
        for v in [*values, *(f"_{v}" for v in beside)]:
            a[v] = np.full((len(pixels), len(days)), np.nan)
            a[v][at, day] = table.column(v).to_numpy()[dated]
        rest = (row * cols + col)[~dated]
        place = np.searchsorted(pixels, rest)
        here = place < len(pixels)
        here[here] = pixels[place[here]] == rest[here]
        for v, absent in [("ice", 0.0), *((f"_{v}", np.nan) for v in fixed_ones)]:
            a[v] = np.full((len(pixels), 1), absent)
            a[v][place[here], 0] = table.column(v).to_numpy()[~dated][here]
        # A season's splines and peaks need at least one pixel and day.
        found = season(a, days, len(days) >= months_for_peak * 30) if len(pixels) else {}
        if further and found:
            found |= further.run(found | {v: a[f"_{v}"] for v in (*beside, *fixed_ones)}, days)
        n = len(pixels) * len(days)
        columns = [pa.repeat(table.column("tile")[0], n), *(pa.array(np.repeat(x[dated][first_at], len(days)), pa.int64()) for x in (row, col)), pa.array(np.tile(days, len(pixels)), pa.date32())]
        for name in names[4:]:
            x = np.asarray(found[name]).ravel() if found else np.zeros(0)
            columns.append(pa.array(x) if name == "is_rare" and n else pa.array(np.nan_to_num(x).astype(np.int32), mask=np.isnan(x.astype(float))))
        return pa.table([c.cast(t) for c, t in zip(columns, types)], names=names)

    seasons_own = ["days_since_last_observation", "days_without_observation", "is_rare", *OUT, "water_year", "snow_cover_days"]
    names = [*PIXEL, "obs_date", *(further.out if further else seasons_own)]
    whole = {"int": pa.int32(), "bigint": pa.int64(), "smallint": pa.int16()}
    types = [pa.string(), *(whole[kinds[c]] for c in ("row", "col")), pa.date32(), *(pa.bool_() if c == "is_rare" else pa.int32() for c in names[4:])]
    schema = f"tile string, row {kinds['row']}, col {kinds['col']}, obs_date date, " + ", ".join(f"{c} {'boolean' if c == 'is_rare' else 'int'}" for c in names[4:])
    return pixel_groups(own, cols).groupBy("tile", "_group", *keys).applyInArrow(run, schema)
