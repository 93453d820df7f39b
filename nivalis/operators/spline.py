"""Smoothing splines of many pixel seasons at once, and the season's peak of grain size and dust."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.operators.series import PIXEL

#: Pixels in a group; with a year of days a group has about 400,000 rows.
GROUP = 1024


def smooth(y: np.ndarray, w: np.ndarray, p: float) -> np.ndarray:
    """Weighted cubic smoothing splines on equidistant days, one per row; minimises p sum w (y - f)^2 + (1 - p) int f''^2.

    nan in y or weights of 0 are excluded from the fit, but get a value. Value and slope per
    day are the unknowns, which makes a block-tridiagonal system of 2 x 2 blocks; it is eliminated
    day by day for all pixels together. Rows with fewer than two values are nan.
    """
    pixels, days = y.shape
    seen = ~np.isnan(y) & (w > 0)
    weight = np.where(seen, p * w, 0.0)
    bend = 1 - p
    stiff = bend * np.array([[12, 6, -12, 6], [6, 4, -6, 2], [-12, -6, 12, -6], [6, 2, -6, 4]], float)
    first, last, up = stiff[:2, :2], stiff[2:, 2:], stiff[:2, 2:]
    # All by day, so that a step reads and writes whole rows.
    weight_of, value_of = np.ascontiguousarray(weight.T), np.ascontiguousarray((weight * np.where(seen, y, 0.0)).T)
    inverse, right = np.zeros((days, 4, pixels)), np.zeros((days, 2, pixels))
    (u00, u01), (u10, u11) = up
    for t in range(days):
        (b00, b01), (b10, b11) = (last if t else 0) + (first if t < days - 1 else 0) + 1e-12 * np.eye(2)
        b00 = b00 + weight_of[t]
        r0, r1 = value_of[t], 0.0
        if t:
            (i00, i01, i10, i11), (q0, q1) = inverse[t - 1], right[t - 1]
            c00, c01, c10, c11 = u00 * i00 + u10 * i10, u00 * i01 + u10 * i11, u01 * i00 + u11 * i10, u01 * i01 + u11 * i11
            b00, b01 = b00 - (c00 * u00 + c01 * u10), b01 - (c00 * u01 + c01 * u11)
            b10, b11 = b10 - (c10 * u00 + c11 * u10), b11 - (c10 * u01 + c11 * u11)
            r0, r1 = r0 - (c00 * q0 + c01 * q1), -(c10 * q0 + c11 * q1)
        det = b00 * b11 - b01 * b10
        det = np.where(np.abs(det) < 1e-300, 1e-300, det)
        inverse[t, 0], inverse[t, 1], inverse[t, 2], inverse[t, 3] = b11 / det, -b01 / det, -b10 / det, b00 / det
        right[t, 0], right[t, 1] = r0, r1
    found = np.zeros((days, pixels))
    f0 = f1 = np.zeros(pixels)
    for t in range(days - 1, -1, -1):
        (i00, i01, i10, i11), (r0, r1) = inverse[t], right[t]
        if t < days - 1:
            r0, r1 = r0 - (u00 * f0 + u01 * f1), r1 - (u10 * f0 + u11 * f1)
        f0, f1 = i00 * r0 + i01 * r1, i10 * r0 + i11 * r1
        found[t] = f0
    f = np.ascontiguousarray(found.T)
    f[seen.sum(axis=1) < 2] = np.nan
    return f


def held(f: np.ndarray, observed: np.ndarray) -> np.ndarray:
    """The fitted values, constant before the first and after the last observed day."""
    days = f.shape[1]
    first = np.where(observed.any(1), observed.argmax(1), 0)
    last = np.where(observed.any(1), days - 1 - observed[:, ::-1].argmax(1), days - 1)
    t = np.clip(np.arange(days), first[:, None], last[:, None])
    return np.take_along_axis(f, t, axis=1)


def hampel(x: np.ndarray, half: int = 2, times: float = 2.0) -> np.ndarray:
    """Values further than times 1.4826 MAD from the median of their window are replaced by it; nans are ignored and stay."""
    padded = np.pad(x, ((0, 0), (half, half)), constant_values=np.nan)
    windows = np.stack([padded[:, i : i + x.shape[1]] for i in range(2 * half + 1)])
    n = (~np.isnan(windows)).sum(axis=0)

    def median(a: np.ndarray) -> np.ndarray:
        a = np.sort(a, axis=0)  # nans last
        low, high = (np.take_along_axis(a, i[None], axis=0)[0] for i in (np.maximum(n - 1, 0) // 2, n // 2))
        return np.where(n % 2, low, (low + high) / 2)

    middle = median(windows)
    spread = median(np.abs(windows - middle))
    return np.where(np.abs(x - middle) > times * 1.4826 * spread, middle, x)


def taper(start: np.ndarray, end: float, days: int) -> np.ndarray:
    """A cubic with level ends from start to end over the days (the last one is the end)."""
    s = np.arange(1, days + 1) / days
    return start[:, None] + (end - start[:, None]) * (3 * s**2 - 2 * s**3)


def fix_peak(grain: np.ndarray, dust: np.ndarray, grain_ok: np.ndarray, dust_ok: np.ndarray, weight: np.ndarray, p_grain: float = 0.8, p_dust: float = 0.1,
             least_grain: float = 40, dusty_grain: float = 300, last_days: int = 40, taper_days: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Grain size and dust of seasons that end in melt-out.

    A spline up to the peak of the last days before melt-out, the peak's value from there on, and,
    in a full year, a taper to the minimum at the end. Dust is 0 before the peak where grains
    are small. Day 1 has the minimum, with weight 1. Rows without enough data are nan.
    """
    pixels, days = grain.shape
    t = np.arange(days)
    g = hampel(np.where(grain_ok, grain, np.nan))
    last = np.where(grain_ok.any(1), days - 1 - grain_ok[:, ::-1].argmax(1), 0)
    late = np.where((t > last[:, None] - last_days) & ~np.isnan(g), g, -np.inf)
    peak = late.argmax(1)
    before = grain_ok & (t <= peak[:, None])
    usable = (peak >= 2) & (before.sum(1) >= 2)
    full = days >= 365

    def season(x, ok, least, p, plateau):
        y = np.where(ok, x, np.nan)
        w = np.where(ok, weight, 0.0)
        y[:, 0], w[:, 0] = least, 1.0
        out = np.where(t < peak[:, None], smooth(y, w, p), plateau[:, None])
        if full:
            out[:, days - taper_days :] = taper(plateau, least, taper_days)
        return out

    rows = np.arange(pixels)
    g_out = season(g, before, least_grain, p_grain, np.where(usable, g[rows, peak], np.nan))
    d_ok = dust_ok & (t <= peak[:, None])
    d = np.where((t < peak[:, None]) & (g_out <= dusty_grain) & d_ok, 0.0, dust)
    last_d = np.where(d_ok.any(1), days - 1 - d_ok[:, ::-1].argmax(1), 0)
    d_out = season(d, d_ok, 0.0, p_dust, d[rows, last_d])
    g_out[~usable] = np.nan
    d_out[~usable | (d_ok.sum(1) < 2)] = np.nan
    return g_out, d_out


def matrix(pdf: pd.DataFrame, columns: list[str], days: np.ndarray, keys=PIXEL) -> tuple[pd.DataFrame, np.ndarray, dict[str, np.ndarray]]:
    """Pixels, the place (pixel, day) of each row, and a pixels x days array of each column."""
    pixels = pdf[list(keys)].drop_duplicates().reset_index(drop=True)
    at = pdf[list(keys)].merge(pixels.reset_index(), on=list(keys), how="left")["index"].to_numpy()
    day = np.searchsorted(days, pdf["obs_date"].to_numpy().astype("datetime64[D]"))
    out = {}
    for c in columns:
        a = np.full((len(pixels), len(days)), np.nan)
        a[at, day] = pdf[c].to_numpy(dtype=float, na_value=np.nan)
        out[c] = a
    return pixels, np.stack([at, day]), out


def pixel_groups(df: DataFrame, cols: int = 2400, group: int = GROUP) -> DataFrame:
    """A column _group: pixels of a tile in runs of `group`, so a task's group has a bounded number of seasons."""
    return df.withColumn("_group", F.floor((F.col("row").cast("long") * cols + F.col("col")) / group))


def smoothing_spline(px: DataFrame, value: str, weight: str | None = None, p: float = 0.1, low: float | None = None, high: float | None = None, cols: int = 2400) -> DataFrame:
    """Adds `<value>_smooth` on all days of each pixel: nulls are excluded from the fit; clipped to the range. One row per pixel and day is needed."""
    columns = [value] + ([weight] if weight else [])
    kinds = {f.name: f.dataType.simpleString() for f in px.schema.fields}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        days = np.unique(pdf["obs_date"].to_numpy().astype("datetime64[D]"))
        _, at, a = matrix(pdf, columns, days)
        f = smooth(a[value], np.nan_to_num(a[weight]) if weight else np.ones_like(a[value]), p)
        f = np.clip(f, -np.inf if low is None else low, np.inf if high is None else high)
        return pdf[[*PIXEL, "obs_date"]].assign(**{f"{value}_smooth": f[at[0], at[1]]})

    schema = f"tile string, row {kinds['row']}, col {kinds['col']}, obs_date date, {value}_smooth double"
    slim = pixel_groups(px.select(*PIXEL, "obs_date", *columns), cols)
    return slim.groupBy("tile", "_group").applyInPandas(run, schema)


def fix_peaks(px: DataFrame, grain: str, dust: str, weight: str, cols: int = 2400, keys=(*PIXEL, "water_year"), grain_range=(40, 1190), dust_range=(0, 950)) -> DataFrame:
    """Adds `<grain>_fixed` and `<dust>_fixed` on all days of each season (see fix_peak), clipped to their ranges.

    One row per pixel and day is needed; values outside the ranges are not used, a null weight counts as 1.
    """
    kinds = {f.name: f.dataType.simpleString() for f in px.schema.fields}
    seasons = [k for k in keys if k not in PIXEL]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        days = np.unique(pdf["obs_date"].to_numpy().astype("datetime64[D]"))
        _, at, a = matrix(pdf, [grain, dust, weight], days)
        g, d = a[grain], a[dust]
        with np.errstate(invalid="ignore"):
            g_ok = (g >= grain_range[0]) & (g <= grain_range[1])
            d_ok = g_ok & (d >= dust_range[0]) & (d <= dust_range[1])
        fixed = fix_peak(g, d, g_ok, d_ok, np.nan_to_num(a[weight], nan=1.0), least_grain=grain_range[0])
        out = pdf[[*keys, "obs_date"]].copy()
        for name, x, limits in zip((grain, dust), fixed, (grain_range, dust_range)):
            out[f"{name}_fixed"] = np.clip(x, *limits)[at[0], at[1]]
        return out

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "obs_date date", f"{grain}_fixed double", f"{dust}_fixed double"])
    slim = pixel_groups(px.select(*keys, "obs_date", grain, dust, weight), cols)
    return slim.groupBy("tile", "_group", *seasons).applyInPandas(run, schema)
