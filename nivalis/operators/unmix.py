"""Spectral unmixing: snow and shade fractions, grain size and dust of each spectrum.

R = f LUT(grain, dust, zenith) + (1 - f - s) R0, with f, s >= 0 and f + s <= 1. For given
grain size and dust this is linear in f and s and solved in closed form with its
constraints, so only grain size and dust are sought: by projected Gauss-Newton from several
starts, the valleys of a coarse grid. All spectra of a batch are solved together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from nivalis.operators.lut import interpolate, interpolate_with_slopes, shared_table

GRAIN = (30.0**0.5, 1200.0**0.5)
DUST = (0.0, 1e-3)


def fractions(r: np.ndarray, snow: np.ndarray, ground: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """f, s and squared residual of r - ground = f (snow - ground) - s ground under the constraints."""
    a, b, y = snow - ground, -ground, r - ground
    aa, bb, ab = (a * a).sum(-1), (b * b).sum(-1), (a * b).sum(-1)
    ay, by = (a * y).sum(-1), (b * y).sum(-1)
    det = aa * bb - ab * ab
    with np.errstate(all="ignore"):
        free = np.stack([(bb * ay - ab * by) / det, (aa * by - ab * ay) / det])
        f_only, s_only = np.clip(ay / aa, 0, 1), np.clip(by / bb, 0, 1)
        c = a - b  # on f + s = 1: r - ground + ground = f c
        f_edge = np.clip(((y - b) * c).sum(-1) / (c * c).sum(-1), 0, 1)
    options = [(f_only, np.zeros_like(f_only)), (np.zeros_like(s_only), s_only), (f_edge, 1 - f_edge)]
    ok = (free[0] >= 0) & (free[1] >= 0) & (free.sum(0) <= 1) & np.isfinite(free).all(0)
    options.append((np.where(ok, free[0], np.nan), np.where(ok, free[1], np.nan)))
    best_f = best_s = best = None
    for f, s in options:
        e = ((y - f[..., None] * a - s[..., None] * b) ** 2).sum(-1)
        e = np.where(np.isnan(e), np.inf, e)
        if best is None:
            best_f, best_s, best = f, s, e
        else:
            better = e < best
            best_f, best_s, best = np.where(better, f, best_f), np.where(better, s, best_s), np.where(better, e, best)
    return best_f, best_s, best


def mixed_only(r: np.ndarray, snow: np.ndarray, ground: np.ndarray):
    """The same with f + s = 1: no ground shows."""
    f = np.clip((r * snow).sum(-1) / np.maximum((snow * snow).sum(-1), 1e-12), 0, 1)
    return f, 1 - f, ((r - f[..., None] * snow) ** 2).sum(-1)


#: Valleys that are followed at most, steps of each, and halvings of the closing search, which gets across the creases of a table.
STARTS, STEPS, HALVINGS = 6, 10, 9
GRID = (9, 7)


def _valleys(errors: np.ndarray, most: int) -> np.ndarray:
    """Of each column of errors (grain, dust, n) the places of its lowest valleys (no neighbour lower), best first; the best again where there are fewer."""
    rows, cols, n = errors.shape
    around = np.pad(errors, ((1, 1), (1, 1), (0, 0)), constant_values=np.inf)
    low = np.ones(errors.shape, bool)
    for i in range(3):
        for j in range(3):
            low &= errors <= around[i : i + rows, j : j + cols]
    flat = np.where(low, errors, np.inf).reshape(-1, n)
    places = np.argsort(flat, axis=0, kind="stable")[:most]
    return np.where(np.isfinite(np.take_along_axis(flat, places, 0)), places, places[0])


def _downhill(x: np.ndarray, y: np.ndarray, shift: np.ndarray, slopes: list[np.ndarray], free: list[np.ndarray], damping: np.ndarray) -> np.ndarray:
    """Damped Gauss-Newton step for x (n x 2, within 0 and 1) and residuals y, off the span of the free linear columns."""
    columns = [shift[:, None] * s for s in slopes]
    basis = []
    for c in free:
        for q in basis:
            c = c - (c * q).sum(1, keepdims=True) * q
        basis.append(c / np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-9))
    for q in basis:
        columns = [c - (c * q).sum(1, keepdims=True) * q for c in columns]
    a, b = columns
    aa, bb, ab, ay, by = ((p * q).sum(1) for p, q in ((a, a), (b, b), (a, b), (a, y), (b, y)))
    aa, bb = aa * (1 + damping) + 1e-12, bb * (1 + damping) + 1e-12
    det = aa * bb - ab * ab
    step = np.stack([(bb * ay - ab * by) / det, (aa * by - ab * ay) / det], 1)
    # At a bound that the step would cross, the other variable moves alone.
    stuck = ((x <= 0) & (step < 0)) | ((x >= 1) & (step > 0))
    alone = np.stack([ay / aa, by / bb], 1)
    return np.where(stuck, 0, np.where(stuck[:, ::-1], alone, step))


def search(r: np.ndarray, ground: np.ndarray, cos_zenith: np.ndarray, axes, table, solve=fractions):
    """f, s, square root of grain size, dust (a share) and squared residual; spectra are rows.

    Gauss-Newton from the valleys of a grid (STARTS at most); the best end, and the grid's best place, are then bettered by
    those around in steps that are halved, so the residual is never above what closing in on the grid alone gives. `solve` gives f, s and the squared residual for given snow.
    """
    n = len(r)
    low, wide = np.array([GRAIN[0], DUST[0]]), np.array([GRAIN[1] - GRAIN[0], DUST[1] - DUST[0]])

    def points(x: np.ndarray, mu: np.ndarray) -> np.ndarray:
        at = np.clip(low + x * wide, low, low + wide)
        return np.column_stack([mu, at])

    grid = np.stack(np.meshgrid(*[np.linspace(0, 1, k) for k in GRID], indexing="ij"), -1).reshape(-1, 2)
    errors = np.stack([solve(r, interpolate(axes, table, points(np.tile(x, (n, 1)), cos_zenith)), ground)[2] for x in grid])
    starts = _valleys(errors.reshape(*GRID, n), STARTS)
    # Each spectrum once for each of its valleys; those with fewer take up no further rows.
    new = np.concatenate([np.ones((1, n), bool), starts[1:] != starts[0]])
    spectrum, x = np.nonzero(new.T)[0], grid[starts.T[new.T]]
    own, under, mu = r[spectrum], ground[spectrum], cos_zenith[spectrum]

    def look(x: np.ndarray):
        snow, *slopes = interpolate_with_slopes(axes, table, points(x, mu), [1, 2])
        return snow, [s * w for s, w in zip(slopes, wide)], *solve(own, snow, under)

    snow, slopes, f, s, e = look(x)
    damping = np.full(len(x), 1e-2)
    for _ in range(STEPS):
        if solve is fractions:
            a, b, y = snow - under, -under, own - (f[:, None] * snow + (1 - f - s)[:, None] * under)
            edge = f + s >= 1 - 1e-12
            free = [np.where((f >= 1)[:, None], 0, np.where(edge[:, None], a - b, a)), np.where((edge | (s <= 0))[:, None], 0, b)]
        else:
            y, free = own - f[:, None] * snow, [np.where((f >= 1)[:, None], 0, snow)]
        there = np.clip(x + _downhill(x, y, f, slopes, free, damping), 0, 1)
        snow2, slopes2, f2, s2, e2 = look(there)
        better = e2 < e
        take = lambda p, q: np.where(better.reshape(-1, *[1] * (p.ndim - 1)), p, q)  # noqa: E731, B023
        x, snow, slopes = take(there, x), take(snow2, snow), [take(p, q) for p, q in zip(slopes2, slopes)]
        f, s, e = take(f2, f), take(s2, s), take(e2, e)
        damping = np.clip(np.where(better, damping / 5, damping * 5), 1e-6, 1e6)
    order = np.lexsort([e, spectrum])
    first = order[np.unique(spectrum[order], return_index=True)[1]]
    # The search closes in on the best of these ends and, apart, from the best place of the grid.
    here = np.concatenate([x[first], grid[starts[0]]])
    own, under, mu = np.tile(r, (2, 1)), np.tile(ground, (2, 1)), np.tile(cos_zenith, 2)
    best = [here, *solve(own, interpolate(axes, table, points(here, mu)), under)]
    size = 1 / (np.array(GRID) - 1)
    for _ in range(HALVINGS):
        size, here = size / 2, best[0].copy()
        for i, j in ((i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j):
            there = np.clip(here + size * (i, j), 0, 1)
            new = [there, *solve(own, interpolate(axes, table, points(there, mu)), under)]
            better = new[3] < best[3]
            best = [np.where(better.reshape(-1, *[1] * (p.ndim - 1)), p, q) for p, q in zip(new, best)]
    second = best[3][n:] < best[3][:n]
    x, f, s, e = (np.where(second.reshape(-1, *[1] * (p.ndim - 1)), p[n:], p[:n]) for p in best)
    found = points(x, cos_zenith)
    return [f, s, found[:, 1], found[:, 2], e]


def unmix(df: DataFrame, bands: list[str], ground: list[str], cos_zenith: str, axes: list[np.ndarray], table: np.ndarray, near: float = 0.02) -> DataFrame:
    """Adds snow_fraction, shade_fraction (percent), grain_size (micrometres), dust (ppm) and residual to each spectrum.

    The table has axes cos_zenith, root of grain size, dust (a share) and, last, the bands; reflectances
    are percent. Spectra brighter than 100 are scaled down. The fit without ground is taken if its
    snow fraction differs by less than `near`. Nulls in a spectrum give nulls.
    """
    shared = shared_table(df.sparkSession, axes, table)
    new = ["snow_fraction", "shade_fraction", "grain_size", "dust", "residual"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grid, values = shared.value
        for pdf in batches:
            r, r0 = (pdf[c].to_numpy(dtype=float, na_value=np.nan) for c in (bands, ground))
            mu = pdf[cos_zenith].to_numpy(dtype=float, na_value=np.nan)
            good = ~(np.isnan(r).any(1) | np.isnan(r0).any(1) | np.isnan(mu))
            out = np.full((len(pdf), 5), np.nan)
            if good.any():
                scale = 100 / np.maximum(100, r[good].max(1))
                x, x0, m = r[good] * scale[:, None], r0[good], np.clip(mu[good], grid[0][0], grid[0][-1])
                a, b = search(x, x0, m, grid, values), search(x, x0, m, grid, values, mixed_only)
                take = np.abs(a[0] - b[0]) < near
                f, s, g, d, e = (np.where(take, q, p) for p, q in zip(a, b))
                out[good] = np.stack([100 * f, 100 * s, g**2, d * 1e6, np.sqrt(e)], 1)
            for i, name in enumerate(new):
                pdf[name] = pd.Series(out[:, i], index=pdf.index).astype(object).where(~np.isnan(out[:, i]), None).astype("Float64")
            yield pdf

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), *(f"{c} double" for c in new)])
    return df.mapInPandas(run, schema)
