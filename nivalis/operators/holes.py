"""Filling holes of rasters by springs or a thin plate: each hole with its rim is a system of its own, solved by multigrid.

1. The pixels of a tile-day are dealt to blocks with a narrow halo. A block labels the holes
   inside it and solves those that end there, all together.
2. Holes that go on in other blocks are labelled across borders: the pairs of labels that meet at a border
   (bounded by the length of all borders) are united per tile-day, and each such hole with its rim becomes a
   group. No group holds more than one connected hole and the known pixels around it.
3. A system is solved by conjugate gradients, preconditioned by a multigrid cycle on the hole's mask; the number
   of steps hardly depends on how wide the hole is.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.operators.neighbourhood import BLOCK, in_blocks
from nivalis.sources.folders import stash

MOST_STEPS = 400
TOLERANCE = 1e-9
SMOOTHING = 3  # steps of Chebyshev's iteration before and after the coarse grid
DIRECT = 400  # unknowns that are solved directly
STENCILS = {
    "springs": [(0, 1), (1, 0), (0, -1), (-1, 0)],
    "plate": [(i, j) for i in range(-2, 3) for j in range(-2, 3) if 0 < abs(i) + abs(j) <= 2],
}


def spring_energy(x: np.ndarray) -> np.ndarray:
    """Gradient of half the sum of squared differences between horizontal and vertical neighbours."""
    out = np.zeros_like(x)
    for axis in (0, 1):
        d = np.diff(x, axis=axis)
        low, high = ((slice(1, None), slice(None, -1)) if axis == 0 else ((slice(None), slice(1, None)), (slice(None), slice(None, -1))))
        out[low] += d
        out[high] -= d
    return out


def plate_energy(x: np.ndarray) -> np.ndarray:
    """Gradient of half the sum of squared Laplacians; at the raster's edge a Laplacian has the directions that are there."""
    bend = np.zeros_like(x)
    bend[1:-1] += x[2:] - 2 * x[1:-1] + x[:-2]
    bend[:, 1:-1] += x[:, 2:] - 2 * x[:, 1:-1] + x[:, :-2]
    out = np.zeros_like(x)
    for b, o in ((bend[1:-1], out), (bend[:, 1:-1].T, out.T)):
        o[2:] += b
        o[1:-1] -= 2 * b
        o[:-2] += b
    return out


ENERGY = {"springs": spring_energy, "plate": plate_energy}


def finer(x: np.ndarray, n: int) -> np.ndarray:
    """Values on n places of a grid of half the distance along the first axis, as a quadratic B-spline's smooth refinement does it."""
    p = np.concatenate([x[:1], x, x[-1:]])
    out = np.empty((n, *x.shape[1:]))
    out[::2] = ((p[:-2] + 6 * p[1:-1] + p[2:]) / 8)[: (n + 1) // 2]
    out[1::2] = ((p[1:-1] + p[2:]) / 2)[: n // 2]
    return out


def coarser(y: np.ndarray) -> np.ndarray:
    """The transpose of finer()."""
    n = len(y)
    even, odd = y[::2], y[1::2]
    p = np.zeros((len(even) + 2, *y.shape[1:]))
    p[:-2] += even / 8
    p[1:-1] += even * 6 / 8
    p[2:] += even / 8
    p[1 : n // 2 + 1] += odd / 2
    p[2 : n // 2 + 2] += odd / 2
    p[1] += p[0]
    p[-2] += p[-1]
    return p[1:-1]


class Multigrid:
    """A symmetric cycle for an energy over a mask of unknowns, on grids of twice, four times ... the distance.

    A coarse place is an unknown if all fine places next to it are, so that its wave ends flat at the
    rim, as a clamped plate does; beyond the raster's edge there is no rim.
    """

    def __init__(self, mask: np.ndarray, method: str):
        self.energy, self.levels, self.inverse = ENERGY[method], [], None
        scale, rng, stride = 1.0, np.random.default_rng(0), 5 if method == "plate" else 3
        while True:
            level = (mask, scale)
            diagonal = np.ones(mask.shape)
            for i in range(stride):  # of places far enough apart to be told by one product
                for j in range(stride):
                    unit = np.zeros(mask.shape)
                    unit[i::stride, j::stride] = 1
                    unit *= mask
                    np.copyto(diagonal, self.apply(level, unit), where=unit > 0)
            v = rng.standard_normal(mask.shape) * mask
            for _ in range(15):
                w = self.apply(level, v) / diagonal
                largest = float(np.sqrt((w * w).sum() / max(float((v * v).sum()), 1e-300)))
                v = w / max(float(np.abs(w).max()), 1e-300)
            self.levels.append((mask, scale, diagonal, 1.1 * largest))
            inner = np.pad(mask, 1, constant_values=True)
            n, m = mask.shape
            inner = np.logical_and.reduce([inner[i : i + n, j : j + m] for i in range(3) for j in range(3)])[::2, ::2]
            if mask.sum() <= DIRECT or min(n, m) < 8 or not inner.any():
                break
            mask, scale = inner, scale / 4 if method == "plate" else scale
        self.at = np.flatnonzero(mask)
        if len(self.at) <= DIRECT:
            system = np.empty((len(self.at), len(self.at)))
            for k, place in enumerate(self.at):
                unit = np.zeros(mask.size)
                unit[place] = 1
                system[:, k] = self.apply(self.levels[-1], unit.reshape(mask.shape)).ravel()[self.at]
            self.inverse = np.linalg.pinv(system, hermitian=True)

    def apply(self, level: tuple, x: np.ndarray) -> np.ndarray:
        return np.where(level[0], self.energy(np.where(level[0], x, 0.0)), 0.0) * level[1]

    def smoothed(self, level: tuple, x: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Chebyshev's iteration for the upper part of the spectrum."""
        _, _, diagonal, high = level
        centre, half = high * 9 / 16, high * 7 / 16
        rho = half / centre
        step = (b - self.apply(level, x)) / diagonal / centre
        for _ in range(SMOOTHING - 1):
            x = x + step
            new = 1 / (2 * centre / half - rho)
            step = new * rho * step + 2 * new / half * (b - self.apply(level, x)) / diagonal
            rho = new
        return x + step

    def cycle(self, b: np.ndarray, k: int = 0) -> np.ndarray:
        level = self.levels[k]
        x = np.zeros_like(b)
        if k == len(self.levels) - 1 and self.inverse is not None:
            x.ravel()[self.at] = self.inverse @ b.ravel()[self.at]
            return x
        x = self.smoothed(level, x, b)
        if k < len(self.levels) - 1:
            mask = self.levels[k + 1][0]
            rest = b - self.apply(level, x)
            below = self.cycle(np.where(mask, coarser(coarser(rest).T).T, 0.0), k + 1)
            x = x + np.where(level[0], finer(finer(below, b.shape[0]).T, b.shape[1]).T, 0.0)
        return self.smoothed(level, x, b)


def solve(a: np.ndarray, mask: np.ndarray, method: str) -> tuple[np.ndarray, int]:
    """a with the places of the mask filled, and the steps it took; raises if the residual does not become small."""
    if method == "plate":
        a, _ = solve(a, mask, "springs")
    else:
        near = np.logical_or.reduce([np.roll(mask, s, axis) for s, axis in ((1, 0), (-1, 0), (1, 1), (-1, 1))]) & ~mask
        a = np.where(mask, a[near].mean() if near.any() else 0.0, a)
    grid = Multigrid(mask, method)
    level = grid.levels[0]
    r = -np.where(mask, grid.energy(a), 0.0)
    first = float(np.sqrt((r * r).sum()))
    scale = float(np.abs(a).max()) * np.sqrt(mask.sum()) * 1e-13  # what rounding leaves
    x, p, rz = np.zeros_like(a), None, 1.0
    for steps in range(MOST_STEPS):
        if float(np.sqrt((r * r).sum())) <= max(TOLERANCE * first, scale):
            return a + x, steps
        z = grid.cycle(r)
        new = float((r * z).sum())
        p = z if p is None else z + new / rz * p
        rz = new
        q = grid.apply(level, p)
        step = rz / max(float((p * q).sum()), 1e-300)
        x, r = x + step * p, r - step * q
    raise RuntimeError(f"holes were not filled to a tolerance of {TOLERANCE}")


def springs(a: np.ndarray) -> np.ndarray:
    """Fills nans by springs between horizontal and vertical neighbours: each is the mean of its neighbours, of which the edge has fewer."""
    holes = np.isnan(a)
    return a if not holes.any() or holes.all() else solve(np.where(holes, 0.0, a), holes, "springs")[0]


def plate(a: np.ndarray) -> np.ndarray:
    """Fills nans by a thin plate: the least sum of squared Laplacians."""
    holes = np.isnan(a)
    return a if not holes.any() or holes.all() else solve(np.where(holes, 0.0, a), holes, "plate")[0]


def united(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component, of 0 ... n - 1 with links a - b."""
    label = np.arange(n)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _pairs(one: np.ndarray, other: np.ndarray, stencil: list) -> tuple[np.ndarray, np.ndarray]:
    """Flat places of `one` and of `other` that are a stencil's offset apart."""
    n, m = one.shape
    number = np.arange(n * m).reshape(n, m)
    out = []
    for i, j in stencil:
        here = (slice(max(0, -i), n - max(0, i)), slice(max(0, -j), m - max(0, j)))
        there = (slice(max(0, i), n - max(0, -i)), slice(max(0, j), m - max(0, -j)))
        both = one[here] & other[there]
        out.append((number[here][both], number[there][both]))
    return tuple(np.concatenate(x) for x in zip(*out))


def labelled(mask: np.ndarray, stencil: list) -> np.ndarray:
    """The flat place of the first member of each place's hole; -1 outside."""
    label = united(mask.size, *_pairs(mask, mask, stencil)).reshape(mask.shape)
    return np.where(mask, label, -1)


VALUE, HOLE, RIM, EDGE = range(4)  # kinds of rows


def inpaint(px: DataFrame, value: str, day: list[str], rows: int, cols: int, method: str = "springs", block: int = BLOCK) -> DataFrame:
    """day, row, col and `<value>_filled` for every cell of a rows x cols tile: nulls and absent cells filled from around, known values unchanged.

    Rasters without any value stay null. A hole as large as a raster is one group.
    """
    stencil, halo = STENCILS[method], 1 if method == "springs" else 2
    kinds = {f.name: f.dataType.simpleString() for f in px.schema.fields}
    names = ["kind", "label", "row", "col", "value", "other"]
    of_day = ", ".join(f"`{d}` {kinds[d]}" for d in day)

    def in_block(keys: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        br, bc = int(keys[-2]), int(keys[-1])
        top, left = max(0, br * block - halo), max(0, bc * block - halo)
        a = np.full((min(rows, (br + 1) * block + halo) - top, min(cols, (bc + 1) * block + halo) - left), np.nan)
        pdf = pdf[pdf["value"].notna()]
        a[pdf["row"].to_numpy(int) - top, pdf["col"].to_numpy(int) - left] = pdf["value"].to_numpy(float)
        own = np.zeros(a.shape, bool)
        own[br * block - top : (br + 1) * block - top, bc * block - left : (bc + 1) * block - left] = True
        holes = np.isnan(a)
        label = labelled(holes & own, stencil)
        inside, outside = _pairs(holes & own, holes & ~own, stencil)
        goes_on = np.isin(label, np.unique(label.ravel()[inside])) & (label >= 0)
        closed = (label >= 0) & ~goes_on
        if closed.any() and not holes.all():
            a = np.where(closed, solve(np.where(holes, 0.0, a), closed, method)[0], a)
        place = lambda flat: (flat // a.shape[1] + top, flat % a.shape[1] + left)
        number = lambda flat: place(flat)[0] * cols + place(flat)[1]

        def table(kind, flat, label_=None, value_=None, other=None):
            r, c = place(flat)
            return pd.DataFrame({"kind": kind, "label": label_, "row": r, "col": c, "value": value_, "other": other}, columns=names)

        done = np.flatnonzero(own & ~goes_on)
        part = np.flatnonzero(goes_on)
        inner, rim = _pairs(goes_on, ~holes, stencil)
        around = np.unique(np.stack([label.ravel()[inner], rim]), axis=1)
        edges = np.unique(np.stack([label.ravel()[inside], outside]), axis=1)
        found = [
            table(VALUE, done, value_=a.ravel()[done]),
            table(HOLE, part, number(label.ravel()[part])),
            table(RIM, around[1], number(around[0]), a.ravel()[around[1]]),
            table(EDGE, edges[1], number(edges[0]), other=number(edges[1])),
        ]
        out = pd.concat([f for f in found if len(f)], ignore_index=True)
        for d, k in zip(day, keys):
            out[d] = k
        return out.astype({"label": "Int64", "other": "Int64", "value": "Float64"})

    slim = px.select(*day, "row", "col", F.col(value).cast("double").alias("value"))
    dealt = in_blocks(slim.where("value IS NOT NULL AND NOT isnan(value)"), day, halo, block)
    dealt = dealt.where((F.col("block_row") <= (rows - 1) // block) & (F.col("block_col") <= (cols - 1) // block))  # beyond the last one lies only halo
    count = lambda n: F.sequence(F.lit(0).cast("long"), F.lit((n - 1) // block).cast("long"))
    every = slim.select(*day).distinct().select(*day, F.explode(count(rows)).alias("block_row")).withColumn("block_col", F.explode(count(cols)))
    parts = dealt.unionByName(every, allowMissingColumns=True).groupBy(*day, "block_row", "block_col")
    found = stash(parts.applyInPandas(in_block, f"{of_day}, kind int, label long, row int, col int, value double, other long"), "holes")
    of_kind = lambda *which: found.where(F.col("kind").isin(*which))

    def unite(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, at = np.unique(pdf[["label", "beyond"]].to_numpy(), return_inverse=True)
        at = at.reshape(-1, 2)
        out = pd.DataFrame({"label": ids, "hole": ids[united(len(ids), at[:, 0], at[:, 1])]})
        for d in day:
            out[d] = pdf[d].iloc[0]
        return out

    border = of_kind(HOLE).select(*day, (F.col("row").cast("long") * cols + F.col("col")).alias("other"), F.col("label").alias("beyond"))
    links = of_kind(EDGE).select(*day, "label", "other").join(border, [*day, "other"]).select(*day, "label", "beyond").distinct()
    holes = links.groupBy(*day).applyInPandas(unite, f"label long, hole long, {of_day}")

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        top, left = max(0, int(pdf["row"].min()) - 1), max(0, int(pdf["col"].min()) - 1)
        a = np.zeros((min(rows, int(pdf["row"].max()) + 2) - top, min(cols, int(pdf["col"].max()) + 2) - left))
        mask, r, c = np.zeros(a.shape, bool), pdf["row"].to_numpy() - top, pdf["col"].to_numpy() - left
        hole = pdf["kind"].to_numpy() == HOLE
        mask[r[hole], c[hole]] = True
        a[r[~hole], c[~hole]] = pdf["value"].to_numpy(float)[~hole]
        out = pdf.loc[hole, [*day, "row", "col"]].copy()
        filled = solve(a, mask, method)[0] if not hole.all() else np.full(a.shape, np.nan)
        out["value"] = pd.Series(filled[r[hole], c[hole]], index=out.index).astype("Float64").where(~np.isnan(filled[r[hole], c[hole]]))
        return out

    wide = of_kind(HOLE, RIM).select(*day, "kind", "label", "row", "col", "value").join(holes, [*day, "label"])
    wide = wide.groupBy(*day, "hole").applyInPandas(fill, f"{of_day}, row int, col int, value double")
    return of_kind(VALUE).select(*day, "row", "col", "value").unionByName(wide).withColumnRenamed("value", f"{value}_filled")
