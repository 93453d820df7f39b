"""Operators that look at neighbours within a tile-day.

The pixels of a tile-day are dealt to square blocks with a halo as wide as the operator
looks; a block is a task's group of bounded size, and only its own pixels come back. So no
pixel is exploded to all its neighbours, and no tile is held whole (but for idw_fill, whose
sums go over the whole raster).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.operators.joins import MARGIN_STEPS_A, MARGIN_STEPS_B, elevation_band

BLOCK = 200


def in_blocks(px: DataFrame, day: list[str], halo: int, block: int = BLOCK) -> DataFrame:
    """Each pixel once for every block whose halo it lies in (four at most), with block_row and block_col. Rows and columns count from 0."""
    for c in ("row", "col"):
        near = F.sequence(F.greatest(F.lit(0).cast("long"), F.floor((F.col(c) - halo) / block)), F.floor((F.col(c) + halo) / block))
        px = px.withColumn(f"block_{c}", F.explode(near))
    return px


def over_blocks(px: DataFrame, day: list[str], halo: int, values: list[str], work: Callable, out: dict[str, str], block: int = BLOCK) -> DataFrame:
    """Runs work(arrays by name, present mask) -> arrays by name on each block; returns day, row, col and the results."""
    keys = [*day, "block_row", "block_col"]
    kinds = {f.name: f.dataType.simpleString() for f in px.schema.fields}

    def run(table: pa.Table) -> pa.Table:
        # Arrays as large as what the block holds; beyond it there is nothing to be seen.
        row, col, block_row, block_col = (table.column(k).to_numpy() for k in ("row", "col", "block_row", "block_col"))
        r, c = row - int(row.min()), col - int(col.min())
        shape = (int(r.max()) + 1, int(c.max()) + 1)
        present = np.zeros(shape, bool)
        present[r, c] = True
        arrays = {}
        for v in values:
            a = np.full(shape, np.nan)
            a[r, c] = table.column(v).cast("float64").to_numpy()
            arrays[v] = a
        found = work(arrays, present)
        own = (row // block == block_row) & (col // block == block_col)
        result = table.select([*day, "row", "col"]).filter(pa.array(own))
        for name in out:
            result = result.append_column(name, pa.array(found[name][r[own], c[own]], from_pandas=True))
        return result

    schema = ", ".join([*(f"`{d}` {kinds[d]}" for d in day), f"row {kinds['row']}", f"col {kinds['col']}", *(f"{k} {t}" for k, t in out.items())])
    slim = px.select(*day, "row", "col", *values)
    # Few bytes, much work: a stated number of partitions is not coalesced.
    tasks = int(px.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return in_blocks(slim, day, halo, block).repartition(tasks, *keys).groupBy(*keys).applyInArrow(run, schema)


def shifted_sum(a: np.ndarray, reach: int, weight: Callable[[int, int], float]) -> np.ndarray:
    """Weighted sum over the (2 reach + 1) square around each place of the last two axes; outside counts 0."""
    padded = np.pad(a, [(0, 0)] * (a.ndim - 2) + [(reach, reach)] * 2)
    n, m = a.shape[-2:]
    out = np.zeros(a.shape)
    for i in range(2 * reach + 1):
        for j in range(2 * reach + 1):
            out += weight(i - reach, j - reach) * padded[..., i : i + n, j : j + m]
    return out


def despeckled(cloud: np.ndarray, least: int = 3, reach: int = 2) -> np.ndarray:
    return cloud & (shifted_sum(cloud.astype(float), reach, lambda i, j: 1.0) > least)


def cloud_despeckle(px: DataFrame, cloud: str, day: list[str], least: int = 3, block: int = BLOCK) -> DataFrame:
    """day, row, col and is_cloud: cloud pixels with more than `least` clouds in the 5 x 5 around (itself counted)."""
    work = lambda a, present: {"is_cloud": despeckled(a[cloud] == 1, least)}
    return over_blocks(px.withColumn(cloud, F.col(cloud).cast("int")), day, 2, [cloud], work, {"is_cloud": "boolean"}, block)


def cloud_share(cloud: np.ndarray, bands: list[np.ndarray], reach: int = 5) -> np.ndarray:
    """Percent of cloud around, weighted by 1 / (distance + 1), among pixels of the same elevation band; the most of several band sets.

    Each place around is compared with the pixel's own band, so the work does not grow with the number of bands.
    """
    if not cloud.any():
        return np.zeros(cloud.shape)
    tall = cloud.shape[0] > cloud.shape[1]
    if tall:  # long rows are added up faster; sums keep their order
        cloud, bands = cloud.T, [b.T for b in bands]
    own, cloudy, (n, m) = np.stack(bands).astype(np.int16), np.pad(cloud, reach), cloud.shape
    around = np.pad(own, [(0, 0), (reach, reach), (reach, reach)], constant_values=-1)
    clouds, total, term = np.zeros(own.shape), np.zeros(own.shape), np.zeros(own.shape)
    weights = 1 / (np.hypot(*np.mgrid[-reach : reach + 1, -reach : reach + 1]) + 1)
    for (i, j), weight in np.ndenumerate(weights):
        i, j = (j, i) if tall else (i, j)
        alike = around[:, i : i + n, j : j + m] == own
        total += np.multiply(alike, weight, out=term)
        alike &= cloudy[i : i + n, j : j + m]
        clouds += np.multiply(alike, weight, out=term)
    out = np.where(own > 0, np.floor(100 * (clouds / np.maximum(total, 1e-12)) + 0.5), 0).max(axis=0)
    return out.T if tall else out


def cloud_margin(px: DataFrame, cloud: str, day: list[str], block: int = BLOCK) -> DataFrame:
    """day, row, col and is_margin: no cloud itself, but more than 1 % of (despeckled) cloud in the 11 x 11 around at its elevation."""

    def work(a, present):
        cloud_ = a[cloud] == 1
        bands = [np.nan_to_num(a[b]) for b in ("band_a", "band_b")]
        return {"is_margin": (cloud_share(despeckled(cloud_), bands) > 1) & ~cloud_}

    own = px.withColumns({cloud: F.col(cloud).cast("int"), "band_a": elevation_band(F.col("elevation"), MARGIN_STEPS_A), "band_b": elevation_band(F.col("elevation"), MARGIN_STEPS_B)})
    return over_blocks(own, day, 7, [cloud, "band_a", "band_b"], work, {"is_margin": "boolean"}, block)


#: Rows whose weights are made at once, and values of a strip of frequencies. They set the memory, not the result.
ROWS_AT_ONCE, FREQUENCIES = 1024, 1 << 18


def inverse_distance_means(value: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """At every place of a raster the mean of the valid values, weighted by 1 / distance (a place itself does not count); nan without any.

    Both sums are convolutions with the weights, so the work grows as n log n with the raster's size. Columns are transformed
    first; then a few frequencies at a time go through the transform along the rows, so no padded raster is held.
    """
    if value.shape[0] < value.shape[1]:
        return inverse_distance_means(value.T, valid.T).T
    n, m = value.shape
    middle = value[valid].mean() if valid.any() else 0.0  # keeps what rounding can add small
    sums = [np.fft.rfft(x, 2 * m, axis=1) for x in (np.where(valid, value - middle, 0.0), valid)]
    i = np.minimum(np.arange(2 * n), 2 * n - np.arange(2 * n))
    j = np.minimum(np.arange(2 * m), 2 * m - np.arange(2 * m))
    weights = np.zeros((n + 1, m + 1))  # both halves of a row or column are alike, and its transform is real
    for at in range(0, n + 1, ROWS_AT_ONCE):
        with np.errstate(divide="ignore"):
            some = 1 / np.hypot(np.arange(at, min(n + 1, at + ROWS_AT_ONCE))[:, None], j)
        if not at:
            some[0, 0] = 0
        weights[at : at + ROWS_AT_ONCE] = np.fft.rfft(some, axis=1).real
    some = max(1, FREQUENCIES // n)
    for at in range(0, m + 1, some):
        kernel = np.fft.fft(weights[i, at : at + some], axis=0)
        for x in sums:
            x[:, at : at + some] = np.fft.ifft(np.fft.fft(x[:, at : at + some], 2 * n, axis=0) * kernel, axis=0)[:n]
    del weights
    total, share = (np.fft.irfft(x, 2 * m, axis=1)[:, :m].copy() for x in sums)
    share[share <= 1e-9] = np.nan
    return middle + total / share


def idw_fill(px: DataFrame, value: str, target: str, day: list[str]) -> DataFrame:
    """day, row, col and `<value>_idw` for target pixels: the mean of all valid pixels of the tile-day, weighted by 1 / distance.

    A group is one raster of a tile-day, whose size is fixed; only targets and valid pixels go there. Targets of a
    tile-day without valid pixels are left out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in px.schema.fields}

    def run(table: pa.Table) -> pa.Table:
        row, col = (table.column(k).to_numpy() for k in ("row", "col"))
        r, c = row - int(row.min()), col - int(col.min())
        wanted, given = table.column(target).to_numpy(), table.column(value).to_numpy()
        a, valid = np.zeros((int(r.max()) + 1, int(c.max()) + 1)), np.zeros((int(r.max()) + 1, int(c.max()) + 1), bool)
        a[r[~wanted], c[~wanted]], valid[r[~wanted], c[~wanted]] = given[~wanted], True
        found = inverse_distance_means(a, valid)[r[wanted], c[wanted]]
        out = table.select([*day, "row", "col"]).filter(pa.array(wanted)).append_column(f"{value}_idw", pa.array(found))
        return out.filter(pa.array(~np.isnan(found)))

    own = px.select(*day, "row", "col", F.col(value).cast("double").alias(value), F.coalesce(F.col(target), F.lit(False)).alias(target))
    own = own.where(F.col(target) | F.col(value).isNotNull())
    schema = ", ".join([*(f"`{d}` {kinds[d]}" for d in day), f"row {kinds['row']}", f"col {kinds['col']}", f"{value}_idw double"])
    return own.groupBy(*day).applyInArrow(run, schema)
