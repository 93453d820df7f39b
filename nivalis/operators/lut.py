"""Look-up tables: multilinear interpolation in n dimensions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of a table; a table is a fixed product, this guards against passing a long table by mistake.
MOST_VALUES = 20_000_000


def shared_table(spark, axes: list[np.ndarray], values: np.ndarray):
    """A broadcast of a table whose size has been checked."""
    if values.size > MOST_VALUES:
        raise ValueError(f"a look-up table of {values.size} values is not broadcast")
    return spark.sparkContext.broadcast((axes, values))


def lut_arrays(lut: DataFrame, axes: list[str], value: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Axes and values of a long table that has a row for each combination; its size is checked before it is collected."""
    n = lut.count()
    if n > MOST_VALUES:
        raise ValueError(f"a look-up table of {n} rows is not broadcast")
    pdf = lut.select(*axes, value).toPandas().sort_values(axes)
    grid = [np.unique(pdf[a].to_numpy(dtype=float)) for a in axes]
    if int(np.prod([len(g) for g in grid])) != n:
        raise ValueError("the table is no full grid")
    return grid, pdf[value].to_numpy(dtype=float).reshape([len(g) for g in grid])


def _corners(axes: list[np.ndarray], points: np.ndarray):
    """Of points (n x axes): the lower corner, the share of the way to the upper one, the steps, and who is outside the grid."""
    n = len(points)
    low, share, steps, outside = [], [], [], np.zeros(n, bool)
    for d, axis in enumerate(axes):
        x = points[:, d]
        outside |= ~((x >= axis[0]) & (x <= axis[-1]))
        i = np.clip(np.searchsorted(axis, x, side="right") - 1, 0, max(len(axis) - 2, 0))
        step = axis[i + 1] - axis[i] if len(axis) > 1 else np.ones(n)
        low.append(i)
        share.append((x - axis[i]) / step if len(axis) > 1 else np.zeros(n))
        steps.append(step)
    return low, share, steps, outside


def interpolate(axes: list[np.ndarray], values: np.ndarray, points: np.ndarray) -> np.ndarray:
    """At points (n x axes); nan outside the grid. Leading axes of `values` beyond the given ones are last in the result."""
    return interpolate_with_slopes(axes, values, points, [])[0]


def interpolate_with_slopes(axes: list[np.ndarray], values: np.ndarray, points: np.ndarray, along: list[int]) -> list[np.ndarray]:
    """The values, then their slopes along some axes; on a node's border those of the upper cell."""
    n, dims = points.shape
    low, share, steps, outside = _corners(axes, points)
    out = [np.zeros((n, *values.shape[dims:])) for _ in range(1 + len(along))]
    for corner in range(1 << dims):
        bits = [(corner >> d) & 1 for d in range(dims)]
        weights = [s if b else 1 - s for s, b in zip(share, bits)]
        found = values[tuple(np.minimum(i + b, len(a) - 1) for i, b, a in zip(low, bits, axes))]
        for k, axis in enumerate([None, *along]):
            weight = np.prod([w if d != axis else (1 if bits[d] else -1) / steps[d] for d, w in enumerate(weights)], axis=0)
            out[k] += weight.reshape(-1, *[1] * (found.ndim - 1)) * found
    for x in out:
        x[outside] = np.nan
    return out


def at_node(axes: list[np.ndarray], values: np.ndarray, axis: int, x: float) -> tuple[list[np.ndarray], np.ndarray] | None:
    """The table at a node of one axis, without that axis; None if x is no node, or if a value is not finite and so not cancelled by a weight of 0."""
    found = np.flatnonzero(axes[axis] == x)
    if not len(found) or not np.isfinite(values).all():
        return None
    return [*axes[:axis], *axes[axis + 1 :]], np.ascontiguousarray(values.take(found[0], axis))


def interpolate_several(axes: list[np.ndarray], tables: list[np.ndarray], points: list[np.ndarray]) -> list[np.ndarray]:
    """To the bit what interpolate() gives of each table over the same axes, at points given as an array for each axis; corners and weights are found once."""
    corners, outside, shape = [(0, 1.0)], False, tables[0].shape
    for d, (axis, x) in enumerate(zip(axes, points)):
        outside |= ~((x >= axis[0]) & (x <= axis[-1]))
        stride = int(np.prod(shape[d + 1 :]))
        i = np.clip(np.searchsorted(axis, x, side="right") - 1, 0, max(len(axis) - 2, 0))
        if len(axis) == 1:
            continue
        share = (x - axis[i]) / (axis[i + 1] - axis[i])
        i = i * stride
        corners = [(at + place, weight * part) for place, part in ((i, 1 - share), (i + stride, share)) for at, weight in corners]
    out = []
    for flat in (table.ravel() for table in tables):
        found = np.zeros(len(points[0]))
        for at, weight in corners:
            found += weight * flat[at]
        found[outside] = np.nan
        out.append(found)
    return out


def lut_interpolate(df: DataFrame, axes: list[np.ndarray], values: np.ndarray, inputs: list, out: str) -> DataFrame:
    """Adds the interpolated value; null where an input is null or outside the table."""
    shared = shared_table(df.sparkSession, axes, values)

    @F.pandas_udf("double")
    def look_up(columns: pd.DataFrame) -> pd.Series:
        grid, table = shared.value
        found = interpolate(grid, table, columns.to_numpy(dtype=float, na_value=np.nan))
        return pd.Series(found, index=columns.index).astype(object).where(~np.isnan(found), None)

    columns = F.struct(*[F.col(c).cast("double").alias(f"x{i}") if isinstance(c, str) else c.cast("double").alias(f"x{i}") for i, c in enumerate(inputs)])
    return df.withColumn(out, look_up(columns))
