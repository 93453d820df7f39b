"""Joins of pixel-days with static rasters, coarser grids, masks and configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.operators.series import PIXEL


def with_static(px: DataFrame, static: DataFrame) -> DataFrame:
    """Elevation, slope and the like onto pixel-days. Tables of write_pixel_buckets join without a shuffle."""
    return px.join(static, PIXEL, "left")


#: A key with more than one in SHARE of all rows is hot; so there are fewer than SHARE hot keys.
SHARE = 1000


def split_join(left: DataFrame, right: DataFrame, on: list[str], hot: Column) -> DataFrame:
    """A left join to a table with one row per key whose hot rows meet their partners by broadcast, the others by a shuffle.

    `hot` is a condition on right that fewer than SHARE rows fulfil, such as a count above one in SHARE of all.
    """
    new = [c for c in right.columns if c not in on]
    found = F.struct(*[F.col(c) for c in new]).alias("_hot")
    tagged = left.join(F.broadcast(right.where(hot).select(*on, found)), on, "left")
    easy = tagged.where(F.col("_hot").isNotNull()).select(*left.columns, *[F.col("_hot")[c].alias(c) for c in new])
    rest = tagged.where(F.col("_hot").isNull()).drop("_hot").join(right.where(~hot), on, "left")
    return easy.unionByName(rest.select(*left.columns, *new))


def resample_join(fine: DataFrame, coarse: DataFrame, value: str, factor: int = 2, method: str = "nearest", on=("tile", "obs_date")) -> DataFrame:
    """A coarse grid's value onto the fine grid: that of the cell the pixel lies in, or bilinear from four cells.

    Bilinear: weights by the distance of cell centres; cells that are missing are left out.
    """
    on = list(on)
    own = coarse.select(*on, F.col("row").alias("c_row"), F.col("col").alias("c_col"), F.col(value).alias(value))
    if method == "nearest":
        at = fine.withColumns({"c_row": F.expr(f"row div {factor}"), "c_col": F.expr(f"col div {factor}")})
        return at.join(own, [*on, "c_row", "c_col"], "left").drop("c_row", "c_col")
    # A row for each corner between four cells holds all four values, so the fine grid is joined once.
    sides = [(i, j) for i in (0, 1) for j in (0, 1)]
    spread = own.withColumn("_k", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in sides])))
    spread = spread.groupBy(*on, (F.col("c_row") - F.col("_k.i")).alias("c_row"), (F.col("c_col") - F.col("_k.j")).alias("c_col"))
    corners = spread.agg(*[F.max(F.when((F.col("_k.i") == i) & (F.col("_k.j") == j), F.col(value))).alias(f"_v{i}{j}") for i, j in sides])
    at = fine.withColumns({f"_{c}": (F.col(c) + 0.5) / factor - 0.5 for c in ("row", "col")})
    at = at.withColumns({f"c_{c}": F.floor(f"_{c}").cast("int") for c in ("row", "col")}).join(corners, [*on, "c_row", "c_col"], "left")
    share = {c: F.col(f"_{c}") - F.col(f"c_{c}") for c in ("row", "col")}
    weight = {(i, j): (share["row"] if i else 1 - share["row"]) * (share["col"] if j else 1 - share["col"]) for i, j in sides}
    total = lambda of: sum((F.coalesce(of(k, F.col(f"_v{k[0]}{k[1]}")), F.lit(0.0)) for k in sides), F.lit(0.0))
    mean = total(lambda k, v: weight[k] * v) / F.nullif(total(lambda k, v: F.when(v.isNotNull(), weight[k])), F.lit(0.0))
    return at.select(*fine.columns, mean.alias(value))


def coarsen(fine: DataFrame, value: str, factor: int = 2, on=("tile", "obs_date")) -> DataFrame:
    """The mean of a fine grid's values in each coarse cell."""
    return fine.groupBy(*on, F.expr(f"row div {factor}").alias("row"), F.expr(f"col div {factor}").alias("col")).agg(F.avg(value).alias(value))


def variable_config(variables: DataFrame, versions: DataFrame, label: str) -> DataFrame:
    """The variables of a version label with their attributes; both tables are configuration, small by nature."""
    return versions.where(F.col("label") == label).join(variables, "variable_id").distinct()


def region_tiles(pixels: DataFrame, links: DataFrame) -> DataFrame:
    """Tiles with all the active regions that hold them."""
    return pixels.select("tile").distinct().join(links.where("is_active = 1"), "tile")


def version_for_tile(pixels: DataFrame, versions: DataFrame, label: str, output_version: str) -> DataFrame:
    """Tiles with the version of their input for an output version and data label; tiles that are not configured drop."""
    chosen = versions.where((F.col("data_label") == label) & (F.col("output_version") == output_version))
    return pixels.select("tile").distinct().join(chosen.select("tile", "output_version", "input_version").distinct(), "tile")


def with_subdivision(px: DataFrame, mask: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Each pixel-day once for every subdivision the pixel is in."""
    chosen = mask.where(F.col("type").isin(types)) if types else mask
    return px.join(chosen, PIXEL)


# Edges of elevation steps, in metres.
MEDIAN_STEPS = (-500, *range(0, 5001, 200), 5500, 6000, 9000)
MARGIN_STEPS_A = (-500, *range(0, 5001, 100), 5500, 6000, 9000)
MARGIN_STEPS_B = (-500, *range(-50, 5051, 100), 5500, 6000, 9000)


def elevation_band(elevation: Column, edges=MEDIAN_STEPS) -> Column:
    """Index from 1 of the half-open step [edge, next edge) the elevation lies in; null outside all."""
    steps = F.array(*map(F.lit, edges))
    below = F.size(F.filter(steps, lambda e: e <= elevation))
    return F.when((below > 0) & (below < len(edges)), below)
