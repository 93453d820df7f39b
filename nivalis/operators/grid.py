"""Grids: mosaics, crops, cells, map projections and reprojection by nearest cell."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis.operators.series import PIXEL

# The sinusoidal grid (metres).
RADIUS = 6371007.181
SIZE = 2400
CELL = 2 * math.pi * RADIUS / 36 / SIZE
X0, Y0 = -math.pi * RADIUS, math.pi * RADIUS / 2
WEB_RADIUS = 6378137.0


def tile_indices(tile: Column) -> tuple[Column, Column]:
    """h and v of a tile name such as h08v04."""
    return F.substring(tile, 2, 2).cast("int"), F.substring(tile, 5, 2).cast("int")


def mosaic_tiles(px: DataFrame, links: DataFrame, tile_rows: int = SIZE, tile_cols: int = SIZE) -> DataFrame:
    """Rows and columns on the grid of each region that has the tile (mosaic_row, mosaic_col).

    Offsets come from the smallest h and v of a region's tiles; links are configuration, one row per region and tile.
    """
    h, v = tile_indices(F.col("tile"))
    own = links.select("region", "tile", h.alias("h"), v.alias("v"))
    low = own.groupBy("region").agg(F.min("h").alias("h0"), F.min("v").alias("v0"))
    place = own.join(low, "region").select("region", "tile", ((F.col("v") - F.col("v0")) * tile_rows).alias("r0"), ((F.col("h") - F.col("h0")) * tile_cols).alias("c0"))
    return px.join(place, "tile").withColumns({"mosaic_row": F.col("row") + F.col("r0"), "mosaic_col": F.col("col") + F.col("c0")}).drop("r0", "c0")


def crop_tile(mosaic: DataFrame, tile: str) -> DataFrame:
    """The part of a mosaic that is one tile, with its own rows and columns."""
    return mosaic.where(F.col("tile") == tile).drop("mosaic_row", "mosaic_col")


def crop_extent(df: DataFrame, rows: tuple[int, int], cols: tuple[int, int], row: str = "row", col: str = "col") -> DataFrame:
    """Rows and columns within limits (inclusive), counted from the crop's corner."""
    own = df.where(F.col(row).between(*rows) & F.col(col).between(*cols))
    return own.withColumns({row: F.col(row) - rows[0], col: F.col(col) - cols[0]})


def cell_of_pixel(row: Column, col: Column, rows: int = SIZE, cols: int = SIZE, per_side: int = 6) -> tuple[Column, Column]:
    """Cell indices from 0; the last cell takes the remainder."""
    cell = lambda x, n: F.least(F.floor(x / (n // per_side)), F.lit(per_side - 1)).cast("int")
    return cell(row, rows), cell(col, cols)


def assemble_cells(parts: list[DataFrame], cells: int) -> DataFrame:
    """Results of cells as one table, for dates that all of the tile's cells have."""
    from functools import reduce

    whole = reduce(DataFrame.unionByName, parts)
    return complete_days(whole, ["tile", "obs_date"], F.struct("cell_row", "cell_col"), cells)


def complete_days(df: DataFrame, keys: list[str], part: Column, expected: int) -> DataFrame:
    """The rows of the groups that have all expected parts."""
    full = df.groupBy(*keys).agg(F.count_distinct(part).alias("_n")).where(F.col("_n") == expected).select(*keys)
    return df.join(full, keys, "left_semi")


def completeness_gate(files: DataFrame, links: DataFrame) -> DataFrame:
    """Region-days with a file of every tile of the region, and the day up to which all tiles have come (end_date)."""
    own = files.select("tile", "obs_date").distinct().join(links.select("region", "tile").distinct(), "tile")
    need = links.groupBy("region").agg(F.count_distinct("tile").alias("need"))
    days = own.groupBy("region", "obs_date").agg(F.count("*").alias("tiles")).join(need, "region").where("tiles = need")
    ends = own.groupBy("region", "tile").agg(F.max("obs_date").alias("d")).groupBy("region").agg(F.min("d").alias("end_date"))
    return days.join(ends, "region").select("region", "obs_date", "tiles", "end_date")


def reset_variables(spark: SparkSession, tile: str, date: str, variables: dict[str, int | None], rows: int, cols: int) -> DataFrame:
    """A tile-day with default values (None: nodata) of a group of variables."""
    cells = spark.range(rows * cols).select(F.lit(tile).alias("tile"), F.expr(f"cast(id div {cols} as int)").alias("row"), F.expr(f"cast(id % {cols} as int)").alias("col"))
    return cells.select("*", F.to_date(F.lit(date)).alias("obs_date"), *[F.lit(v).cast("int").alias(k) for k, v in variables.items()])


def reset_days(px: DataFrame, days: DataFrame, variables: list[str]) -> DataFrame:
    """Pixel-days with the variables set to nodata on the tile-days of another table."""
    mark = days.select("tile", "obs_date").distinct().withColumn("_reset", F.lit(True))
    own = px.join(mark, ["tile", "obs_date"], "left")
    return own.withColumns({v: F.when(F.col("_reset").isNull(), F.col(v)) for v in variables}).drop("_reset")


def sinusoidal_of(lat: Column, lon: Column) -> tuple[Column, Column]:
    """x and y in metres; angles in degrees."""
    return F.radians(lon) * F.cos(F.radians(lat)) * RADIUS, F.radians(lat) * RADIUS


def latlon_of_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    lat = F.degrees(F.atan(F.exp(y / WEB_RADIUS)) * 2 - math.pi / 2)
    return lat, F.degrees(x / WEB_RADIUS)


def pixel_of(x: Column, y: Column, size: int = SIZE) -> dict[str, Column]:
    """Tile, row and column (of tiles with size x size pixels) that a point of the sinusoidal plane lies in."""
    cell = 2 * math.pi * RADIUS / 36 / size
    gx, gy = F.floor((x - X0) / cell), F.floor((F.lit(Y0) - y) / cell)
    name = F.concat(F.lit("h"), F.lpad((gx / size).cast("int").cast("string"), 2, "0"), F.lit("v"), F.lpad((gy / size).cast("int").cast("string"), 2, "0"))
    return {"tile": name, "row": F.pmod(gy, F.lit(size)).cast("int"), "col": F.pmod(gx, F.lit(size)).cast("int")}


def target_grid(spark: SparkSession, x0: float, y0: float, step: float, rows: int, cols: int, parts: int | None = None) -> DataFrame:
    """Centres of the cells of an output grid: t_row, t_col, tx, ty. Made from a range, in parallel."""
    ids = spark.range(0, rows * cols, 1, parts) if parts else spark.range(rows * cols)
    grid = ids.select(F.expr(f"cast(id div {cols} as int)").alias("t_row"), F.expr(f"cast(id % {cols} as int)").alias("t_col"))
    return grid.select("*", ((F.col("t_col") + 0.5) * step + x0).alias("tx"), (F.lit(y0) - (F.col("t_row") + 0.5) * step).alias("ty"))


def reprojection_index(grid: DataFrame, crs: str = "EPSG:4326", size: int = SIZE) -> DataFrame:
    """grid with the pixel (tile, row, col) that each target cell lies in: the same for all days and variables."""
    if crs == "EPSG:4326":
        lat, lon = F.col("ty"), F.col("tx")
    elif crs == "EPSG:3857":
        lat, lon = latlon_of_web_mercator(F.col("tx"), F.col("ty"))
    else:
        raise ValueError("EPSG:4326 or EPSG:3857")
    return grid.withColumns(pixel_of(*sinusoidal_of(lat, lon), size))


def write_index(index: DataFrame, path: str) -> DataFrame:
    """Stores an index by tile, to be read for every day and variable."""
    index.repartition("tile").sortWithinPartitions("tile", "row", "col").write.mode("overwrite").partitionBy("tile").parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def reproject_indexed(px: DataFrame, index: DataFrame, processed: str = "snow") -> DataFrame:
    """Each target cell of a stored index with its pixel; cells without one keep nulls; notprocessed tells where the variable is null.

    Only tiles that the target meets are read: their names (648 in all the world) are looked up first, and the
    condition on them reaches the scan, as a partition filter where pixels are stored by tile.
    """
    tiles = [r.tile for r in index.select("tile").distinct().collect()]
    out = index.join(px.where(F.col("tile").isin(tiles)), PIXEL, "left")
    return out.withColumn("notprocessed", F.col(processed).isNull())


def reproject_nearest(px: DataFrame, grid: DataFrame, crs: str = "EPSG:4326", size: int = SIZE, processed: str = "snow") -> DataFrame:
    """The same without a stored index."""
    out = reprojection_index(grid, crs, size).join(px, PIXEL, "left")
    return out.withColumn("notprocessed", F.col(processed).isNull())
