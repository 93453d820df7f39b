"""Groups of pixels: backgrounds, salt pans, medians of a pyramid of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from nivalis.functions.optics import normalised_difference
from nivalis.operators.joins import MEDIAN_STEPS, elevation_band
from nivalis.operators.series import PIXEL
from nivalis.sources.folders import stash

BANDS = [f"b{k}" for k in range(1, 8)]
LEVELS = (24, 12, 6, 3, 2, 1)


def background_reflectance(px: DataFrame, months=(8, 9), most_zenith: float = 30, least_b3: int = 10) -> DataFrame:
    """Per pixel the seven bands of its most snow-free day of the season.

    The day of the largest NDVI (only days classified neither snow nor cloud), unless the
    smallest NDSI is above 0: then the day of the smallest band 3 that is not dark. First
    day of ties; days seen under a larger view zenith do not count.
    """
    own = px.where(F.month("obs_date").isin(*months) & (F.col("sensor_zenith") <= most_zenith))
    ndsi, ndvi = normalised_difference(F.col("b3"), F.col("b6")), normalised_difference(F.col("b2"), F.col("b1"))
    own = own.withColumns({"_ndsi": ndsi, "_ndvi": F.when(F.col("class") == 2, ndvi)})
    spectrum = F.struct("obs_date", *BANDS)
    date = -F.unix_date("obs_date")
    green = F.max(F.when(F.col("_ndvi").isNotNull(), F.struct(F.col("_ndvi"), date.alias("d"), spectrum.alias("s"))))
    dark = F.min(F.when(F.col("b3") >= least_b3, F.struct(F.col("b3").alias("v"), (-date).alias("d"), spectrum.alias("s"))))
    found = own.groupBy(*PIXEL).agg(green.alias("green"), dark.alias("dark"), F.min("_ndsi").alias("least_ndsi"))
    pick = F.when((F.col("least_ndsi") > 0) | F.col("green").isNull(), F.col("dark.s")).otherwise(F.col("green.s"))
    return found.select(*PIXEL, pick.alias("s")).select(*PIXEL, F.col("s.obs_date").alias("background_date"), *[F.col(f"s.{b}").alias(b) for b in BANDS])


def saltpan_flag(px: DataFrame, day: list[str], snow: str = "snow", base: str = "is_base", step: int = 10, above: int = 40, least_pixels: int = 25, least_bins: int = 5, percent: float = 5, low: int = -50, high: int = 5400) -> DataFrame:
    """Adds is_saltpan: base pixels with snow where the elevations around are free of snow.

    Per day, cell and elevation bin: the share of base pixels with snow. A bin counts as snow-free
    if, of it and the `above` bins above, enough have a share below `percent`; bins without that many
    above them are never.
    """
    key = [*day, "cell_row", "cell_col"]
    own = px.withColumn("bin", F.floor((F.col("elevation") - low) / step).cast("int"))
    top = (high - low) // step
    shares = own.where(F.col(base) & F.col("bin").between(0, top - 1)).groupBy(*key, "bin").agg(
        F.count("*").alias("n"), F.count(F.when(F.col(snow) > 0, 1)).alias("snowy")
    )
    free = shares.where((F.col("n") >= least_pixels) & (F.col("snowy") * 100 < F.col("n") * percent)).select(*key, "bin")
    # A free bin speaks for itself and the `above` bins below it.
    votes = free.select(*key, F.explode(F.sequence(F.col("bin") - above, F.col("bin"))).alias("bin")).groupBy(*key, "bin").agg(F.count("*").alias("votes"))
    votes = votes.where((F.col("votes") >= least_bins) & F.col("bin").between(0, top - above))
    flagged = own.join(votes, [*key, "bin"], "left")
    return flagged.withColumn("is_saltpan", F.col("votes").isNotNull() & F.coalesce(F.col(base) & (F.col(snow) > 0), F.lit(False))).drop("votes", "bin")


def spatial_medians(px: DataFrame, value: str, day: list[str], rows: int, cols: int, edges=MEDIAN_STEPS, least: int = 10, snow: str = "snow", valid: str = "valid") -> DataFrame:
    """Per day, elevation band and finest cell (_cr, _cc) the median of the valid snow pixels' values around, as _around.

    For band k the bands k, k + 1, ... top, then the others downwards are asked; in each, the smallest cell of a
    pyramid (24 ... 1 per side) with more than `least` valid values above 0 (any at the
    top) gives the median, rounded. All medians come from histograms of integers, and are stored once, as each
    level asks them; the order of bands is settled on the small table of (day, band).
    """
    own = px.withColumn("band", elevation_band(F.col("elevation"), edges))
    cells = F.array(*[
        F.struct(F.lit(level).alias("level"), F.expr(f"row * {n} div {rows}").alias("cr"), F.expr(f"col * {n} div {cols}").alias("cc"))
        for level, n in enumerate(LEVELS)
    ])
    good = own.where(F.col(snow) & F.col(valid) & (F.col(value) > 0) & F.col("band").isNotNull())
    hist = good.withColumn("c", F.explode(cells)).groupBy(*day, "band", "c", F.col(value).alias("v")).agg(F.count("*").alias("n"))
    w = W.partitionBy(*day, "band", "c")
    hist = hist.withColumns({"total": F.sum("n").over(w), "upto": F.sum("n").over(w.orderBy("v").rowsBetween(W.unboundedPreceding, 0))})
    medians = hist.groupBy(*day, "band", "c", "total").agg(
        F.min(F.when(F.col("upto") >= F.ceil(F.col("total") / 2), F.col("v"))).alias("lo"),
        F.min(F.when(F.col("upto") >= F.floor(F.col("total") / 2) + 1, F.col("v"))).alias("hi"),
    )
    top = len(LEVELS) - 1
    medians = medians.where((F.col("total") > least) | (F.col("c.level") == top)).select(
        *day, F.col("band").alias("from_band"), "c", F.round((F.col("lo") + F.col("hi")) / 2).cast("int").alias("median")
    )
    medians = stash(medians, "medians")
    # The band to ask: the first at or above with any valid pixel in the tile, else the first below the top.
    whole = medians.where(F.col("c.level") == top)
    present = whole.select(*day, "from_band").distinct()
    bands = F.array(*[F.lit(i) for i in range(1, len(edges))])
    asked = present.groupBy(*day).agg(F.sort_array(F.collect_set("from_band")).alias("have")).withColumn("band", F.explode(bands))
    up = F.array_min(F.filter("have", lambda b: b >= F.col("band")))
    asked = asked.select(*day, "band", F.coalesce(up, F.array_max("have")).alias("from_band"))
    # A median goes to the finest cells below it under each band that asks it, and of a finest cell's the smallest cell counts
    # (level and median in one number). These rows meet by top cells, of which a raster with more rows or columns than stated has
    # several. Parquet's size tells little of how many rows there are, so Spark must not broadcast a table of medians by it.
    fine = LEVELS[0]
    wide = F.element_at(F.array(*[F.lit(fine // n) for n in LEVELS]), F.col("c.level") + 1)
    told = medians.hint("merge").join(asked, [*day, "from_band"]).select(*day, "band", "c.cr", "c.cc", wide.alias("_wide"), (F.col("c.level") * (1 << 32) + F.col("median")).alias("_told"))
    tops = {f"_top_{c}": F.expr(f"{c} * _wide div {fine}") for c in ("cr", "cc")}
    table = told.withColumns(tops).repartition(*day, "band", *tops)
    for c in ("cr", "cc"):
        table = table.withColumn(f"_{c}", F.explode(F.sequence(F.col(c) * F.col("_wide"), (F.col(c) + 1) * F.col("_wide") - 1)))
    table = table.groupBy(*day, "band", *tops, "_cr", "_cc").agg(F.min("_told").alias("_told"))
    return stash(table.select(*day, "band", "_cr", "_cc", (F.col("_told") % (1 << 32)).cast("int").alias("_around")), "medians-around")


def with_medians(px: DataFrame, medians: dict[str, tuple[DataFrame, str]], day: list[str], rows: int, cols: int, edges=MEDIAN_STEPS, snow: str = "snow") -> DataFrame:
    """Adds `<value>_spatial` for each value of `medians` (what spatial_medians gives, the column that tells valid pixels).

    For snow pixels without a valid value it is the median around them; else the value. Pixels are shuffled once for all values.
    """
    fine = LEVELS[0]
    out = px.withColumns({"band": elevation_band(F.col("elevation"), edges), "_cr": F.expr(f"row * {fine} div {rows}"), "_cc": F.expr(f"col * {fine} div {cols}")})
    for value, (table, valid) in medians.items():
        out = out.join(table.hint("merge"), [*day, "band", "_cr", "_cc"], "left")
        out = out.withColumn(f"{value}_spatial", F.when(F.col(snow) & ~F.col(valid), F.col("_around")).otherwise(F.col(value))).drop("_around")
    return out.drop("band", "_cr", "_cc")


def spatial_median_fill(px: DataFrame, value: str, day: list[str], rows: int, cols: int, edges=MEDIAN_STEPS, least: int = 10) -> DataFrame:
    """Adds `<value>_spatial` (see with_medians). Needs snow and valid (booleans), elevation, row and col."""
    return with_medians(px, {value: (spatial_medians(px, value, day, rows, cols, edges, least), "valid")}, day, rows, cols, edges)
