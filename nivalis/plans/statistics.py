"""Statistics: daily per subdivision, then over the years, then for the web."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.functions.wateryear import day_of_water_year, water_year
from nivalis.operators.stats import DAILY_IDS, PIXEL_KM2, latest_stat, smoothed_median_of, stat_upsert, web_series
from nivalis.sources.folders import stash


def daily_job(px: DataFrame, mask: DataFrame, snow: str, value: str, var_id: int, least_elevation: int = 0, least_snow: int = 0) -> DataFrame:
    """Stat rows of every subdivision and day.

    Pixels are summed up per day and combination of subdivisions first: for each value a count and the sum of
    snow, as no statistic needs pairs of both. These rows, not the pixels, go to the several subdivisions
    a pixel is in.
    """
    key = ["tile", "row", "col"]
    combos = mask.groupBy(*key).agg(F.array_sort(F.collect_set("subdivision_id")).alias("ids"))
    # Elevation stands in for the filters' sake; equal rows collapse before they are dealt out.
    own = px.where((F.col("elevation") >= least_elevation) & (F.col(snow) >= least_snow)).join(combos, key)
    rows = own.groupBy("obs_date", "ids", F.col(value).alias("v")).agg(F.count("*").alias("n"), F.sum(F.col(snow).cast("long")).alias("s"))
    dealt = rows.withColumn("subdivision_id", F.explode("ids")).drop("ids")
    counted = stash(dealt.groupBy("obs_date", "subdivision_id", "v").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "daily-counts")
    group = ["obs_date", "subdivision_id"]
    sums = counted.groupBy(*group).agg(
        (F.sum("s") / 100 * PIXEL_KM2).alias("snow_area_km2"),
        (F.sum(F.col("v").cast("long") * F.col("n")) / F.sum(F.when(F.col("v").isNotNull(), F.col("n")))).alias("mean_value"),
    )
    values = counted.where("v IS NOT NULL").select(*group, F.col("v").alias("value"), "n")
    wide = sums.join(smoothed_median_of(values, group).select(*group, "smoothed_median"), group, "left")
    pairs = ", ".join(f"{i}, {name}" for name, i in DAILY_IDS.items())
    return wide.select(
        water_year(F.col("obs_date")).alias("water_year"), day_of_water_year(F.col("obs_date")).alias("day"), "subdivision_id",
        F.lit(var_id).alias("var_id"), F.expr(f"stack({len(DAILY_IDS)}, {pairs}) AS (stat_id, stat_value)"),
    )


def statistics_job(old: DataFrame, new: DataFrame, current: int, stat_id: int = 2) -> DataFrame:
    """The web series after an update: new days replace old ones, the latest rows count.

    The new rows and the updated ones are used several times each; both are stored once (a row per day,
    subdivision, variable and statistic).
    """
    stat = latest_stat(stat_upsert(old, stash(new, "daily-rows"))).where(F.col("stat_id") == stat_id)
    return web_series(stash(stat.select("water_year", "day", "subdivision_id", "var_id", "stat_value"), "latest-rows"), current)
