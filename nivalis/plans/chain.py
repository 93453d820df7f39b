"""The chain from inputs to statistics as one restartable run: each step does what has changed before it, and commits it in one write.

A step's items (tile-days, tile-years or years) carry a stamp of what they are made from: the input's edit
time, or the committed versions of the step before. An item is due if its stamp is not the committed one.
What a step makes for its due items goes to a folder of a new version, and only then one small table is
written that names step, items, stamps and version: from that moment readers take the new version of
these items, all at once, and the old one of all others. A run that dies before has changed nothing; the next one
finds the same items due. Versions that no status row names any more can be deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from nivalis.functions.flags import inversion_candidates
from nivalis.functions.wateryear import water_year
from nivalis.plans.albedo import albedo_job
from nivalis.plans.gapfill import gap_fill_job
from nivalis.plans.ingest import ingest_job, spatial_job, unmix_job
from nivalis.plans.statistics import daily_job

DAY, YEAR = ["tile", "obs_date"], ["tile", "water_year"]
ALBEDOS = ["albedo_mu0", "albedo_muz", "deltavis", "radiative_forcing", "albedo_observed_mu0", "albedo_observed_muz"]
STATUS = T.StructType([
    T.StructField("step", T.StringType()), T.StructField("tile", T.StringType()), T.StructField("obs_date", T.DateType()), T.StructField("water_year", T.IntegerType()),
    T.StructField("stamp", T.StringType()), T.StructField("version", T.StringType()), T.StructField("at", T.TimestampType()),
])


def status(spark: SparkSession, folder: str) -> DataFrame:
    """The committed rows of all runs; an empty folder has none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/status")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(STATUS).parquet(f"{folder}/status") if there else spark.createDataFrame([], STATUS)


def committed_items(spark: SparkSession, folder: str, step: str, keys: list[str]) -> DataFrame:
    """keys, stamp and version of a step's items as they were committed last."""
    last = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("at"), F.desc("version")))
    own = status(spark, folder).where(F.col("step") == step).withColumn("_r", last)
    return own.where("_r = 1").select(*keys, "stamp", "version")


def committed(spark: SparkSession, folder: str, step: str, keys: list[str], only: DataFrame | None = None) -> DataFrame:
    """The committed rows of a step, of the items in `only` if given."""
    items = committed_items(spark, folder, step, keys).drop("stamp")
    if only is not None:
        items = items.join(only.select(*keys).distinct(), keys, "left_semi")
    versions = [r.version for r in items.select("version").distinct().collect()]  # as many as runs
    if not versions:
        raise ValueError(f"nothing of {step} is committed")
    rows = spark.read.option("basePath", f"{folder}/{step}").parquet(*[f"{folder}/{step}/version={v}" for v in versions])
    return rows.join(items, [*keys, "version"], "left_semi").drop("version")


def due(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The items (keys, stamp) that are not committed with their stamp."""
    return items.join(done.select(*keys, F.col("stamp").alias("_done")), keys, "left").where("_done IS NULL OR _done <> stamp").drop("_done")


def do(spark: SparkSession, folder: str, step: str, items: DataFrame, keys: list[str], make: Callable[[DataFrame], DataFrame]) -> int:
    """Makes and commits the due items of a step; how many there were."""
    todo = due(items, committed_items(spark, folder, step, keys), keys).persist()
    count = todo.count()
    if count:
        version = uuid.uuid4().hex
        make(todo).write.partitionBy(*[k for k in keys if k == "tile"]).parquet(f"{folder}/{step}/version={version}")
        commit(spark, folder, step, todo, version)
    todo.unpersist()
    return count


def commit(spark: SparkSession, folder: str, step: str, todo: DataFrame, version: str) -> None:
    given = {"step": F.lit(step), "version": F.lit(version), "at": F.current_timestamp()}
    own = {c: F.col(c) for c in todo.columns}
    rows = todo.select(*[(given | own).get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATUS])
    rows.coalesce(1).write.mode("append").parquet(f"{folder}/status")


def run_chain(folder: str, files: DataFrame, px: DataFrame, static: DataFrame, background: DataFrame, lut: tuple[list[np.ndarray], np.ndarray], mask: DataFrame,
              rows: int = 2400, cols: int = 2400, block: int = 200, var_id: int = 7, albedo: dict[str, tuple] | None = None) -> dict[str, int]:
    """Ingest, unmixing, the spatial step, gap filling, albedo and daily statistics of whatever is new in `files`; items done per step.

    `files` has tile, obs_date and edit_ts of the latest input of each tile-day; px the pixels of (at least) those that are due.
    `albedo` is the look-up tables of albedo_job, which then needs solar_azimuth in px, and slope and aspect in static; without it
    there is no albedo step.
    """
    spark, counts = px.sparkSession, {}
    of = lambda rows_, todo, keys: rows_.join(todo.select(*keys), keys, "left_semi")

    def after(step: str, keys: list[str]) -> DataFrame:
        return committed_items(spark, folder, step, keys)

    def unmixed(todo: DataFrame) -> DataFrame:
        ready = committed(spark, folder, "ingest", DAY, todo)
        candidate = F.coalesce(inversion_candidates(F.col("nodata_filter"), F.col("zero_filter"), False), F.lit(False))
        found = unmix_job(ready.where(candidate), background, static, *lut)
        others = ready.where(~candidate).join(static.select("tile", "row", "col", "canopy_cover", "ice_fraction"), ["tile", "row", "col"], "left")
        return found.unionByName(others, allowMissingColumns=True)

    def gap_filled(todo: DataFrame) -> DataFrame:
        days = committed(spark, folder, "spatial", DAY).withColumn("water_year", water_year(F.col("obs_date")))
        own = of(days, todo, YEAR).select(
            "tile", "row", "col", "obs_date", F.col("viewable_snow_fraction").alias("snow"), F.col("snow_fraction").alias("total"), F.col("grain_spatial").alias("grain"),
            F.col("dust_ppm_spatial").alias("dust"), "weight", "nodata_filter", "zero_filter",
        )
        low, high = own.agg(F.min("obs_date"), F.max("obs_date")).first()
        return gap_fill_job(own, f"{low.year - (low.month < 10)}-10-01", str(high), static, cols=cols, by_year=True)

    def albedos(todo: DataFrame) -> DataFrame:
        days = of(committed(spark, folder, "spatial", DAY).withColumn("water_year", water_year(F.col("obs_date"))), todo, YEAR)
        place = ["tile", "row", "col", "obs_date"]
        seasons = of(committed(spark, folder, "gap_fill", YEAR), todo, YEAR).select(*place, "water_year", "grain_size", "dust")
        seen = seasons.join(days.select(*place, "solar_zenith", "solar_azimuth"), place, "left")
        found = albedo_job(seen, static, albedo, keys=["tile", "row", "col", "water_year"])
        return found.select(*place, "water_year", *ALBEDOS)

    def statistics(todo: DataFrame) -> DataFrame:
        days = committed(spark, folder, "gap_fill", YEAR).join(todo.select("water_year"), "water_year", "left_semi")
        return daily_job(days.join(static.select("tile", "row", "col", "elevation"), ["tile", "row", "col"]), mask, "viewable_snow_fraction", "grain_size", var_id)

    inputs = files.select(*DAY, F.col("edit_ts").cast("string").alias("stamp"))
    counts["ingest"] = do(spark, folder, "ingest", inputs, DAY, lambda todo: ingest_job(of(px, todo, DAY), static, block))
    counts["unmix"] = do(spark, folder, "unmix", after("ingest", DAY).select(*DAY, F.col("version").alias("stamp")), DAY, unmixed)
    spatial = lambda todo: spatial_job(committed(spark, folder, "unmix", DAY, todo), rows, cols)
    counts["spatial"] = do(spark, folder, "spatial", after("unmix", DAY).select(*DAY, F.col("version").alias("stamp")), DAY, spatial)
    # A year is due if any of its days has a new version: at most 366 of them per tile and year, and a few hundred tiles.
    years = after("spatial", DAY).withColumn("water_year", water_year(F.col("obs_date")))
    stamp = lambda *cols_: F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(F.concat_ws(":", *cols_)))), 256).alias("stamp")
    counts["gap_fill"] = do(spark, folder, "gap_fill", years.groupBy(*YEAR).agg(stamp("obs_date", "version")), YEAR, gap_filled)
    if albedo is not None:
        # Versions of gap-filled years change with any of their days, so with the sun's angles too.
        counts["albedo"] = do(spark, folder, "albedo", after("gap_fill", YEAR).select(*YEAR, F.col("version").alias("stamp")), YEAR, albedos)
    counts["statistics"] = do(spark, folder, "statistics", after("gap_fill", YEAR).groupBy("water_year").agg(stamp("tile", "version")), ["water_year"], statistics)
    return counts
