"""Sources and sinks: water years, configuration, file names, inventories, daily tables, web files, the user product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W


def read_water_year(px: DataFrame, first: Column, last: Column, tile: str | None = None, variables: list[str] | None = None) -> DataFrame:
    """The rows of a date range; days without any row are absent, so the range ends at the last day that is there.

    The conditions are plain comparisons, which reach the scan (and prune partitions by tile and water year).
    """
    own = px.where(F.col("obs_date").between(first, last))
    own = own if tile is None else own.where(F.col("tile") == tile)
    return own if variables is None else own.select("tile", "row", "col", "obs_date", *variables)


def last_day(px: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the last date present: where a shortened window ends."""
    return px.groupBy(*keys).agg(F.max("obs_date").alias("end_date"))


def read_config(spark: SparkSession, path: str, schema: T.StructType, key: str = "id") -> DataFrame:
    """A CSV with names in the first row and descriptions in the second, which is left out: its key is no number."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.csv(path, header=True, schema=text, multiLine=True, enforceSchema=True)
    rows = rows.where(F.expr(f"try_cast(`{key}` AS BIGINT)").isNotNull())
    return rows.select(*[F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name) for f in schema.fields])


# Names of input files, e.g. MOD09GA.A2024002.h08v04.061.2024003120000.hdf.
FILE_NAME = r"^(\w+)\.A(\d{4})(\d{3})\.(h\d{2}v\d{2})\.(\d{3})\.(\d+)\.(\w+)$"


def parse_file_metadata(files: DataFrame, name: str = "file_name", pattern: str = FILE_NAME) -> DataFrame:
    """Adds product, obs_date, tile, version, stamp and is_nrt (a short stamp: near real time); nulls where the name does not fit."""
    part = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))
    date = F.date_add(F.make_date(part(2).cast("int"), F.lit(1), F.lit(1)), part(3).cast("int") - 1)
    return files.withColumns({
        "product": part(1), "obs_date": date, "tile": part(4), "version": part(5), "stamp": part(6), "is_nrt": F.length(part(6)) < 13,
    })


def latest_file(files: DataFrame, keys=("tile", "obs_date"), edited: str = "edit_ts", name: str = "file_name") -> DataFrame:
    """The file edited last of each key; the last name of ties."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(edited), F.desc(name)))
    return files.withColumn("_r", rank).where("_r = 1").drop("_r")


def inventory_days(files: DataFrame, first: Column, last: Column, keys=("tile",)) -> DataFrame:
    """Files per key and day of the range, days without any included."""
    days = files.select(*keys).distinct().select(*keys, F.explode(F.sequence(first, last)).alias("obs_date"))
    counts = files.groupBy(*keys, "obs_date").agg(F.count("*").alias("files"))
    return days.join(counts, [*keys, "obs_date"], "left").withColumn("files", F.coalesce("files", F.lit(0).cast("long")))


def inventory_months(days: DataFrame, keys=("tile",)) -> DataFrame:
    """Days present and expected per month."""
    month = F.trunc("obs_date", "month").alias("month")
    return days.groupBy(*keys, month).agg(F.count(F.when(F.col("files") > 0, 1)).alias("present"), F.count("*").alias("expected"))


def write_daily(df: DataFrame, path: str, first_month: int = 10) -> None:
    """Writes pixel-days by tile, water year and day; only the days in df are replaced. All variables of a day share files."""
    from nivalis.functions.wateryear import water_year

    own = df.withColumn("water_year", water_year(F.col("obs_date"), first_month)).repartition("tile", "water_year", "obs_date")
    out = own.sortWithinPartitions("tile", "obs_date", "row", "col").write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy("tile", "water_year", "obs_date").parquet(path)


def write_pixel_buckets(df: DataFrame, table: str, path: str, buckets: int, order: tuple[str, ...] = ()) -> DataFrame:
    """Writes df as a table bucketed and sorted by pixel (tile, row, col), one file per bucket, and returns it.

    Pixel-days, static rasters and masks that are written with the same number of buckets join without a
    shuffle, and windows over a pixel need none. The buckets go by the pixel, not by cells of the tile, as Spark
    takes buckets as they are only if they go by all keys of a join.
    """
    keys = ["tile", "row", "col"]
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(table)
    return df.sparkSession.table(table)


WEB_COLUMNS = ["day", "min_year_value", "max_year_value", "prc25", "median", "prc75", "year_to_date"]


def write_stat_csv(series: DataFrame, path: str, keys=("subdivision_id", "var_id")) -> None:
    """One CSV folder per subdivision and variable, ordered by day."""
    own = series.select(*keys, *WEB_COLUMNS).repartition(*keys).sortWithinPartitions(*keys, "day")
    own.write.mode("overwrite").partitionBy(*keys).option("header", True).csv(path)


def stat_json(series: DataFrame, keys=("subdivision_id", "var_id"), metadata: list[str] = ()) -> DataFrame:
    """A JSON document per subdivision and variable: metadata and arrays by day; NaN becomes null. A series has 366 rows at most."""
    clean = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c)).alias(c) if c != "day" else F.col(c) for c in WEB_COLUMNS]
    row = F.struct(*clean)
    days = series.groupBy(*keys, *metadata).agg(F.array_sort(F.collect_list(row)).alias("d"))
    arrays = [F.col(f"d.{c}").alias(c) for c in WEB_COLUMNS]
    return days.select(*keys, F.to_json(F.struct(*keys, *metadata, *arrays), {"ignoreNullFields": "false"}).alias("json"))


def write_stat_json(series: DataFrame, path: str, keys=("subdivision_id", "var_id")) -> None:
    stat_json(series, keys).write.mode("overwrite").partitionBy(*keys).text(path)


def to_output_product(px: DataFrame, variables: list[dict], cell: float, x0: float, y0: float) -> DataFrame:
    """Selected variables renamed, checked against their range (null outside), encoded, with x, y and time coordinates.

    `variables`: name, output_name, divisor, min, max, nodata of each; coordinates are cell centres in metres
    and days since 1970-01-01.
    """
    from nivalis.functions.codec import encode

    out = [
        encode(F.when(F.col(v["name"]).between(v["min"], v["max"]), F.col(v["name"])), v.get("divisor", 1), v["nodata"], low=-(1 << 31)).alias(v["output_name"])
        for v in variables
    ]
    x = (F.col("col") + 0.5) * cell + x0
    y = F.lit(y0) - (F.col("row") + 0.5) * cell
    return px.select("tile", "row", "col", F.unix_date("obs_date").alias("time"), x.alias("x"), y.alias("y"), *out)
