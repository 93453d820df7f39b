"""Views of the test tables in the shape of the library's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from nivalis.functions.wateryear import day_of_water_year, water_year


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, keys: list[str], **key_columns: str) -> DataFrame:
    """One line item per key: the last by order, line and part."""
    own = table(spark, sf_dir, "lineitem").selectExpr("*", *[f"{e} AS `{k}`" for k, e in key_columns.items()])
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("l_orderkey"), F.desc("l_linenumber"), F.desc("l_partkey")))
    return own.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


_VALUES = [
    "CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'R' AND CAST(l_quantity AS INT) % 2 = 0 THEN 0 ELSE CAST(l_quantity AS INT) * 2 END AS snow",
    "CAST(30 + (l_orderkey * 17 + l_partkey * 5) % 1180 AS INT) AS grain",
    "CAST((l_orderkey * 3 + l_partkey * 11) % 960 AS INT) AS dust",
    "CAST((l_orderkey * 31 + l_partkey * 7 + l_linenumber) % 32768 AS INT) AS state_1km",
    *[f"CAST((l_orderkey * {7 * k} + l_partkey * 13 + l_linenumber * 29) % 101 AS INT) AS b{k}" for k in range(1, 8)],
    "CAST((l_orderkey + l_partkey) % 3 AS INT) AS class",
    "CAST(l_orderkey % 90 AS INT) AS solar_zenith",
    "CAST(l_partkey % 60 AS INT) AS sensor_zenith",
    "CAST(l_orderkey % 128 AS INT) AS nodata_filter",
    "CAST(l_partkey % 128 AS INT) AS zero_filter",
    "CAST(1 + l_orderkey % 100 AS INT) AS weight",
]


def pixel_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as pixels, ship dates as days."""
    lines = _lines(spark, sf_dir, ["pixel", "obs_date"], pixel="l_suppkey", obs_date="CAST(l_shipdate AS DATE)")
    return lines.selectExpr(
        "CONCAT('h08v0', CAST(4 + pixel % 2 AS STRING)) AS tile", "CAST(pixel div 10 AS INT) AS row", "CAST(pixel % 10 AS INT) AS col", "obs_date", *_VALUES
    )


def first_and_last_day(spark: SparkSession, sf_dir: str):
    """Of pixel_days; every date of a line item is one of its dates, so the items need not be told apart."""
    return table(spark, sf_dir, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS d").agg(F.min("d"), F.max("d")).first()


def grid_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a grid of 50 columns, ship years as days; elevation by the part."""
    lines = _lines(spark, sf_dir, ["row", "col", "obs_date"], row="CAST(l_partkey div 50 AS INT)", col="CAST(l_partkey % 50 AS INT)", obs_date="CAST(date_trunc('YEAR', l_shipdate) AS DATE)")
    return lines.selectExpr("'h08v04' AS tile", "row", "col", "obs_date", "CAST((l_partkey * 37) % 5000 AS INT) AS elevation", *_VALUES)


def static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "CONCAT('h08v0', CAST(4 + s_suppkey % 2 AS STRING)) AS tile", "CAST(s_suppkey div 10 AS INT) AS row", "CAST(s_suppkey % 10 AS INT) AS col",
        "CAST(floor(abs(s_acctbal)) AS INT) % 5000 AS elevation", "CAST(s_suppkey * 7 % 101 AS INT) AS canopy_cover", "CAST(s_suppkey % 20 AS INT) AS ice_fraction",
        "s_suppkey % 17 = 0 AS is_water", "CAST(s_suppkey % 45 AS INT) AS slope", "CAST(s_suppkey * 37 % 360 - 180 AS INT) AS aspect",
    )


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels in nations (adm0) and regions (groupadm0)."""
    pixels = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return pixels.selectExpr(
        "CONCAT('h08v0', CAST(4 + s_suppkey % 2 AS STRING)) AS tile", "CAST(s_suppkey div 10 AS INT) AS row", "CAST(s_suppkey % 10 AS INT) AS col",
        "stack(2, 'adm0', CAST(n_nationkey AS INT), 'groupadm0', CAST(n_regionkey + 100 AS INT)) AS (type, subdivision_id)",
    )


def hierarchy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Links region -> nation -> supplier, and names of the first two."""
    n, s, r = (table(spark, sf_dir, t) for t in ("nation", "supplier", "region"))
    top = n.selectExpr("CAST(n_regionkey AS INT) AS group_id", "CAST(n_nationkey + 100 AS INT) AS id", "CAST(n_nationkey % 3 AS INT) AS display")
    low = s.selectExpr("CAST(s_nationkey + 100 AS INT) AS group_id", "CAST(s_suppkey + 1000 AS INT) AS id", "CAST(s_suppkey % 3 AS INT) AS display")
    names = r.selectExpr("CAST(r_regionkey AS INT) AS id", "r_name AS name").unionByName(n.selectExpr("CAST(n_nationkey + 100 AS INT) AS id", "n_name AS name"))
    return top.unionByName(low), names


def stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as statistics, several rows per key on purpose."""
    o = table(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    return o.select(
        water_year(F.col("d")).alias("water_year"), day_of_water_year(F.col("d")).alias("day"), F.expr("CAST(o_custkey % 5 AS INT) AS subdivision_id"),
        F.expr("CAST(o_custkey % 3 AS INT) AS var_id"), F.lit(2).alias("stat_id"), F.col("o_totalprice").alias("stat_value"),
        F.expr("date_add(d, CAST(o_orderkey % 100 AS INT)) AS update_date"),
    )


def daily_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per key: the largest."""
    return stat(spark, sf_dir).groupBy("water_year", "day", "subdivision_id", "var_id").agg(F.max("stat_value").alias("stat_value"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as listed input files."""
    return table(spark, sf_dir, "events").selectExpr(
        "CONCAT('MOD09GA.A', date_format(ts, 'yyyyDDD'), '.h08v0', CAST(4 + user_id % 2 AS STRING), '.061.', CAST(event_id AS STRING), '.hdf') AS file_name",
        "ts AS edit_ts", "event_id",
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions and the tiles that pixels lie on."""
    pixels = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return pixels.selectExpr("CONCAT('region', CAST(n_regionkey AS STRING)) AS region", "CONCAT('h08v0', CAST(4 + s_suppkey % 2 AS STRING)) AS tile", "1 AS is_active").distinct()
