"""The tree of subdivisions and what a web page needs to know about it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.functions.codec import round_out
from nivalis.operators.stats import histogram_percentiles


def subdivision_paths(links: DataFrame) -> DataFrame:
    """Root, second and third level ids of every path, with the display flag of the last link. Links are configuration."""
    up = links.select(F.col("group_id").alias("root_id"), F.col("id").alias("second_id"))
    down = links.select(F.col("group_id").alias("second_id"), F.col("id").alias("third_id"), "display")
    roots = links.select("group_id").distinct().join(links.select(F.col("id").alias("group_id")).distinct(), "group_id", "left_anti")
    return up.join(roots.withColumnRenamed("group_id", "root_id"), "root_id").join(down, "second_id", "left").select("root_id", "second_id", "third_id", "display")


def members_of_roots(links: DataFrame) -> DataFrame:
    """Each root with all ids below it."""
    paths = subdivision_paths(links)
    return paths.selectExpr("root_id", "explode(array(second_id, third_id)) AS member_id").where("member_id IS NOT NULL").distinct()


def subdivision_tree(links: DataFrame, names: DataFrame) -> DataFrame:
    """root_id and its nested JSON: names and members, bottom-up, in order of ids."""
    paths = subdivision_paths(links)
    label = names.select(F.col("id").alias("n_id"), "name")
    third = paths.where("third_id IS NOT NULL").join(label, F.col("third_id") == F.col("n_id"), "left")
    third = third.groupBy("root_id", "second_id").agg(F.array_sort(F.collect_list(F.struct(F.col("third_id").alias("id"), "name", "display"))).alias("members"))
    second = paths.select("root_id", "second_id").distinct().join(third, ["root_id", "second_id"], "left").join(label, F.col("second_id") == F.col("n_id"), "left")
    second = second.groupBy("root_id").agg(F.array_sort(F.collect_list(F.struct(F.col("second_id").alias("id"), "name", "members"))).alias("members"))
    top = second.join(label, F.col("root_id") == F.col("n_id"), "left")
    return top.select("root_id", F.to_json(F.struct(F.col("root_id").alias("id"), "name", "members")).alias("json"))


def named(ids: DataFrame, names: DataFrame, column: str = "id") -> DataFrame:
    """Ids with their names, or "Catchment <code>" where there is none."""
    known = names.select(F.col("id").alias(column), "name")
    return ids.join(known, column, "left").withColumn("name", F.coalesce("name", F.concat(F.lit("Catchment "), F.col(column).cast("string"))))


def web_metadata(stat: DataFrame, links: DataFrame, names: DataFrame, wide: bool = True) -> DataFrame:
    """Per root and variable: first and last water year, number of subdivisions, and a display range around the 5th and 95th percentile."""
    own = stat.join(members_of_roots(links).withColumnRenamed("member_id", "subdivision_id"), "subdivision_id")
    values = own.groupBy("root_id", "var_id", "stat_value").agg(F.count("*").alias("n"), F.min("water_year").alias("first"), F.max("water_year").alias("last"))
    found = values.groupBy("root_id", "var_id").agg(F.min("first").alias("first_year"), F.max("last").alias("last_year"))
    # Percentiles from the counts of distinct values: their positions by running sums.
    found = found.join(histogram_percentiles(values, ["root_id", "var_id"], {"p5": 5, "p95": 95}, "stat_value"), ["root_id", "var_id"], "left")
    low, high = round_out(F.col("p5"), F.col("p95"), wide)
    sizes = own.groupBy("root_id", "var_id").agg(F.count_distinct("subdivision_id").alias("subdivisions"))
    out = found.select("root_id", "var_id", "first_year", "last_year", low.alias("range_low"), high.alias("range_high")).join(sizes, ["root_id", "var_id"])
    return named(out, names, "root_id")
