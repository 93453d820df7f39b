"""Statistics per subdivision: daily, historic, yearly extremes, and the series shown on the web."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from nivalis.functions.quantiles import percentile_hazen

PIXEL_KM2 = (2 * 3.141592653589793 * 6371.007181 / 36 / 2400) ** 2
#: Ranges of values that a group's percentiles are looked up in.
RANGES = 128
STAT_KEY = ["water_year", "day", "subdivision_id", "var_id"]
#: Ids of the daily statistics, and of the first of each kind of extreme year.
DAILY_IDS = {"snow_area_km2": 1, "mean_value": 2, "smoothed_median": 3}
KIND_IDS = {"mean": 0, "median": 1, "sum": 2}
MAX_VALUE, MIN_VALUE, MAX_YEAR, MIN_YEAR, SNOW_MAX_VALUE, SNOW_MIN_VALUE = 20, 30, 40, 50, 60, 70


def histogram(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts of each value: what exact medians of integers need, small whatever the number of rows."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value")).agg(F.count("*").alias("n"))


def histogram_percentiles(counts: DataFrame, keys: list[str], percents: dict[str, float], value: str = "value") -> DataFrame:
    """Per group with values: Hazen percentiles of the values, each counted n times (see histogram).

    No task needs all values of a group: they fall into ranges (whose bounds are estimates, which only
    the sizes of tasks depend on), and running sums are taken over ranges first, then within the few
    ranges in which the positions lie.
    """
    own = counts.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum("n").alias("n"))
    bounds = own.groupBy(*keys).agg(F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 1000).alias("_bounds"))
    own = own.join(bounds, keys).withColumn("_range", F.size(F.filter("_bounds", lambda b: b < F.col(value)))).drop("_bounds")
    group = W.partitionBy(*keys)
    ranges = own.groupBy(*keys, "_range").agg(F.sum("n").alias("_in"))
    ranges = ranges.withColumns({"_total": F.sum("_in").over(group), "_before": F.sum("_in").over(group.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)) - F.col("_in")})
    total = F.col("_total")
    at = {c: F.greatest(F.lit(1.0), F.least(total.cast("double"), total * p / 100 + 0.5)) for c, p in percents.items()}
    asked = F.array(*[F.struct(F.lit(c).alias("name"), (a - F.floor(a)).alias("share"), F.floor(a).alias("low"), F.least(F.floor(a) + 1, total).alias("high")) for c, a in at.items()])
    asked = ranges.withColumn("_a", F.explode(asked)).select(*keys, "_range", "_before", "_in", "_a.name", "_a.share", F.explode(F.map_from_arrays(F.array(F.lit("low"), F.lit("high")), F.array("_a.low", "_a.high"))).alias("side", "place"))
    asked = asked.where((F.col("place") > F.col("_before")) & (F.col("place") <= F.col("_before") + F.col("_in")))
    asked = asked.select(*keys, "_range", "name", "share", "side", (F.col("place") - F.col("_before")).alias("place"))
    within = own.join(asked.select(*keys, "_range").distinct(), [*keys, "_range"])
    within = within.withColumn("_upto", F.sum("n").over(W.partitionBy(*keys, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, 0)))
    hits = within.join(asked, [*keys, "_range"]).where((F.col("place") <= F.col("_upto")) & (F.col("place") > F.col("_upto") - F.col("n")))
    side = lambda c, s: F.max(F.when((F.col("name") == c) & (F.col("side") == s), F.col(value).cast("double")))
    share = lambda c: F.max(F.when(F.col("name") == c, F.col("share")))
    return hits.groupBy(*keys).agg(*[(side(c, "low") + share(c) * (side(c, "high") - side(c, "low"))).alias(c) for c in percents])


def smoothed_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per group: n, the median m, and (n/2 - #(x < m)) / (#(x = m) + 0.1) + m - 0.5.

    From histograms, so a group of any size reaches a task as its distinct values only.
    """
    return smoothed_median_of(histogram(df, keys, value), keys)


def smoothed_median_of(h: DataFrame, keys: list[str]) -> DataFrame:
    """The same from histograms (keys, value, n)."""
    own = W.partitionBy(*keys)
    h = h.withColumns({"total": F.sum("n").over(own), "upto": F.sum("n").over(own.orderBy("value").rowsBetween(W.unboundedPreceding, 0))})
    lower = F.min(F.when(F.col("upto") >= F.ceil(F.col("total") / 2), F.col("value"))).over(own)
    upper = F.min(F.when(F.col("upto") >= F.floor(F.col("total") / 2) + 1, F.col("value"))).over(own)
    h = h.withColumn("m", (lower + upper) / 2)
    below = F.sum(F.when(F.col("value") < F.col("m"), F.col("n")).otherwise(0))
    equal = F.sum(F.when(F.col("value") == F.col("m"), F.col("n")).otherwise(0))
    found = h.groupBy(*keys, "total", "m").agg(below.alias("below"), equal.alias("equal"))
    return found.select(
        *keys, F.col("total").alias("n"), F.col("m").alias("median"),
        ((F.col("total") / 2 - F.col("below")) / (F.col("equal") + 0.1) + F.col("m") - 0.5).alias("smoothed_median"),
    )


def daily_stats(px: DataFrame, snow: str, value: str, keys: list[str], least_elevation: int = 0, least_snow: int = 0, pixel_km2: float = PIXEL_KM2) -> DataFrame:
    """Per group: snow area in km2, mean of a variable and its smoothed median, after the elevation and snow filters (strictly below is out)."""
    own = px.where((F.col("elevation") >= least_elevation) & (F.col(snow) >= least_snow))
    sums = own.groupBy(*keys).agg(
        F.count("*").alias("pixels"), (F.sum(F.col(snow).cast("long")) / 100 * pixel_km2).alias("snow_area_km2"),
        (F.sum(F.col(value).cast("long")) / F.count(value)).alias("mean_value"),
    )
    return sums.join(smoothed_median(own, keys, value).drop("n"), keys, "left")


def stat_upsert(old: DataFrame, new: DataFrame, days=("water_year", "day")) -> DataFrame:
    """The old rows without the days that the new ones have, and the new rows."""
    return old.join(new.select(*days).distinct(), list(days), "left_anti").unionByName(new)


def stat_skeleton(groups: DataFrame, years: DataFrame, stat_id: int = 1, days: int = 366) -> DataFrame:
    """Rows with null values for every group (var_id, subdivision_id), water year and day; the groups and years are configuration."""
    return groups.crossJoin(years).select(
        "water_year", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("day"), "subdivision_id", "var_id",
        F.lit(stat_id).alias("stat_id"), F.lit(None).cast("double").alias("stat_value"),
    )


def latest_stat(stat: DataFrame, keys=(*STAT_KEY, "stat_id")) -> DataFrame:
    """Per key the rows with the latest update; ties stay."""
    newest = F.rank().over(W.partitionBy(*keys).orderBy(F.desc("update_date")))
    return stat.withColumn("_r", newest).where("_r = 1").drop("_r")


def historic_day_quantiles(stat: DataFrame, water_year: int, keys=("subdivision_id", "var_id", "day")) -> DataFrame:
    """Per day of the water year: median and Hazen quartiles over the years before (the year given is left out), nulls skipped by the quartiles; a null makes the median null."""
    past = stat.where(F.col("water_year") != water_year).groupBy(*keys)
    ordered = F.array_sort(F.collect_list("stat_value"))
    found = past.agg(ordered.alias("x"), F.count("*").alias("rows"))
    x = F.col("x")
    return found.select(
        *keys,
        F.when(F.size(x) == F.col("rows"), percentile_hazen(x, 50)).alias("median"),
        percentile_hazen(x, 25).alias("prc25"),
        percentile_hazen(x, 75).alias("prc75"),
    )


def yearly(stat: DataFrame, kind: str, keys=("subdivision_id", "var_id")) -> DataFrame:
    value = {
        "mean": F.avg("stat_value"),
        "sum": F.sum("stat_value"),
        "median": percentile_hazen(F.array_sort(F.collect_list("stat_value")), 50),
    }[kind]
    return stat.groupBy(*keys, "water_year").agg(value.alias("yearly"))


def extreme_years(stat: DataFrame, kind: str = "mean", keys=("subdivision_id", "var_id")) -> DataFrame:
    """Per variable the years with the largest and smallest yearly value; of ties the first year; the last year if all are null."""
    y = yearly(stat, kind, keys)
    year, value = F.col("water_year"), F.col("yearly")
    found = y.groupBy(*keys).agg(
        F.max(F.when(value.isNotNull(), F.struct(value.alias("v"), (-year).alias("y")))).alias("high"),
        F.min(F.when(value.isNotNull(), F.struct(value.alias("v"), year.alias("y")))).alias("low"),
        F.max(year).alias("last"),
    )
    return found.select(*keys, F.coalesce(-F.col("high.y"), F.col("last")).alias("max_year"), F.coalesce(F.col("low.y"), F.col("last")).alias("min_year"))


def extreme_year_values(stat: DataFrame, kind: str = "mean", keys=("subdivision_id", "var_id")) -> DataFrame:
    """For each day the values of the two extreme years, and (on day 1) the years themselves, as stat rows of water year 1."""
    years = extreme_years(stat, kind, keys)
    k = KIND_IDS[kind]
    values = _values_of(stat, years, keys, MAX_VALUE + k, MIN_VALUE + k)
    marks = years.select(*keys, F.expr(f"stack(2, {MAX_YEAR + k}, max_year, {MIN_YEAR + k}, min_year) AS (stat_id, y)"))
    marks = marks.select(*keys, F.lit(1).alias("day"), "stat_id", F.col("y").cast("double").alias("stat_value"))
    return values.unionByName(marks).withColumn("water_year", F.lit(1))


def snow_year_values(stat: DataFrame, snow_var: int, key: str = "subdivision_id") -> DataFrame:
    """For each day and variable the values of the years with most and least snow (by the snow variable's sum)."""
    years = extreme_years(stat.where(F.col("var_id") == snow_var), "sum", (key,))
    return _values_of(stat, years, (key,), SNOW_MAX_VALUE, SNOW_MIN_VALUE, ("var_id",)).withColumn("water_year", F.lit(1))


def _values_of(stat: DataFrame, years: DataFrame, keys, max_id: int, min_id: int, more=()) -> DataFrame:
    """One join for both extremes: a row per group and extreme year, tagged with its statistic's id."""
    tagged = years.select(*keys, F.expr(f"stack(2, {max_id}, max_year, {min_id}, min_year) AS (stat_id, water_year)"))
    own = stat.drop("stat_id").join(tagged, [*keys, "water_year"])
    return own.select(*keys, *more, "day", "stat_id", "stat_value")


def web_series(stat: DataFrame, water_year: int, kind: str = "mean", keys=("subdivision_id", "var_id")) -> DataFrame:
    """Per day: the two extreme years' values, the past years' quartiles and median, and the current year's values side by side.

    The current year is no extreme year: extremes are taken over the past ones.
    """
    past = stat.where(F.col("water_year") != water_year)
    years = extreme_years(past, kind, keys)
    value = lambda year: F.max(F.when(F.col("water_year") == year, F.col("stat_value")))
    sides = stat.join(years, list(keys), "left").groupBy(*keys, "day").agg(
        value(F.col("min_year")).alias("min_year_value"), value(F.col("max_year")).alias("max_year_value"), value(F.lit(water_year)).alias("year_to_date")
    )
    return sides.join(historic_day_quantiles(stat, water_year, (*keys, "day")), [*keys, "day"], "left")


def sort_stats(stat: DataFrame) -> DataFrame:
    return stat.orderBy(*STAT_KEY, "stat_id")
