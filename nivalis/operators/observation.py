"""Table-driven thresholds and the status of an observation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.functions.flags import STATUS


def apply_thresholds(df: DataFrame, rules: list[dict]) -> DataFrame:
    """In order: where a rule's `thresholded` variable is below `least`, its `replaced` one becomes `value`.

    Rules are configuration: dicts, e.g. collected from a filter table. A rule that names a
    column absent from df is passed over; nulls are never low. 0 is low if the threshold is
    above 0, for mosaics as for the public product.
    """
    for rule in rules:
        if rule["thresholded"] in df.columns and rule["replaced"] in df.columns:
            low = F.col(rule["thresholded"]) < rule["least"]
            df = df.withColumn(rule["replaced"], F.when(low, rule["value"]).otherwise(F.col(rule["replaced"])))
    return df


def observation_status(df: DataFrame, snow: str, low_snow: int = 10, most_zenith: float = 85, low_season: tuple[int, int] | None = (6, 9), others: tuple[str, ...] = ()) -> DataFrame:
    """Adds status and applies it: needs snow, is_observed, solar_zenith, is_false_positive and obs_date.

    Observed or not at first; low values of observed snow; then high solar zenith (on observed
    ones); then the false-positive mask within the low season: snow 0, the other variables null.
    """
    s = STATUS
    observed = F.when(F.col("is_observed"), s["observed"]).otherwise(s["no_observation"])
    low = (F.col(snow) < low_snow) & (F.col(snow) != 0)
    status = F.when((observed == s["observed"]) & low, s["low_value"]).otherwise(observed)
    status = F.when((status == s["observed"]) & (F.col("solar_zenith") > most_zenith), s["high_solar_zenith"]).otherwise(status)
    df = df.withColumn("status", status)
    if low_season is None:
        return df
    wrong = (F.col("status") == s["observed"]) & F.col("is_false_positive") & F.month("obs_date").between(*low_season)
    df = df.withColumn("_wrong", F.coalesce(wrong, F.lit(False)))
    df = df.withColumns({"status": F.when(F.col("_wrong"), s["false_positive"]).otherwise(F.col("status")), snow: F.when(F.col("_wrong"), 0).otherwise(F.col(snow))})
    return df.withColumns({c: F.when(~F.col("_wrong"), F.col(c)) for c in others}).drop("_wrong") if others else df.drop("_wrong")


def zero_zenith_anomaly(px: DataFrame, limit: float, status: str | None = None) -> DataFrame:
    """Adds is_anomalous: per tile and month, zeniths of 0 if the next distinct one is at least `limit` away or there is none.

    With the name of a status column, that is set to "unknown solar zenith" there, if it says observed, temporary or unavailable.

    Two smallest distinct values by a partial aggregation; the result, a row per tile and month, is joined back.
    """
    own = px.withColumn("_month", F.trunc("obs_date", "month"))
    least = own.where("solar_zenith IS NOT NULL").groupBy("tile", "_month").agg(
        F.min("solar_zenith").alias("low"), F.min(F.when(F.col("solar_zenith") != 0, F.col("solar_zenith"))).alias("next")
    )
    bad = least.where((F.col("low") == 0) & (F.col("next").isNull() | (F.col("next") >= limit))).select("tile", "_month", F.lit(True).alias("_bad"))
    out = own.join(bad, ["tile", "_month"], "left").withColumn("is_anomalous", F.col("_bad").isNotNull() & F.coalesce(F.col("solar_zenith") == 0, F.lit(False)))
    if status:
        may = F.col("is_anomalous") & F.col(status).isin([STATUS[k] for k in ("observed", "temporary", "unavailable")])
        out = out.withColumn(status, F.when(may, STATUS["unknown_solar_zenith"]).otherwise(F.col(status)))
    return out.drop("_month", "_bad")
