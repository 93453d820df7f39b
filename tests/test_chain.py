"""The chain from inputs to statistics: killed between and within its steps, run again, run on a changed input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nivalis import adapters as A
from nivalis import queries
from nivalis.operators import groups
from nivalis.plans import chain
from nivalis.plans.albedo import albedo_job

DATA = "/root/testdata/sf0.001"
PLACE = ["tile", "row", "col", "obs_date"]
STEPS = ["ingest", "unmix", "spatial", "gap_fill", "albedo", "statistics"]


@pytest.fixture(scope="module")
def inputs(spark):
    px = A.pixel_days(spark, DATA).where("obs_date BETWEEN '1998-09-28' AND '1998-10-03'").drop("snow", "grain", "dust", "nodata_filter", "zero_filter", "weight")
    px = px.withColumn("solar_azimuth", F.col("b1") * 3).cache()
    files = px.select("tile", "obs_date").distinct().withColumn("edit_ts", F.lit("2020-01-01").cast("timestamp"))
    fixed = (A.static(spark, DATA).cache(), groups.background_reflectance(A.pixel_days(spark, DATA)).cache(), queries._snow_lut(), A.bridge(spark, DATA).cache())
    return px, files.cache(), fixed


def run(folder, files, px, fixed):
    return chain.run_chain(folder, files, px, *fixed, rows=10, cols=10, albedo=queries._luts())


def outcome(spark, folder):
    tables = [chain.committed(spark, folder, step, chain.YEAR) for step in ("gap_fill", "albedo")] + [chain.committed(spark, folder, "statistics", ["water_year"])]
    return [sorted(map(str, t.select(*sorted(t.columns)).collect())) for t in tables]


def test_a_chain_that_is_killed_and_run_again_gives_what_one_run_gives(spark, inputs, tmp_path, monkeypatch):
    px, files, fixed = inputs
    many = files.count()
    whole = f"file://{tmp_path}/whole"
    assert run(whole, files, px, fixed) == {"ingest": many, "unmix": many, "spatial": many, "gap_fill": 4, "albedo": 4, "statistics": 2}
    assert run(whole, files, px, fixed) == dict.fromkeys(STEPS, 0)
    expected = outcome(spark, whole)
    assert all(expected)

    # Albedos are those of the gap-filled days, a season apart, under the sun of the observed ones.
    days = chain.committed(spark, whole, "gap_fill", chain.YEAR).select(*PLACE, "water_year", "grain_size", "dust")
    found = chain.committed(spark, whole, "albedo", chain.YEAR)
    direct = albedo_job(days.join(px.select(*PLACE, "solar_zenith", "solar_azimuth"), PLACE, "left"), fixed[0], queries._luts(), keys=["tile", "row", "col", "water_year"])
    assert found.where("albedo_mu0 IS NOT NULL").count() > 0
    assert sorted(map(str, found.select(*PLACE, *chain.ALBEDOS).collect())) == sorted(map(str, direct.select(*PLACE, *chain.ALBEDOS).collect()))

    # Killed after the data of the spatial step were written and before they were committed.
    broken, commit = f"file://{tmp_path}/broken", chain.commit

    def dies(spark_, folder, step, *rest):
        if step == "spatial":
            raise KeyboardInterrupt
        commit(spark_, folder, step, *rest)

    monkeypatch.setattr(chain, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        run(broken, files, px, fixed)
    with pytest.raises(ValueError):
        chain.committed(spark, broken, "spatial", chain.DAY)
    monkeypatch.setattr(chain, "commit", commit)
    assert run(broken, files, px, fixed) == {"ingest": 0, "unmix": 0, "spatial": many, "gap_fill": 4, "albedo": 4, "statistics": 2}
    assert outcome(spark, broken) == expected

    # One input is edited: its day, its tile's year and the year's statistics are made again, the rest stays.
    day = files.where("obs_date >= '1998-10-01'").orderBy("obs_date", "tile").first()
    is_it = (F.col("tile") == day.tile) & (F.col("obs_date") == F.lit(day.obs_date))
    edited = files.withColumn("edit_ts", F.when(is_it, F.lit("2020-01-02").cast("timestamp")).otherwise(F.col("edit_ts")))
    dark = px.withColumn("class", F.when(is_it, 0).otherwise(F.col("class"))).withColumn("state_1km", F.when(is_it, 0).otherwise(F.col("state_1km")))
    assert run(broken, edited, dark.where(is_it), fixed) == {"ingest": 1, "unmix": 1, "spatial": 1, "gap_fill": 1, "albedo": 1, "statistics": 1}
    anew = f"file://{tmp_path}/anew"
    run(anew, edited, dark, fixed)
    assert outcome(spark, broken) == outcome(spark, anew)
    assert dt.date(1998, 10, 1) <= day.obs_date
