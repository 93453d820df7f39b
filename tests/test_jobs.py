"""The jobs without SQL, held against loops, and whether their queries take all of their input."""

import datetime as dt
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis import adapters, queries
from nivalis.operators import joins, lut
from nivalis import streaming
from nivalis.operators import spline
from nivalis.plans import albedo, gapfill, ingest, statistics

DATA = "/root/testdata/sf0.001"
PIXEL = ("tile", "row", "col")


def water_year(day):
    return day.year + (day.month >= 10)


def seasons(spark, first, last, pixels=2, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for p in range(pixels):
        for i in range((last - first).days + 1):
            if rng.random() < 0.3:
                snow = int(rng.choice([0, 30, 60, 90]))
                rows.append(("h00v00", 0, p, first + dt.timedelta(i), snow, min(100, snow + 5), int(rng.integers(50, 900)), int(rng.integers(0, 400)), int(rng.integers(1, 100)), int(rng.random() < 0.1), 64 if snow == 0 else 0))
    kinds = "tile string, row int, col int, obs_date date, snow int, total int, grain int, dust int, weight int, nodata_filter int, zero_filter int"
    return spark.createDataFrame(rows, kinds)


def test_gap_filling_by_year_is_the_job_on_each_year(spark):
    first, last = dt.date(1998, 10, 1), dt.date(2000, 12, 20)
    px = seasons(spark, first, last).where("NOT (col = 1 AND obs_date BETWEEN '1999-10-01' AND '2000-09-30')")
    whole = gapfill.gap_fill_job(px, str(first), str(last), cols=10, by_year=True)
    found = {(r.col, r.obs_date): r for r in whole.collect()}
    assert len(found) == whole.count()
    expected = {}
    for low, high in (("1998-10-01", "1999-09-30"), ("1999-10-01", "2000-09-30"), ("2000-10-01", str(last))):
        expected |= {(r.col, r.obs_date): r for r in gapfill.gap_fill_job(px, low, high, cols=10).collect()}
    assert found == expected and {water_year(k[1]) for k in found} == {1999, 2000, 2001}


def test_gap_filling_against_loops(spark):
    first, last = dt.date(1999, 10, 1), dt.date(2000, 9, 30)
    px = seasons(spark, first, last, 1)
    found = sorted(gapfill.gap_fill_job(px, str(first), str(last), cols=10).collect(), key=lambda r: r.obs_date)
    given = {r.obs_date: r for r in px.collect()}
    days = [first + dt.timedelta(i) for i in range(366)]
    assert [r.obs_date for r in found] == days
    seen = [d in given and given[d].nodata_filter == 0 for d in days]
    run = covered = 0
    for r, s in zip(found, seen):
        run = 0 if s else run + 1
        covered += r.snow_fraction > 10
        assert r.days_since_last_observation == run and r.snow_cover_days == covered
        assert 0 <= r.viewable_snow_fraction <= 100 and (r.grain_size is None) == (r.dust is None)
        assert r.grain_size is None or r.snow_fraction > 10 and 40 <= r.grain_size <= 1190 and 0 <= r.dust <= 950


def test_gap_filling_query_has_every_day_of_every_water_year(spark):
    px = {(r.tile, r.row, r.col, r.obs_date) for r in adapters.pixel_days(spark, DATA).collect()}
    last = max(k[3] for k in px)
    expected = set()
    for *pixel, year in {(*k[:3], water_year(k[3])) for k in px}:
        low, high = dt.date(year - 1, 10, 1), min(last, dt.date(year, 9, 30))
        expected |= {(*pixel, low + dt.timedelta(i)) for i in range((high - low).days + 1)}
    for name in ("o83_gap_fill_job", "o84_albedo_job"):
        found = [(r.tile, r.row, r.col, r.obs_date) for r in queries.QUERIES[name](spark, DATA).select("tile", "row", "col", "obs_date").collect()]
        assert len(found) == len(set(found)) and px <= set(found) and set(found) == expected


def test_albedo_job_against_the_formula(spark):
    """The made-up table is linear in all axes, so it is exact everywhere."""
    rows = [("h00v00", 0, 0, dt.date(y, 9, 29) + dt.timedelta(i), water_year(dt.date(y, 9, 29) + dt.timedelta(i)), z, 0, 400, 200) for y in (1999,) for i, z in enumerate((None, 30, None, 60))]
    px = spark.createDataFrame(rows, "tile string, row int, col int, obs_date date, water_year int, solar_zenith int, solar_azimuth int, grain_size int, dust int")
    static = spark.createDataFrame([("h00v00", 0, 0, 0, 0)], "tile string, row int, col int, slope int, aspect int")
    found = sorted(albedo.albedo_job(px, static, queries._luts(), keys=[*PIXEL, "water_year"]).collect(), key=lambda r: r.obs_date)
    for r, zenith in zip(found, (30, 30, 60, 60)):  # October starts a series of its own
        mu = math.cos(math.radians(zenith))
        assert r.albedo_mu0 == math.floor(92 - 0.8 * 20 + 8 * (1 - mu) + 0.5)
        assert r.deltavis == math.floor(7e4 * 2e-5 + 0.5)


def test_albedo_job_rounds_halves_that_the_table_misses(spark):
    """At a zenith of 60 degrees 325 gives 6.5 and 375 gives 7.5; the sums over the corners come out as 6.499999999999999."""
    rows = [("h00v00", 0, i, dt.date(2000, 1, 1), 60, 0, grain, dust) for i, (grain, dust) in enumerate([(195, 325), (710, 325), (63, 375), (799, 375)])]
    px = spark.createDataFrame(rows, "tile string, row int, col int, obs_date date, solar_zenith int, solar_azimuth int, grain_size int, dust int")
    static = spark.createDataFrame([("h00v00", 0, i, 0, 0) for i in range(4)], "tile string, row int, col int, slope int, aspect int")
    found = albedo.albedo_job(px, static, queries._luts()).orderBy("col").collect()
    assert [r.radiative_forcing for r in found] == [7, 7, 8, 8]


def sunny_days(spark, seed=5):
    """Days of two pixels' seasons and one without static row; sun, grain size and dust missing on some."""
    rng = np.random.default_rng(seed)
    some = lambda low, high, share: int(rng.integers(low, high)) if rng.random() < share else None
    rows = [("h00v00", 0, p, dt.date(1999, 9, 1) + dt.timedelta(i), some(0, 95, 0.3) if p != 1 else None, some(-180, 300, 0.3), some(30, 2100, 0.8), some(0, 1100, 0.8)) for p in range(3) for i in range(60)]
    px = spark.createDataFrame(rows, "tile string, row int, col int, obs_date date, solar_zenith int, solar_azimuth int, grain_size int, dust int")
    px = px.withColumn("water_year", F.year("obs_date") + (F.month("obs_date") >= 10).cast("int"))
    return px.repartition(3), spark.createDataFrame([("h00v00", 0, 0, 20, 100), ("h00v00", 0, 1, 5, -30)], "tile string, row int, col int, slope int, aspect int")


@pytest.mark.parametrize("soot", [0.0, 2e-5])
def test_albedo_job_is_its_steps_by_columns(spark, soot):
    """Batches of 7 rows, which cut the series."""
    from nivalis.functions import optics
    from nivalis.operators.series import interpolate_linear

    px, static = sunny_days(spark)
    keys, luts = [*PIXEL, "water_year"], queries._luts()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = {(r.col, r.obs_date): r.asDict() for r in albedo.albedo_job(px, static, luts, soot, keys).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    steps = interpolate_linear(interpolate_linear(px, "solar_zenith", "nearest", keys), "solar_azimuth", "nearest", keys).join(static, list(PIXEL), "left")
    mu0 = F.cos(F.radians("solar_zenith_filled"))
    grain = F.greatest(F.lit(1), F.least(F.lit(1999), F.col("grain_size")))
    steps = steps.withColumns({"mu0": mu0, "muz": optics.sun_on_slope(mu0, F.col("solar_azimuth_filled"), F.col("slope"), F.col("aspect")), "g": F.sqrt(grain.cast("double")), "d": F.col("dust") / 10 / 1e6})
    for name, table, mu, dust in (("albedo_mu0", "albedo", "mu0", F.lit(0.0)), ("albedo_muz", "albedo", "muz", F.lit(0.0)), ("deltavis", "deltavis", "muz", "d"), ("radiative_forcing", "radiative_forcing", "muz", "d")):
        steps = lut.lut_interpolate(steps, *luts[table], ["mu0", mu, "g", dust, F.lit(soot)], f"_{name}")
        value = F.round(F.col(f"_{name}") * albedo.SLACK)
        steps = steps.withColumn(name, F.when(value.between(*albedo.RANGES[table]), value.cast("int")))
    for mu in ("mu0", "muz"):
        steps = steps.withColumn(f"albedo_observed_{mu}", optics.observed_albedo(F.col(f"albedo_{mu}"), F.col("deltavis")))
    expected = {(r.col, r.obs_date): r.asDict() for r in steps.collect()}
    assert len(found) == len(expected) == 180 and found.keys() == expected.keys()
    for k, r in found.items():
        for c, x in r.items():
            if c in ("mu0", "muz"):
                assert x == pytest.approx(expected[k][c], abs=1e-14), (k, c)
            else:
                assert x == expected[k][c], (k, c)
    assert all(any(r[c] is not None for r in found.values()) and any(r[c] is None for r in found.values()) for c in albedo.OUT)


def test_albedos_of_seasons_are_those_of_filled_days_under_the_sun(spark):
    first, last = dt.date(1998, 10, 1), dt.date(2000, 3, 1)
    px = seasons(spark, first, last).withColumns({"solar_zenith": F.when(F.col("grain") % 3 != 0, F.col("dust") % 90), "solar_azimuth": F.when(F.col("grain") % 4 != 0, F.col("dust") % 300)})
    static = spark.createDataFrame([("h00v00", 0, 0, 5, 20, 100)], "tile string, row int, col int, ice_fraction int, slope int, aspect int")
    how = str(first), str(last), static
    found = albedo.season_albedo_job(px, *how, queries._luts(), cols=10, by_year=True)
    days = gapfill.gap_fill_job(px, *how, cols=10, by_year=True).join(px.select(*PIXEL, "obs_date", "solar_zenith", "solar_azimuth"), [*PIXEL, "obs_date"], "left")
    expected = albedo.albedo_job(days, static, queries._luts(), keys=[*PIXEL, "water_year"]).select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.where("albedo_muz IS NOT NULL AND deltavis IS NOT NULL").count() > 0


def test_albedo_query_shuffles_observed_rows_only(spark):
    """Once to tell line items apart, once into groups of pixels; no window goes over the filled days."""
    plan = queries.QUERIES["o84_albedo_job"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2 and plan.count("Window [") == 1 and "Join" not in plan


def test_albedo_of_days_is_one_sort(spark):
    """The two angles are filled by one pass over a series in order, not by windows in both directions."""
    px, static = sunny_days(spark)
    plan = albedo.albedo_job(px, static, queries._luts())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("ArrowEvalPython") == 0


def test_several_tables_at_once_are_each_table_alone():
    rng = np.random.default_rng(8)
    axes = [np.linspace(0, 1, 4), np.array([0.0, 0.3, 1.0]), np.linspace(0, 2, 5), np.array([0.5])]
    tables = [rng.random((4, 3, 5, 1)) for _ in range(2)]
    points = np.concatenate([rng.uniform(-0.1, [1.1, 1.1, 2.1, 0.5], (500, 4)), rng.choice([0.0, 1.0], (50, 4))])
    points[:500, 3] = 0.5
    points[7, 1] = np.nan
    for table, got in zip(tables, lut.interpolate_several(axes, tables, list(points.T))):
        assert np.array_equal(got, lut.interpolate(axes, table, points), equal_nan=True)
    less, table = lut.at_node(axes, tables[0], 1, 0.3)
    points[:, 1] = 0.3
    assert np.array_equal(lut.interpolate_several(less, [table], list(points[:, [0, 2, 3]].T))[0], lut.interpolate(axes, tables[0], points), equal_nan=True)
    assert lut.at_node(axes, tables[0], 1, 0.4) is None and lut.at_node(axes, tables[0] * np.inf, 1, 0.3) is None


def hazen(x, percent):
    x = sorted(x)
    at = max(1.0, min(len(x), len(x) * percent / 100 + 0.5))
    low = math.floor(at)
    return x[low - 1] + (at - low) * (x[min(low, len(x) - 1)] - x[low - 1])


def web(old, new, current):
    """The statistics job in loops; rows are (water_year, day, subdivision_id, var_id, stat_id, stat_value, update_date)."""
    fresh = {r[:2] for r in new}
    rows = [r for r in old if r[:2] not in fresh] + list(new)
    newest = {}
    for r in rows:
        newest[r[:5]] = max(newest.get(r[:5], r[6]), r[6])
    own = [r for r in rows if r[6] == newest[r[:5]] and r[4] == 2]
    past, years, series = defaultdict(list), defaultdict(list), defaultdict(list)
    for y, day, sub, var, _, v, _ in own:
        series[sub, var, day].append((y, v))
        if y != current:
            past[sub, var, day].append(v)
            years[sub, var, y].append(v)
    ends = {}
    for sub, var in {k[:2] for k in years}:
        means = {y: sum(v) / len(v) for (s, r, y), v in years.items() if (s, r) == (sub, var)}
        ends[sub, var] = min(means, key=lambda y: (means[y], y)), max(means, key=lambda y: (means[y], -y))
    out = {}
    for k, values in series.items():
        low, high = ends.get(k[:2], (None, None))
        pick = lambda year: max((v for y, v in values if y == year), default=None)  # noqa: B023, E731
        p = past.get(k)
        out[k] = [pick(low), pick(high), pick(current), *([hazen(p, q) for q in (50, 25, 75)] if p else [None] * 3)]
    return out


def test_statistics_query_takes_all_old_rows(spark):
    px = joins.with_static(adapters.pixel_days(spark, DATA), adapters.static(spark, DATA).select("tile", "row", "col", "elevation"))
    new = statistics.daily_job(px, adapters.bridge(spark, DATA), "snow", "grain", 7).withColumn("update_date", F.lit("2002-01-01").cast("date"))
    columns = ["water_year", "day", "subdivision_id", "var_id", "stat_id", F.col("stat_value").cast("double"), "update_date"]
    old, new = ([tuple(r) for r in t.select(*columns).collect()] for t in (adapters.stat(spark, DATA), new))
    expected = web(old, new, 2001)
    names = ["min_year_value", "max_year_value", "year_to_date", "median", "prc25", "prc75"]
    rows = queries.QUERIES["o85_statistics_job"](spark, DATA).collect()
    found = {(r.subdivision_id, r.var_id, r.day): [r[n] for n in names] for r in rows}
    assert len(rows) == len(found) and set(found) == set(expected)
    assert any(k[1] != 7 and k[2] % 7 for k in found)
    for k, values in expected.items():
        assert found[k] == pytest.approx(values), k


def test_daily_tables_hold_every_day_and_value(spark, monkeypatch):
    """What the query writes, read file by file."""
    import pathlib

    import pyarrow.parquet as pq

    from nivalis.sources import tables

    paths, write = [], tables.write_daily
    monkeypatch.setattr(tables, "write_daily", lambda df, path: (paths.append(path), write(df, path)))
    queries.QUERIES["o07_write_daily"](spark, DATA).collect()
    found, files = [], list(pathlib.Path(paths[0].removeprefix("file://")).rglob("*.parquet"))
    for f in files:
        part = dict(p.split("=") for p in f.parts if "=" in p)
        day = dt.date.fromisoformat(part["obs_date"])
        assert int(part["water_year"]) == water_year(day)
        found += [(part["tile"], r["row"], r["col"], day, r["snow"], r["grain"], r["dust"]) for r in pq.ParquetFile(f).read().to_pylist()]
    px = adapters.pixel_days(spark, DATA).select("tile", "row", "col", "obs_date", "snow", "grain", "dust").collect()
    assert len(found) == len(px) and set(found) == {tuple(r) for r in px}
    assert len(files) == len({(r.tile, r.obs_date) for r in px})


def test_display_range_counts_repeated_values(spark):
    from nivalis.plans import tree

    values = {(1, 0): [0.0] * 90 + [float(100 * i) for i in range(1, 11)], (2, 0): [float(i * i % 977) for i in range(1000)], (2, 1): [None, None]}
    stat = spark.createDataFrame([(2000, s * 10, v, x) for (s, v), xs in values.items() for x in xs], "water_year int, subdivision_id int, var_id int, stat_value double")
    links = spark.createDataFrame([(1, 10, 0), (2, 20, 0)], "group_id int, id int, display int")
    names = spark.createDataFrame([(1, "one")], "id int, name string")
    found = {(r.root_id, r.var_id): (r.range_low, r.range_high) for r in tree.web_metadata(stat, links, names).collect()}
    outer = lambda x: (math.floor(hazen(x, 5) / 50) * 50, math.ceil(hazen(x, 95) / 50) * 50)
    assert found == {(1, 0): outer(values[1, 0]), (2, 0): outer(values[2, 0]), (2, 1): (None, None)}


@pytest.mark.parametrize("name", ["o87_display_range", "o34_display_range", "o87_web_metadata", "o07_read_daily"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    with duckdb.connect() as db:
        for p in Path(DATA).glob("*.parquet"):
            db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        cursor = db.execute(queries.SQL[name])
        columns = [c[0] for c in cursor.description]
        expected = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r)) for r in queries.QUERIES[name](spark, DATA).select(*columns).collect()) == expected


def test_unmix_job_recovers_mixtures(spark):
    """Of columns that clash with its results, of a pixel without background, of one that is no candidate."""
    axes, table = queries._snow_lut()
    truth = [(0.7, 0.1, 400.0, 3e-4), (0.4, 0.2, 150.0, 1e-4), (0.5, 0.05, 900.0, 6e-4)]
    ground = [10.0, 20.0, 8.0, 12.0, 30.0, 25.0, 15.0]
    bands = [f"b{k}" for k in range(1, 8)]
    mu = math.cos(math.radians(50))
    rows, grounds = [], []
    for i, (f, s, g, dust) in enumerate([*truth, truth[0], truth[0]]):
        snow = lut.interpolate(axes, table, np.array([[mu, g**0.5, dust]]))[0]
        r = (f * snow + (1 - f - s) * np.array(ground)).tolist()
        rows.append(("h00v00", 0, i, dt.date(2000, 1, 1), *r, 50, 0, 2 if i == 4 else 0, 0, 0.9, -1, -2, "kept"))
        if i != 3:
            grounds.append(("h00v00", 0, i, *ground))
    doubles = ", ".join(f"{b} double" for b in bands)
    px = spark.createDataFrame(rows, f"tile string, row int, col int, obs_date date, {doubles}, solar_zenith int, sensor_zenith int, nodata_filter int, zero_filter int, ndsi double, dust int, snow_fraction int, note string")
    background = spark.createDataFrame(grounds, f"tile string, row int, col int, {doubles}")
    static = spark.createDataFrame([("h00v00", 0, i, 0, 0) for i in range(5)], "tile string, row int, col int, canopy_cover int, ice_fraction int")
    found = {r.col: r for r in ingest.unmix_job(px, background, static, axes, table, tolerance=1).collect()}
    assert set(found) == {0, 1, 2, 3}
    for i, (f, s, g, dust) in enumerate(truth):
        r = found[i]
        assert r.note == "kept" and r.residual < 0.5 and r.viewable_snow_fraction == pytest.approx(100 * f, abs=3)
        assert r.grain_size == pytest.approx(g, rel=0.15) and r.dust == pytest.approx(dust * 1e6, rel=0.25) and r.zero_filter == 0
    assert found[3].viewable_snow_fraction is None and found[3].dust is None


def test_unmix_query_solves_every_candidate(spark):
    found = queries.QUERIES["o81_unmix_job"](spark, DATA)
    assert found.count() == adapters.pixel_days(spark, DATA).where("class NOT IN (1, 2)").count() > 0


def test_ingest_job_for_viirs(spark):
    """Flags of the coarse grid, no classifier, pixels without background."""
    bands = [f"b{k}" for k in range(1, 8)]
    rows = [("h00v00", r, c, dt.date(2000, 1, 1), *([60] * 7 if (r, c) == (0, 0) else [10, 20, 10, 20, 20, 20, 5]), 0, 0) for r in range(2) for c in range(4)]
    px = spark.createDataFrame(rows, "tile string, row int, col int, obs_date date, " + ", ".join(f"{b} int" for b in bands) + ", solar_zenith int, sensor_zenith int")
    coarse = spark.createDataFrame([("h00v00", dt.date(2000, 1, 1), 0, 0, 0b0100, 0b0001, 0), ("h00v00", dt.date(2000, 1, 1), 0, 1, 0b1000, 0b0001, 0b10000)], "tile string, obs_date date, row int, col int, qf1 int, qf2 int, qf7 int")
    static = spark.createDataFrame([("h00v00", r, c, 1000, False) for r in range(2) for c in range(4)], "tile string, row int, col int, elevation int, is_water boolean")
    ground = spark.createDataFrame([("h00v00", r, c) for r in range(2) for c in range(4) if c], "tile string, row int, col int")
    found = {(r.row, r.col): r for r in ingest.ingest_job(px, static, viirs=True, coarse=coarse, background=ground).collect()}
    assert len(found) == 8
    for (r, c), x in found.items():
        bit = lambda k: x.nodata_filter >> (k - 1) & 1  # noqa: E731, B023
        assert (bit(2), bit(3), bit(5)) == (0, int(c == 0), int((r, c) == (0, 0)))
        assert x.weight == (100 if c < 2 else 25)
        assert x.zero_filter & 1 == 0


def spatial_table(spark, rows):
    kinds = "row int, col int, viewable_snow_fraction int, grain int, dust_ppm int, grain_size_dust int, elevation int, canopy_cover int, nodata_filter int, zero_filter int"
    return spark.createDataFrame([("h00v00", dt.date(2000, 1, 1), *r, "own", True) for r in rows], f"tile string, obs_date date, {kinds}, snow string, valid boolean")


def test_spatial_job_fills_from_pixels_without_filters_only(spark):
    """Half of the tile under bit 3 with other grains; pixels without own values; the caller's snow and valid columns stay."""
    rows = [(r, c, 50, 100 if c < 3 else 900, 10 if c < 3 else 70, 9 if (r, c) == (0, 0) else 0, 1000, 50, 0 if c < 3 else 4, 0) for r in range(6) for c in range(6)]
    table = spatial_table(spark, rows)
    out = ingest.spatial_job(table, 6, 6)
    assert out.columns == [*table.columns, "grain_spatial", "dust_ppm_spatial"]
    found = {(r.row, r.col): r for r in out.collect()}
    assert found[0, 0].grain_spatial == 100 and found[0, 0].dust_ppm_spatial == 10 and found[0, 0].snow == "own" and found[0, 0].valid
    assert all(x.grain_spatial == (100 if c < 3 else 900) and x.nodata_filter == (0 if c < 3 else 4) for (_, c), x in found.items())
    # VIIRS takes no notice of the classifier's bits, but of the others.
    cloudy = spatial_table(spark, [(r, c, 50, 500, 10, 1 if c == 0 else 0, 1000, 50, 2, 1) for r in range(6) for c in range(6)])
    assert {x.grain_spatial for x in ingest.spatial_job(cloudy, 6, 6).collect()} == {500}
    changed = cloudy.withColumn("grain", F.when(F.col("col") == 0, 7).otherwise(F.col("grain")))
    assert {x.grain_spatial for x in ingest.spatial_job(changed, 6, 6).where("col = 0").collect()} == {7}  # no snow, nothing to fill
    assert {x.grain_spatial for x in ingest.spatial_job(changed, 6, 6, viirs=True).where("col = 0").collect()} == {500}


def test_medians_of_a_raster_larger_than_stated(spark):
    """Rows beyond the stated ones have pyramids of their own; no row comes twice."""
    from nivalis.operators import groups

    day = dt.date(2000, 1, 1)
    rows = [("h00v00", day, r, 0, 100, 10 * (1 + r // 48) if r % 2 else None, True, bool(r % 2)) for r in range(130)]
    px = spark.createDataFrame(rows, "tile string, obs_date date, row int, col int, elevation int, grain int, snow boolean, valid boolean")
    found = groups.spatial_median_fill(px, "grain", ["tile", "obs_date"], 48, 48).collect()
    assert sorted((r.row, r.grain_spatial) for r in found) == [(r, 10 * (1 + r // 48)) for r in range(130)]


def test_spatial_job_flags_salt_pans_of_the_base_only(spark):
    """Five and more snow-free bins above 5000 m: snow of the base in them is salt, under clouds, canopy or little snow it is not."""
    rows = []
    for b in range(8):  # bins 4950 to 5020 m, a row of 36 pixels each; in one cell of a 6 x 6 grid of cells
        for c in range(36):
            snowy = c == 0
            rows.append((b, c, 60 if snowy else 0, 300, 10, 0, 4950 + 10 * b, 0, 0, 0))
    odd = [(20, 0, 60, 300, 10, 0, 4951, 30, 0, 0), (20, 1, 60, 300, 10, 0, 4951, 0, 2, 0), (20, 2, 60, 300, 10, 0, 4951, 0, 16, 0), (20, 3, 60, 300, 10, 0, 4951, 0, 0, 4), (20, 4, 60, 300, 10, 0, 4951, 0, 0, 8), (20, 5, 60, 300, 10, 0, 4951, 29, 1, 1)]
    rows += [(90 + b, c, 60 if c == 0 else 0, 300, 10, 0, 5000 + b, 0, 0, 0) for b in range(1) for c in range(36)]
    flag = lambda found: {k for k, r in found.items() if r.nodata_filter & 64}
    found = {(r.row, r.col): r for r in ingest.spatial_job(spatial_table(spark, rows + odd), 216, 216).collect()}
    # Bins 4950, 4960, 4970 and 4980 see five snow-free ones; those from 4990 on do not. Of the odd ones only the last is base.
    assert flag(found) == {(0, 0), (1, 0), (2, 0), (3, 0), (20, 5)}
    high = [(b, c, 60 if c == 0 else 0, 300, 10, 0, 5000 + 10 * b, 0, 0, 0) for b in range(9) for c in range(36)]
    found = {(r.row, r.col): r for r in ingest.spatial_job(spatial_table(spark, high), 216, 216).collect()}
    assert flag(found) == {(0, 0)}  # the bin 5000 to 5010 m is asked, the next has no 40 bins above it
    assert all(found[k].grain_spatial is not None for k in found)


def test_fix_peaks_is_fix_peak_of_each_season(spark):
    rng = np.random.default_rng(5)
    first, days = dt.date(1999, 10, 1), 366
    grain = {p: [int(x) if rng.random() < 0.4 else None for x in np.linspace(60, 900, days) + rng.normal(0, 20, days)] for p in range(3)}
    rows = [("h00v00", 0, p, 2000, first + dt.timedelta(i), g, 50 + i % 9, 90) for p, gs in grain.items() for i, g in enumerate(gs)]
    px = spark.createDataFrame(rows, "tile string, row int, col int, water_year int, obs_date date, grain int, dust int, weight int")
    found = {(r.col, r.obs_date): r for r in spline.fix_peaks(px, "grain", "dust", "weight", cols=10).collect()}
    for p, gs in grain.items():
        g = np.array([[np.nan if x is None else x for x in gs]], float)
        d = np.array([[50 + i % 9 for i in range(days)]], float)
        ok = (g >= 40) & (g <= 1190)
        expected = spline.fix_peak(g, d, ok, ok, np.full(g.shape, 90.0))
        for i in (0, 100, 250, days - 1):
            r = found[p, first + dt.timedelta(i)]
            assert r.grain_fixed == pytest.approx(np.clip(expected[0][0, i], 40, 1190)) and r.dust_fixed == pytest.approx(np.clip(expected[1][0, i], 0, 950))


def test_files_are_planned_as_they_come(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"file_name": "MOD09GA.A2000001.h08v04.061.1.hdf", "edit_ts": "2000-01-02T00:00:00"}', '{"file_name": "MOD09GA.A2000001.h08v04.061.2.hdf", "edit_ts": "2000-01-03T00:00:00"}', '{"file_name": "readme.txt", "edit_ts": "2000-01-03T00:00:00"}']
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    fields = "tile string, obs_date date, input_file_name string, input_edit_ts timestamp, discarded_file_name string, discarded_edit_ts timestamp"
    status = spark.createDataFrame([], fields + "".join(f", status_of_{s} int" for s in ("ingest", "weight", "inversion", "corrected_snow", "spatial")))
    seen = []
    streaming.plan_as_files_come(streaming.file_stream(spark, str(tmp_path / "in")), lambda: status, lambda df, i: seen.extend(df.collect()), str(tmp_path / "checkpoint")).awaitTermination()
    assert [(r.file_name[-5], r.action, r.do_inversion) for r in seen] == [("2", "ingest", True)]


def exchanges(df):
    """Exchanges in the plan as Spark would run it, without those that adaptive execution adds no more."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_gap_filling_is_one_shuffle(spark):
    first, last = dt.date(1999, 10, 1), dt.date(2000, 9, 30)
    px = seasons(spark, first, last)
    static = spark.createDataFrame([("h00v00", 0, p, 5) for p in range(2)], "tile string, row int, col int, ice_fraction int")
    for by_year in (False, True):
        assert exchanges(gapfill.gap_fill_job(px, str(first), str(last), static, cols=10, by_year=by_year)) == 1


def test_runs_and_stretches_of_matrices_are_those_of_the_windows(spark):
    from nivalis.operators import series

    rng = np.random.default_rng(12)
    first, days = dt.date(1999, 10, 1), 120
    z = rng.choice([np.nan, 0.0, 30.0], (6, days), p=[0.6, 0.2, 0.2])
    z[0], z[1], z[2] = np.nan, 0.0, 30.0
    rows = [("h00v00", 0, p, first + dt.timedelta(i), None if np.isnan(z[p, i]) else int(z[p, i])) for p in range(6) for i in range(days)]
    px = spark.createDataFrame(rows, "tile string, row int, col int, obs_date date, snow int")
    px = series.stretches(series.unobserved_runs(px, F.col("snow").isNotNull()), F.col("snow"))
    since, length = gapfill.runs(~np.isnan(z))
    snowy, absent = gapfill.stretch_days(z)
    for r in px.collect():
        at = r.col, (r.obs_date - first).days
        assert (r.days_since_last_observation, r.days_without_observation, r.days_with_snow, r.days_with_absent_snow) == (since[at], length[at], snowy[at], absent[at]), at
