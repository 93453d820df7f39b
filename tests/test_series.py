import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import series, spline

START = dt.date(2000, 1, 1)


def pixel(spark, values, column="snow"):
    rows = [("h00v00", 0, 0, START + dt.timedelta(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"tile string, row int, col int, obs_date date, {column} int")


def column(df, name):
    return [r[name] for r in df.orderBy("obs_date").collect()]


def test_run_lengths_of_the_worked_example(spark):
    found = series.unobserved_runs(pixel(spark, [5] + [None] * 9 + [7]), F.col("snow").isNotNull())
    assert column(found, "days_without_observation") == [0] + [9] * 9 + [0]
    assert column(found, "days_since_last_observation") == [0, *range(1, 10), 0]


def test_stretches_and_rare_days(spark):
    px = pixel(spark, [0, 20, None, 30, 0])
    assert column(series.stretches(px, F.col("snow")), "days_with_snow") == [0, 2, 2, 2, 0]
    assert column(series.rare_observations(px, "snow", 3, 1), "snow") == [0, None, None, None, 0]


def test_interpolation_and_ends(spark):
    px = pixel(spark, [None, 10, None, 20, None])
    assert column(series.interpolate_linear(px, "snow"), "snow_filled") == [5, 10, 15, 20, 25]
    assert column(series.interpolate_linear(px, "snow", "nearest"), "snow_filled") == [10, 10, 15, 20, 20]
    assert column(series.interpolate_linear(pixel(spark, [None, 4, None]), "snow"), "snow_filled") == [4, 4, 4]
    assert column(series.interpolate_linear(pixel(spark, [None, None]), "snow"), "snow_filled") == [None, None]


def test_densify_an_empty_table(spark):
    empty = pixel(spark, []).where("false")
    assert series.densify(empty, F.lit(START), F.lit(START)).count() == 0


def test_densify_bounds_the_rows_of_a_task_and_shuffles_observed_rows_only(spark, monkeypatch):
    monkeypatch.setattr(series, "ROWS_A_TASK", 50)
    day = lambda i: START + dt.timedelta(i)
    rows = [("h00v00", 0, p, day(i), 100 * p + i) for p in range(40) for i in (-3, 2, 5, 5, 9, 30) if p % 7] + [("h00v00", 0, 0, day(40), 1), ("h00v00", 0, 7, None, 1), ("h00v00", 0, 7, None, 2)]
    px = spark.createDataFrame(rows, "tile string, row int, col int, obs_date date, snow int")
    dense = series.densify(px, F.lit(day(0)), F.lit(day(9)), rows=400)
    own = {(p, i): 100 * p + i for p in range(40) for i in (2, 5, 9) if p % 7}
    expected = [(p, day(i), own.get((p, i))) for p in range(40) for i in range(10) if p % 7 or p < 8 for _ in range(2 if p % 7 and i == 5 else 1)]
    assert sorted(map(repr, (tuple(r) for r in dense.select("col", "obs_date", "snow").collect()))) == sorted(map(repr, expected))
    runs = series.stretches(series.unobserved_runs(dense, F.col("snow").isNotNull()), F.col("snow"))
    assert runs._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert runs.rdd.getNumPartitions() == 8 and max(runs.rdd.glom().map(len).collect()) < 150


def test_hampel_matches_the_matrix_form(spark):
    values = [5, 6, 90, 7, None, 6, 5, 40, 6]
    ours = column(pixel(spark, values).withColumn("h", series.hampel("snow")), "h")
    theirs = spline.hampel(np.array([[np.nan if v is None else v for v in values]], float))[0]
    assert [None if np.isnan(x) else x for x in theirs] == ours


def test_hampel_of_observed_days_alone_is_that_among_all_days(spark):
    rng = np.random.default_rng(4)
    values = [int(v) if rng.random() < 0.6 else None for v in rng.integers(0, 30, 300) ** 2]
    px = pixel(spark, values)
    among = column(px.withColumn("h", series.hampel("snow")), "h")
    alone = px.where("snow IS NOT NULL").withColumn("h", series.hampel("snow", by_days=True))
    dense = series.densify(alone.drop("snow"), F.lit(START), F.lit(START + dt.timedelta(299)))
    assert column(dense, "h") == among and among != [None if v is None else float(v) for v in values]


def test_hampel_query_sends_observed_rows_only_through_its_window(spark):
    from nivalis import queries

    plan = queries.QUERIES["o65_hampel"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("collect_list")  # above it in the plan, so after it


def dense_spline(y, w, p):
    """The same energy, solved as one dense system."""
    n = len(y)
    a, b = np.zeros((2 * n, 2 * n)), np.zeros(2 * n)
    k = (1 - p) * np.array([[12, 6, -12, 6], [6, 4, -6, 2], [-12, -6, 12, -6], [6, 2, -6, 4]], float)
    for i in range(n - 1):
        a[2 * i : 2 * i + 4, 2 * i : 2 * i + 4] += k
    for i in range(n):
        if not np.isnan(y[i]):
            a[2 * i, 2 * i] += p * w[i]
            b[2 * i] += p * w[i] * y[i]
    return np.linalg.lstsq(a, b, rcond=None)[0][::2]


def test_spline_against_a_dense_solution_and_its_limit():
    rng = np.random.default_rng(1)
    y, w = rng.uniform(0, 100, (3, 40)), rng.integers(1, 100, (3, 40)).astype(float)
    y[rng.random((3, 40)) < 0.4] = np.nan
    found = spline.smooth(y, w, 0.1)
    for i in range(3):
        assert np.allclose(found[i], dense_spline(y[i], w[i], 0.1), atol=1e-5)
    close = spline.smooth(y, np.ones_like(y), 1 - 1e-9)
    assert np.allclose(close[~np.isnan(y)], y[~np.isnan(y)], atol=1e-3)
    assert np.isnan(spline.smooth(np.array([[1.0, np.nan, np.nan]]), np.ones((1, 3)), 0.5)).all()


def test_fix_peak_holds_the_peak_and_tapers():
    days = 366
    grain = np.linspace(100, 800, 250).tolist() + [np.nan] * (days - 250)
    g = np.array([grain])
    dust = np.where(np.isnan(g), np.nan, 50.0)
    out, d = spline.fix_peak(g, dust, ~np.isnan(g), ~np.isnan(dust), np.ones_like(g))
    assert out[0, 255] == pytest.approx(800) and out[0, -1] == pytest.approx(40)
    assert d[0, 255] == pytest.approx(50) and d[0, -1] == pytest.approx(0)
    assert np.isnan(spline.fix_peak(g * np.nan, dust, np.zeros(g.shape, bool), np.zeros(g.shape, bool), np.ones_like(g))[0]).all()
