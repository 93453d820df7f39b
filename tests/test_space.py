import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis.operators import lut, holes, neighbourhood, stats, unmix

DAY = ["tile", "obs_date"]
WHEN = dt.date(2000, 1, 1)


def tile(spark, **arrays):
    shape = next(iter(arrays.values())).shape
    rows = [("h00v00", WHEN, i, j, *(None if np.isnan(a[i, j]) else float(a[i, j]) for a in arrays.values())) for i in range(shape[0]) for j in range(shape[1])]
    return spark.createDataFrame(rows, "tile string, obs_date date, row int, col int, " + ", ".join(f"{k} double" for k in arrays))


def as_array(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r[name] is None else float(r[name])
    return out


def loop_margin(cloud, bands):
    n, m = cloud.shape
    out = np.zeros(cloud.shape, bool)
    for i in range(n):
        for j in range(m):
            best = 0
            for band in bands:
                top = bottom = 0.0
                for a in range(max(0, i - 5), min(n, i + 6)):
                    for b in range(max(0, j - 5), min(m, j + 6)):
                        if band[a, b] == band[i, j]:
                            w = 1 / (np.hypot(a - i, b - j) + 1)
                            top, bottom = top + w * cloud[a, b], bottom + w
                best = max(best, np.floor(100 * top / bottom + 0.5))
            out[i, j] = best > 1
    return out


@pytest.mark.parametrize("block", [4, 200])
def test_despeckle_and_margin_against_loops(spark, block):
    shape = (12, 12)
    cloud = np.zeros(shape)
    cloud[1, 1] = 1
    cloud[6:9, 6:9] = 1
    elevation = np.where(np.arange(12)[:, None] < 7, 100.0, 1000.0) * np.ones(shape)
    px = tile(spark, cloud=cloud, elevation=elevation)
    kept = as_array(neighbourhood.cloud_despeckle(px, "cloud", DAY, block=block), "is_cloud", shape)
    expected = cloud.copy()
    expected[1, 1] = 0
    assert (kept == expected).all()
    margin = as_array(neighbourhood.cloud_margin(px, "cloud", DAY, block=block), "is_margin", shape)
    bands = [(elevation > 500) * 1, (elevation > 500) * 1]
    assert (margin.astype(bool) == (loop_margin(expected, bands) & (cloud == 0))).all()


@pytest.mark.parametrize(("method", "error"), [("springs", 0.2), ("plate", 0.02)])
def test_inpaint_a_smooth_surface(spark, method, error):
    x = np.linspace(0, 1, 21)
    true = np.exp(x[:, None] + x[None, :])
    holed = true.copy()
    holed[5:8, 5:8] = holed[15, 12:16] = np.nan
    found = as_array(holes.inpaint(tile(spark, z=holed), "z", DAY, 21, 21, method), "z_filled", true.shape)
    known = ~np.isnan(holed)
    assert np.allclose(found[known], true[known]) and np.abs(found - true).max() < error


def test_lut_is_exact_at_nodes_and_linear_between(spark):
    axes, values = [np.array([0.0, 1.0, 3.0]), np.array([0.0, 2.0])], np.array([[0.0, 2.0], [1.0, 3.0], [3.0, 5.0]])
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (9.0, 0.0), (None, 0.0)], "a double, b double")
    assert [r.v for r in lut.lut_interpolate(df, axes, values, ["a", "b"], "v").collect()] == [3.0, 3.0, None, None]
    long = spark.createDataFrame([(a, b, float(values[i, j])) for i, a in enumerate(axes[0].tolist()) for j, b in enumerate(axes[1].tolist())], "a double, b double, v double")
    assert (lut.lut_arrays(long, ["a", "b"], "v")[1] == values).all()


def snow_lut():
    axes = [np.linspace(0, 1, 5), np.linspace(30**0.5, 1200**0.5, 30), np.linspace(0, 1e-3, 6)]
    mu, g, d = np.meshgrid(*axes, indexing="ij")
    bands = np.array([0.2, 0.9, 0.05, 0.1, 1.4, 2.3, 2.5])
    return axes, np.stack([98 - b * g - (9e3 if i in (0, 2, 3) else 2e3) * d + 2 * mu for i, b in enumerate(bands)], -1)


def test_unmixing_recovers_mixtures(spark):
    axes, table = snow_lut()
    truth = [(0.7, 0.1, 400.0, 3e-4), (0.4, 0.2, 150.0, 1e-4), (0.5, 0.05, 900.0, 6e-4)]
    ground = np.array([10, 20, 8, 12, 30, 25, 15.0])
    rows = []
    for f, s, g, dust in truth:
        snow = lut.interpolate(axes, table, np.array([[0.6, g**0.5, dust]]))[0]
        rows.append((*(f * snow + (1 - f - s) * ground).tolist(), *ground.tolist(), 0.6))
    rows.append((*[None] * 7, *ground.tolist(), 0.6))
    names = [f"b{i}" for i in range(7)] + [f"g{i}" for i in range(7)] + ["mu"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    found = unmix.unmix(df, names[:7], names[7:14], "mu", axes, table).collect()
    for row, (f, s, g, dust) in zip(found, truth):
        assert row.residual < 0.5
        assert row.snow_fraction == pytest.approx(100 * f, abs=3) and row.grain_size == pytest.approx(g, rel=0.15) and row.dust == pytest.approx(dust * 1e6, rel=0.25)
    assert found[3].snow_fraction is None


def test_smoothed_median_of_the_worked_example(spark):
    df = spark.createDataFrame([("a", v) for v in (10, 10, 10, 20)] + [("b", None)], "k string, v int")
    rows = stats.smoothed_median(df, ["k"], "v").collect()
    assert len(rows) == 1 and rows[0].smoothed_median == pytest.approx(2 / 3.1 + 10 - 0.5)


def test_extreme_years_ties_and_nulls(spark):
    rows = [(1, 1, y, d, v) for y, v in ((1999, 5.0), (2000, 5.0), (2001, 1.0)) for d in (1, 2)] + [(2, 1, y, 1, None) for y in (1999, 2000)]
    s = spark.createDataFrame(rows, "subdivision_id int, var_id int, water_year int, day int, stat_value double")
    found = {r.subdivision_id: (r.max_year, r.min_year) for r in stats.extreme_years(s).collect()}
    assert found == {1: (1999, 2001), 2: (2000, 2000)}
    q = stats.historic_day_quantiles(s, 2001).where("subdivision_id = 2").first()
    assert q.median is None and q.prc25 is None


def test_daily_job_equals_daily_stats(spark):
    from nivalis.plans.statistics import daily_job

    rng = np.random.default_rng(0)
    px = tile(spark, snow=rng.integers(0, 100, (6, 6)).astype(float), grain=rng.integers(30, 60, (6, 6)).astype(float)).select("tile", "obs_date", "row", "col", F.col("snow").cast("int"), F.col("grain").cast("int"), F.lit(700).alias("elevation"))
    mask = px.select("tile", "row", "col", F.explode(F.array(F.lit(1), F.col("row") % 2 + 2)).alias("subdivision_id"))
    a = {(r.subdivision_id, r.stat_id): r.stat_value for r in daily_job(px, mask, "snow", "grain", 1).collect()}
    for r in stats.daily_stats(px.join(mask, ["tile", "row", "col"]), "snow", "grain", ["obs_date", "subdivision_id"]).collect():
        assert a[r.subdivision_id, 1] == pytest.approx(r.snow_area_km2)
        assert a[r.subdivision_id, 2] == pytest.approx(r.mean_value)
        assert a[r.subdivision_id, 3] == pytest.approx(r.smoothed_median)


@pytest.mark.parametrize("method", ["springs", "plate"])
def test_inpaint_converges_in_a_hole_of_100_pixels(method):
    """A ramp solves both systems exactly, whatever the size of the hole."""
    true = np.tile(np.linspace(0, 90, 120), (120, 1)) + np.arange(120)[:, None] / 3
    holed = true.copy()
    holed[10:110, 10:110] = np.nan
    assert np.abs(getattr(holes, method)(holed) - true).max() < 1e-2


def test_inpaint_says_when_it_does_not_converge(monkeypatch):
    holed = np.tile(np.arange(30.0), (30, 1))
    holed[5:25, 5:25] = np.nan
    monkeypatch.setattr(holes, "MOST_STEPS", 1)
    with pytest.raises(RuntimeError):
        holes.springs(holed)


def test_springs_are_the_least_squares_of_horizontal_and_vertical_springs():
    x = np.linspace(0, 1, 101)
    true = np.exp(x[:, None] + x[None, :])
    holed = true[:14, :15].copy()
    holed[3:9, 2:11] = holed[0, :4] = holed[12:, 13:] = np.nan
    n, m = holed.shape
    number = np.arange(n * m).reshape(n, m)
    pairs = [(number[i, j], number[i + a, j + b]) for i in range(n) for j in range(m) for a, b in ((1, 0), (0, 1)) if i + a < n and j + b < m]
    flat, hole = holed.ravel(), np.isnan(holed.ravel())
    pairs = [p for p in pairs if hole[p[0]] or hole[p[1]]]
    system, right = np.zeros((len(pairs), n * m)), np.zeros(len(pairs))
    for k, (a, b) in enumerate(pairs):
        for node, sign in ((a, 1.0), (b, -1.0)):
            if hole[node]:
                system[k, node] = sign
            else:
                right[k] -= sign * flat[node]
    expected = flat.copy()
    expected[hole] = np.linalg.lstsq(system[:, hole], right, rcond=None)[0]
    assert np.allclose(holes.springs(holed).ravel(), expected, atol=1e-6)
    whole = true.copy()
    whole[20:50, 35:90] = np.nan
    assert np.abs(holes.plate(whole) - true).max() < 0.05


def test_inverse_distance_means_against_loops():
    rng = np.random.default_rng(2)
    value, valid = rng.uniform(100, 900, (9, 12)), rng.random((9, 12)) < 0.3
    found = neighbourhood.inverse_distance_means(value, valid)
    for i in range(9):
        for j in range(12):
            w = [(1 / np.hypot(a - i, b - j), value[a, b]) for a in range(9) for b in range(12) if valid[a, b] and (a, b) != (i, j)]
            assert found[i, j] == pytest.approx(sum(x * v for x, v in w) / sum(x for x, _ in w))
    assert np.isnan(neighbourhood.inverse_distance_means(value, np.zeros((9, 12), bool))).all()


def dense(holed, method):
    """The same systems as matrices."""
    n, m = holed.shape
    energy = np.zeros((n * m, n * m))
    for k in range(n * m):
        unit = np.zeros(n * m)
        unit[k] = 1
        energy[:, k] = holes.ENERGY[method](unit.reshape(n, m)).ravel()
    flat, hole = holed.ravel().copy(), np.isnan(holed.ravel())
    flat[hole] = np.linalg.solve(energy[np.ix_(hole, hole)], -energy[np.ix_(hole, ~hole)] @ flat[~hole])
    return flat.reshape(n, m)


def squared_laplacians(x):
    n, m = x.shape
    total = 0.0
    for i in range(n):
        for j in range(m):
            bend = (x[i + 1, j] - 2 * x[i, j] + x[i - 1, j] if 0 < i < n - 1 else 0) + (x[i, j + 1] - 2 * x[i, j] + x[i, j - 1] if 0 < j < m - 1 else 0)
            total += bend**2
    return total


@pytest.mark.parametrize("block", [200, 13, 7])  # 13: blocks end where the raster does
@pytest.mark.parametrize("method", ["springs", "plate"])
def test_holes_across_blocks_equal_a_dense_solution(spark, method, block):
    """Noise; holes within a block, across borders and corners, at the edges, side by side; absent cells, empty blocks."""
    rng = np.random.default_rng(8)
    true = rng.normal(0, 9, (26, 31))
    holed = true.copy()
    for cells in (np.s_[1:3, 1:3], np.s_[5:9, 4:17], np.s_[12:16, 12:16], np.s_[0:2, 20:24], np.s_[20:26, 25:31], np.s_[18, :12], np.s_[20, :12], np.s_[9:12, 6], np.s_[14:21, 20:23], np.s_[10, 24:30:2]):
        holed[cells] = np.nan
    expected = dense(holed, method)
    if method == "plate":  # the least energy of all
        assert all(squared_laplacians(expected) < squared_laplacians(np.where(np.isnan(holed), expected + rng.normal(0, 0.1, true.shape), true)) for _ in range(5))
    px = tile(spark, z=holed).where("z IS NOT NULL AND NOT isnan(z) OR row < 12")
    found = as_array(holes.inpaint(px, "z", DAY, 26, 31, method, block), "z_filled", true.shape)
    assert np.abs(found - expected).max() < 1e-5


def test_rasters_without_a_value_stay_null(spark):
    px = tile(spark, z=np.full((4, 5), np.nan))
    for block in (200, 2):
        found = holes.inpaint(px, "z", DAY, 4, 5, "springs", block).collect()
        assert len(found) == 20 and all(r.z_filled is None or np.isnan(r.z_filled) for r in found)
    assert holes.inpaint(px.where("row > 9"), "z", DAY, 4, 5).count() == 0


@pytest.mark.parametrize(("method", "most"), [("springs", 20), ("plate", 45)])
def test_steps_hardly_depend_on_the_width_of_a_hole(method, most):
    steps = []
    for width in (50, 100, 200, 400):
        rng = np.random.default_rng(width)
        a = rng.normal(0, 5, (width + 40, width + 40))
        mask = np.zeros(a.shape, bool)
        mask[20:-20, 20:-20] = True
        filled, n = holes.solve(np.where(mask, 0.0, a), mask, method)
        steps.append(n)
        left = np.where(mask, holes.ENERGY[method](filled), 0.0)
        assert np.abs(left).max() < 1e-5 * np.abs(np.where(mask, holes.ENERGY[method](np.where(mask, 0.0, a)), 0.0)).max()
    assert max(steps) <= most and steps[-1] <= 2 * steps[0]


def test_cloud_share_compares_each_place_with_one_band(monkeypatch):
    """As sums over one raster per band give it, without making these."""
    from nivalis.operators import neighbourhood as nb

    rng = np.random.default_rng(8)
    cloud, bands = rng.random((40, 9)) < 0.3, [rng.integers(0, 30, (40, 9)).astype(float) for _ in range(2)]
    weight, most = lambda i, j: 1 / (np.hypot(i, j) + 1), np.zeros(cloud.shape)
    for band in bands:
        for step in np.unique(band[band > 0]):
            here = band == step
            share = nb.shifted_sum((cloud & here).astype(float), 5, weight) / np.maximum(nb.shifted_sum(here.astype(float), 5, weight), 1e-12)
            most = np.maximum(most, np.where(here, np.floor(100 * share + 0.5), 0))

    def no_raster_per_band(a, *rest):
        raise AssertionError(f"a raster for each band: {a.shape}")

    monkeypatch.setattr(nb, "shifted_sum", no_raster_per_band)
    assert (nb.cloud_share(cloud, bands) == most).all() and most.max() > 1
    assert not nb.cloud_share(cloud & False, bands).any()


@pytest.mark.parametrize("shape", [(300, 20), (20, 300), (1, 7), (5, 1)])
def test_inverse_distance_means_strip_by_strip(monkeypatch, shape):
    monkeypatch.setattr(neighbourhood, "FREQUENCIES", 900)
    monkeypatch.setattr(neighbourhood, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(3)
    value, valid = rng.uniform(0, 100, shape), rng.random(shape) < 0.4
    valid.flat[:2] = True
    r, c = np.nonzero(np.ones(shape))
    with np.errstate(divide="ignore"):
        w = 1 / np.hypot(r[:, None] - r, c[:, None] - c)
    w = np.where(np.isinf(w), 0, w) * valid.ravel()
    assert np.allclose(neighbourhood.inverse_distance_means(value, valid).ravel(), w @ np.where(valid, value, 0).ravel() / w.sum(1))


def test_inverse_distance_means_hold_little_more_than_the_raster():
    import tracemalloc

    value, valid = np.random.default_rng(3).uniform(0, 100, (20_000, 50)), np.random.default_rng(4).random((20_000, 50)) < 0.4
    tracemalloc.start()
    neighbourhood.inverse_distance_means(value, valid)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * value.nbytes
