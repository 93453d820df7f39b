"""Groups of close spectra, held against every pair."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nivalis import queries
from nivalis.operators import spectra

DATA = "/root/testdata/sf0.001"


def by_pairs(values, tolerance):
    """Representative of each distinct spectrum, by rounds over all pairs."""
    own = {hashlib.md5(",".join(map(str, v)).encode()).digest(): v for v in values}
    near = lambda a, b: all(abs(x - y) <= tolerance for x, y in zip(own[a], own[b]))
    still, told = set(own), {}
    while still:
        cells = {}
        for i in still:
            c = tuple(math.floor(x / tolerance) for x in own[i])
            cells[c] = min(i, cells.get(c, i))
        elected = [i for i in cells.values() if not any(j < i and near(i, j) for j in cells.values())]
        for i in list(still):
            around = [j for j in elected if near(i, j)]
            if around:
                told[i] = min(around)
                still.remove(i)
    return told


def clouds(kind, seed=1):
    """Spectra of 15 values around few centres, brighter and darker, so most have many others near; some twice."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 100, (6, 15))
    found = centres[rng.integers(0, 6, 500)] + rng.integers(-12, 13, (500, 1)) + rng.integers(-1, 2, (500, 15))
    line = np.repeat(np.arange(0, 120, 2)[:, None], 15, 1)  # each near the next one
    found = np.concatenate([found, line, found[:40]]).astype(kind)
    return [tuple(r) for r in (found if kind is int else found / 4 * 4).tolist()]


@pytest.mark.parametrize("kind", [int, float])
def test_net_equals_rounds_over_all_pairs(spark, kind):
    rows, names = clouds(kind), [f"c {i}" if i else "members" for i in range(15)]  # names that clash or need quotes
    px = spark.createDataFrame(rows, ", ".join(f"`{n}` {'bigint' if kind is int else 'double'}" for n in names))
    for parts in (1, 7):
        net = {bytes(r.spectrum_id): r for r in spectra.distinct_spectra(px.repartition(parts), names, 7).collect()}
        assert {i: bytes(r.representative) for i, r in net.items()} == by_pairs(rows, 7)
    value = lambda r: np.array([r[f"v{i}"] for i in range(15)])
    chosen = [r for i, r in net.items() if bytes(r.representative) == i]
    assert all(np.abs(value(r) - value(net[bytes(r.representative)])).max() <= 7 for r in net.values())
    assert all(np.abs(value(a) - value(b)).max() > 7 for k, a in enumerate(chosen) for b in chosen[:k])
    assert sum(r.members for r in net.values()) == len(rows) and len(net) == len(set(rows)) > 3 * len(chosen)


def test_net_of_hot_cells_by_few_keys(spark, monkeypatch):
    """A third of all spectra in one cell; one value for a key."""
    monkeypatch.setattr(spectra, "MOST_KEYS", 1)
    rng = np.random.default_rng(5)
    rows = [(50 + i % 7, 50 + i // 7 % 7, 50 + i // 49) for i in range(300)] + [tuple(r) for r in rng.integers(0, 100, (600, 3)).tolist()]
    px = spark.createDataFrame(rows, "a int, b int, c int")
    found = {bytes(r.spectrum_id): bytes(r.representative) for r in spectra.distinct_spectra(px, ["a", "b", "c"], 7).collect()}
    assert found == by_pairs(rows, 7)


def test_net_without_what_is_no_number(spark):
    px = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (float("nan"), 1.0), (1.0, float("-inf")), (1.0, 2.0), (8.0, 9.0), (8.5, 9.0)], "a double, b double")
    found = spectra.distinct_spectra(px, ["a", "b"], 7).collect()
    assert sorted((r.v0, r.v1, r.members) for r in found) == [(1.0, 2.0, 2), (8.0, 9.0, 1), (8.5, 9.0, 1)]
    apart = spectra.distinct_spectra(px, ["a", "b"], 0).collect()
    assert len(apart) == 3 and all(r.representative == r.spectrum_id for r in apart)
    assert spectra.distinct_spectra(px.where("a > 100"), ["a", "b"], 7).count() == 0
    assert px.where(spectra.spectrum_id(px, ["a", "b"]).isNull()).count() == 3


def test_query_merges_and_counts_every_pixel_day(spark):
    found = queries.QUERIES["o51_distinct_spectra"](spark, DATA)
    r = found.agg(F.countDistinct("representative").alias("groups"), F.count("*").alias("spectra"), F.sum("members").alias("pixels")).first()
    assert r.groups < r.spectra <= r.pixels


def test_a_spectrum_is_looked_up_few_times(spark):
    names = [f"v{i}" for i in range(15)]
    some = spark.range(20_000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("spectrum_id"), *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(101))).alias(n) for i, n in enumerate(names)])
    keys = spectra._keys(some, names, 7)
    assert keys and spectra._look_up(some, keys, spectra.WIDE * 7, 7).count() < 6 * 20_000


def test_net_with_several_groups_for_a_key(spark, monkeypatch):
    for name, value in (("MOST_KEYS", 1), ("MOST_ROWS", 40), ("PAIRS", 50)):
        monkeypatch.setattr(spectra, name, value)
    rng = np.random.default_rng(6)
    rows = list({tuple(r) for r in rng.integers(50, 75, (400, 3)).tolist()})
    px = spark.createDataFrame(rows, "a int, b int, c int")
    found = {bytes(r.spectrum_id): bytes(r.representative) for r in spectra.distinct_spectra(px, ["a", "b", "c"], 7).collect()}
    assert found == by_pairs(rows, 7)


@pytest.mark.parametrize("whole", [True, False])
def test_first_near_equals_all_pairs(monkeypatch, whole):
    monkeypatch.setattr(spectra, "PAIRS", 300)
    rng = np.random.default_rng(2)
    a, b = (rng.uniform(0, 60, (n, 4)) for n in (500, 700))
    a, b = (np.floor(x) if whole else x for x in (a, b))
    a[:100], b[:50] = a[0], a[0] + 3
    near = (np.abs(a[:, None] - b) <= 7.5).all(2)
    assert (spectra.first_near(a, b, 7.5) == np.where(near.any(1), near.argmax(1), len(b))).all()
    assert (spectra.first_near(a, b[:0], 7.5) == 0).all() and len(spectra.first_near(a[:0], b, 7.5)) == 0


def shuffled_rows(spark):
    """Rows that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_few_spectra_go_to_more_than_one_group(spark, monkeypatch):
    """Values far from each other in all places, each spectrum with some near ones: copies for all keys in reach would be many."""
    monkeypatch.setattr(spectra, "WANTED", 100)
    name, seen, kept = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], spectra.stash
    monkeypatch.setattr(spectra, "stash", lambda df, label: [seen.append(spark.conf.get(name)), kept(df, label)][1])
    rng, n = np.random.default_rng(8), 12_000
    rows = (rng.integers(0, 101, (n // 40, 15))[rng.integers(0, n // 40, n)] + rng.integers(-3, 4, (n, 15))).tolist()
    px = spark.createDataFrame(rows, ", ".join(f"c{i} int" for i in range(15)))
    before, setting = shuffled_rows(spark), spark.conf.get(name)
    assert spectra.distinct_spectra(px, px.columns, 7).count() == len(set(map(tuple, rows)))
    assert shuffled_rows(spark) - before < 6 * n  # 9 when all that stood for a cell were copied
    assert set(seen) == {"true"} and spark.conf.get(name) == setting


def test_zeros_of_either_sign_are_one_value(spark):
    px = spark.createDataFrame([(0.0, 2.0), (-0.0, 2.0)], "a double, b double")
    assert [(r.v0, r.members) for r in spectra.distinct_spectra(px, ["a", "b"], 7).collect()] == [(0.0, 2)]
    assert px.select(spectra.spectrum_id(px, ["a", "b"]).alias("i")).distinct().count() == 1
