"""What the plans of stored tables and skewed joins look like, and that their results are those of the plain forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nivalis.operators import grid, joins, series
from nivalis.sources import tables

KEYS = ["tile", "row", "col"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def pixel_days(spark):
    rows = [(f"h0{t}v04", r, c, dt.date(2000, 1, 1) + dt.timedelta(i), (r * c + i) % 9) for t in (8, 9) for r in range(5) for c in range(6) for i in range(4)]
    return spark.createDataFrame(rows, "tile string, row int, col int, obs_date date, snow int")


def test_tables_bucketed_by_pixel_join_without_a_shuffle(spark, tmp_path, no_broadcasts):
    px = pixel_days(spark)
    static = px.select(*KEYS).distinct().withColumn("elevation", F.col("row") * 100)
    mask = static.select(*KEYS, F.explode(F.array(F.lit(1), F.col("row") + 2)).alias("subdivision_id"), F.lit("adm0").alias("type"))
    stored = {n: tables.write_pixel_buckets(df, f"buckets_{n}_{abs(hash(str(tmp_path)))}", f"file://{tmp_path}/{n}", 4, order) for n, df, order in (("px", px, ("obs_date",)), ("static", static, ()), ("mask", mask, ()))}
    both = joins.with_static(stored["px"], stored["static"])
    dealt = joins.with_subdivision(both, stored["mask"])
    assert plan(joins.with_static(px, static)).count("Exchange") >= 2 and "Exchange" not in plan(both) and "Exchange" not in plan(dealt)
    assert "Exchange" not in plan(series.unobserved_runs(stored["px"], F.col("snow").isNotNull()))
    expected = joins.with_subdivision(joins.with_static(px, static), mask)
    assert sorted(map(tuple, dealt.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize(("crs", "box"), [("EPSG:4326", (-140.0, 52.0, 0.7)), ("EPSG:3857", (-15584000.0, 6800000.0, 78000.0))])
def test_a_stored_index_reads_the_tiles_of_its_target_only(spark, tmp_path, crs, box):
    px = pixel_days(spark).unionByName(pixel_days(spark).withColumn("tile", F.lit("h35v17")))
    px.write.partitionBy("tile").parquet(f"file://{tmp_path}/px")
    stored = spark.read.parquet(f"file://{tmp_path}/px")
    target = grid.target_grid(spark, *box, 40, 60)
    index = grid.write_index(grid.reprojection_index(target, crs, 10), f"file://{tmp_path}/index")
    found = grid.reproject_indexed(stored, index)
    line = next(x for x in plan(found).splitlines() if "snow" in x and "FileScan" in x)
    assert "PartitionFilters" in line and "h08v04" in line.partition("PartitionFilters")[2] and "h35v17" not in line
    plain = grid.reproject_nearest(px, target, crs, 10)
    columns = [*plain.columns]
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, plain.collect()))
    assert found.where("snow IS NOT NULL").count() > 0


def test_nine_of_ten_rows_under_one_key_are_not_shuffled(spark, no_broadcasts):
    left = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 10 < 9, 7).when(F.col("id") % 100 == 9, None).otherwise(F.col("id") % 50 + 100).cast("long").alias("a"), (F.col("id") % 3).alias("b"), "id")
    right = left.where("a IS NOT NULL").groupBy("a", "b").agg(F.count("*").alias("n")).withColumn("value", F.col("a") * 10 + F.col("b")).where("a <> 119")
    total = left.count()
    found = joins.split_join(left, right, ["a", "b"], F.col("n") > total / joins.SHARE * 100)
    expected = left.join(right, ["a", "b"], "left").select("a", "b", "id", "n", "value")
    assert sorted(map(str, found.select("a", "b", "id", "n", "value").collect())) == sorted(map(str, expected.collect()))
    assert right.where(F.col("n") > total / joins.SHARE * 100).count() == 3
    text = plan(found)
    assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1  # the hot key by broadcast, the rest after it has gone
    rest = left.join(F.broadcast(right.where("n > 2000").select("a", "b")), ["a", "b"], "left_anti")
    sizes = sorted(r["count"] for r in rest.where("a IS NOT NULL").repartition(4, "a", "b").groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] < 3 * sizes[len(sizes) // 2]


def test_medians_around_are_not_broadcast(spark, monkeypatch):
    """Neither where the tables of medians are made nor where pixels meet them; pixels are shuffled once for both values."""
    from nivalis.operators import groups
    from nivalis.plans import ingest

    plans, kept = [], groups.stash
    monkeypatch.setattr(groups, "stash", lambda df, label: [plans.append(plan(df)), kept(df, label)][1])
    kinds = "row int, col int, viewable_snow_fraction int, grain int, dust_ppm int, grain_size_dust int, elevation int, canopy_cover int, nodata_filter int, zero_filter int"
    rows = [("h00v00", dt.date(2000, 1, 1), r, c, 50, 100 + r, c, 9 if c % 3 == 0 else 0, 1000 + 90 * r, 50, 0, 0) for r in range(24) for c in range(24)]
    found = ingest.spatial_job(spark.createDataFrame(rows, f"tile string, obs_date date, {kinds}"), 24, 24)
    assert len(plans) == 4 and not any("BroadcastHashJoin" in x for x in plans)
    text = plan(found)
    assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 2 and text.count("Exchange") == 3
    assert found.where("grain_spatial IS NULL OR dust_ppm_spatial IS NULL").count() == 0
