import datetime as dt

import pytest
from pyspark.sql import functions as F

from nivalis.functions import bits, codec, flags, optics, wateryear
from nivalis.functions.quantiles import percentile_hazen


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_water_year_of_the_worked_example(spark):
    day = F.to_date(F.lit("2024-01-02"))
    assert tuple(one(spark, wateryear.water_year(day), wateryear.day_of_water_year(day), wateryear.days_in_water_year(day))) == (2024, 94, 366)


def test_date_window_is_capped_at_yesterday_and_the_start():
    assert wateryear.date_window(dt.date(2001, 3, 20), 12, 10, dt.date(2001, 3, 16)) == (dt.date(2000, 10, 1), dt.date(2001, 3, 15))
    assert wateryear.date_window(dt.date(2001, 3, 20), 2, 10) == (dt.date(2001, 1, 21), dt.date(2001, 3, 20))
    assert wateryear.interpolation_window(dt.date(2000, 10, 1), dt.date(2001, 9, 30), 3, 3) == (dt.date(2000, 7, 1), dt.date(2001, 12, 30))


def test_hazen(spark):
    x = F.array(*[F.lit(float(i)) for i in (1, 2, 3, 4)])
    assert tuple(one(spark, percentile_hazen(x, 25), percentile_hazen(x, 75), percentile_hazen(x, 0))) == (1.5, 3.5, 1.0)
    assert one(spark, percentile_hazen(F.array().cast("array<double>"), 50))[0] is None


def test_encode_decode_is_the_identity_and_saturates(spark):
    px = spark.createDataFrame([(1.5,), (None,), (-3.0,), (99.0,)], "v double")
    stored = px.select(codec.encode(F.col("v"), 2, 255, 0, 100).alias("s"))
    assert [r[0] for r in stored.collect()] == [3, 255, 0, 100]
    assert [r[0] for r in stored.select(codec.decode(F.col("s"), 2, 255)).collect()] == [1.5, None, 0.0, 50.0]


def test_bits_set_get_and_pack(spark):
    c = F.lit(0b1010)
    assert tuple(one(spark, bits.set_bit(c, 1, F.lit(True)), bits.set_bit(c, 2, F.lit(None).cast("boolean")), bits.get_bit(c, 4))) == (0b1011, 0b1000, True)
    assert one(spark, bits.pack_masks([F.lit(1), F.lit(4), F.lit(2)]))[0] == 1 | 4 << 3 | 2 << 6


def test_nulls_stay_null(spark):
    null = F.lit(None).cast("int")
    assert one(spark, optics.corrected_snow_fraction(null, F.lit(1), F.lit(1), F.lit(1)))[0] is None
    assert one(spark, optics.sun_on_slope(F.lit(None).cast("double"), F.lit(1), F.lit(1), F.lit(1)))[0] is None
    assert one(spark, codec.scale_to_colormap(null, 0, 1))[0] == 255


def test_pixel_size_at_nadir_is_one(spark):
    along, across = one(spark, *optics.pixel_size(F.lit(0)))
    assert along == pytest.approx(1, abs=1e-6) and across == pytest.approx(1, abs=1e-6)


def test_zero_weight_counts_as_one(spark):
    assert one(spark, flags.observation_weight({"landwater": F.lit(6)}, [F.lit(50)]))[0] == 1
