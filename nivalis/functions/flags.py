"""Cloud, no-snow and quality decisions, kept as bit fields (positions from 1).

daily_nodata_filter: 1 no input, 2 classified cloud, 3 no background, 4 rare observation,
5 bright cloud, 6 cloud margin, 7 salt pan. daily_zero_filter: 1 classified neither,
2 low NDSI, 3 little snow, 4 small grains, 5 low elevation, 6 water, 7 no snow.
daily_grain_size_dust: 1-3 for grain size and 4-6 for dust: too little snow, below the
minimum, above the maximum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nivalis.functions.bits import flags_of, get_bit, set_bit

# Weights (percent) by flag value.
WEIGHTS = {
    "cloud": (100, 50, 50, 100),
    "cloudshadow": (100, 80),
    "landwater": (80, 100, 80, 80, 80, 0, 0, 0),
    "aerosol": (100, 100, 50, 25),
    "cirrus": (100, 100, 50, 25),
    "modland": (100, 50, 0, 0),
    "atmos_corr": (80, 100),
    "adj_corr": (90, 100),
}
VIIRS_WEIGHTS = {
    "cloud": (100, 100, 50, 50),
    "cloudshadow": (100, 80),
    "landwater": (100, 100, 0, 0, 0, 80, 0),
    "aerosol": (100, 100, 50, 25),
    "cirrus": (100, 25),
}
# Reflectances (percent) of bands 1 to 6 above which a pixel is a bright cloud.
BRIGHT = (35, 35, 31, 31, 30, 22)
# Status codes of an observation.
STATUS = {
    "unavailable": 0, "observed": 1, "cloudy_or_other": 10, "high_solar_zenith": 20, "unknown_solar_zenith": 21,
    "low_value": 30, "not_public": 40, "false_positive": 50, "no_input": 60, "no_observation": 61, "poor_quality": 62,
    "no_reflectance": 63, "low_ndsi": 64, "low_snow_fraction": 65, "low_grain_size": 66, "few_observations": 67,
    "water": 68, "low_elevation": 69, "temporary": 255,
}
SNOW, CLOUD, NEITHER = 0, 1, 2


def combine_classification(cls: Column, state_cloud: Column, saltpan: Column, nodata: Column, zero: Column) -> tuple[Column, Column]:
    """Both filters with the classifier's bits: cloud where nothing else is flagged; neither unless the state says cloud, or salt pan."""
    cloud = (cls == CLOUD) & (nodata == 0) & (zero == 0)
    neither = ((cls == NEITHER) & ~state_cloud.isin(1, 2)) | (saltpan == 1)
    return set_bit(nodata, 2, cloud), set_bit(zero, 1, neither)


def angle_weight(along: Column, cross: Column) -> Column:
    """Percent: the smaller the footprint, the more."""
    weight = F.round(100 / (along * cross))
    return F.when(weight.isNotNull(), F.least(F.lit(100), weight).cast("int"))


def observation_weight(flags: dict[str, Column], others: list[Column], tables=WEIGHTS) -> Column:
    """The least of the flags' weights and the other ones; 0 counts as 1. Flag values without a weight do not count."""
    looked_up = [F.try_element_at(F.array(*map(F.lit, tables[name])), value.cast("int") + 1) for name, value in flags.items()]
    least = F.least(*looked_up, *others)
    return F.when(least == 0, 1).otherwise(least).cast("int")


def bright_cloud(bands: list[Column], limits=BRIGHT) -> Column:
    out = F.lit(True)
    for band, limit in zip(bands, limits):
        out = out & (band > limit)
    return out


def zero_flags(ndsi: Column, elevation: Column, water: Column, snow: Column, grain: Column, least_ndsi=-0.5, least_elevation=500, little=10, least_grain=40) -> dict[int, Column]:
    return {
        2: ndsi < least_ndsi,
        3: (snow > 0) & (snow <= little),
        4: (snow > 0) & (grain < least_grain),
        5: elevation < least_elevation,
        6: water,
        7: snow == 0,
    }


def grain_dust_flags(snow: Column, grain: Column, dust: Column, grain_range=(40, 1190), dust_range=(0, 950), grain_snow=30, dust_snow=90) -> Column:
    return flags_of({
        1: snow < grain_snow, 2: grain < grain_range[0], 3: grain > grain_range[1],
        4: snow < dust_snow, 5: dust < dust_range[0], 6: dust > dust_range[1],
    })


def nodata_or_zero(nodata: Column, zero: Column, version: int = 1, viirs: bool = False) -> tuple[Column, Column]:
    """Whether a day has no data and whether it is observed as free of snow; VIIRS does not use the classifier's bits."""
    nodata = set_bit(set_bit(nodata, 2, F.lit(False)) if viirs else nodata, 4, F.lit(False))
    zero = set_bit(zero, 1, F.lit(False)) if viirs else zero
    z = {i: get_bit(zero, i) for i in range(1, 8)}
    if version == 0:
        missing = ((nodata != 0) | z[6]) & ~z[5]
        free = (z[1] | z[2] | z[3] | z[4] | z[5] | z[7]) & ~missing
    else:
        faint = (z[3] | z[4]) & ~z[1] & ~z[2] & ~z[7]
        missing = ((nodata != 0) | faint) & ~z[5] & ~z[6]
        free = (z[1] | z[2] | z[5] | z[6] | z[7]) & ~missing
    return missing, free


def inversion_candidates(nodata: Column, zero: Column, viirs: bool = False) -> Column:
    """The pixels worth unmixing."""
    if viirs:
        out = F.lit(True)
        for bit in (1, 3, 5, 6):
            out = out & ~get_bit(nodata, bit)
    else:
        out = (nodata == 0) & ~get_bit(zero, 1)
    return out & ~get_bit(zero, 2) & ~get_bit(zero, 6)
