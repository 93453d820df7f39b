"""Daily ingest (flags, weights, cloud bits) and unmixing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.functions.bits import flags_of, get_bit, pack_masks, set_bit, squeeze_viirs, unpack_bits
from nivalis.functions.codec import cut_min_max
from nivalis.functions.flags import VIIRS_WEIGHTS, WEIGHTS, angle_weight, bright_cloud, combine_classification, grain_dust_flags, inversion_candidates, observation_weight, zero_flags
from nivalis.functions.optics import canopy_correction, corrected_snow_fraction, pixel_size, spectral_indices
from nivalis.operators.grid import cell_of_pixel
from nivalis.operators.groups import BANDS, saltpan_flag, spatial_medians, with_medians
from nivalis.operators.joins import SHARE, split_join
from nivalis.operators.neighbourhood import cloud_margin
from nivalis.operators.spectra import distinct_spectra, spectrum_id
from nivalis.operators.unmix import unmix
from nivalis.sources.folders import stash

DAY = ["tile", "obs_date"]
SOLVED = ["snow_fraction", "shade_fraction", "grain_size", "dust", "residual"]
#: How far values of one group of spectra may lie from its representative, and for VIIRS.
TOLERANCE = {False: 7, True: 12}


def ingest_job(px: DataFrame, static: DataFrame, block: int = 200, viirs: bool = False, coarse: DataFrame | None = None, background: DataFrame | None = None) -> DataFrame:
    """Adds nodata_filter, zero_filter, weight, sensor_mask and ndsi.

    Needs bands, zeniths, state_1km and class; for VIIRS qf1, qf2 and qf7 instead of the last two (there is no
    classifier, so bits 2 and 1 stay off and the margin is that of bright clouds). With `coarse`, a grid of half the
    resolution, its columns beyond tile, day, row and col are joined first; with `background`, pixels without one get
    bit 3. Narrow but for these joins, the cloud margin and the static join.
    """
    if coarse is not None:
        near = coarse.withColumnsRenamed({"row": "_row", "col": "_col"})
        px = px.withColumns({"_row": F.expr("row div 2"), "_col": F.expr("col div 2")}).join(near, [*DAY, "_row", "_col"], "left").drop("_row", "_col")
    px = px.join(static.select("tile", "row", "col", "elevation", "is_water"), ["tile", "row", "col"], "left")
    cuts = {b: cut_min_max(F.col(b), 0, 100) for b in BANDS}
    px = px.withColumn("sensor_mask", pack_masks([m for _, m in cuts.values()]))
    px = px.withColumns({b: v for b, (v, _) in cuts.items()})
    flags = squeeze_viirs(F.col("qf1"), F.col("qf2"), F.col("qf7")) if viirs else F.col("state_1km")
    state = {c: unpack_bits(flags)[i] for i, c in enumerate(("cloud", "cloudshadow", "landwater", "aerosol", "cirrus", "saltpan"))}
    px = px.withColumn("ndsi", spectral_indices([F.col(b) for b in BANDS])["ndsi"])
    nodata = F.when(F.coalesce(F.col("sensor_mask"), F.lit(1)) != 0, 1).otherwise(0)
    zero = flags_of({k: v for k, v in zero_flags(F.col("ndsi"), F.col("elevation"), F.col("is_water"), F.lit(None), F.lit(None)).items() if k in (2, 5, 6)})
    if not viirs:
        nodata, zero = combine_classification(F.col("class"), state["cloud"], state["saltpan"], nodata, zero)
    if background is not None:
        px = px.join(background.select("tile", "row", "col", F.lit(True).alias("_ground")).distinct(), ["tile", "row", "col"], "left")
        nodata = set_bit(nodata, 3, F.col("_ground").isNull())
    nodata = set_bit(nodata, 5, bright_cloud([F.col(b) for b in BANDS[:6]]))
    others = [angle_weight(*pixel_size(F.col("sensor_zenith"))), F.greatest(F.lit(1), F.round(F.cos(F.radians("solar_zenith")) * 100)).cast("int")]
    weight = observation_weight({k: v for k, v in state.items() if k != "saltpan"}, others, VIIRS_WEIGHTS if viirs else WEIGHTS)
    px = px.withColumns({"nodata_filter": nodata, "zero_filter": zero, "weight": weight}).drop("_ground")
    px = px.withColumn("is_cloud_bit", get_bit(F.col("nodata_filter"), 2) | get_bit(F.col("nodata_filter"), 5))
    margin = cloud_margin(px, "is_cloud_bit", DAY, block)
    px = px.join(margin, [*DAY, "row", "col"], "left")
    return px.withColumn("nodata_filter", set_bit(F.col("nodata_filter"), 6, F.coalesce("is_margin", F.lit(False)))).drop("is_margin", "is_cloud_bit")


def unmix_job(px: DataFrame, background: DataFrame, static: DataFrame, axes: list[np.ndarray], table: np.ndarray, tolerance: float | None = None, viirs: bool = False) -> DataFrame:
    """Fractions, grain size, dust and their flags for the pixels worth unmixing; one solution per group of close spectra (TOLERANCE, or the one given).

    Columns of px with names of results (SOLVED) are replaced. Pixels without background, or with a null in a band, get nulls.
    """
    ground = background.select("tile", "row", "col", *[F.col(b).alias(f"g{i + 1}") for i, b in enumerate(BANDS)])
    fixed = static.select("tile", "row", "col", "canopy_cover", "ice_fraction")
    own = px.drop(*SOLVED, "spectrum_id", "members").where(inversion_candidates(F.col("nodata_filter"), F.col("zero_filter"), viirs)).join(ground, ["tile", "row", "col"], "left").join(fixed, ["tile", "row", "col"], "left")
    values = [*BANDS, *[f"g{i + 1}" for i in range(7)], "solar_zenith"]
    ground = [f"g{i + 1}" for i in range(7)]
    net = distinct_spectra(own, values, TOLERANCE[viirs] if tolerance is None else tolerance)
    net = stash(net.withColumnsRenamed({f"v{i}": v for i, v in enumerate(values)}), "net")
    chosen = net.where(F.col("spectrum_id") == F.col("representative")).withColumn("mu0", F.cos(F.radians("solar_zenith")))
    solved = unmix(chosen.select("representative", *BANDS, *ground, "mu0"), BANDS, ground, "mu0", axes, table)
    solved = stash(net.select("spectrum_id", "members", "representative").join(solved.select("representative", *SOLVED), "representative").drop("representative"), "unmixed")
    # Few spectra hold most snow and cloud: those of more than a thousandth of all pixels are broadcast.
    many = F.col("members") > (solved.agg(F.sum("members")).first()[0] or 0) / SHARE
    out = split_join(own.withColumn("spectrum_id", spectrum_id(own, values)), solved, ["spectrum_id"], many).drop("spectrum_id", "members")
    canopy = canopy_correction(F.col("canopy_cover"), F.col("sensor_zenith"))
    snow = F.round("snow_fraction").cast("int")
    out = out.withColumns({"viewable_snow_fraction": snow, "grain": F.round("grain_size").cast("int"), "dust_ppm": F.round("dust").cast("int")})
    little = zero_flags(F.col("ndsi"), F.lit(None), F.lit(None), F.col("viewable_snow_fraction"), F.col("grain"))
    zero = F.col("zero_filter")
    for bit in (3, 4, 7):
        zero = set_bit(zero, bit, little[bit])
    return out.withColumns({
        "snow_fraction": corrected_snow_fraction(snow, F.round("shade_fraction"), canopy, F.coalesce("ice_fraction", F.lit(0))),
        "zero_filter": zero,
        "grain_size_dust": grain_dust_flags(F.col("viewable_snow_fraction"), F.col("grain"), F.col("dust_ppm")),
    })


#: Filter bits that make a pixel no snow for the medians; the class of a classifier (2 and 1) is left out for VIIRS.
NOT_SNOW = {False: (range(1, 9), range(1, 9)), True: ((1, 3, 5, 6, 7), (2, 3, 4, 5, 6, 7))}
MOST_CANOPY = 30


def _off(filter_: str, bits) -> Column:
    """Whether all of the filter's bits are off; a null filter is not."""
    return F.coalesce(F.col(filter_).bitwiseAND(F.lit(sum(1 << b - 1 for b in bits))) == 0, F.lit(False))


def saltpan_base(viirs: bool = False) -> Column:
    """Pixels whose snow counts for the salt pans: low canopy, no cloud, not of little snow or small grains."""
    clouds = (5, 6) if viirs else (2, 5, 6)
    return F.coalesce(F.col("canopy_cover") < MOST_CANOPY, F.lit(False)) & _off("nodata_filter", clouds) & _off("zero_filter", (3, 4))


def spatial_job(px: DataFrame, rows: int = 2400, cols: int = 2400, viirs: bool = False, **saltpans) -> DataFrame:
    """What neighbours tell about unmixed pixels: salt pans (bit 7 of nodata_filter), grain size and dust from the medians around.

    Needs viewable_snow_fraction, grain, dust_ppm, grain_size_dust, both filters, elevation and canopy_cover. Salt pans are
    flagged first; snow is then what no filter excludes, flagged pixels included in these, and a value is valid if its three
    bits of grain_size_dust are off. Adds grain_spatial and dust_ppm_spatial, and keeps all columns; further
    arguments go to saltpan_flag.
    """
    kept = [F.col(f"`{c}`") for c in px.columns if c not in ("grain_spatial", "dust_ppm_spatial")]
    cell_row, cell_col = cell_of_pixel(F.col("row"), F.col("col"), rows, cols)
    own = px.select(*kept).withColumns({"_base": saltpan_base(viirs), "cell_row": cell_row, "cell_col": cell_col})
    own = saltpan_flag(own, DAY, "viewable_snow_fraction", "_base", **saltpans).withColumn("nodata_filter", set_bit(F.col("nodata_filter"), 7, F.col("is_saltpan")))
    nodata, zero = NOT_SNOW[viirs]
    own = own.withColumn("_snow", _off("nodata_filter", nodata) & _off("zero_filter", zero))
    for value, bits in (("grain", (1, 2, 3)), ("dust_ppm", (4, 5, 6))):
        own = own.withColumn(f"_valid_{value}", _off("grain_size_dust", bits) & F.col(value).isNotNull())
    own = stash(own, "snow-around")  # read by both medians and the fill
    medians = {v: (spatial_medians(own, v, DAY, rows, cols, snow="_snow", valid=f"_valid_{v}"), f"_valid_{v}") for v in ("grain", "dust_ppm")}
    return with_medians(own, medians, DAY, rows, cols, snow="_snow").select(*kept, "grain_spatial", "dust_ppm_spatial")
