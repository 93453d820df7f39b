"""Spectral indices, viewing geometry and the arithmetic of snow fractions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.007181
ORBIT_KM = 705.0


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); null where the denominator is 0."""
    return (a - b) / F.nullif((a + b).cast("double"), F.lit(0.0))


def spectral_indices(bands: list[Column], swir_limit: float = 0.2) -> dict[str, Column]:
    """NDSI (bands 3, 6), NDVI (2, 1), the norm over the root of 7, and whether band 6 is below the limit (in percent / 100)."""
    total = sum((b.cast("double") * b for b in bands[1:]), bands[0].cast("double") * bands[0])
    return {
        "ndsi": normalised_difference(bands[2], bands[5]),
        "ndvi": normalised_difference(bands[1], bands[0]),
        "norm": F.sqrt(total) / F.sqrt(F.lit(float(len(bands)))),
        "swir_low": bands[5] < swir_limit * 100,
    }


def pixel_size(view_zenith: Column, earth: float = EARTH_KM, orbit: float = ORBIT_KM, size: float = 1.0) -> tuple[Column, Column]:
    """Along-track and cross-track size of a pixel (size at nadir given), for a view zenith in degrees."""
    far = (earth + orbit) / earth
    theta = F.asin(F.sin(F.radians(view_zenith)) / far)
    along = (F.cos(theta) * (earth + orbit) - F.sqrt(1 - (far * F.sin(theta)) ** 2) * earth) / orbit * size
    half = F.atan(F.lit(size / (2 * orbit)))
    cross = (F.asin(F.sin(theta + half) * far) - F.asin(F.sin(theta - half) * far) - half * 2) * earth
    return along, cross * size


def canopy_correction(cover: Column, view_zenith: Column, shape: float = 2.7) -> Column:
    """Percent of canopy seen at the view zenith, from that seen from above; rounded."""
    slant = F.cos(F.atan(F.tan(F.radians(view_zenith)) * shape))
    return F.round((1 - F.pow(1 - cover / 100, 1 / slant)) * 100).cast("int")


def corrected_snow_fraction(viewable: Column, shade: Column, canopy: Column, ice: Column) -> Column:
    """Viewable snow as a percentage of what shade, canopy and ice leave free, not below the ice."""
    free = 100 - F.least(shade + canopy + ice, F.lit(99))
    share = F.greatest(F.least(F.lit(100), F.round(viewable * 100 / free)), ice)
    return F.when(viewable.isNotNull(), share.cast("int"))


def sun_on_slope(mu0: Column, azimuth: Column, slope: Column, aspect: Column) -> Column:
    """Cosine of the sun's angle on a slope, in [0, 1]; mu0 is the cosine of the solar zenith, angles in degrees.

    The azimuth (from north, clockwise) is turned into one from south, counter-clockwise
    positive, in [-180, 180], as the aspect is given.
    """
    turned = 180 - azimuth
    phi = F.when(turned > 180, turned - 360).when(turned < -180, turned + 360).otherwise(turned)
    mu = mu0 * F.cos(F.radians(slope)) + F.sqrt(1 - mu0 * mu0) * F.sin(F.radians(slope)) * F.cos(F.radians(phi - aspect))
    return F.when(mu.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), mu)))


def observed_albedo(clean: Column, deltavis: Column, share: float = 0.63) -> Column:
    """Albedo in percent of dirty snow, from the clean one and the drop in the visible (both percent)."""
    albedo = F.round(clean - deltavis * share)
    return F.when(albedo.between(0, 100), albedo.cast("int"))
