"""Albedo and radiative forcing of gap-filled days."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nivalis.operators.lut import at_node, interpolate_several, shared_table
from nivalis.operators.series import PIXEL, by_day, fill_nearest
from nivalis.plans.gapfill import Further, gap_fill_job

# Ranges of the outputs.
RANGES = {"albedo": (0, 100), "deltavis": (0, 75), "radiative_forcing": (0, 500)}
#: What sums of products of doubles can miss, so that an exact half that comes out as 4.499999999999999 is rounded as a half.
SLACK = 1 + 1e-13
OUT = ["albedo_mu0", "albedo_muz", "deltavis", "radiative_forcing", "albedo_observed_mu0", "albedo_observed_muz"]
#: Rows that are looked up at once: their corners and weights stay in the processor's cache.
ROWS_AT_ONCE = 8192


def rounded(x: np.ndarray) -> np.ndarray:
    """To whole numbers, halves away from zero, as Spark rounds."""
    size = np.abs(x)
    whole = np.floor(size)
    return np.copysign(whole + (size - whole >= 0.5), x)


def within(x: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.where((x >= low) & (x <= high), x, np.nan)


def illumination(zenith: np.ndarray, azimuth: np.ndarray, slope: np.ndarray, aspect: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of the solar zenith and of the sun's angle on the slope, as optics.sun_on_slope() has it for columns."""
    mu0, turned = np.cos(np.radians(zenith)), 180 - azimuth
    phi = np.where(turned > 180, turned - 360, np.where(turned < -180, turned + 360, turned))
    tilt = np.radians(slope)
    return mu0, np.clip(mu0 * np.cos(tilt) + np.sqrt(1 - mu0 * mu0) * np.sin(tilt) * np.cos(np.radians(phi - aspect)), 0.0, 1.0)


class Tables:
    """The look-up tables of albedos, without the axes on which all points lie on one node: soot, and dust of clean snow."""

    def __init__(self, spark, luts: dict[str, tuple], soot: float):
        self.fixed, self.shared = {}, {}
        for name, known in (("albedo", {4: soot, 3: 0.0}), ("deltavis", {4: soot}), ("radiative_forcing", {4: soot})):
            axes, values = [np.asarray(a) for a in luts[name][0]], luts[name][1]
            left = list(range(5))
            for axis, x in known.items():
                less = at_node(axes, values, axis, x)
                if less:
                    (axes, values), left = less, [i for i in left if i != axis]
            self.shared[name], self.fixed[name] = shared_table(spark, axes, values), (left, known)

    def look_up(self, names: list[str], points: list) -> list[np.ndarray]:
        """Of tables, those over the same axes together, at mu0, mu, root of grain size and dust."""
        (axes, values), (left, known) = self.shared[names[0]].value, self.fixed[names[0]]
        same = all(self.fixed[n][0] == left and all(map(np.array_equal, self.shared[n].value[0], axes)) for n in names[1:])
        if not same:
            return [self.look_up([n], points)[0] for n in names]
        given = [np.full(len(points[0]), known[i]) if i in known else points[i] for i in left]
        return interpolate_several(axes, [self.shared[n].value[1] for n in names], given)

    def albedos(self, mu0: np.ndarray, muz: np.ndarray, grain: np.ndarray, dust: np.ndarray) -> dict[str, np.ndarray]:
        """The columns OUT of rows, nan where there is none."""
        found = {c: np.empty(len(mu0)) for c in OUT}
        for start in range(0, len(mu0), ROWS_AT_ONCE):
            part = slice(start, start + ROWS_AT_ONCE)
            for c, x in self._albedos(mu0[part], muz[part], grain[part], dust[part]).items():
                found[c][part] = x
        return found

    def _albedos(self, mu0, muz, grain, dust) -> dict[str, np.ndarray]:
        # Days without a grain size count as of the largest one, as greatest() and least() of columns have it; without dust they have clean albedos only.
        root = np.sqrt(np.clip(np.where(np.isnan(grain), 1999, grain), 1, 1999))
        raw = {f"albedo_{name}": self.look_up(["albedo"], [mu0, mu, root])[0] for name, mu in (("mu0", mu0), ("muz", muz))}
        dusty = np.flatnonzero(~np.isnan(dust))
        two = ["deltavis", "radiative_forcing"]
        for name, x in zip(two, self.look_up(two, [mu0[dusty], muz[dusty], root[dusty], dust[dusty] / 10 / 1e6])):
            raw[name] = np.full(len(mu0), np.nan)
            raw[name][dusty] = x
        out = {name: within(rounded(x * SLACK), *RANGES["albedo" if name.startswith("albedo") else name]) for name, x in raw.items()}
        # Observed ones: optics.observed_albedo().
        return out | {f"albedo_observed_{mu}": within(rounded(out[f"albedo_{mu}"] - out["deltavis"] * 0.63), 0, 100) for mu in ("mu0", "muz")}


def albedo_job(px: DataFrame, static: DataFrame, luts: dict[str, tuple], soot: float = 0.0, keys=PIXEL) -> DataFrame:
    """albedo_mu0 and albedo_muz (clean), deltavis, radiative_forcing and observed albedos, where grain size and dust exist.

    `luts` maps albedo, deltavis and radiative_forcing to (axes, values) over mu0, mu, root of grain
    size, dust (a share) and soot. Zeniths and azimuths are filled in time, nearest at the ends
    of a series (one for each of the keys). One shuffle and one sort: the window that numbers a series' rows
    hands them over in order, and a task holds a batch of rows and one series at a time.
    """
    px = px.join(static.select(*PIXEL, "slope", "aspect"), PIXEL, "left")
    tables, angles = Tables(px.sparkSession, luts, soot), ["solar_zenith", "solar_azimuth"]
    doubles = [*(f"{c}_filled" for c in angles), "mu0", "muz"]
    # The rows are carried as they are, the inputs as doubles beside them.
    inputs = [*angles, "slope", "aspect", "grain_size", "dust"]
    ready = px.withColumns({f"_{c}": F.col(c).cast("double") for c in inputs} | {"_day": F.unix_date("obs_date").cast("double"), "_nth": F.row_number().over(by_day(keys))})

    def of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        number = {c: rows.column(c).to_numpy() for c in (*(f"_{c}" for c in inputs), "_day")}
        begins = np.flatnonzero(rows.column("_nth").to_numpy() == 1)
        new = {f"{c}_filled": fill_nearest(number[f"_{c}"], rows.column(f"_{c}").is_valid().to_numpy(), number["_day"], begins) for c in angles}
        new["mu0"], new["muz"] = illumination(*new.values(), number["_slope"], number["_aspect"])
        new |= tables.albedos(new["mu0"], new["muz"], number["_grain_size"], number["_dust"])
        rows = rows.select(names[: -len(new)])
        for c in names[-len(new) :]:
            x, missing = new[c], np.isnan(new[c])
            rows = rows.append_column(c, pa.array(x if c in doubles else np.where(missing, 0, x).astype(np.int32), mask=missing))
        yield from rows.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            begins = np.flatnonzero(batch.column("_nth").to_numpy() == 1)
            if len(begins) and (held or begins[-1]):  # all but the last series of the batch is whole
                yield from of(pa.Table.from_batches([*held, batch.slice(0, begins[-1])]))
                held, batch = [], batch.slice(begins[-1])
            held.append(batch)
        if held:
            yield from of(pa.Table.from_batches(held))

    kinds = [T.StructField(f.name, f.dataType) for f in px.schema.fields]
    kinds += [T.StructField(c, T.DoubleType()) for c in doubles] + [T.StructField(c, T.IntegerType()) for c in OUT]
    names = [f.name for f in kinds]
    return ready.mapInArrow(run, T.StructType(kinds))


def season_albedo_job(px: DataFrame, first: str, last: str, static: DataFrame, luts: dict[str, tuple], soot: float = 0.0, **how) -> DataFrame:
    """What albedo_job gives of the seasons of gap_fill_job (whose further arguments are `how`) under the sun of the observed rows, within its one shuffle.

    px needs solar_zenith and solar_azimuth, static slope and aspect. A series is a pixel's season.
    """
    tables = Tables(px.sparkSession, luts, soot)

    def run(a: dict[str, np.ndarray], days: np.ndarray) -> dict[str, np.ndarray]:
        shape = a["dust"].shape
        day, begins = np.tile(np.arange(shape[1], dtype=float), shape[0]), np.arange(shape[0]) * shape[1]
        filled = [fill_nearest(a[c].ravel(), ~np.isnan(a[c].ravel()), day, begins) for c in ("solar_zenith", "solar_azimuth")]
        mu0, muz = illumination(*filled, *(np.repeat(a[c][:, 0], shape[1]) for c in ("slope", "aspect")))
        return {c: x.reshape(shape) for c, x in tables.albedos(mu0, muz, a["grain_size"].ravel(), a["dust"].ravel()).items()}

    return gap_fill_job(px, first, last, static, further=Further(["solar_zenith", "solar_azimuth"], ["slope", "aspect"], run, OUT), **how)
