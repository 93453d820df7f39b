"""The registered queries, one or more for each operator, with their SQL where SQL can say it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nivalis import adapters as A
from nivalis.functions import bits, codec, flags, optics, wateryear
from nivalis.operators import grid, groups, joins, observation, series, spectra, stats
from nivalis.oracle import sql
from nivalis.plans import incremental, tree
from nivalis.sources import folders, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ID = ["tile", "row", "col", "obs_date"]
IDS = 'tile, "row", col, obs_date'
PIX = 'PARTITION BY tile, "row", col'
W = f"{PIX} ORDER BY obs_date"


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            SQL[f.__name__] = oracle
        return f

    return register


def _bands():
    return [F.col(f"b{k}") for k in range(1, 8)]


def _span(spark: SparkSession, sf_dir: str) -> tuple:
    """First and last day, and how many rows all pixels on all days are (three scalars, of the lines that the pixel-days are made of)."""
    low, high, pixels = A.table(spark, sf_dir, "lineitem").agg(F.min(F.col("l_shipdate").cast("date")), F.max(F.col("l_shipdate").cast("date")), F.approx_count_distinct("l_suppkey")).first()
    return low, high, pixels * ((high - low).days + 1) if low else 0


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pixels on all days of the whole range of dates."""
    low, high, rows = _span(spark, sf_dir)
    return series.densify(A.pixel_days(spark, sf_dir), F.lit(low), F.lit(high), rows=rows)


# --- sources and sinks -----------------------------------------------------


@query(sql("px", f"SELECT {IDS}, snow, grain FROM px WHERE obs_date BETWEEN DATE '1999-10-01' AND DATE '2000-09-30'"))
def o01_read_water_year(spark, d):
    return tables.read_water_year(A.pixel_days(spark, d), F.to_date(F.lit("1999-10-01")), F.to_date(F.lit("2000-09-30")), variables=["snow", "grain"])


@query(sql("px", "SELECT tile, year(obs_date) + (month(obs_date) >= 10)::INT AS water_year, max(obs_date) AS end_date FROM px GROUP BY ALL"))
def o01_last_day(spark, d):
    px = A.pixel_days(spark, d).withColumn("water_year", wateryear.water_year(F.col("obs_date")))
    return tables.last_day(px, ["tile", "water_year"])


@query("SELECT n_nationkey::INT AS id, n_name AS name, n_regionkey::INT AS region_id FROM nation")
def o02_read_config(spark, d):
    from pyspark.sql import types as T

    own = A.table(spark, d, "nation").selectExpr("CAST(n_nationkey AS STRING) AS id", "n_name AS name", "CAST(n_regionkey AS STRING) AS region_id")
    note = own.limit(1).selectExpr("'unique id' AS id", "'a name, with a comma' AS name", "'id of the region' AS region_id")
    path = folders.new_folder(spark, "config")
    note.unionByName(own).coalesce(1).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("region_id", T.IntegerType())])
    return tables.read_config(spark, path, schema)


@query(sql("files", "SELECT file_name, 'MOD09GA' AS product, obs_date, tile, '061' AS version, event_id::VARCHAR AS stamp, len(event_id::VARCHAR) < 13 AS is_nrt FROM files"))
def o03_parse_file_metadata(spark, d):
    return tables.parse_file_metadata(A.files(spark, d)).select("file_name", "product", "obs_date", "tile", "version", "stamp", "is_nrt")


@query(sql("latest", "SELECT tile, obs_date, file_name, edit_ts FROM latest"))
def o04_latest_file(spark, d):
    return tables.latest_file(tables.parse_file_metadata(A.files(spark, d))).select("tile", "obs_date", "file_name", "edit_ts")


_DAYS = """SELECT t.tile, c.d AS obs_date, count(f.file_name) AS files FROM (SELECT DISTINCT tile FROM files) t
CROSS JOIN (SELECT unnest(range((SELECT min(obs_date) FROM files)::TIMESTAMP, (SELECT max(obs_date) + 1 FROM files)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d) c
LEFT JOIN files f ON f.tile = t.tile AND f.obs_date = c.d GROUP BY ALL"""


def _inventory(spark, d):
    files = tables.parse_file_metadata(A.files(spark, d))
    low, high = files.agg(F.min("obs_date"), F.max("obs_date")).first()
    return files, tables.inventory_days(files, F.lit(low), F.lit(high))


@query(sql("files", _DAYS))
def o05_inventory_days(spark, d):
    return _inventory(spark, d)[1]


@query(sql("files", "SELECT tile, date_trunc('month', obs_date)::DATE AS month, count(*) FILTER (WHERE files > 0) AS present, count(*) AS expected FROM days GROUP BY ALL", days=_DAYS))
def o05_inventory_months(spark, d):
    return tables.inventory_months(_inventory(spark, d)[1])


def _plan(mode: int):
    def run(spark, d):
        files, days = _inventory(spark, d)
        done = tables.latest_file(files.where("event_id % 2 = 0"))
        s = lambda k: F.expr(f"CAST(event_id % {k} <> 0 AS INT)")
        status = done.select(
            "tile", "obs_date", F.col("file_name").alias("input_file_name"), F.col("edit_ts").alias("input_edit_ts"),
            F.when(F.expr("event_id % 14 = 0"), F.col("file_name")).alias("discarded_file_name"), F.when(F.expr("event_id % 14 = 0"), F.col("edit_ts")).alias("discarded_edit_ts"),
            F.lit(1).alias("status_of_ingest"), s(3).alias("status_of_weight"), s(4).alias("status_of_inversion"), s(5).alias("status_of_corrected_snow"), s(7).alias("status_of_spatial"),
        )
        return incremental.incremental_plan(days.select("tile", "obs_date"), tables.latest_file(files), status, mode)

    return run


_STATUS = """SELECT tile, obs_date, file_name AS input_file_name, edit_ts AS input_edit_ts,
  CASE WHEN event_id % 14 = 0 THEN file_name END AS bad_name, CASE WHEN event_id % 14 = 0 THEN edit_ts END AS bad_ts,
  true AS s_ingest, event_id % 3 <> 0 AS s_weight, event_id % 4 <> 0 AS s_inversion, event_id % 5 <> 0 AS s_corrected_snow, event_id % 7 <> 0 AS s_spatial
FROM (SELECT *, row_number() OVER (PARTITION BY tile, obs_date ORDER BY edit_ts DESC, file_name DESC) AS rn FROM files WHERE event_id % 2 = 0) WHERE rn = 1"""


def _plan_sql(mode: int) -> str:
    again = {0: (), 1: ("weight", "inversion", "corrected_snow", "spatial"), 11: ("weight",), 19: ("ingest", "weight"), 20: ("corrected_snow",), 80: ("spatial",), 99: incremental.STEPS}[mode]
    lack = mode in (0, 1, 99)
    step = lambda s: (
        f"CASE WHEN none THEN false WHEN fresh THEN {str(mode != 19 or s in again).lower()} ELSE (ok OR known) AND ({str(s in again).lower()}"
        + (f" OR NOT s_{s}" if lack and s != "ingest" else "") + ") END"
    )
    flags_ = ", ".join(f"coalesce({step(s)}, false) AS do_{s}" for s in incremental.STEPS)
    base = f"""SELECT *, ok AND (NOT (file_name IS NOT DISTINCT FROM input_file_name AND edit_ts IS NOT DISTINCT FROM input_edit_ts) OR {str(mode == 99).lower()}) AS fresh,
      NOT ok AND NOT known AND (NOT (s_ingest AND s_weight AND s_inversion AND s_corrected_snow AND s_spatial) OR {str(mode == 99).lower()}) AS none
    FROM (SELECT days.tile, days.obs_date, l.file_name, l.edit_ts, s.input_file_name, s.input_edit_ts, s.input_file_name IS NOT NULL AS known,
            l.file_name IS NOT NULL AND NOT (l.file_name IS NOT DISTINCT FROM s.bad_name AND l.edit_ts IS NOT DISTINCT FROM s.bad_ts) AS ok,
            {", ".join(f"coalesce(s_{s}, false) AS s_{s}" for s in incremental.STEPS)}
          FROM days LEFT JOIN latest l USING (tile, obs_date) LEFT JOIN done s USING (tile, obs_date))"""
    body = f"""SELECT tile, obs_date, file_name, CASE WHEN none THEN 'set_nodata' WHEN do_ingest THEN 'ingest'
      WHEN do_weight OR do_inversion OR do_corrected_snow OR do_spatial THEN 'recompute' ELSE 'skip' END AS action, {", ".join(f"do_{s}" for s in incremental.STEPS)}
    FROM (SELECT *, {flags_} FROM base)"""
    return sql("latest", body, days=_DAYS, done=_STATUS, base=base)


for _mode in (0, 1, 11, 19, 20, 80, 99):
    QUERIES[f"o06_incremental_plan_{_mode}"] = _plan(_mode)
    SQL[f"o06_incremental_plan_{_mode}"] = _plan_sql(_mode)


@query(sql("px", """SELECT DISTINCT tile, "row", col, last_day(obs_date) AS obs_date,
  year(last_day(obs_date)) + (month(last_day(obs_date)) >= 10)::INT AS water_year FROM px"""))
def o07_write_daily(spark, d):
    """Writes all pixel-days by their days; the SQL asks for the months they are in."""
    return _daily(spark, d).select("tile", "row", "col", F.last_day("obs_date").alias("obs_date"), "water_year").distinct()


def _daily(spark, d):
    path = folders.new_folder(spark, "daily")
    px = A.pixel_days(spark, d).select(*ID, "snow", "grain", "dust")
    tables.write_daily(px, path)
    return spark.read.schema(px.withColumn("water_year", F.lit(0)).schema).parquet(path)


@query(sql("px", f"SELECT {IDS}, snow, grain, dust, year(obs_date) + (month(obs_date) >= 10)::INT AS water_year FROM px"))
def o07_read_daily(spark, d):
    """The same tables as o07_write_daily, with all days and values."""
    return _daily(spark, d).select(*ID, "snow", "grain", "dust", "water_year")


# The year of the web series: the last one of the data.
_NOW = 2001
_PAST = f"SELECT * FROM daily WHERE water_year <> {_NOW}"
_HAZEN = "CASE WHEN len({x}) > 0 THEN {x}[floor({p})::INT] + ({p} - floor({p})) * ({x}[least(floor({p})::INT + 1, len({x}))] - {x}[floor({p})::INT]) END"


def _hazen(x: str, percent: float) -> str:
    return _HAZEN.format(x=x, p=f"greatest(1.0::DOUBLE, least(len({x})::DOUBLE, len({x}) * {percent} / 100.0 + 0.5))")


_YEARLY = {"mean": "avg(stat_value)", "sum": "sum(stat_value)", "median": "quantile_cont(stat_value, 0.5)"}


def _years(kind: str, source: str, keys: str = "subdivision_id, var_id") -> str:
    return f"""SELECT {keys}, arg_max(water_year, (v, -water_year)) AS max_year, arg_min(water_year, (v, water_year)) AS min_year
    FROM (SELECT {keys}, water_year, {_YEARLY[kind]} AS v FROM {source} GROUP BY ALL) GROUP BY {keys}"""


_QUANTILES = f"""SELECT subdivision_id, var_id, day, {_hazen("x", 50)} AS median, {_hazen("x", 25)} AS prc25, {_hazen("x", 75)} AS prc75
FROM (SELECT subdivision_id, var_id, day, list(stat_value ORDER BY stat_value) AS x FROM past GROUP BY ALL)"""
_WEB = f"""SELECT d.subdivision_id, d.var_id, d.day, max(stat_value) FILTER (WHERE water_year = min_year) AS min_year_value,
  max(stat_value) FILTER (WHERE water_year = max_year) AS max_year_value, max(stat_value) FILTER (WHERE water_year = {_NOW}) AS year_to_date,
  any_value(q.median) AS median, any_value(q.prc25) AS prc25, any_value(q.prc75) AS prc75
FROM daily d LEFT JOIN years y USING (subdivision_id, var_id) LEFT JOIN q USING (subdivision_id, var_id, day) GROUP BY ALL"""
_ROUND = ["min_year_value", "max_year_value", "year_to_date", "median", "prc25", "prc75"]
_WEB_SQL = sql("daily", "SELECT subdivision_id, var_id, day, " + ", ".join(f"round({c}, 4) AS {c}" for c in _ROUND) + f" FROM ({_WEB})", past=_PAST, years=_years("mean", "past"), q=_QUANTILES)


def _web(spark, d):
    w = stats.web_series(A.daily_stat(spark, d), _NOW)
    return w.select("subdivision_id", "var_id", "day", *[F.round(c, 4).alias(c) for c in _ROUND])


@query(_WEB_SQL)
def o08_write_stat_csv(spark, d):
    path = folders.new_folder(spark, "web")
    tables.write_stat_csv(_web(spark, d), path)
    back = spark.read.option("header", True).schema("day int, min_year_value double, max_year_value double, prc25 double, median double, prc75 double, year_to_date double, subdivision_id int, var_id int").csv(path)
    return back.select("subdivision_id", "var_id", "day", *_ROUND)


@query(_WEB_SQL)
def o08_stat_json(spark, d):
    docs = tables.stat_json(_web(spark, d))
    kind = "subdivision_id int, var_id int, " + ", ".join(f"{c} array<{'int' if c == 'day' else 'double'}>" for c in tables.WEB_COLUMNS)
    back = docs.select(F.from_json("json", kind).alias("j"))
    zipped = F.arrays_zip(*[F.col(f"j.{c}").alias(c) for c in tables.WEB_COLUMNS])
    return back.select("j.subdivision_id", "j.var_id", F.explode(zipped).alias("z")).select("subdivision_id", "var_id", "z.day", *[F.col(f"z.{c}").alias(c) for c in _ROUND])


@query(sql("px", f"""SELECT tile, "row", col, datediff('day', DATE '1970-01-01', obs_date) AS time, ((col + 0.5) * 463.0 + 1000)::DOUBLE AS x, (2000 - ("row" + 0.5) * 463.0)::DOUBLE AS y,
  coalesce(CASE WHEN snow BETWEEN 0 AND 80 THEN snow END, 255) AS viewable_snow_fraction, coalesce(CASE WHEN dust BETWEEN 0 AND 950 THEN dust * 10 END, 65535) AS dust_concentration FROM px"""))
def o09_to_output_product(spark, d):
    variables = [
        {"name": "snow", "output_name": "viewable_snow_fraction", "divisor": 1, "min": 0, "max": 80, "nodata": 255},
        {"name": "dust", "output_name": "dust_concentration", "divisor": 10, "min": 0, "max": 950, "nodata": 65535},
    ]
    return tables.to_output_product(A.pixel_days(spark, d), variables, 463.0, 1000.0, 2000.0)


# --- scalars, bit fields, flags -----------------------------------------------


@query(sql("px", f"SELECT {IDS}, coalesce(least(255, round(snow * 2.5)), 255)::INT AS stored, CASE WHEN coalesce(least(255, round(snow * 2.5)), 255) <> 255 THEN round(round(snow * 2.5) / 2.5, 6) END AS value FROM px"))
def o10_encode_decode(spark, d):
    px = A.pixel_days(spark, d).withColumn("stored", codec.encode(F.col("snow"), 2.5, 255))
    return px.select(*ID, "stored", F.round(codec.decode(F.col("stored"), 2.5, 255), 6).alias("value"))


@query(sql("px", f"""SELECT {IDS}, CASE WHEN snow IS NOT NULL THEN greatest(20, least(70, snow)) END AS clamped, CASE WHEN snow BETWEEN 20 AND 70 THEN snow END AS ranged,
  CASE WHEN snow IS NULL THEN 1 WHEN snow < 20 THEN 2 WHEN snow > 70 THEN 4 ELSE 0 END AS mask FROM px"""))
def o11_cut_min_max(spark, d):
    clamped, mask = codec.cut_min_max(F.col("snow"), 20, 70, 1)
    ranged, _ = codec.cut_min_max(F.col("snow"), 20, 70, 2)
    return A.pixel_days(spark, d).select(*ID, clamped.alias("clamped"), ranged.alias("ranged"), mask.alias("mask"))


_STATE = "state_1km & 3 AS cloud, (state_1km >> 2) & 1 AS cloudshadow, (state_1km >> 3) & 7 AS landwater, (state_1km >> 6) & 3 AS aerosol, (state_1km >> 8) & 3 AS cirrus, (state_1km >> 14) & 1 AS saltpan"


@query(sql("px", f"SELECT {IDS}, {_STATE} FROM px"))
def o12_unpack_bits(spark, d):
    return A.pixel_days(spark, d).select(*ID, *bits.unpack_bits(F.col("state_1km")))


@query(sql("px", f"""SELECT {IDS}, (qc & 3)::INT AS modland, ((qc >> 30) & 1)::INT AS atmos_corr, ((qc >> 31) & 1)::INT AS adj_corr
  FROM (SELECT *, state_1km::BIGINT * 131071 % 4294967296 AS qc FROM px)"""))
def o12_unpack_qc(spark, d):
    qc = bits.squeeze_qc(F.expr("CAST(state_1km AS BIGINT) * 131071 % 4294967296"))
    return A.pixel_days(spark, d).select(*ID, *bits.unpack_bits(qc, bits.QC_500M))


@query(sql("px", f"""SELECT {IDS}, state_1km & {0b100111111111111} AS state,
  ((qc & 3) | (((qc >> 30) & 1) << 2) | (((qc >> 31) & 1) << 3))::INT AS qc,
  ((b1 >> 2) & 3) | (((b2 >> 3) & 1) << 2) | ((b2 & 7) << 3) | (((b3 >> 2) & 7) << 6) AS qf
  FROM (SELECT *, state_1km::BIGINT * 131071 % 4294967296 AS qc FROM px)"""))
def o13_squeeze_flags(spark, d):
    qc = F.expr("CAST(state_1km AS BIGINT) * 131071 % 4294967296")
    return A.pixel_days(spark, d).select(
        *ID, bits.squeeze_state(F.col("state_1km")).alias("state"), bits.squeeze_qc(qc).alias("qc"), bits.squeeze_viirs(F.col("b1"), F.col("b2"), F.col("b3")).alias("qf")
    )


@query(sql("px", f"SELECT {IDS}, CASE WHEN snow > 10 THEN nodata_filter | 8 ELSE nodata_filter & ~8 END AS field, (zero_filter >> 4) & 1 = 1 AS low FROM px"))
def o14_set_get_bit(spark, d):
    return A.pixel_days(spark, d).select(*ID, bits.set_bit(F.col("nodata_filter"), 4, F.col("snow") > 10).alias("field"), bits.get_bit(F.col("zero_filter"), 5).alias("low"))


def _masks(low: int, high: int) -> str:
    return " | ".join(f"(CASE WHEN b{k} < {low} THEN 2 WHEN b{k} > {high} THEN 4 ELSE 0 END << {3 * (k - 1)})" for k in range(1, 8))


@query(sql("px", f"SELECT {IDS}, m AS sensor_mask, m <> 0 AS no_input FROM (SELECT *, {_masks(5, 90)} AS m FROM px)"))
def o15_pack_sensor_mask(spark, d):
    m = bits.pack_masks([codec.cut_min_max(b, 5, 90)[1] for b in _bands()])
    return A.pixel_days(spark, d).select(*ID, m.alias("sensor_mask"), (m != 0).alias("no_input"))


_ND = "round(({a} - {b}) / nullif(({a} + {b})::DOUBLE, 0), 6)"


@query(sql("px", f"""SELECT {IDS}, {_ND.format(a="b3", b="b6")} AS ndsi, {_ND.format(a="b2", b="b1")} AS ndvi,
  round(sqrt({" + ".join(f"b{k}::DOUBLE * b{k}" for k in range(1, 8))}) / sqrt(7.0::DOUBLE), 6) AS norm, b6 < 20 AS swir_low FROM px"""))
def o16_spectral_indices(spark, d):
    found = optics.spectral_indices(_bands())
    return A.pixel_days(spark, d).select(*ID, *[(F.round(c, 6) if k != "swir_low" else c).alias(k) for k, c in found.items()])


@query(sql("px", f"""SELECT {IDS}, CASE WHEN class = 1 AND nf = 0 AND zf = 0 THEN nf | 2 ELSE nf & ~2 END AS nodata,
  CASE WHEN (class = 2 AND (state_1km & 3) NOT IN (1, 2)) OR (state_1km >> 14) & 1 = 1 THEN zf | 1 ELSE zf & ~1 END AS zero
  FROM (SELECT *, CASE WHEN snow IS NULL THEN 1 ELSE 0 END AS nf, CASE WHEN b3 < 20 THEN 2 ELSE 0 END AS zf FROM px)"""))
def o17_combine_classification(spark, d):
    state = {c: x for c, x in zip((n for n, *_ in bits.STATE_1KM), bits.unpack_bits(F.col("state_1km")))}
    nodata, zero = flags.combine_classification(
        F.col("class"), state["cloud"], state["saltpan"], F.when(F.col("snow").isNull(), 1).otherwise(0), F.when(F.col("b3") < 20, 2).otherwise(0)
    )
    return A.pixel_days(spark, d).select(*ID, nodata.alias("nodata"), zero.alias("zero"))


@query(sql("px", f"""SELECT {IDS}, CASE WHEN w = 0 THEN 1 ELSE w END AS weight FROM (SELECT *, least(weight, [100, 50, 50, 100][cloud + 1], [100, 80][cloudshadow + 1],
  [80, 100, 80, 80, 80, 0, 0, 0][landwater + 1], [100, 100, 50, 25][aerosol + 1], [100, 100, 50, 25][cirrus + 1]) AS w FROM (SELECT *, {_STATE} FROM px))"""))
def o18_observation_weight(spark, d):
    names = [n for n, *_ in bits.STATE_1KM]
    looked = {n: c for n, c in zip(names, bits.unpack_bits(F.col("state_1km"))) if n != "saltpan"}
    return A.pixel_days(spark, d).select(*ID, flags.observation_weight(looked, [F.col("weight")]).alias("weight"))


_FAR = "(6371.007181::DOUBLE + 705.0) / 6371.007181::DOUBLE"


@query(sql("px", f"""SELECT {IDS}, round((cos(th) * (6371.007181::DOUBLE + 705.0) - sqrt(1 - pow({_FAR} * sin(th), 2)) * 6371.007181::DOUBLE) / 705.0, 4) AS along,
  round((asin(sin(th + be) * {_FAR}) - asin(sin(th - be) * {_FAR}) - be * 2) * 6371.007181::DOUBLE, 4) AS across
  FROM (SELECT *, asin(sin(radians(sensor_zenith)) / ({_FAR})) AS th, atan(1.0 / 1410.0) AS be FROM px)"""))
def o19_pixel_size(spark, d):
    along, across = optics.pixel_size(F.col("sensor_zenith"))
    return A.pixel_days(spark, d).select(*ID, F.round(along, 4).alias("along"), F.round(across, 4).alias("across"))


@query(sql("px static", f"""SELECT {IDS}, round((1 - pow(1 - canopy_cover / 100.0::DOUBLE, 1 / cos(atan(tan(radians(sensor_zenith)) * 2.7)))) * 100)::INT AS canopy
  FROM px JOIN static USING (tile, "row", col)"""))
def o20_canopy_correction(spark, d):
    px = joins.with_static(A.pixel_days(spark, d), A.static(spark, d))
    return px.select(*ID, optics.canopy_correction(F.col("canopy_cover"), F.col("sensor_zenith")).alias("canopy"))


@query(sql("px static", f"""SELECT {IDS}, CASE WHEN snow IS NOT NULL THEN greatest(least(100, round(snow * 100 / (100 - least(b4 + canopy_cover + ice_fraction, 99))::DOUBLE)), ice_fraction)::INT END AS snow_fraction
  FROM px JOIN static USING (tile, "row", col)"""))
def o21_corrected_snow_fraction(spark, d):
    px = joins.with_static(A.pixel_days(spark, d), A.static(spark, d))
    return px.select(*ID, optics.corrected_snow_fraction(F.col("snow"), F.col("b4"), F.col("canopy_cover"), F.col("ice_fraction")).alias("snow_fraction"))


@query(sql("px", f"SELECT {IDS}, b1 > 35 AND b2 > 35 AND b3 > 31 AND b4 > 31 AND b5 > 30 AND b6 > 22 AS bright FROM px"))
def o22_bright_cloud_flag(spark, d):
    return A.pixel_days(spark, d).select(*ID, flags.bright_cloud(_bands()[:6]).alias("bright"))


@query(sql("px static", f"""SELECT {IDS}, (CASE WHEN (b3 - b6) / nullif((b3 + b6)::DOUBLE, 0) < -0.5 THEN 2 ELSE 0 END) | (CASE WHEN snow > 0 AND snow <= 10 THEN 4 ELSE 0 END)
  | (CASE WHEN snow > 0 AND grain < 40 THEN 8 ELSE 0 END) | (CASE WHEN elevation < 500 THEN 16 ELSE 0 END) | (CASE WHEN is_water THEN 32 ELSE 0 END)
  | (CASE WHEN snow = 0 THEN 64 ELSE 0 END) AS zero FROM px JOIN static USING (tile, "row", col)"""))
def o23_zero_flags(spark, d):
    px = joins.with_static(A.pixel_days(spark, d), A.static(spark, d))
    found = flags.zero_flags(optics.normalised_difference(F.col("b3"), F.col("b6")), F.col("elevation"), F.col("is_water"), F.col("snow"), F.col("grain"))
    return px.select(*ID, bits.flags_of(found).alias("zero"))


@query(sql("px", f"""SELECT {IDS}, (CASE WHEN snow < 30 THEN 1 ELSE 0 END) | (CASE WHEN grain < 40 THEN 2 ELSE 0 END) | (CASE WHEN grain > 1190 THEN 4 ELSE 0 END)
  | (CASE WHEN snow < 90 THEN 8 ELSE 0 END) | (CASE WHEN dust < 0 THEN 16 ELSE 0 END) | (CASE WHEN dust > 950 THEN 32 ELSE 0 END) AS flags FROM px"""))
def o24_grain_dust_flags(spark, d):
    return A.pixel_days(spark, d).select(*ID, flags.grain_dust_flags(F.col("snow"), F.col("grain"), F.col("dust")).alias("flags"))


def _zbits(z: str) -> str:
    return ", ".join(f"({z} >> {k - 1}) & 1 = 1 AS z{k}" for k in range(1, 8))


@query(sql("px", f"""SELECT {IDS}, m0 AS missing_0, (z1 OR z2 OR z3 OR z4 OR z5 OR z7) AND NOT m0 AS free_0, m1 AS missing_1, (z1 OR z2 OR z5 OR z6 OR z7) AND NOT m1 AS free_1,
    mv AS missing_viirs, (z2 OR z5 OR z6 OR z7) AND NOT mv AS free_viirs
  FROM (SELECT *, ((nodata_filter & 119) <> 0 OR z6) AND NOT z5 AS m0,
    ((nodata_filter & 119) <> 0 OR ((z3 OR z4) AND NOT z1 AND NOT z2 AND NOT z7)) AND NOT z5 AND NOT z6 AS m1,
    ((nodata_filter & 117) <> 0 OR ((z3 OR z4) AND NOT z2 AND NOT z7)) AND NOT z5 AND NOT z6 AS mv
  FROM (SELECT *, {_zbits("zero_filter")} FROM px))"""))
def o25_nodata_or_zero(spark, d):
    out = []
    for name, kw in (("0", {"version": 0}), ("1", {}), ("viirs", {"viirs": True})):
        missing, free = flags.nodata_or_zero(F.col("nodata_filter"), F.col("zero_filter"), **kw)
        out += [missing.alias(f"missing_{name}"), free.alias(f"free_{name}")]
    return A.pixel_days(spark, d).select(*ID, *out)


@query(sql("px", f"""SELECT {IDS}, n = 0 AND NOT z1 AND NOT z2 AND NOT z6 AS modis, (n & 53) = 0 AND NOT z2 AND NOT z6 AS viirs
  FROM (SELECT *, nodata_filter % 8 AS n, {_zbits("zero_filter")} FROM px)"""))
def o26_inversion_candidates(spark, d):
    n = F.col("nodata_filter") % 8
    return A.pixel_days(spark, d).select(*ID, flags.inversion_candidates(n, F.col("zero_filter")).alias("modis"), flags.inversion_candidates(n, F.col("zero_filter"), True).alias("viirs"))


@query(sql("px", f"""SELECT {IDS}, snow, CASE WHEN snow < 30 THEN NULL ELSE grain END AS grain, CASE WHEN (CASE WHEN snow < 30 THEN NULL ELSE grain END) < 100 THEN 0 ELSE dust END AS dust
  FROM (SELECT * REPLACE (CASE WHEN snow < 15 THEN 0 ELSE snow END AS snow) FROM px)"""))
def o27_apply_thresholds(spark, d):
    rules = [
        {"thresholded": "snow", "replaced": "snow", "least": 15, "value": 0},
        {"thresholded": "snow", "replaced": "grain", "least": 30, "value": None},
        {"thresholded": "grain", "replaced": "dust", "least": 100, "value": 0},
        {"thresholded": "absent", "replaced": "dust", "least": 1, "value": 0},
    ]
    return observation.apply_thresholds(A.pixel_days(spark, d), rules).select(*ID, "snow", "grain", "dust")


@query(sql("px static", f"""SELECT {IDS}, CASE WHEN wrong THEN 50 ELSE st END AS status, CASE WHEN wrong THEN 0 ELSE snow END AS snow, CASE WHEN NOT wrong THEN grain END AS grain
  FROM (SELECT *, st = 1 AND is_water AND month(obs_date) BETWEEN 6 AND 9 AS wrong FROM (SELECT *, CASE WHEN snow IS NULL THEN 61 WHEN snow < 10 AND snow <> 0 THEN 30 WHEN solar_zenith > 60 THEN 20 ELSE 1 END AS st
  FROM px JOIN static USING (tile, "row", col)))"""))
def o28_observation_status(spark, d):
    px = joins.with_static(A.pixel_days(spark, d), A.static(spark, d)).withColumns({"is_observed": F.col("snow").isNotNull(), "is_false_positive": F.col("is_water")})
    return observation.observation_status(px, "snow", most_zenith=60, others=("grain",)).select(*ID, "status", "snow", "grain")


@query(sql("px", f"""SELECT {IDS}, solar_zenith = 0 AND low = 0 AND (next IS NULL OR next >= 2) AS is_anomalous FROM px JOIN
  (SELECT tile, date_trunc('month', obs_date) AS m, min(solar_zenith) AS low, min(solar_zenith) FILTER (WHERE solar_zenith <> 0) AS next FROM px GROUP BY ALL) s
  ON s.tile = px.tile AND s.m = date_trunc('month', px.obs_date)""".replace(IDS, 'px.tile, px."row", px.col, px.obs_date')))
def o29_zero_zenith_anomaly(spark, d):
    return observation.zero_zenith_anomaly(A.pixel_days(spark, d), 2).select(*ID, "is_anomalous")


@query(sql("px", f"""SELECT {IDS}, CASE WHEN solar_zenith = 0 AND low = 0 AND (next IS NULL OR next >= 2) AND status IN (0, 1, 255) THEN 21 ELSE status END AS status
FROM (SELECT px.*, low, next, CASE class WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 255 END AS status FROM px JOIN
  (SELECT tile, date_trunc('month', obs_date) AS m, min(solar_zenith) AS low, min(solar_zenith) FILTER (WHERE solar_zenith <> 0) AS next FROM px GROUP BY ALL) s
  ON s.tile = px.tile AND s.m = date_trunc('month', px.obs_date))"""))
def o29_unknown_zenith_status(spark, d):
    px = A.pixel_days(spark, d).withColumn("status", F.expr("CASE class WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 255 END"))
    return observation.zero_zenith_anomaly(px, 2, "status").select(*ID, "status")


@query("""SELECT o_orderkey, year(d) + (month(d) >= 10)::INT AS wy_north, year(d) + (month(d) >= 4)::INT AS wy_south, datediff('day', s, d) + 1 AS day, datediff('day', s, s + INTERVAL 1 YEAR) AS days,
  s AS first_date, (s + INTERVAL 1 YEAR)::DATE - 1 AS last_date, CASE WHEN d > DATE '2001-06-01' - INTERVAL 2 MONTH THEN 'nrt' ELSE 'hist' END AS mode
FROM (SELECT *, make_date(year(d) - (month(d) < 10)::INT, 10, 1) AS s FROM (SELECT *, o_orderdate::DATE AS d FROM orders))""")
def o30_water_year(spark, d):
    day = F.col("o_orderdate").cast("date")
    return A.table(spark, d, "orders").select(
        "o_orderkey", wateryear.water_year(day).alias("wy_north"), wateryear.water_year(day, 4).alias("wy_south"), wateryear.day_of_water_year(day).alias("day"),
        wateryear.days_in_water_year(day).alias("days"), wateryear.water_year_start(day).alias("first_date"), wateryear.water_year_end(day).alias("last_date"),
        wateryear.processing_mode(day, F.to_date(F.lit("2001-06-01"))).alias("mode"),
    )


@query("""SELECT o_orderkey, unnest(range(date_trunc('month', make_date(year(d) - (month(d) < 10)::INT, 10, 1))::TIMESTAMP, date_trunc('month', d)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 MONTH))::DATE AS month
FROM (SELECT *, o_orderdate::DATE AS d FROM orders)""")
def o31_month_firsts(spark, d):
    day = F.col("o_orderdate").cast("date")
    return A.table(spark, d, "orders").select("o_orderkey", F.explode(wateryear.month_firsts(wateryear.water_year_start(day), day)).alias("month"))


@query(sql("px", "SELECT tile, obs_date, count(*) AS pixels FROM px WHERE obs_date BETWEEN DATE '2000-10-01' AND DATE '2001-03-15' GROUP BY ALL"))
def o31_date_window(spark, d):
    import datetime as dt

    first, last = wateryear.date_window(dt.date(2001, 3, 20), 12, 10, today=dt.date(2001, 3, 16))
    return tables.read_water_year(A.pixel_days(spark, d), F.lit(first), F.lit(last)).groupBy("tile", "obs_date").agg(F.count("*").alias("pixels"))


@query(sql("px static", f"""SELECT {IDS}, round(greatest(0, least(1, mu0 * cos(radians(slope)) + sqrt(1 - mu0 * mu0) * sin(radians(slope)) * cos(radians(phi - aspect)))), 4) AS mu
  FROM (SELECT *, cos(radians(solar_zenith)) AS mu0, CASE WHEN 180 - b1 * 4 > 180 THEN 180 - b1 * 4 - 360 WHEN 180 - b1 * 4 < -180 THEN 180 - b1 * 4 + 360 ELSE 180 - b1 * 4 END AS phi
  FROM px JOIN static USING (tile, "row", col))"""))
def o32_sun_on_slope(spark, d):
    px = joins.with_static(A.pixel_days(spark, d), A.static(spark, d))
    return px.select(*ID, F.round(optics.sun_on_slope(F.cos(F.radians("solar_zenith")), F.col("b1") * 4, F.col("slope"), F.col("aspect")), 4).alias("mu"))


@query(sql("px", f"SELECT {IDS}, CASE WHEN round(b1 - dust / 10.0 * 0.63) BETWEEN 0 AND 100 THEN round(b1 - dust / 10.0 * 0.63)::INT END AS albedo FROM px"))
def o33_observed_albedo(spark, d):
    return A.pixel_days(spark, d).select(*ID, optics.observed_albedo(F.col("b1"), F.col("dust") / 10.0).alias("albedo"))


@query(sql("px", f"SELECT {IDS}, least(b6, 80) AS red, least(b1, 80) AS green, least(b3, 80) AS blue, CASE WHEN snow IS NULL THEN 255 ELSE round((greatest(10, least(90, snow)) - 10) / 80.0 * 254)::INT END AS shade FROM px"))
def o34_colours(spark, d):
    return A.pixel_days(spark, d).select(*ID, *codec.rgb_composite(F.col("b6"), F.col("b1"), F.col("b3"), 80), codec.scale_to_colormap(F.col("snow"), 10, 90).alias("shade"))


@query(sql("px", f"""SELECT tile, (floor({_hazen("x", 5)} / 50) * 50)::BIGINT AS low, (ceil({_hazen("x", 95)} / 50) * 50)::BIGINT AS high FROM (SELECT tile, list(grain ORDER BY grain) AS x FROM px GROUP BY tile)"""))
def o34_display_range(spark, d):
    px = A.pixel_days(spark, d)
    x = px.select("tile").distinct().join(stats.histogram_percentiles(stats.histogram(px, ["tile"], "grain"), ["tile"], {"p5": 5, "p95": 95}), "tile", "left")
    low, high = codec.round_out(F.col("p5"), F.col("p95"), True)
    return x.select("tile", low.alias("low"), high.alias("high"))


# --- joins ---------------------------------------------------------------------


@query(sql("px static", f"SELECT {IDS}, snow, elevation, slope, aspect, canopy_cover, ice_fraction, is_water FROM px JOIN static USING (tile, \"row\", col)"))
def o35_with_static(spark, d):
    return joins.with_static(A.pixel_days(spark, d).select(*ID, "snow"), A.static(spark, d))


_COARSE = 'SELECT tile, obs_date, "row" // 2 AS r, col // 2 AS c, avg(grain) AS coarse FROM grid GROUP BY ALL'


@query(sql("grid", f"""SELECT tile, "row", col, g.obs_date, round(coarse, 6) AS coarse FROM grid g JOIN k USING (tile, obs_date) WHERE k.r = g."row" // 2 AND k.c = g.col // 2""", k=_COARSE))
def o36_resample_nearest(spark, d):
    g = A.grid_days(spark, d)
    coarse = joins.coarsen(g, "grain").withColumnRenamed("grain", "coarse")
    return joins.resample_join(g.select(*ID), coarse, "coarse").select(*ID, F.round("coarse", 6).alias("coarse"))


@query(sql("grid", """SELECT f.tile, f."row", f.col, f.obs_date, round(sum(w * coarse) / nullif(sum(CASE WHEN coarse IS NOT NULL THEN w END), 0), 6) AS coarse
FROM (SELECT *, (1 - abs(pr - r)) * (1 - abs(pc - c)) AS w FROM (SELECT *, floor(pr)::INT + i AS r, floor(pc)::INT + j AS c FROM
  (SELECT tile, "row", col, obs_date, ("row" + 0.5::DOUBLE) / 2 - 0.5 AS pr, (col + 0.5::DOUBLE) / 2 - 0.5 AS pc FROM grid), (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j))) f
LEFT JOIN k ON k.tile = f.tile AND k.obs_date = f.obs_date AND k.r = f.r AND k.c = f.c GROUP BY ALL""", k=_COARSE))
def o36_resample_bilinear(spark, d):
    g = A.grid_days(spark, d)
    coarse = joins.coarsen(g, "grain").withColumnRenamed("grain", "coarse")
    return joins.resample_join(g.select(*ID), coarse, "coarse", method="bilinear").select(*ID, F.round("coarse", 6).alias("coarse"))


@query("""SELECT DISTINCT 'v' || (s_suppkey % 3) AS label, n_nationkey::INT AS variable_id, n_name AS name, n_regionkey::INT AS divisor
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 1""")
def o37_variable_config(spark, d):
    variables = A.table(spark, d, "nation").selectExpr("CAST(n_nationkey AS INT) AS variable_id", "n_name AS name", "CAST(n_regionkey AS INT) AS divisor")
    versions = A.table(spark, d, "supplier").selectExpr("CONCAT('v', CAST(s_suppkey % 3 AS STRING)) AS label", "CAST(s_nationkey AS INT) AS variable_id")
    return joins.variable_config(variables, versions, "v1").select("label", "variable_id", "name", "divisor")


@query(sql("px links", "SELECT DISTINCT tile, region, is_active FROM px JOIN links USING (tile)"))
def o38_region_tiles(spark, d):
    return joins.region_tiles(A.pixel_days(spark, d), A.links(spark, d)).select("tile", "region", "is_active")


@query(sql("px", """SELECT DISTINCT tile, 'v1' AS output_version, input_version FROM px JOIN
(SELECT 'h08v0' || (4 + s_suppkey % 2) AS tile, 'in' || max(s_suppkey) AS input_version FROM supplier WHERE s_suppkey % 3 = 1 GROUP BY 1) USING (tile)"""))
def o38_version_for_tile(spark, d):
    versions = A.table(spark, d, "supplier").selectExpr(
        "CONCAT('h08v0', CAST(4 + s_suppkey % 2 AS STRING)) AS tile", "CONCAT('v', CAST(s_suppkey % 3 AS STRING)) AS output_version", "'daily' AS data_label", "s_suppkey"
    ).groupBy("tile", "output_version", "data_label").agg(F.concat(F.lit("in"), F.max("s_suppkey")).alias("input_version"))
    return joins.version_for_tile(A.pixel_days(spark, d), versions, "daily", "v1")


def _bucketed(name, df, *order):
    """df as a table bucketed by pixel, in a folder and under a name of its own."""
    path = folders.new_folder(df.sparkSession, name)
    return tables.write_pixel_buckets(df, path.rpartition("/")[2].replace("-", "_"), path, 8, order)


@query(sql("px static", f"SELECT {IDS}, snow, elevation, slope, aspect, canopy_cover, ice_fraction, is_water FROM px JOIN static USING (tile, \"row\", col)"))
def o35_with_static_bucketed(spark, d):
    """The same of stored tables that need no shuffle to join."""
    px = _bucketed("pixel-days", A.pixel_days(spark, d).select(*ID, "snow"), "obs_date")
    return joins.with_static(px, _bucketed("static", A.static(spark, d)))


@query(sql("px bridge", f"SELECT {IDS}, snow, type, subdivision_id FROM px JOIN bridge USING (tile, \"row\", col)"))
def o39_with_subdivision_bucketed(spark, d):
    px = _bucketed("pixel-days", A.pixel_days(spark, d).select(*ID, "snow"), "obs_date")
    return joins.with_subdivision(px, _bucketed("mask", A.bridge(spark, d), "type")).select(*ID, "snow", "type", "subdivision_id")


@query(sql("px bridge", f"SELECT {IDS}, snow, type, subdivision_id FROM px JOIN bridge USING (tile, \"row\", col)"))
def o39_with_subdivision(spark, d):
    return joins.with_subdivision(A.pixel_days(spark, d).select(*ID, "snow"), A.bridge(spark, d)).select(*ID, "snow", "type", "subdivision_id")


def _steps(edges) -> str:
    return f"CASE WHEN elevation >= {edges[0]} AND elevation < {edges[-1]} THEN len(list_filter([{', '.join(map(str, edges))}], lambda e: e <= elevation)) END"


@query(sql("grid", f"SELECT {IDS}, {_steps(joins.MEDIAN_STEPS)} AS band, {_steps(joins.MARGIN_STEPS_A)} AS band_a, {_steps(joins.MARGIN_STEPS_B)} AS band_b FROM grid"))
def o40_elevation_band(spark, d):
    e = F.col("elevation")
    return A.grid_days(spark, d).select(
        *ID, joins.elevation_band(e).alias("band"), joins.elevation_band(e, joins.MARGIN_STEPS_A).alias("band_a"), joins.elevation_band(e, joins.MARGIN_STEPS_B).alias("band_b")
    )


@query(sql("stat", """SELECT water_year, day, subdivision_id, var_id, stat_id, stat_value, update_date FROM stat WHERE var_id <> 0
  AND (water_year, day) NOT IN (SELECT (water_year, day) FROM stat WHERE var_id = 0)
UNION ALL SELECT water_year, day, subdivision_id, var_id, stat_id, stat_value, update_date FROM stat WHERE var_id = 0"""))
def o41_stat_upsert(spark, d):
    s = A.stat(spark, d)
    return stats.stat_upsert(s.where("var_id <> 0"), s.where("var_id = 0"))


@query(sql("stat", """SELECT water_year, unnest(range(1, 367))::INT AS day, subdivision_id, var_id, 1 AS stat_id, NULL::DOUBLE AS stat_value
FROM (SELECT DISTINCT subdivision_id, var_id FROM stat), (SELECT DISTINCT water_year FROM stat)"""))
def o41_stat_skeleton(spark, d):
    s = A.stat(spark, d)
    return stats.stat_skeleton(s.select("subdivision_id", "var_id").distinct(), s.select("water_year").distinct())


@query(sql("stat", "SELECT * EXCLUDE (r) FROM (SELECT *, rank() OVER (PARTITION BY water_year, day, subdivision_id, var_id, stat_id ORDER BY update_date DESC) AS r FROM stat) WHERE r = 1"))
def o42_latest_stat(spark, d):
    return stats.latest_stat(A.stat(spark, d))


_CELL = 2 * 3.141592653589793 * 6371007.181 / 36 / 10


@query(sql("px", f"""SELECT t_row, t_col, g.tile, g."row", g.col, p.obs_date, p.snow, p.snow IS NULL AS notprocessed FROM
(SELECT *, 'h' || lpad((gx // 10)::VARCHAR, 2, '0') || 'v' || lpad((gy // 10)::VARCHAR, 2, '0') AS tile, (gy % 10)::INT AS "row", (gx % 10)::INT AS col FROM
  (SELECT *, floor((radians(tx) * cos(radians(ty)) * 6371007.181::DOUBLE + pi() * 6371007.181::DOUBLE) / {_CELL!r}::DOUBLE)::INT AS gx,
            floor((pi() * 6371007.181::DOUBLE / 2 - radians(ty) * 6371007.181::DOUBLE) / {_CELL!r}::DOUBLE)::INT AS gy FROM
    (SELECT i // 60 AS t_row, i % 60 AS t_col, (i % 60 + 0.5::DOUBLE) * 0.7 - 140 AS tx, 52 - (i // 60 + 0.5::DOUBLE) * 0.7 AS ty FROM range(2400) t(i)))) g
LEFT JOIN px p ON p.tile = g.tile AND p."row" = g."row" AND p.col = g.col"""))
def o43_reproject_nearest(spark, d):
    target = grid.target_grid(spark, -140.0, 52.0, 0.7, 40, 60)
    found = grid.reproject_nearest(A.pixel_days(spark, d).select(*ID, "snow"), target, size=10)
    return found.select("t_row", "t_col", *ID, "snow", "notprocessed")


@query(sql("px", f"""SELECT t_row, t_col, g.tile, g."row", g.col, p.obs_date, p.snow, p.snow IS NULL AS notprocessed FROM
(SELECT *, 'h' || lpad((gx // 10)::VARCHAR, 2, '0') || 'v' || lpad((gy // 10)::VARCHAR, 2, '0') AS tile, (gy % 10)::INT AS "row", (gx % 10)::INT AS col FROM
  (SELECT *, floor((lon * cos(lat) + pi()) * 6371007.181::DOUBLE / {_CELL!r}::DOUBLE)::INT AS gx, floor((pi() / 2 - lat) * 6371007.181::DOUBLE / {_CELL!r}::DOUBLE)::INT AS gy FROM
    (SELECT t_row, t_col, tx / 6378137.0::DOUBLE AS lon, atan(sinh(ty / 6378137.0::DOUBLE)) AS lat FROM
      (SELECT i // 60 AS t_row, i % 60 AS t_col, (i % 60 + 0.5::DOUBLE) * 78000 - 15584000 AS tx, 6800000 - (i // 60 + 0.5::DOUBLE) * 78000 AS ty FROM range(2400) t(i))))) g
LEFT JOIN px p ON p.tile = g.tile AND p."row" = g."row" AND p.col = g.col"""))
def o43_reproject_mercator(spark, d):
    """By an index that is stored once for the grid."""
    index = grid.reprojection_index(grid.target_grid(spark, -15584000.0, 6800000.0, 78000.0, 40, 60), "EPSG:3857", 10)
    index = grid.write_index(index, folders.new_folder(spark, "index"))
    found = grid.reproject_indexed(A.pixel_days(spark, d).select(*ID, "snow"), index)
    return found.select("t_row", "t_col", *ID, "snow", "notprocessed")


# --- aggregations --------------------------------------------------------------


_MEDIAN = """SELECT {k}, n, m AS median, round((n / 2.0::DOUBLE - below) / (equal + 0.1::DOUBLE) + m - 0.5, 6) AS smoothed_median FROM
(SELECT {k}, count(*) AS n, m, count(*) FILTER (WHERE v < m) AS below, count(*) FILTER (WHERE v = m) AS equal FROM
 (SELECT {k}, {v} AS v, median({v}) OVER (PARTITION BY {k}) AS m FROM {t} WHERE {v} IS NOT NULL) GROUP BY ALL)"""
_SUB = "SELECT * FROM px JOIN static USING (tile, \"row\", col) JOIN bridge USING (tile, \"row\", col) WHERE elevation >= 500 AND snow >= 10"


def _subdivided(spark, d):
    px = joins.with_static(A.pixel_days(spark, d), A.static(spark, d).select("tile", "row", "col", "elevation"))
    return joins.with_subdivision(px, A.bridge(spark, d))


@query(sql("px static bridge", f"""SELECT obs_date, subdivision_id, pixels, snow_area_km2, mean_value, median, smoothed_median FROM
(SELECT obs_date, subdivision_id, count(*) AS pixels, round(sum(snow) / 100.0::DOUBLE * {stats.PIXEL_KM2!r}::DOUBLE, 6) AS snow_area_km2, round(avg(grain), 6) AS mean_value FROM sub GROUP BY ALL)
LEFT JOIN med USING (obs_date, subdivision_id)""", sub=_SUB, med=_MEDIAN.format(k="obs_date, subdivision_id", v="grain", t="sub")))
def o44_daily_stats(spark, d):
    found = stats.daily_stats(_subdivided(spark, d), "snow", "grain", ["obs_date", "subdivision_id"], 500, 10)
    r = lambda c: F.round(c, 6).alias(c)
    return found.select("obs_date", "subdivision_id", "pixels", r("snow_area_km2"), r("mean_value"), "median", r("smoothed_median"))


@query(sql("px", _MEDIAN.format(k="tile, obs_date", v="snow", t="px")))
def o45_smoothed_median(spark, d):
    found = stats.smoothed_median(A.pixel_days(spark, d), ["tile", "obs_date"], "snow")
    return found.select("tile", "obs_date", "n", "median", F.round("smoothed_median", 6).alias("smoothed_median"))


@query(sql("daily", "SELECT subdivision_id, var_id, day, round(median, 4) AS median, round(prc25, 4) AS prc25, round(prc75, 4) AS prc75 FROM q", past=_PAST, q=_QUANTILES))
def o46_historic_day_quantiles(spark, d):
    found = stats.historic_day_quantiles(A.daily_stat(spark, d), _NOW)
    return found.select("subdivision_id", "var_id", "day", *[F.round(c, 4).alias(c) for c in ("median", "prc25", "prc75")])


def _extreme(kind):
    return lambda spark, d: stats.extreme_years(A.daily_stat(spark, d), kind)


for _kind in ("mean", "median", "sum"):
    QUERIES[f"o47_extreme_years_{_kind}"] = _extreme(_kind)
    SQL[f"o47_extreme_years_{_kind}"] = sql("daily", _years(_kind, "daily"))


@query(sql("daily", """SELECT subdivision_id, var_id, day, 20 AS stat_id, round(stat_value, 4) AS stat_value, 1 AS water_year FROM daily JOIN y USING (subdivision_id, var_id) WHERE water_year = max_year
UNION ALL SELECT subdivision_id, var_id, day, 30, round(stat_value, 4), 1 FROM daily JOIN y USING (subdivision_id, var_id) WHERE water_year = min_year
UNION ALL SELECT subdivision_id, var_id, 1, 40, max_year::DOUBLE, 1 FROM y UNION ALL SELECT subdivision_id, var_id, 1, 50, min_year::DOUBLE, 1 FROM y""", y=_years("mean", "daily")))
def o48_extreme_year_values(spark, d):
    found = stats.extreme_year_values(A.daily_stat(spark, d), "mean")
    return found.withColumn("stat_value", F.round("stat_value", 4))


@query(sql("daily", """SELECT subdivision_id, var_id, day, 60 AS stat_id, round(stat_value, 4) AS stat_value, 1 AS water_year FROM daily JOIN y USING (subdivision_id) WHERE water_year = max_year
UNION ALL SELECT subdivision_id, var_id, day, 70, round(stat_value, 4), 1 FROM daily JOIN y USING (subdivision_id) WHERE water_year = min_year""",
           s="SELECT * FROM daily WHERE var_id = 0", y=_years("sum", "s", "subdivision_id")))
def o48_snow_year_values(spark, d):
    return stats.snow_year_values(A.daily_stat(spark, d), 0).withColumn("stat_value", F.round("stat_value", 4))


@query(_WEB_SQL)
def o49_web_series(spark, d):
    return _web(spark, d)


_MONTHS = "SELECT *, (b2 - b1) / nullif((b2 + b1)::DOUBLE, 0) AS ndvi FROM px WHERE month(obs_date) IN (8, 9) AND sensor_zenith <= 30"
_BACKGROUND = f"""SELECT tile, "row", col, CASE WHEN mn > 0 OR g.obs_date IS NULL THEN k.obs_date ELSE g.obs_date END AS background_date,
  {", ".join(f"CASE WHEN mn > 0 OR g.obs_date IS NULL THEN k.b{i} ELSE g.b{i} END AS b{i}" for i in range(1, 8))}
FROM (SELECT tile, "row", col, min((b3 - b6) / nullif((b3 + b6)::DOUBLE, 0)) AS mn FROM s GROUP BY ALL)
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER ({PIX} ORDER BY ndvi DESC, obs_date) AS rn FROM s WHERE class = 2 AND ndvi IS NOT NULL) WHERE rn = 1) g USING (tile, "row", col)
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER ({PIX} ORDER BY b3, obs_date) AS rn FROM s WHERE b3 >= 10) WHERE rn = 1) k USING (tile, "row", col)"""


@query(sql("px", _BACKGROUND, s=_MONTHS))
def o50_background_reflectance(spark, d):
    return groups.background_reflectance(A.pixel_days(spark, d))


_SPECTRUM = [*(f"b{i}" for i in range(1, 8)), *(f"g{i}" for i in range(1, 8)), "solar_zenith"]
_NEAR = " AND ".join(f"abs(a.{c} - b.{c}) <= 7" for c in _SPECTRUM)
_BESIDE = "SELECT *, unnest([b1 // 8 - 1, b1 // 8, b1 // 8 + 1]) AS k1, k2 FROM (SELECT *, unnest([b2 // 8 - 1, b2 // 8, b2 // 8 + 1]) AS k2 FROM {})"
# Round by round: who stands for a cell of steps of 7, who of these has no smaller one near, and who is near one of those.
_NET = f"""SELECT {", ".join(_SPECTRUM)}, members, id AS spectrum_id, representative FROM (
WITH RECURSIVE net AS (SELECT *, NULL::VARCHAR AS representative FROM spectra
UNION ALL (
  WITH still AS (SELECT * EXCLUDE (representative) FROM net WHERE representative IS NULL),
  stands AS (SELECT * FROM still WHERE id IN (SELECT min(id) FROM still GROUP BY {", ".join(f"{c} // 7" for c in _SPECTRUM)})),
  elected AS (SELECT * FROM stands WHERE id NOT IN
    (SELECT a.id FROM stands a JOIN ({_BESIDE.format("stands")}) b ON a.b1 // 8 = b.k1 AND a.b2 // 8 = b.k2 AND b.id < a.id AND {_NEAR})),
  told AS (SELECT a.id, min(b.id) AS representative FROM still a JOIN ({_BESIDE.format("elected")}) b ON a.b1 // 8 = b.k1 AND a.b2 // 8 = b.k2 AND {_NEAR} GROUP BY a.id)
  SELECT still.*, told.representative FROM still LEFT JOIN told USING (id)))
SELECT * FROM net WHERE representative IS NOT NULL)"""


@query(sql("px", _NET, s=_MONTHS, ground=f"SELECT tile, \"row\", col, {', '.join(f'b{i} AS g{i}' for i in range(1, 8))} FROM ({_BACKGROUND})",
           spectra=f"""SELECT {", ".join(_SPECTRUM)}, md5(concat_ws(',', {", ".join(_SPECTRUM)})) AS id, count(*) AS members
FROM px JOIN ground USING (tile, "row", col) WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _SPECTRUM)} GROUP BY ALL"""))
def o51_distinct_spectra(spark, d):
    px = A.pixel_days(spark, d)
    ground = groups.background_reflectance(px).select("tile", "row", "col", *[F.col(f"b{i}").alias(f"g{i}") for i in range(1, 8)])
    found = spectra.distinct_spectra(px.join(ground, ["tile", "row", "col"]), _SPECTRUM)
    text = {c: F.lower(F.hex(c)) for c in ("spectrum_id", "representative")}
    return found.withColumnsRenamed({f"v{i}": c for i, c in enumerate(_SPECTRUM)}).withColumns(text)


def _saltpans(table: str, snow: str, base: str, least_pixels: int, least_bins: int, cells: str) -> str:
    """The table with bin, cr and cc, and is_saltpan: 546 elevations from -50 on make 545 bins; a bin is asked if all of 40 above it are elevations of the list."""
    return f"""SELECT t.*, coalesce(({base}) AND {snow} > 0 AND bin BETWEEN 0 AND 505 AND votes >= {least_bins}, false) AS is_saltpan
FROM (SELECT *, floor((elevation + 50) / 10.0)::INT AS bin, {cells} FROM {table}) t LEFT JOIN
(SELECT a.tile, a.obs_date, a.cr, a.cc, a.bin, count(*) AS votes FROM
  (SELECT DISTINCT tile, obs_date, floor((elevation + 50) / 10.0)::INT AS bin, {cells} FROM {table}) a JOIN
  (SELECT tile, obs_date, floor((elevation + 50) / 10.0)::INT AS bin, {cells} FROM {table} WHERE ({base}) AND elevation BETWEEN -50 AND 5399
   GROUP BY ALL HAVING count(*) >= {least_pixels} AND 100.0 * count(*) FILTER (WHERE {snow} > 0) / count(*) < 5) f
  ON a.tile = f.tile AND a.obs_date = f.obs_date AND a.cr = f.cr AND a.cc = f.cc AND f.bin BETWEEN a.bin AND a.bin + 40 GROUP BY ALL) v
USING (tile, obs_date, cr, cc, bin)"""


@query(sql("grid", f"SELECT {IDS}, is_saltpan FROM pans", high="SELECT * REPLACE ((elevation + 100)::INT AS elevation) FROM grid",
           pans=_saltpans("high", "snow", "class < 2", 1, 2, 'least("row" // 8, 5) AS cr, least(col // 8, 5) AS cc')))
def o52_saltpan_flag(spark, d):
    cr, cc = F.expr("least(row div 8, 5)"), F.expr("least(col div 8, 5)")
    px = A.grid_days(spark, d).withColumns({"is_base": F.col("class") < 2, "cell_row": cr, "cell_col": cc, "elevation": F.col("elevation") + 100})
    return groups.saltpan_flag(px, ["tile", "obs_date"], least_pixels=1, least_bins=2).select(*ID, "is_saltpan")


@query(sql("px", f"SELECT tile, \"row\", col, {', '.join(f'round({_hazen(chr(120), p)}, 6) AS p{p}' for p in (5, 25, 50, 75, 95))} FROM (SELECT tile, \"row\", col, list(grain ORDER BY grain) AS x FROM px GROUP BY ALL)"))
def o53_percentile_hazen(spark, d):
    from nivalis.functions.quantiles import percentile_hazen

    x = A.pixel_days(spark, d).groupBy("tile", "row", "col").agg(F.array_sort(F.collect_list("grain")).alias("x"))
    return x.select("tile", "row", "col", *[F.round(percentile_hazen(F.col("x"), p), 6).alias(f"p{p}") for p in (5, 25, 50, 75, 95)])


_ROWS, _COLS = 960, 50  # of the grid view, for up to 48,000 parts
_LEVELS = " UNION ALL ".join(f"SELECT {i} AS level, {n} AS per_side" for i, n in enumerate(groups.LEVELS))


@query(sql("grid", f"""SELECT {IDS}, CASE WHEN snowy AND NOT valid THEN fill ELSE grain END AS grain_spatial FROM g LEFT JOIN
(SELECT t.tile, t.obs_date, t."row", t.col, arg_min(m.median, m.level) AS fill FROM
  (SELECT g.*, a.from_band FROM g JOIN asked a USING (tile, obs_date, band) WHERE snowy AND NOT valid) t CROSS JOIN lv
  JOIN med m ON m.tile = t.tile AND m.obs_date = t.obs_date AND m.band = t.from_band AND m.level = lv.level AND m.cr = t."row" * per_side // {_ROWS} AND m.cc = t.col * per_side // {_COLS}
 GROUP BY ALL) USING (tile, obs_date, "row", col)""",
           g=f"SELECT *, snow > 0 AS snowy, coalesce(class = 0, false) AS valid, {_steps(joins.MEDIAN_STEPS)} AS band FROM (SELECT * REPLACE (coalesce(snow, 0) AS snow) FROM grid)",
           lv=_LEVELS,
           med=f"""SELECT tile, obs_date, band, level, "row" * per_side // {_ROWS} AS cr, col * per_side // {_COLS} AS cc, round(median(grain))::INT AS median, count(*) AS n
             FROM g CROSS JOIN lv WHERE snowy AND valid AND grain > 0 GROUP BY ALL HAVING count(*) > 10 OR level = 5""",
           asked="""SELECT tile, obs_date, band, coalesce(min(b) FILTER (WHERE b >= band), max(b)) AS from_band
             FROM (SELECT DISTINCT tile, obs_date, band AS b FROM g WHERE snowy AND valid AND grain > 0), (SELECT DISTINCT band FROM g) GROUP BY ALL"""))
def o54_spatial_median_fill(spark, d):
    px = A.grid_days(spark, d).withColumn("snow", F.coalesce("snow", F.lit(0)) > 0).withColumn("valid", F.col("class") == 0)
    return groups.spatial_median_fill(px, "grain", ["tile", "obs_date"], _ROWS, _COLS).select(*ID, "grain_spatial")


@query(sql("files links", """SELECT region, obs_date, tiles, end_date FROM (SELECT region, obs_date, count(*) AS tiles FROM (SELECT DISTINCT tile, obs_date FROM files) JOIN links USING (tile) GROUP BY ALL)
JOIN (SELECT region, count(DISTINCT tile) AS need FROM links GROUP BY ALL) USING (region)
JOIN (SELECT region, min(d) AS end_date FROM (SELECT region, tile, max(obs_date) AS d FROM files JOIN links USING (tile) GROUP BY ALL) GROUP BY ALL) USING (region) WHERE tiles = need"""))
def o55_completeness_gate(spark, d):
    return grid.completeness_gate(tables.parse_file_metadata(A.files(spark, d)), A.links(spark, d))


# --- windows over the series of each pixel --------------------------------------


@query(sql("dense", f"""SELECT {IDS}, CASE WHEN seen THEN 0 ELSE row_number() OVER ({PIX}, run, seen ORDER BY obs_date) END AS days_since_last_observation,
  CASE WHEN seen THEN 0 ELSE count(*) OVER ({PIX}, run, seen) END AS days_without_observation
FROM (SELECT *, snow IS NOT NULL AS seen, sum((snow IS NOT NULL)::INT) OVER ({W} ROWS UNBOUNDED PRECEDING) AS run FROM dense)"""))
def o56_o57_unobserved_runs(spark, d):
    found = series.unobserved_runs(_dense(spark, d), F.col("snow").isNotNull())
    return found.select(*ID, "days_since_last_observation", "days_without_observation")


_STRETCH = f"""SELECT *, CASE WHEN snow = 0 THEN 0 ELSE count(*) FILTER (WHERE snow > 0) OVER ({PIX}, a) END AS days_with_snow,
  CASE WHEN snow > 0 THEN 0 ELSE count(*) FILTER (WHERE snow = 0) OVER ({PIX}, b) END AS days_with_absent_snow
FROM (SELECT *, count(*) FILTER (WHERE snow = 0) OVER ({W} ROWS UNBOUNDED PRECEDING) AS a, count(*) FILTER (WHERE snow > 0) OVER ({W} ROWS UNBOUNDED PRECEDING) AS b FROM dense)"""


@query(sql("dense", f"SELECT {IDS}, days_with_snow, days_with_absent_snow FROM s", s=_STRETCH))
def o58_stretches(spark, d):
    return series.stretches(_dense(spark, d), F.col("snow")).select(*ID, "days_with_snow", "days_with_absent_snow")


_RARE = "days_with_snow BETWEEN 1 AND 2 OR days_with_absent_snow BETWEEN 1 AND 2"


@query(sql("dense", f"SELECT {IDS}, {_RARE} AS is_rare, CASE WHEN NOT ({_RARE}) THEN snow END AS snow FROM s", s=_STRETCH))
def o59_rare_observations(spark, d):
    return series.rare_observations(_dense(spark, d), "snow").select(*ID, "is_rare", "snow")


@query(sql("dense", f"""SELECT {IDS}, coalesce(snow > 10, false) AND count(*) FILTER (WHERE snow > 10) OVER w >= 3 * (count(*) OVER w - 1) / 80.0 AS persists
FROM dense WINDOW w AS ({W} ROWS BETWEEN 40 PRECEDING AND 40 FOLLOWING)"""))
def o61_moving_persist(spark, d):
    return _dense(spark, d).select(*ID, series.moving_persist(F.col("snow") > 10, least=3).alias("persists"))


_WY = "year(obs_date) + (month(obs_date) >= 10)::INT"


@query(sql("dense static", f"""SELECT {IDS}, count(*) FILTER (WHERE coalesce(snow, 0) > 10) OVER w AS cover_days,
  CASE WHEN NOT bool_or(filled IS NULL) OVER w AND elevation >= 500 THEN count(*) FILTER (WHERE filled >= 10) OVER w END AS mosaic_days
FROM (SELECT *, CASE WHEN snow IS NULL AND state_1km % 7 = 0 THEN NULL ELSE coalesce(snow, 0) END AS filled FROM dense JOIN static USING (tile, "row", col))
WINDOW w AS ({PIX}, {_WY} ORDER BY obs_date ROWS UNBOUNDED PRECEDING)"""))
def o62_snow_cover_days(spark, d):
    px = joins.with_static(_dense(spark, d), A.static(spark, d)).withColumn("water_year", wateryear.water_year(F.col("obs_date")))
    filled = F.when(F.col("snow").isNull() & (F.col("state_1km") % 7 == 0), None).otherwise(F.coalesce("snow", F.lit(0)))
    px = px.withColumn("filled", filled)
    return px.select(
        *ID, series.snow_cover_days(F.coalesce("snow", F.lit(0))).alias("cover_days"), series.mosaic_snow_cover_days(F.col("filled"), 10, F.col("elevation") < 500).alias("mosaic_days")
    )


_E = "datediff('day', DATE '1970-01-01', obs_date)"
_NEAR = f"""SELECT *, {_E} AS t, last_value(CASE WHEN snow IS NOT NULL THEN {_E} END IGNORE NULLS) OVER p AS pt, last_value(snow IGNORE NULLS) OVER p AS pv,
  first_value(CASE WHEN snow IS NOT NULL THEN {_E} END IGNORE NULLS) OVER n AS nt, first_value(snow IGNORE NULLS) OVER n AS nv
FROM dense WINDOW p AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
_LINE = "pv + (nv - pv) / nullif((nt - pt)::DOUBLE, 0) * (t - pt)"


@query(sql("dense", f"SELECT {IDS}, round(coalesce({_LINE}, pv, nv), 6) AS snow_filled FROM near", near=_NEAR))
def o63_interpolate_nearest_ends(spark, d):
    return series.interpolate_linear(_dense(spark, d), "snow", "nearest").select(*ID, F.round("snow_filled", 6).alias("snow_filled"))


@query(sql("dense", f"""SELECT {IDS.replace("tile", "near.tile").replace('"row"', 'near."row"').replace("col", "near.col")}, round(CASE WHEN t < t1 AND t2 IS NOT NULL THEN v1 + (v2 - v1) / (t2 - t1)::DOUBLE * (t - t1)
  WHEN t > u1 AND u2 IS NOT NULL THEN w2 + (w1 - w2) / (u1 - u2)::DOUBLE * (t - u2) ELSE coalesce({_LINE}, pv, nv) END, 6) AS snow_filled
FROM near LEFT JOIN ends e ON e.tile = near.tile AND e."row" = near."row" AND e.col = near.col""", near=_NEAR,
           ends="""SELECT tile, "row", col, x[1].t AS t1, x[1].v AS v1, x[2].t AS t2, x[2].v AS v2, x[-1].t AS u1, x[-1].v AS w1, x[-2].t AS u2, x[-2].v AS w2
             FROM (SELECT tile, "row", col, list({t: datediff('day', DATE '1970-01-01', obs_date), v: snow} ORDER BY obs_date) AS x FROM px WHERE snow IS NOT NULL GROUP BY ALL)"""))
def o63_interpolate_linear(spark, d):
    return series.interpolate_linear(_dense(spark, d), "snow").select(*ID, F.round("snow_filled", 6).alias("snow_filled"))


@query(sql("dense", f"""SELECT {IDS}, CASE WHEN obs_date < lo THEN arg_min(v, obs_date) FILTER (WHERE snow IS NOT NULL) OVER w WHEN obs_date > hi THEN arg_max(v, obs_date) FILTER (WHERE snow IS NOT NULL) OVER w ELSE v END AS held
FROM (SELECT *, coalesce(snow, (dayofyear(obs_date) % 50)::INT) AS v, min(obs_date) FILTER (WHERE snow IS NOT NULL) OVER ({PIX}) AS lo, max(obs_date) FILTER (WHERE snow IS NOT NULL) OVER ({PIX}) AS hi FROM dense)
WINDOW w AS ({PIX})"""))
def o64_hold_ends(spark, d):
    value = F.coalesce("snow", (F.dayofyear("obs_date") % 50))
    px = _dense(spark, d).withColumn("v", value)
    return px.select(*ID, series.hold_ends(F.col("v"), F.col("snow").isNotNull()).alias("held"))


@query(sql("dense", f"""SELECT {IDS}, CASE WHEN abs(g - m) > 2 * 1.4826::DOUBLE * list_aggregate(list_transform(xs, lambda x: abs(x - m)), 'median') THEN m ELSE g END AS grain
FROM (SELECT {IDS}, grain::DOUBLE AS g, median(grain) OVER w AS m, list(grain) FILTER (WHERE grain IS NOT NULL) OVER w AS xs FROM dense WINDOW w AS ({W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))"""))
def o65_hampel(spark, d):
    low, high, rows = _span(spark, d)
    # Only observed days have values, so only they go through the window; the other days are made after it.
    px = series.in_tasks(A.pixel_days(spark, d).select(*ID, "grain"), rows)
    return series.densify(px.select(*ID, series.hampel("grain", by_days=True).alias("grain")), F.lit(low), F.lit(high))


@query(sql("px", f"""SELECT {IDS}, n < 180 AS too_few, CASE WHEN n < 180 THEN 0 ELSE snow END AS snow, CASE WHEN n >= 180 THEN grain END AS grain, CASE WHEN n >= 180 THEN dust END AS dust
FROM (SELECT *, count(*) FILTER (WHERE snow > 0) OVER ({PIX}) AS n FROM px)"""))
def o68_too_few_observations(spark, d):
    return series.too_few_observations(A.pixel_days(spark, d), "snow", ["grain", "dust"], least=180).select(*ID, "too_few", "snow", "grain", "dust")


@query(sql("dense", f"""SELECT {IDS}, r > 20 AS is_masked, CASE WHEN r <= 20 THEN grain END AS grain, solar_zenith
FROM (SELECT *, CASE WHEN seen THEN 0 ELSE count(*) OVER ({PIX}, run, seen) END AS r FROM
 (SELECT *, snow IS NOT NULL AS seen, sum((snow IS NOT NULL)::INT) OVER ({W} ROWS UNBOUNDED PRECEDING) AS run FROM dense))"""))
def o69_rare_mask(spark, d):
    px = series.unobserved_runs(_dense(spark, d), F.col("snow").isNotNull())
    units = {"grain": "um", "solar_zenith": "degree"}
    return series.rare_mask(px, "days_without_observation", 20, units).select(*ID, "is_masked", "grain", "solar_zenith")


# --- layout --------------------------------------------------------------------


@query(sql("px links", f"""SELECT region, {IDS}, snow, "row" + (v - v0) * 10 AS mosaic_row, col + (h - h0) * 10 AS mosaic_col FROM px
JOIN (SELECT *, min(h) OVER (PARTITION BY region) AS h0, min(v) OVER (PARTITION BY region) AS v0 FROM (SELECT *, substr(tile, 2, 2)::INT AS h, substr(tile, 5, 2)::INT AS v FROM links)) USING (tile)"""))
def o74_mosaic_tiles(spark, d):
    return grid.mosaic_tiles(A.pixel_days(spark, d).select(*ID, "snow"), A.links(spark, d), 10, 10).select("region", *ID, "snow", "mosaic_row", "mosaic_col")


@query(sql("px", f"SELECT tile, \"row\" - 1 AS \"row\", col - 2 AS col, obs_date, snow FROM px WHERE tile = 'h08v04' AND \"row\" BETWEEN 1 AND 8 AND col BETWEEN 2 AND 7"))
def o75_crop(spark, d):
    mosaic = grid.mosaic_tiles(A.pixel_days(spark, d).select(*ID, "snow"), A.links(spark, d), 10, 10)
    own = grid.crop_tile(mosaic.where("region = 'region0'"), "h08v04").drop("region", "is_active")
    return grid.crop_extent(own, (1, 8), (2, 7)).select(*ID, "snow")


@query(sql("grid", f"SELECT {IDS}, least(\"row\" // 6, 5) AS cell_row, least(col // 8, 5) AS cell_col FROM grid"))
def o76_cell_of_pixel(spark, d):
    cr, cc = grid.cell_of_pixel(F.col("row"), F.col("col"), 41, 50)
    return A.grid_days(spark, d).select(*ID, cr.alias("cell_row"), cc.alias("cell_col"))


@query(sql("px", f"""SELECT {IDS}, snow, cell_row, cell_col FROM (SELECT *, 0 AS cell_row, least(col // 5, 1) AS cell_col FROM px)
WHERE (tile, obs_date) IN (SELECT (tile, obs_date) FROM (SELECT tile, obs_date, count(DISTINCT least(col // 5, 1)) AS n FROM px GROUP BY ALL) WHERE n = 2)"""))
def o77_assemble_cells(spark, d):
    px = A.pixel_days(spark, d).select(*ID, "snow").withColumns({"cell_row": F.lit(0), "cell_col": F.expr("least(col div 5, 1)")})
    return grid.assemble_cells([px.where("cell_col = 0"), px.where("cell_col = 1")], 2)


@query(sql("px files", f"SELECT {IDS}, CASE WHEN m IS NULL THEN snow END AS snow, CASE WHEN m IS NULL THEN grain END AS grain, dust FROM px LEFT JOIN (SELECT DISTINCT tile, (obs_date - INTERVAL 25 YEAR)::DATE AS obs_date, 1 AS m FROM files) USING (tile, obs_date)"))
def o78_reset_days(spark, d):
    days = tables.parse_file_metadata(A.files(spark, d)).select("tile", F.add_months("obs_date", -300).alias("obs_date"))
    return grid.reset_days(A.pixel_days(spark, d).select(*ID, "snow", "grain", "dust"), days, ["snow", "grain"])


@query(sql("stat", "SELECT * FROM stat ORDER BY water_year, day, subdivision_id, var_id, stat_id"))
def o79_sort_stats(spark, d):
    return stats.sort_stats(A.stat(spark, d))


@query(sql("dense", f"SELECT {IDS}, snow, grain, dust FROM dense"))
def o80_densify(spark, d):
    return _dense(spark, d).select(*ID, "snow", "grain", "dust")


# --- trees and metadata -------------------------------------------------------


_ROOTS = "SELECT DISTINCT group_id AS root_id FROM hier WHERE group_id NOT IN (SELECT id FROM hier)"


@query(sql("hier", "SELECT root_id, u.id AS second_id, l.id AS third_id, l.display FROM roots JOIN hier u ON u.group_id = root_id LEFT JOIN hier l ON l.group_id = u.id", roots=_ROOTS))
def o86_subdivision_paths(spark, d):
    return tree.subdivision_paths(A.hierarchy(spark, d)[0])


@query(sql("hier names", """SELECT root_id, list_sort(list(DISTINCT n.name)) [1] AS first_name, count(DISTINCT u.id) AS seconds, count(l.id) AS thirds FROM roots JOIN hier u ON u.group_id = root_id
LEFT JOIN hier l ON l.group_id = u.id LEFT JOIN names n ON n.id = u.id GROUP BY root_id""", roots=_ROOTS))
def o86_subdivision_tree(spark, d):
    """Read back from the nested JSON."""
    docs = tree.subdivision_tree(*A.hierarchy(spark, d))
    kind = "id int, name string, members array<struct<id:int,name:string,members:array<struct<id:int,name:string,display:int>>>>"
    j = docs.select("root_id", F.from_json("json", kind).alias("j"))
    thirds = F.aggregate("j.members", F.lit(0).cast("long"), lambda n, m: n + F.coalesce(F.size(m["members"]), F.lit(0)))
    return j.select("root_id", F.array_min("j.members.name").alias("first_name"), F.size("j.members").cast("long").alias("seconds"), F.greatest(thirds, F.lit(0)).alias("thirds"))


@query(sql("stat hier names", f"""SELECT root_id, var_id, min(water_year) AS first_year, max(water_year) AS last_year, count(DISTINCT subdivision_id) AS subdivisions,
  coalesce(any_value(name), 'Catchment ' || root_id) AS name FROM
(SELECT *, subdivision_id * 5 + 100 + var_id AS member_id FROM stat) JOIN (SELECT DISTINCT root_id, unnest([u.id, l.id]) AS member_id FROM roots JOIN hier u ON u.group_id = root_id LEFT JOIN hier l ON l.group_id = u.id) USING (member_id)
LEFT JOIN names ON names.id = root_id GROUP BY root_id, var_id""", roots=_ROOTS))
def o87_web_metadata(spark, d):
    return _web_metadata(spark, d).select("root_id", "var_id", "first_year", "last_year", "subdivisions", "name")


def _web_metadata(spark, d):
    links, names = A.hierarchy(spark, d)
    own = A.stat(spark, d).withColumn("subdivision_id", F.expr("subdivision_id * 5 + 100 + var_id"))
    return tree.web_metadata(own, links, names)


@query(sql("stat hier", f"""SELECT root_id, var_id, (floor({_hazen("x", 5)} / 50) * 50)::BIGINT AS range_low, (ceil({_hazen("x", 95)} / 50) * 50)::BIGINT AS range_high FROM
(SELECT root_id, var_id, list(stat_value ORDER BY stat_value) AS x FROM (SELECT *, subdivision_id * 5 + 100 + var_id AS member_id FROM stat)
 JOIN (SELECT DISTINCT root_id, unnest([u.id, l.id]) AS member_id FROM roots JOIN hier u ON u.group_id = root_id LEFT JOIN hier l ON l.group_id = u.id) USING (member_id) GROUP BY ALL)""", roots=_ROOTS))
def o87_display_range(spark, d):
    return _web_metadata(spark, d).select("root_id", "var_id", "range_low", "range_high")


# --- look-up tables, splines, neighbours, unmixing, jobs ------------------------
# Those without SQL are held against brute force, exact cases and properties in the tests. The look-up
# tables are smooth made-up ones (a product's own are an argument); all pixels come from the tables.


def _albedo_lut():
    import numpy as np

    axes = [np.linspace(0, 1, 6), np.linspace(0, 1, 6), np.linspace(1, 45, 8), np.linspace(0, 1e-3, 4), np.linspace(0, 5e-5, 2)]
    mu0, mu, grain, dust, soot = np.meshgrid(*axes, indexing="ij")
    return axes, 92 - 0.8 * grain + 6 * (1 - mu) + 2 * (1 - mu0) - 8000 * dust - 1e5 * soot


def _luts():
    axes, albedo = _albedo_lut()
    dust, mu0 = axes[3][None, None, None, :, None], axes[0][:, None, None, None, None]
    return {"albedo": (axes, albedo), "deltavis": (axes, albedo * 0 + 70003 * dust), "radiative_forcing": (axes, albedo * 0 + 4e5 * dust * mu0)}


def _snow_lut():
    import numpy as np

    axes = [np.linspace(0, 1, 5), np.linspace(30**0.5, 1200**0.5, 8), np.linspace(0, 1e-3, 5)]
    mu0, grain, dust = np.meshgrid(*axes, indexing="ij")
    bands = np.array([0.2, 0.9, 0.05, 0.1, 1.4, 2.3, 2.5])
    shine = np.stack([98 - b * grain - (9e3 if i in (0, 2, 3) else 2e3) * dust + 2 * mu0 for i, b in enumerate(bands)], -1)
    return axes, np.clip(shine, 1, 100)


def _product_lut():
    """Products of up to four axes, each linear: what multilinear interpolation gives exactly, if every corner has its weight."""
    import numpy as np

    axes = [np.linspace(0, 1, 5), np.linspace(0, 1, 4), np.linspace(5, 35, 7), np.linspace(0, 1e-3, 3), np.linspace(0, 2, 3)]
    mu0, mu, grain, dust, soot = np.meshgrid(*axes, indexing="ij")
    return axes, 92 - 0.8 * grain + 3 * mu0 * mu - 0.2 * grain * mu0 + 700 * dust * grain * mu - 90 * mu0 * mu * grain * dust + 4 * soot * mu0


# The table is a sum of products of its axes, so its multilinear interpolation is the formula it was made from.
@query(sql("px", f"""SELECT {IDS}, round(92 - 0.8 * g + 3 * mu0 * mu - 0.2 * g * mu0 + 700 * d * g * mu - 90 * mu0 * mu * g * d + 4 * 0.7 * mu0, 6) AS albedo
FROM (SELECT *, cos(radians(solar_zenith)) AS mu0, cos(radians(sensor_zenith)) AS mu, sqrt(grain) AS g, dust / 1e6 AS d FROM px)"""))
def o60_lut_interpolate(spark, d):
    from nivalis.operators.lut import lut_interpolate

    px = A.pixel_days(spark, d).select(
        *ID, F.cos(F.radians("solar_zenith")).alias("mu0"), F.cos(F.radians("sensor_zenith")).alias("mu"), F.sqrt(F.col("grain").cast("double")).alias("root_grain"), (F.col("dust") / 1e6).alias("dust")
    )
    return lut_interpolate(px, *_product_lut(), ["mu0", "mu", "root_grain", "dust", F.lit(0.7)], "albedo").select(*ID, F.round("albedo", 6).alias("albedo"))


def _spline(days: str, p: float) -> str:
    """k, t and x0, the spline's value, of days (k, t, top: its last day, w, y) by the normal equations of value and slope per day.

    (w y, 0) is on their right side. One day's 2 x 2 block after the other is eliminated upwards, then solved downwards; the
    coupling of a day with the next one is 1 - p times ((-12, 6), (-6, 2)).
    """
    c2, c4, c6, c12 = (f"{(1 - p) * c!r}::DOUBLE" for c in (2, 4, 6, 12))
    inverse = "a11 / (a00 * a11 - a01 * a01) AS i00, -a01 / (a00 * a11 - a01 * a01) AS i01, a00 / (a00 * a11 - a01 * a01) AS i11"
    return f"""(WITH RECURSIVE own AS MATERIALIZED (SELECT k, t, top, {p!r}::DOUBLE * w AS w, y FROM {days}),
up AS (
  SELECT k, t, {inverse}, r0, r1 FROM (SELECT k, t, {c12} + w + 1e-12 AS a00, {c6} AS a01, {c4} + 1e-12 AS a11, w * y AS r0, 0.0::DOUBLE AS r1 FROM own WHERE t = 0)
  UNION ALL
  SELECT k, t, {inverse}, r0, r1 FROM (
    SELECT k, t, p00 + c00 * {c12} + c01 * {c6} AS a00, p01 - (c00 * {c6} + c01 * {c2}) AS a01, p11 - (c10 * {c6} + c11 * {c2}) AS a11,
      w * y - (c00 * r0 + c01 * r1) AS r0, -(c10 * r0 + c11 * r1) AS r1 FROM (
      SELECT d.k, d.t, d.w, d.y, u.r0, u.r1, -{c12} * i00 - {c6} * i01 AS c00, -{c12} * i01 - {c6} * i11 AS c01, {c6} * i00 + {c2} * i01 AS c10, {c6} * i01 + {c2} * i11 AS c11,
        CASE WHEN d.t < top THEN 2 * {c12} ELSE {c12} END + d.w + 1e-12 AS p00, CASE WHEN d.t < top THEN 0 ELSE -{c6} END AS p01, CASE WHEN d.t < top THEN 2 * {c4} ELSE {c4} END + 1e-12 AS p11
      FROM up u JOIN own d ON d.k = u.k AND d.t = u.t + 1))),
steps AS MATERIALIZED (SELECT * FROM up),
down AS (
  SELECT k, t, i00 * r0 + i01 * r1 AS x0, i01 * r0 + i11 * r1 AS x1 FROM steps JOIN own USING (k, t) WHERE t = top
  UNION ALL
  SELECT k, t, i00 * q0 + i01 * q1, i01 * q0 + i11 * q1 FROM (
    SELECT s.k, s.t, i00, i01, i11, r0 + {c12} * x0 - {c6} * x1 AS q0, r1 + {c6} * x0 - {c2} * x1 AS q1
    FROM down JOIN steps s ON s.k = down.k AND s.t = down.t - 1))
SELECT k, t, x0 FROM down)"""


_DAYS_OF = """SELECT tile, "row", col, obs_date, dense_rank() OVER (ORDER BY tile, "row", col) AS k, obs_date - min(obs_date) OVER () AS t, max(obs_date) OVER () - min(obs_date) OVER () AS top,
  CASE WHEN snow IS NOT NULL AND weight > 0 THEN weight ELSE 0 END AS w, coalesce(snow, 0)::DOUBLE AS y,
  count(*) FILTER (WHERE snow IS NOT NULL AND weight > 0) OVER (PARTITION BY tile, "row", col) AS seen FROM dense"""


@query(sql("dense", f"""SELECT tile, "row", col, obs_date, CASE WHEN seen >= 2 THEN round(greatest(0, least(100, x0)), 2) END AS snow_smooth
FROM {_spline("days", 0.1)} JOIN days USING (k, t)""", days=_DAYS_OF))
def o66_smoothing_spline(spark, d):
    from nivalis.operators.spline import smoothing_spline

    found = smoothing_spline(_dense(spark, d).select(*ID, "snow", "weight"), "snow", "weight", 0.1, 0, 100, cols=10)
    return found.withColumn("snow_smooth", F.round("snow_smooth", 2))


def _taper(x: str, end: int) -> str:
    """The spline x up to the peak, the plateau from there on, and in the last seven days a cubic from it to the end."""
    share = "((t - top + 7) / 7.0::DOUBLE)"
    return f"CASE WHEN t > top - 7 THEN plateau + ({end} - plateau) * (3 * {share} ** 2 - 2 * {share} ** 3) WHEN t < peak THEN {x} ELSE plateau END"


@query(sql("px", f"""SELECT tile, "row", col, water_year, obs_date, CASE WHEN usable THEN round(greatest(40, least(1190, g_out)), 1) END AS grain_fixed,
  CASE WHEN usable AND d_seen >= 2 THEN round(greatest(0, least(950, d_out)), 1) END AS dust_fixed FROM (SELECT dusty.*, {_taper("x0", 0)} AS d_out FROM dusty JOIN {_spline("dusty", 0.1)} USING (k, t))""",
           seasons='SELECT DISTINCT tile, "row", col, year(obs_date) + (month(obs_date) >= 10)::INT AS water_year FROM px',
           full_years="""SELECT tile, "row", col, water_year, obs_date, grain, dust, coalesce(weight, 1) AS weight, k, obs_date - make_date(water_year - 1, 10, 1) AS t, make_date(water_year, 9, 30) - make_date(water_year - 1, 10, 1) AS top,
             coalesce(grain BETWEEN 40 AND 1190, false) AS g_ok, CASE WHEN grain BETWEEN 40 AND 1190 THEN grain END AS x
             FROM (SELECT *, row_number() OVER () AS k, unnest(range(make_date(water_year - 1, 10, 1)::TIMESTAMP, make_date(water_year, 10, 1)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS obs_date FROM
               (SELECT * FROM seasons)) LEFT JOIN px USING (tile, "row", col, obs_date)""",
           windows="SELECT *, median(x) OVER w AS middle, list(x) OVER w AS around FROM full_years WINDOW w AS (PARTITION BY k ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)",
           calm="""SELECT * EXCLUDE (around), CASE WHEN abs(x - middle) > 2 * 1.4826::DOUBLE * list_median([abs(v - middle) FOR v IN around IF v IS NOT NULL]) THEN middle ELSE x END AS g FROM windows""",
           late="SELECT *, coalesce(max(t) FILTER (WHERE g_ok) OVER (PARTITION BY k), 0) AS last_seen FROM calm",
           peaks="SELECT k, coalesce(arg_max(t, (g, -t)) FILTER (WHERE t > last_seen - 40 AND g IS NOT NULL), 0) AS peak FROM late GROUP BY k",
           marked="SELECT *, g_ok AND t <= peak AS before FROM late JOIN peaks USING (k)",
           grainy="""SELECT * EXCLUDE (middle, x), count(*) FILTER (WHERE before) OVER w >= 2 AND peak >= 2 AS usable, max(g) FILTER (WHERE t = peak) OVER w AS plateau,
             CASE WHEN t = 0 THEN 1 WHEN before THEN weight ELSE 0 END AS w, CASE WHEN t = 0 THEN 40 WHEN before THEN g ELSE 0 END::DOUBLE AS y FROM marked WINDOW w AS (PARTITION BY k)""",
           grains=f"SELECT grainy.* EXCLUDE (w, y, plateau), {_taper('x0', 40)} AS g_out FROM grainy JOIN {_spline('grainy', 0.8)} USING (k, t)",
           grains_ok="SELECT *, g_ok AND t <= peak AND coalesce(dust BETWEEN 0 AND 950, false) AS d_ok FROM grains",
           dust_of="SELECT *, CASE WHEN t < peak AND g_out <= 300 AND d_ok THEN 0 ELSE dust END AS d, coalesce(max(t) FILTER (WHERE d_ok) OVER (PARTITION BY k), 0) AS last_d FROM grains_ok",
           dusty="""SELECT *, count(*) FILTER (WHERE d_ok) OVER w AS d_seen, max(d) FILTER (WHERE t = last_d) OVER w AS plateau,
             CASE WHEN t = 0 THEN 1 WHEN d_ok THEN weight ELSE 0 END AS w, CASE WHEN t = 0 OR NOT d_ok THEN 0 ELSE d END::DOUBLE AS y FROM dust_of WINDOW w AS (PARTITION BY k)"""))
def o67_fix_peak(spark, d):
    """Every water year of the data, its days without gaps; to a tenth, as two orders of elimination agree to some 1e-9 only."""
    from nivalis.operators.spline import fix_peaks

    keys = [*series.PIXEL, "water_year"]
    px = A.pixel_days(spark, d).withColumn("water_year", wateryear.water_year(F.col("obs_date")))
    first, last = (F.make_date(F.col("water_year") - back, F.lit(month), F.lit(day)) for back, month, day in ((1, 10, 1), (0, 9, 30)))
    found = fix_peaks(series.densify(px, first, last, keys), "grain", "dust", "weight", cols=10, keys=keys)
    return found.withColumns({c: F.round(c, 1) for c in ("grain_fixed", "dust_fixed")})


def _clouds(table: str, cloud: str) -> str:
    """The table's pixels with cloud, and kept: clouds with more than 3 in the 5 x 5 around."""
    return f"""SELECT *, {cloud} AS cloud, coalesce({cloud} AND n > 3, false) AS kept FROM {table} LEFT JOIN
(SELECT tile, obs_date, "row", col, count(*) AS n FROM (SELECT tile, obs_date, "row" + i AS "row", col + j AS col FROM {table}, (SELECT unnest(range(-2, 3)) AS i), (SELECT unnest(range(-2, 3)) AS j) WHERE {cloud}) GROUP BY ALL)
USING (tile, obs_date, "row", col)"""


_CLOUDS = _clouds("grid", "class = 1")


@query(sql("grid", "SELECT tile, obs_date, \"row\", col, kept AS is_cloud FROM clouds", clouds=_CLOUDS))
def o70_cloud_despeckle(spark, d):
    from nivalis.operators.neighbourhood import cloud_despeckle

    px = A.grid_days(spark, d).withColumn("cloud", F.col("class") == 1)
    return cloud_despeckle(px, "cloud", ["tile", "obs_date"], block=100)


def _margin_share(band: str) -> str:
    return f"coalesce(floor(100 * (sum(w) FILTER (WHERE o.{band} = t.{band} AND o.kept) / sum(w) FILTER (WHERE o.{band} = t.{band})) + 0.5), 0)"


_MARGIN = f"""SELECT tile, obs_date, "row", col, greatest(a, b) > 1 AND NOT cloud AS is_margin FROM
(SELECT t.tile, t.obs_date, t."row", t.col, any_value(t.cloud) AS cloud, {_margin_share("band_a")} AS a, {_margin_share("band_b")} AS b FROM banded t
 JOIN (SELECT *, "row" + i AS to_row, col + j AS to_col, 1 / (sqrt(i * i + j * j) + 1) AS w FROM banded, (SELECT unnest(range(-5, 6)) AS i), (SELECT unnest(range(-5, 6)) AS j)) o
 ON o.tile = t.tile AND o.obs_date = t.obs_date AND o.to_row = t."row" AND o.to_col = t.col GROUP BY t.tile, t.obs_date, t."row", t.col)"""
_BANDED = f"SELECT *, {_steps(joins.MARGIN_STEPS_A)} AS band_a, {_steps(joins.MARGIN_STEPS_B)} AS band_b FROM clouds"


@query(sql("grid", _MARGIN, clouds=_CLOUDS, banded=_BANDED))
def o71_cloud_margin(spark, d):
    from nivalis.operators.neighbourhood import cloud_margin

    px = A.grid_days(spark, d).withColumn("cloud", F.col("class") == 1)
    return cloud_margin(px, "cloud", ["tile", "obs_date"], block=100)


@query(sql("grid", f"""SELECT {IDS}, round(sum(v / w) / sum(1 / w), 3) AS grain_idw FROM
(SELECT t.tile, t.obs_date, t."row", t.col, s.grain AS v, sqrt(pow(t."row" - s."row", 2) + pow(t.col - s.col, 2)) AS w FROM grid t JOIN grid s USING (tile, obs_date)
 WHERE t.snow < 4 AND NOT coalesce(s.snow < 4, false) AND s.snow > 96) GROUP BY ALL"""))
def o72_idw_fill(spark, d):
    from nivalis.operators.neighbourhood import idw_fill

    px = A.grid_days(spark, d).withColumns({"grain": F.when(F.col("snow") > 96, F.col("grain")), "little": F.coalesce(F.col("snow") < 4, F.lit(False))})
    return idw_fill(px, "grain", "little", ["tile", "obs_date"]).withColumn("grain_idw", F.round("grain_idw", 3))


def _inpaint(method):
    def run(spark, d):
        from nivalis.operators.holes import inpaint

        g = A.grid_days(spark, d).select(*ID, "solar_zenith")
        rows = g.agg(F.max("row")).first()[0] + 1
        found = inpaint(g.withColumn("solar_zenith", F.when(F.col("row") % 4 != 1, F.col("solar_zenith"))), "solar_zenith", ["tile", "obs_date"], rows, 50, method)
        return found.withColumn("solar_zenith_filled", F.round("solar_zenith_filled", 4))

    return run


QUERIES["o73_inpaint_springs"] = _inpaint("springs")
# Holes of one row mostly: each cell the mean of its neighbours, over and over, until nothing changes.
SQL["o73_inpaint_springs"] = sql(
    "grid", f"""SELECT {", ".join("cells." + c for c in IDS.split(", "))}, round(coalesce(cells.x, turns.x), 4) AS solar_zenith_filled
FROM cells LEFT JOIN turns ON turns.k = 200 AND cells.tile = turns.tile AND cells.obs_date = turns.obs_date AND cells."row" = turns."row" AND cells.col = turns.col""",
    cells="""SELECT d.tile, d.obs_date, r."row", c.col, v.x FROM (SELECT DISTINCT tile, obs_date FROM grid) d CROSS JOIN (SELECT unnest(range((SELECT max("row") + 1 FROM grid)))::INT AS "row") r
      CROSS JOIN (SELECT unnest(range(50))::INT AS col) c LEFT JOIN (SELECT tile, obs_date, "row", col, solar_zenith::DOUBLE AS x FROM grid WHERE "row" % 4 <> 1) v
      ON v.tile = d.tile AND v.obs_date = d.obs_date AND v."row" = r."row" AND v.col = c.col""",
    near="""SELECT a.tile, a.obs_date, a."row", a.col, b."row" AS nr, b.col AS nc, b.x FROM cells a CROSS JOIN (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) o(i, j)
      JOIN cells b ON b.tile = a.tile AND b.obs_date = a.obs_date AND b."row" = a."row" + i AND b.col = a.col + j WHERE a.x IS NULL""",
    base='SELECT tile, obs_date, "row", col, count(*) AS n, coalesce(sum(x), 0) AS c FROM near GROUP BY ALL',
    pairs="""SELECT near.tile, near.obs_date, near."row", near.col, nr, nc, 1.0::DOUBLE AS w, n, c FROM near JOIN base USING (tile, obs_date, "row", col) WHERE x IS NULL
      UNION ALL SELECT tile, obs_date, "row", col, "row", col, 0.0::DOUBLE, n, c FROM base""",
    turns="""SELECT tile, obs_date, "row", col, 0 AS k, c / n AS x FROM base
      UNION ALL SELECT p.tile, p.obs_date, p."row", p.col, t.k + 1, (any_value(p.c) + sum(p.w * t.x)) / any_value(p.n) FROM turns t
      JOIN pairs p ON p.tile = t.tile AND p.obs_date = t.obs_date AND p.nr = t."row" AND p.nc = t.col WHERE t.k < 200 GROUP BY p.tile, p.obs_date, p."row", p.col, t.k""",
).replace("WITH ", "WITH RECURSIVE ", 1)
QUERIES["o73_inpaint_plate"] = _inpaint("plate")


_BRIGHT = "b1 > 35 AND b2 > 35 AND b3 > 31 AND b4 > 31 AND b5 > 30 AND b6 > 22"
_ALONG = f"(cos(th) * (6371.007181::DOUBLE + 705.0) - sqrt(1 - pow({_FAR} * sin(th), 2)) * 6371.007181::DOUBLE) / 705.0"
_ACROSS = f"(asin(sin(th + be) * {_FAR}) - asin(sin(th - be) * {_FAR}) - be * 2) * 6371.007181::DOUBLE"


@query(sql("px static", f"""SELECT {IDS}, CASE WHEN is_margin THEN nodata | 32 ELSE nodata END AS nodata_filter, zero AS zero_filter, weight, sensor_mask, round(ndsi, 6) AS ndsi
FROM flagged JOIN margin USING (tile, obs_date, "row", col)""",
           base=f"""SELECT *, {_masks(0, 100)} AS sensor_mask, {_STATE}, (b3 - b6) / nullif((b3 + b6)::DOUBLE, 0) AS ndsi,
             asin(sin(radians(sensor_zenith)) / ({_FAR})) AS th, atan(1.0 / 1410.0) AS be FROM px JOIN static USING (tile, "row", col)""",
           limits="SELECT *, (CASE WHEN ndsi < -0.5 THEN 2 ELSE 0 END) | (CASE WHEN elevation < 500 THEN 16 ELSE 0 END) | (CASE WHEN is_water THEN 32 ELSE 0 END) AS zf, (sensor_mask <> 0)::INT AS nf FROM base",
           flagged=f"""SELECT * EXCLUDE (weight), (CASE WHEN class = 1 AND nf = 0 AND zf = 0 THEN nf | 2 ELSE nf END) | (CASE WHEN {_BRIGHT} THEN 16 ELSE 0 END) AS nodata,
             CASE WHEN (class = 2 AND cloud NOT IN (1, 2)) OR saltpan = 1 THEN zf | 1 ELSE zf END AS zero,
             greatest(1, least([100, 50, 50, 100][cloud + 1], [100, 80][cloudshadow + 1], [80, 100, 80, 80, 80, 0, 0, 0][landwater + 1], [100, 100, 50, 25][aerosol + 1], [100, 100, 50, 25][cirrus + 1],
               least(100, round(100 / (({_ALONG}) * ({_ACROSS}))))::INT, greatest(1, round(cos(radians(solar_zenith)) * 100))::INT))::INT AS weight FROM limits""",
           clouds=_clouds("(SELECT * EXCLUDE (cloud) FROM flagged)", "(nodata & 18) <> 0"), banded=_BANDED, margin=_MARGIN))
def o82_ingest_job(spark, d):
    from nivalis.plans.ingest import ingest_job

    found = ingest_job(A.pixel_days(spark, d), A.static(spark, d))
    return found.select(*ID, "nodata_filter", "zero_filter", "weight", "sensor_mask", F.round("ndsi", 6).alias("ndsi"))


@query()
def o82_ingest_job_viirs(spark, d):
    """Flags of a grid of half the resolution, pixels without background, no classifier."""
    from nivalis.plans.ingest import ingest_job

    flags = A.pixel_days(spark, d).groupBy("tile", "obs_date", F.expr("row div 2").alias("row"), F.expr("col div 2").alias("col")).agg(F.min("state_1km").alias("f"))
    flags = flags.select("tile", "obs_date", "row", "col", F.expr("f % 256 AS qf1"), F.expr("f div 8 % 256 AS qf2"), F.expr("f div 64 % 256 AS qf7"))
    px, ground = A.pixel_days(spark, d), groups.background_reflectance(A.pixel_days(spark, d))
    found = ingest_job(px.drop("class", "state_1km"), A.static(spark, d), viirs=True, coarse=flags, background=ground)
    return found.select(*ID, "nodata_filter", "zero_filter", "weight", "sensor_mask", F.round("ndsi", 6).alias("ndsi"))


def _medians_around(value: str, valid: str) -> dict[str, str]:
    """Common table expressions: the view spat's `value`, or where it is snow and not valid the median around, as <value>_around."""
    return {
        f"{value}_good": f"SELECT * FROM spat WHERE snowy AND {valid} AND {value} > 0",
        f"{value}_med": f"""SELECT tile, obs_date, band, level, "row" * per_side // {_ROWS} AS cr, col * per_side // {_COLS} AS cc, round(median({value}))::INT AS median
          FROM {value}_good CROSS JOIN lv GROUP BY ALL HAVING count(*) > 10 OR level = 5""",
        f"{value}_asked": f"""SELECT tile, obs_date, band, coalesce(min(b) FILTER (WHERE b >= band), max(b)) AS from_band
          FROM (SELECT DISTINCT tile, obs_date, band AS b FROM {value}_good), (SELECT DISTINCT band FROM spat) GROUP BY ALL""",
        f"{value}_around": f"""SELECT t.tile, t.obs_date, t."row", t.col, arg_min(m.median, m.level) AS fill FROM
          (SELECT spat.*, from_band FROM spat JOIN {value}_asked USING (tile, obs_date, band) WHERE snowy AND NOT {valid}) t CROSS JOIN lv
          JOIN {value}_med m ON m.tile = t.tile AND m.obs_date = t.obs_date AND m.band = t.from_band AND m.level = lv.level AND m.cr = t."row" * per_side // {_ROWS} AND m.cc = t.col * per_side // {_COLS}
          GROUP BY ALL""",
    }


#: Filters with every bit in some pixel, and most often off, so that salt pans, snow and fills all occur.
_NODATA, _ZERO = "CASE WHEN b1 % 3 = 0 THEN nodata_filter % 64 ELSE 0 END", "CASE WHEN b2 % 3 = 0 THEN zero_filter ELSE 0 END"
_SPATIAL_CELLS = f'least("row" // {_ROWS // 6}, 5) AS cr, least(col // {_COLS // 6}, 5) AS cc'


def _spatial_sql(viirs: bool) -> str:
    clouds, nodata, zero = (16 | 32, 1 | 4 | 16 | 32 | 64, 2 | 4 | 8 | 16 | 32 | 64) if viirs else (2 | 16 | 32, 255, 255)
    return sql(
        "grid", f"""SELECT tile, obs_date, "row", col, nodata_filter, CASE WHEN snowy AND NOT g_valid THEN g.fill ELSE grain END AS grain_spatial,
        CASE WHEN snowy AND NOT d_valid THEN d.fill ELSE dust END AS dust_ppm_spatial
        FROM spat LEFT JOIN grain_around g USING (tile, obs_date, "row", col) LEFT JOIN dust_around d USING (tile, obs_date, "row", col)""",
        base=f"""SELECT * EXCLUDE (nodata_filter, zero_filter), {_NODATA} AS nodata, {_ZERO} AS zero, b3 % 40 AS canopy, CASE WHEN class = 0 THEN 0 WHEN class = 1 THEN 1 + b4 % 7 ELSE 8 << (b5 % 3) END AS gd
          FROM grid""",
        pans=_saltpans("base", "snow", f"canopy < 30 AND nodata & {clouds} = 0 AND zero & 12 = 0", 2, 2, _SPATIAL_CELLS),
        spat=f"""SELECT *, nodata | CASE WHEN is_saltpan THEN 64 ELSE 0 END AS nodata_filter, (nodata | CASE WHEN is_saltpan THEN 64 ELSE 0 END) & {nodata} = 0 AND zero & {zero} = 0 AS snowy,
          gd & 7 = 0 AS g_valid, gd & 56 = 0 AS d_valid, {_steps(joins.MEDIAN_STEPS)} AS band FROM pans""",
        lv=_LEVELS, **_medians_around("grain", "g_valid"), **_medians_around("dust", "d_valid"),
    )


def _spatial(spark, d, viirs):
    from nivalis.plans.ingest import spatial_job

    px = A.grid_days(spark, d).withColumns({
        "viewable_snow_fraction": F.col("snow"), "dust_ppm": F.col("dust"), "canopy_cover": F.col("b3") % 40, "nodata_filter": F.expr(_NODATA), "zero_filter": F.expr(_ZERO),
        "grain_size_dust": F.when(F.col("class") == 0, 0).when(F.col("class") == 1, 1 + F.col("b4") % 7).otherwise(F.expr("shiftleft(8, b5 % 3)")),
    })
    return spatial_job(px, _ROWS, _COLS, viirs, least_pixels=2, least_bins=2).select(*ID, "nodata_filter", "grain_spatial", "dust_ppm_spatial")


@query(_spatial_sql(False))
def o82_spatial_job(spark, d):
    """Salt pans and medians around, of the grid view's snow, grain size and dust."""
    return _spatial(spark, d, False)


@query(_spatial_sql(True))
def o82_spatial_job_viirs(spark, d):
    return _spatial(spark, d, True)


@query()
def o81_unmix_job(spark, d):
    from nivalis.plans.ingest import unmix_job

    px, background = A.pixel_days(spark, d), groups.background_reflectance(A.pixel_days(spark, d))
    ready = px.withColumns({
        "nodata_filter": F.when(F.col("class") == 1, 2).otherwise(0), "zero_filter": F.when(F.col("class") == 2, 1).otherwise(0),
        "ndsi": optics.normalised_difference(F.col("b3"), F.col("b6")),
    })
    found = unmix_job(ready, background, A.static(spark, d), *_snow_lut())
    return found.select(*ID, "viewable_snow_fraction", "snow_fraction", "grain_size", "dust", "residual", "zero_filter", "grain_size_dust")


def _seasons(spark, d):
    """Pixels as gap filling needs them, its arguments: all water years of the data, the last one up to the last day."""
    px = A.pixel_days(spark, d).withColumns({
        "total": F.col("snow"), "nodata_filter": F.when(F.col("snow").isNull(), 1).otherwise(0), "zero_filter": F.when(F.col("snow") == 0, 64).otherwise(0),
    })
    low, high = A.first_and_last_day(spark, d)
    if low is None:
        low = high = dt.date(1999, 10, 1)
    first = dt.date(low.year - (low.month < 10), 10, 1)
    return px, first.isoformat(), high.isoformat(), A.static(spark, d)


@query()
def o83_gap_fill_job(spark, d):
    from nivalis.plans.gapfill import gap_fill_job

    return gap_fill_job(*_seasons(spark, d), cols=10, by_year=True)


@query()
def o84_albedo_job(spark, d):
    from nivalis.plans.albedo import season_albedo_job

    px, *how = _seasons(spark, d)
    return season_albedo_job(px.withColumn("solar_azimuth", F.col("b1") * 3), *how, _luts(), cols=10, by_year=True)


def _filled(c: str) -> str:
    """The column filled in time, nearest at the ends of a pixel's days."""
    back, ahead = f"({W} ROWS UNBOUNDED PRECEDING)", f"({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    at = f"CASE WHEN {c} IS NOT NULL THEN obs_date END"
    pv, pd, nv, nd = (f"{f}({x} IGNORE NULLS) OVER {w}" for f, w in (("last_value", back), ("first_value", ahead)) for x in (c, at))
    return f"CASE WHEN {pv} IS NULL THEN {nv} WHEN {nv} IS NULL OR {pd} = {nd} THEN {pv} ELSE {pv} + ({nv} - {pv})::DOUBLE / ({nd} - {pd}) * (obs_date - {pd}) END"


@query(sql("px static", f"""SELECT {IDS}, a0 AS albedo_mu0, az AS albedo_muz, dv AS deltavis, rf AS radiative_forcing, round(a0 - dv * 0.63::DOUBLE)::INT AS albedo_observed_mu0, round(az - dv * 0.63::DOUBLE)::INT AS albedo_observed_muz
FROM (SELECT *, round(92 - 0.8::DOUBLE * g + 8 * (1 - mu0))::INT AS a0, round(92 - 0.8::DOUBLE * g + 6 * (1 - muz) + 2 * (1 - mu0))::INT AS az, round(70003::DOUBLE * dust / 1e7)::INT AS dv, round(4e5::DOUBLE * dust / 1e7 * mu0)::INT AS rf FROM
  (SELECT *, sqrt(grain) AS g, greatest(0, least(1, mu0 * cos(radians(slope)) + sqrt(1 - mu0 * mu0) * sin(radians(slope)) * cos(radians(phi - aspect)))) AS muz FROM
    (SELECT *, cos(radians(zen)) AS mu0, CASE WHEN 180 - azi > 180 THEN -180 - azi WHEN 180 - azi < -180 THEN 540 - azi ELSE 180 - azi END AS phi FROM
      (SELECT *, {_filled("z")} AS zen, {_filled("a")} AS azi FROM
        (SELECT *, CASE WHEN class <> 2 THEN solar_zenith END AS z, CASE WHEN class <> 1 THEN b1 * 3 END AS a FROM px))) JOIN static USING (tile, "row", col)))"""))
def o84_albedo_of_days(spark, d):
    """Of observed days, the sun's angles missing on some."""
    from nivalis.plans.albedo import albedo_job

    px = A.pixel_days(spark, d).select(
        *ID, F.col("grain").alias("grain_size"), "dust", F.when(F.col("class") != 2, F.col("solar_zenith")).alias("solar_zenith"), F.when(F.col("class") != 1, F.col("b1") * 3).alias("solar_azimuth")
    )
    found = albedo_job(px, A.static(spark, d), _luts())
    return found.select(*ID, "albedo_mu0", "albedo_muz", "deltavis", "radiative_forcing", "albedo_observed_mu0", "albedo_observed_muz")


_STACK = "\nUNION ALL ".join(f"SELECT {_WY} AS water_year, datediff('day', make_date(year(obs_date) - (month(obs_date) < 10)::INT, 10, 1), obs_date) + 1 AS day, subdivision_id, 7 AS var_id, {i} AS stat_id, round({c}, 6) AS stat_value FROM w" for c, i in stats.DAILY_IDS.items())


@query(sql("px static bridge", _STACK, sub=_SUB, med=_MEDIAN.format(k="obs_date, subdivision_id", v="grain", t="sub"),
           w=f"""SELECT * FROM (SELECT obs_date, subdivision_id, sum(snow) / 100.0::DOUBLE * {stats.PIXEL_KM2!r}::DOUBLE AS snow_area_km2, avg(grain) AS mean_value FROM sub GROUP BY ALL)
             LEFT JOIN med USING (obs_date, subdivision_id)"""))
def o85_daily_statistics(spark, d):
    from nivalis.plans.statistics import daily_job

    px = joins.with_static(A.pixel_days(spark, d), A.static(spark, d).select("tile", "row", "col", "elevation"))
    return daily_job(px, A.bridge(spark, d), "snow", "grain", 7, 500, 10).withColumn("stat_value", F.round("stat_value", 6))


_ALL = _SUB.replace("elevation >= 500 AND snow >= 10", "elevation >= 0 AND snow >= 0")
_WEB_ROUNDED = "SELECT subdivision_id, var_id, day, " + ", ".join(f"round({c}, 4) AS {c}" for c in _ROUND) + f" FROM ({_WEB})"


@query(sql("px static bridge stat", _WEB_ROUNDED, sub=_ALL, med=_MEDIAN.format(k="obs_date, subdivision_id", v="grain", t="sub"),
           w=f"""SELECT * FROM (SELECT obs_date, subdivision_id, sum(snow) / 100.0::DOUBLE * {stats.PIXEL_KM2!r}::DOUBLE AS snow_area_km2, avg(grain) AS mean_value FROM sub GROUP BY ALL)
             LEFT JOIN med USING (obs_date, subdivision_id)""",
           fresh=_STACK, updated="""SELECT water_year, day, subdivision_id, var_id, stat_id, stat_value, update_date FROM stat WHERE (water_year, day) NOT IN (SELECT (water_year, day) FROM fresh)
             UNION ALL SELECT water_year, day, subdivision_id, var_id, stat_id, stat_value, DATE '2002-01-01' FROM fresh""",
           daily="""SELECT * FROM (SELECT *, rank() OVER (PARTITION BY water_year, day, subdivision_id, var_id, stat_id ORDER BY update_date DESC) AS r FROM updated) WHERE r = 1 AND stat_id = 2""",
           past=_PAST, years=_years("mean", "past"), q=_QUANTILES))
def o85_statistics_job(spark, d):
    """Daily statistics, put among older ones, to web series."""
    from nivalis.plans.statistics import daily_job, statistics_job

    px = joins.with_static(A.pixel_days(spark, d), A.static(spark, d).select("tile", "row", "col", "elevation"))
    new = daily_job(px, A.bridge(spark, d), "snow", "grain", 7).withColumn("update_date", F.lit("2002-01-01").cast("date"))
    return statistics_job(A.stat(spark, d), new, _NOW).select("subdivision_id", "var_id", "day", *[F.round(c, 4).alias(c) for c in _ROUND])
