"""DuckDB SQL of the adapter views; the queries' SQL is built on these."""

from __future__ import annotations

_VALUES = ", ".join([
    "CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'R' AND CAST(l_quantity AS INT) % 2 = 0 THEN 0 ELSE CAST(l_quantity AS INT) * 2 END AS snow",
    "(30 + (l_orderkey * 17 + l_partkey * 5) % 1180)::INT AS grain", "((l_orderkey * 3 + l_partkey * 11) % 960)::INT AS dust",
    "((l_orderkey * 31 + l_partkey * 7 + l_linenumber) % 32768)::INT AS state_1km",
    *[f"((l_orderkey * {7 * k} + l_partkey * 13 + l_linenumber * 29) % 101)::INT AS b{k}" for k in range(1, 8)],
    "((l_orderkey + l_partkey) % 3)::INT AS class", "(l_orderkey % 90)::INT AS solar_zenith", "(l_partkey % 60)::INT AS sensor_zenith",
    "(l_orderkey % 128)::INT AS nodata_filter", "(l_partkey % 128)::INT AS zero_filter", "(1 + l_orderkey % 100)::INT AS weight",
])
_LAST = "ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC"
VIEWS = {
    "px": f"""SELECT 'h08v0' || (4 + pixel % 2) AS tile, (pixel // 10)::INT AS "row", (pixel % 10)::INT AS col, obs_date, {_VALUES}
        FROM (SELECT *, l_suppkey AS pixel, l_shipdate::DATE AS obs_date,
                     row_number() OVER (PARTITION BY l_suppkey, l_shipdate::DATE {_LAST}) AS rn FROM lineitem) WHERE rn = 1""",
    "grid": f"""SELECT 'h08v04' AS tile, "row", col, obs_date, ((l_partkey * 37) % 5000)::INT AS elevation, {_VALUES}
        FROM (SELECT *, row_number() OVER (PARTITION BY "row", col, obs_date {_LAST}) AS rn FROM
              (SELECT *, (l_partkey // 50)::INT AS "row", (l_partkey % 50)::INT AS col, date_trunc('year', l_shipdate)::DATE AS obs_date FROM lineitem)) WHERE rn = 1""",
    "static": """SELECT 'h08v0' || (4 + s_suppkey % 2) AS tile, (s_suppkey // 10)::INT AS "row", (s_suppkey % 10)::INT AS col,
        floor(abs(s_acctbal))::INT % 5000 AS elevation, (s_suppkey * 7 % 101)::INT AS canopy_cover, (s_suppkey % 20)::INT AS ice_fraction,
        s_suppkey % 17 = 0 AS is_water, (s_suppkey % 45)::INT AS slope, (s_suppkey * 37 % 360 - 180)::INT AS aspect FROM supplier""",
    "bridge": """SELECT 'h08v0' || (4 + s_suppkey % 2) AS tile, (s_suppkey // 10)::INT AS "row", (s_suppkey % 10)::INT AS col, type, subdivision_id
        FROM supplier JOIN (SELECT n_nationkey AS k, 'adm0' AS type, n_nationkey::INT AS subdivision_id FROM nation
                            UNION ALL SELECT n_nationkey, 'groupadm0', (n_regionkey + 100)::INT FROM nation) ON s_nationkey = k""",
    "hier": """SELECT n_regionkey::INT AS group_id, (n_nationkey + 100)::INT AS id, (n_nationkey % 3)::INT AS display FROM nation
        UNION ALL SELECT (s_nationkey + 100)::INT, (s_suppkey + 1000)::INT, (s_suppkey % 3)::INT FROM supplier""",
    "names": "SELECT r_regionkey::INT AS id, r_name AS name FROM region UNION ALL SELECT (n_nationkey + 100)::INT, n_name FROM nation",
    "stat": """SELECT year(d) + (month(d) >= 10)::INT AS water_year, datediff('day', make_date(year(d) - (month(d) < 10)::INT, 10, 1), d) + 1 AS day,
        (o_custkey % 5)::INT AS subdivision_id, (o_custkey % 3)::INT AS var_id, 2 AS stat_id, o_totalprice AS stat_value, d + (o_orderkey % 100)::INT AS update_date
        FROM (SELECT *, o_orderdate::DATE AS d FROM orders)""",
    "daily": "SELECT water_year, day, subdivision_id, var_id, max(stat_value) AS stat_value FROM stat GROUP BY ALL",
    "files": """SELECT 'MOD09GA.A' || strftime(ts, '%Y%j') || '.h08v0' || (4 + user_id % 2) || '.061.' || event_id || '.hdf' AS file_name, ts AS edit_ts, event_id,
        ts::DATE AS obs_date, 'h08v0' || (4 + user_id % 2) AS tile FROM events""",
    "latest": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY tile, obs_date ORDER BY edit_ts DESC, file_name DESC) AS rn FROM files) WHERE rn = 1",
    "links": """SELECT DISTINCT 'region' || n_regionkey AS region, 'h08v0' || (4 + s_suppkey % 2) AS tile, 1 AS is_active
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "dense": """SELECT p.tile, p."row", p.col, c.d AS obs_date, px.* EXCLUDE (tile, "row", col, obs_date)
        FROM (SELECT DISTINCT tile, "row", col FROM px) p
        CROSS JOIN (SELECT unnest(range((SELECT min(obs_date) FROM px)::TIMESTAMP, (SELECT max(obs_date) + 1 FROM px)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d) c
        LEFT JOIN px ON px.tile = p.tile AND px."row" = p."row" AND px.col = p.col AND px.obs_date = c.d""",
}
NEEDS = {"daily": ["stat"], "latest": ["files"], "dense": ["px"]}


def sql(views: str, body: str, **ctes: str) -> str:
    """A statement over adapter views (names, space-separated) and further common table expressions."""
    wanted: list[str] = []
    for v in views.split():
        wanted += [x for x in (*NEEDS.get(v, []), v) if x not in wanted]
    parts = [f"{v} AS ({VIEWS[v]})" for v in wanted] + [f"{k} AS ({s})" for k, s in ctes.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
