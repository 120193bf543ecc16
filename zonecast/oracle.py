"""Reference SQL (DuckDB dialect) for every registered query.

Written independently of the DataFrame code, straight from the model's
definitions: brute-force pairs instead of the grid, plain joins instead of
pre-aggregation, ``quantile_cont`` instead of histogram refinement. Doubles
are written ``1e0``-style so both engines compute in binary floating point.
"""

from __future__ import annotations

import math

# the widget values of the registered queries; the range is that of the air measurements
SPAN = ("(SELECT min(DATE_OBSERVATION) FROM air)", "(SELECT max(DATE_OBSERVATION) FROM air)")
SPARSE_RANGE, SPARSE_RADIUS = ("DATE '1998-01-01'", "DATE '1998-02-28'"), "5e0"
NO_STATION_RADIUS = "0.01e0"
YEAR_1998 = ("DATE '1998-01-01'", "DATE '1998-12-31'")
RULE = "Q"              # of a range of more than two years
POLL = "'1-URGENT'"
RADIUS = "15e0"
ZONE = "'1'"
DEG = "0.017453292519943295e0"


def hav(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    x1, y1, x2, y2 = (f"({c} * {DEG})" for c in (lon1, lat1, lon2, lat2))
    sl = f"sin(({y2} - {y1}) / 2e0)"
    so = f"sin(({x2} - {x1}) / 2e0)"
    a = f"{sl} * {sl} + cos({y1}) * cos({y2}) * ({so} * {so})"
    return f"(6371e0 * (2e0 * asin(sqrt(least({a}, 1e0)))))"


def r6(x: str) -> str:
    return f"(round_even(({x}) * 1e6, 0) / 1e6)"


ZONES = """zones AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS GEOCODE, n.n_name AS GEONAME, r.r_name AS BOROUGH,
         40.5e0 + ((n.n_nationkey * 7) % 25) * 0.02e0 AS LATITUDE_ZONE,
         -74.25e0 + ((n.n_nationkey * 11) % 25) * 0.025e0 AS LONGITUDE_ZONE
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

WEATHER_RAW = """weather_raw AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS ID_STATION, s.s_name AS NAME,
         CAST(l.l_shipdate AS DATE) AS DATE,
         40.4e0 + ((s.s_suppkey * 37) % 100) * 0.006e0
           + CASE WHEN s.s_suppkey % 10 = 3 AND CAST(l.l_shipdate AS DATE) >= DATE '1999-01-01'
                  THEN 0.05e0 ELSE 0e0 END AS LATITUDE,
         -74.4e0 + ((s.s_suppkey * 53) % 100) * 0.0075e0 AS LONGITUDE,
         CASE WHEN l.l_partkey % 50 = 0 THEN NULL ELSE 20e0 + l.l_quantity * 1.6e0 END AS TEMP,
         CASE WHEN l.l_partkey % 40 = 1 THEN 9999.9e0
              ELSE 10e0 + l.l_quantity * 1.2e0 - l.l_discount * 100e0 END AS DEWP,
         CASE WHEN l.l_partkey % 30 = 2 THEN 999.9e0
              ELSE 2e0 + l.l_tax * 100e0 + (l.l_partkey % 13) END AS WDSP,
         s.s_nationkey AS S_NATIONKEY
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

def weather_sql(start: str, end: str) -> str:
    return f"""weather_conv AS (
  SELECT ID_STATION, NAME, LATITUDE, LONGITUDE, DATE,
         ((TEMP - 32e0) * 5e0) / 9e0 AS TEMP,
         ((DEWP - 32e0) * 5e0) / 9e0 AS DEWP,
         WDSP * 1.852e0 AS WDSP
  FROM weather_raw),
weather AS (SELECT * FROM weather_conv WHERE WDSP <= 150e0 AND DEWP <= 40e0),
weather_range AS (SELECT * FROM weather WHERE DATE BETWEEN {start} AND {end}),
stations AS (SELECT DISTINCT ID_STATION, NAME, LATITUDE, LONGITUDE FROM weather),
means AS (SELECT ID_STATION, avg(TEMP) AS TEMP, avg(WDSP) AS WDSP, avg(DEWP) AS DEWP
          FROM weather_range WHERE ID_STATION IS NOT NULL GROUP BY ID_STATION),
sw AS (SELECT s.ID_STATION, s.NAME, s.LATITUDE, s.LONGITUDE, m.TEMP, m.WDSP, m.DEWP
       FROM stations s JOIN means m ON s.ID_STATION = m.ID_STATION)"""

def pairs_sql(radius: str) -> str:
    return f"""zkeys AS (SELECT DISTINCT GEOCODE, LATITUDE_ZONE, LONGITUDE_ZONE FROM zones),
pairs AS (
  SELECT z.GEOCODE, z.LATITUDE_ZONE, z.LONGITUDE_ZONE, sw.*,
         {hav('z.LONGITUDE_ZONE', 'z.LATITUDE_ZONE', 'sw.LONGITUDE', 'sw.LATITUDE')} AS DIST_KM
  FROM zkeys z, sw
  WHERE {hav('z.LONGITUDE_ZONE', 'z.LATITUDE_ZONE', 'sw.LONGITUDE', 'sw.LATITUDE')} <= {radius})"""


PAIRS = pairs_sql(RADIUS)


def _idw(v: str, out: str) -> str:
    w = "(1e0 / (DIST_KM + 0.1e0))"
    return (f"round_even(CASE WHEN count({v}) = count(*) THEN sum({w} * {v}) / sum({w}) END * 10e0, 0)"
            f" / 10e0 AS {out}")


ZONE_WEATHER = f"""zm AS (
  SELECT GEOCODE, LATITUDE_ZONE, LONGITUDE_ZONE, {_idw('TEMP', 'W_TEMP')}, {_idw('WDSP', 'W_WIND')},
         {_idw('DEWP', 'W_DEWP')}, count(*) AS NB
  FROM pairs GROUP BY GEOCODE, LATITUDE_ZONE, LONGITUDE_ZONE),
zw AS (
  SELECT z.GEOCODE, zm.W_TEMP, zm.W_WIND, zm.W_DEWP, CAST(coalesce(zm.NB, 0) AS INTEGER) AS NB_STATIONS
  FROM zones z LEFT JOIN zm ON z.GEOCODE = zm.GEOCODE AND z.LATITUDE_ZONE = zm.LATITUDE_ZONE
                           AND z.LONGITUDE_ZONE = zm.LONGITUDE_ZONE)"""

AIR_RAW = """
  SELECT CASE WHEN o.o_orderkey % 101 = 0 THEN '999' ELSE CAST(c.c_nationkey AS VARCHAR) END AS GEOJOIN_ID,
         CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS DATE_MESURE_BRUTE,
         o.o_orderpriority AS NOM_POLLUANT,
         CASE WHEN o.o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o.o_totalprice AS VARCHAR) END AS VALEUR_BRUTE
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


def air_sql(start: str, end: str, raw: str | None = None, poll: str = POLL) -> str:
    return f"""air_raw AS ({raw or AIR_RAW}),
air_clean AS (
  SELECT GEOJOIN_ID, TRY_CAST(DATE_MESURE_BRUTE AS DATE) AS DATE_OBSERVATION, NOM_POLLUANT,
         TRY_CAST(VALEUR_BRUTE AS DOUBLE) AS VALEUR
  FROM air_raw WHERE TRY_CAST(VALEUR_BRUTE AS DOUBLE) IS NOT NULL),
air AS (
  SELECT a.GEOJOIN_ID, a.DATE_OBSERVATION, a.NOM_POLLUANT, a.VALEUR, z.GEONAME, z.LATITUDE_ZONE, z.LONGITUDE_ZONE
  FROM air_clean a JOIN zones z ON a.GEOJOIN_ID = z.GEOCODE),
air_range AS (SELECT * FROM air WHERE DATE_OBSERVATION BETWEEN {start} AND {end}),
pm AS (SELECT GEOJOIN_ID AS GEOCODE, avg(VALEUR) AS MEAN_POLLUANT FROM air_range
       WHERE NOM_POLLUANT = {poll} GROUP BY GEOJOIN_ID)"""

DISPLAY = """display AS (
  SELECT z.GEOCODE, z.GEONAME, z.BOROUGH,
         round_even(coalesce(pm.MEAN_POLLUANT, 0e0) * 100e0, 0) / 100e0 AS MEAN_POLLUANT,
         coalesce(zw.W_TEMP, 0e0) AS W_TEMP, zw.W_WIND, zw.W_DEWP,
         CAST(coalesce(zw.NB_STATIONS, 0) AS INTEGER) AS NB_STATIONS,
         z.LATITUDE_ZONE, z.LONGITUDE_ZONE
  FROM zones z LEFT JOIN pm ON z.GEOCODE = pm.GEOCODE LEFT JOIN zw ON z.GEOCODE = zw.GEOCODE)"""

KPI = """kpi AS (
  SELECT CASE WHEN count(*) = 0 THEN 0e0 ELSE avg(MEAN_POLLUANT) END AS AVG_POLLUANT,
         CASE WHEN count(*) = 0 THEN 0e0 ELSE avg(nullif(W_TEMP, 0e0)) END AS AVG_TEMP,
         CASE WHEN count(*) = 0 THEN 0e0 ELSE avg(nullif(W_WIND, 0e0)) END AS AVG_WIND,
         CAST(count(*) AS INTEGER) AS NB_ZONES
  FROM display WHERE MEAN_POLLUANT > 0e0)"""

ACTIVE = """active AS (
  SELECT s.ID_STATION, s.NAME, s.LATITUDE, s.LONGITUDE
  FROM (SELECT DISTINCT ID_STATION FROM weather_range) a JOIN stations s ON a.ID_STATION = s.ID_STATION)"""

SEL_ZONE = f"""sel AS (
  SELECT LATITUDE_ZONE, LONGITUDE_ZONE FROM zones WHERE GEOCODE = {ZONE}
  ORDER BY GEOCODE, LATITUDE_ZONE, LONGITUDE_ZONE LIMIT 1)"""

AIR = air_sql(*SPAN)
W_ALL = ",\n".join([ZONES, WEATHER_RAW, AIR, weather_sql(*SPAN)])
DASH = ",\n".join([W_ALL, PAIRS, ZONE_WEATHER, DISPLAY])
W_1998 = ",\n".join([ZONES, WEATHER_RAW, air_sql(*YEAR_1998), weather_sql(*YEAR_1998)])
W_SPARSE = ",\n".join([ZONES, WEATHER_RAW, air_sql(*SPARSE_RANGE), weather_sql(*SPARSE_RANGE)])
DASH_SPARSE = ",\n".join([W_SPARSE, pairs_sql(SPARSE_RADIUS), ZONE_WEATHER, DISPLAY])
DASH_NO_STATION = ",\n".join([W_ALL, pairs_sql(NO_STATION_RADIUS), ZONE_WEATHER, DISPLAY])
DASH_NO_MEASUREMENT = ",\n".join([ZONES, WEATHER_RAW, air_sql(*SPAN, poll="'none such'"), weather_sql(*SPAN), PAIRS, ZONE_WEATHER, DISPLAY])
DASH_1998 = ",\n".join([W_1998, PAIRS, ZONE_WEATHER, DISPLAY])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _bucket(d: str, rule: str) -> str:
    return {"D": d,
            "W": f"CAST({d} + (7 - isodow({d})) * INTERVAL 1 DAY AS DATE)",
            "M": f"last_day({d})",
            "Q": f"last_day(CAST(date_trunc('quarter', {d}) + INTERVAL 2 MONTH AS DATE))"}[rule]


def _calendar(lo: str, hi: str, rule: str, out: str) -> str:
    if rule in ("D", "W"):
        step = "1 DAY" if rule == "D" else "7 DAY"
        return (f"SELECT CAST(g AS DATE) AS {out} FROM "
                f"(SELECT unnest(generate_series(CAST({lo} AS TIMESTAMP), CAST({hi} AS TIMESTAMP), "
                f"INTERVAL {step})) AS g)")
    unit, step, shift = ("month", "1 MONTH", "0 MONTH") if rule == "M" else ("quarter", "3 MONTH", "2 MONTH")
    return (f"SELECT last_day(CAST(g + INTERVAL {shift} AS DATE)) AS {out} FROM "
            f"(SELECT unnest(generate_series(CAST(date_trunc('{unit}', {lo}) AS TIMESTAMP), "
            f"CAST(date_trunc('{unit}', {hi}) AS TIMESTAMP), INTERVAL {step})) AS g)")


def resample_sql(src: str, date_col: str, values: tuple[str, ...], rule: str, out: str) -> str:
    avgs = ", ".join(f"avg({v}) AS {v}" for v in values)
    per = f"SELECT {_bucket(date_col, rule)} AS {out}, {avgs} FROM {src} WHERE {date_col} IS NOT NULL GROUP BY 1"
    cal = _calendar("(SELECT min(" + out + ") FROM per)", "(SELECT max(" + out + ") FROM per)", rule, out)
    cols = ", ".join(f"per.{v}" for v in values)
    return (f"per AS ({per}), cal AS ({cal})\n"
            f"SELECT cal.{out}, {cols} FROM cal LEFT JOIN per ON cal.{out} = per.{out}")


def dashboard_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["unit_convert"] = _with(W_ALL) + \
        "SELECT ID_STATION, NAME, LATITUDE, LONGITUDE, DATE, TEMP, DEWP, WDSP FROM weather_conv"
    q["outlier_filter"] = _with(W_ALL) + \
        "SELECT ID_STATION, NAME, LATITUDE, LONGITUDE, DATE, TEMP, DEWP, WDSP FROM weather"
    q["date_range_filter"] = _with(W_1998) + \
        "SELECT ID_STATION, NAME, LATITUDE, LONGITUDE, DATE, TEMP, DEWP, WDSP FROM weather_range"
    q["station_dim"] = _with(W_ALL) + "SELECT * FROM stations"
    q["station_means"] = _with(W_ALL) + "SELECT * FROM means"
    q["haversine"] = _with(W_ALL) + (
        "SELECT s.*, " + r6(hav("c.LON_C", "c.LAT_C", "s.LONGITUDE", "s.LATITUDE")) + " AS DIST_CENTER_KM\n"
        "FROM stations s, (SELECT avg(LATITUDE_ZONE) AS LAT_C, avg(LONGITUDE_ZONE) AS LON_C FROM zones) c")
    row_pairs = (f"SELECT z.GEOCODE, z.LATITUDE_ZONE, z.LONGITUDE_ZONE, sw.ID_STATION, sw.NAME, sw.LATITUDE,"
                 f" sw.LONGITUDE, {hav('z.LONGITUDE_ZONE', 'z.LATITUDE_ZONE', 'sw.LONGITUDE', 'sw.LATITUDE')}"
                 f" AS DIST_KM FROM zones z, sw WHERE "
                 f"{hav('z.LONGITUDE_ZONE', 'z.LATITUDE_ZONE', 'sw.LONGITUDE', 'sw.LATITUDE')} <= {RADIUS}")
    radius = _with(W_ALL) + (
        f", rp AS ({row_pairs})\n"
        "SELECT GEOCODE, LATITUDE_ZONE, LONGITUDE_ZONE, ID_STATION, NAME, LATITUDE, LONGITUDE, "
        + r6("DIST_KM") + " AS DIST_KM FROM rp\n"
        "UNION ALL SELECT GEOCODE, LATITUDE_ZONE, LONGITUDE_ZONE, NULL, NULL, NULL, NULL, NULL FROM zones z\n"
        "WHERE NOT EXISTS (SELECT 1 FROM rp WHERE rp.GEOCODE = z.GEOCODE\n"
        "  AND rp.LATITUDE_ZONE = z.LATITUDE_ZONE AND rp.LONGITUDE_ZONE = z.LONGITUDE_ZONE)")
    q["radius_join"] = radius
    q["radius_join_grid"] = radius
    q["radius_join_divided"] = radius
    q["zone_weather_idw"] = _with(W_ALL, PAIRS, ZONE_WEATHER) + "SELECT * FROM zw"
    q["pollutant_zone_mean"] = _with(ZONES, AIR) + "SELECT * FROM pm"
    q["zone_display"] = _with(DASH) + (
        "SELECT GEOCODE, GEONAME, BOROUGH, MEAN_POLLUANT, W_TEMP, W_WIND, W_DEWP, NB_STATIONS FROM display")
    q["zone_display_1998"] = q["zone_display"].replace(DASH, DASH_1998)
    q["clean_air"] = _with(ZONES, AIR) + "SELECT * FROM air_clean"
    q["air_zone_join"] = _with(ZONES, AIR) + "SELECT * FROM air"
    q["date_bounds"] = _with(ZONES, AIR) + \
        "SELECT min(DATE_OBSERVATION) AS MIN_DATE, max(DATE_OBSERVATION) AS MAX_DATE FROM air"
    q["pollutant_list"] = _with(ZONES, AIR) + \
        "SELECT DISTINCT NOM_POLLUANT FROM air_range WHERE VALEUR IS NOT NULL ORDER BY 1"
    q["zone_options"] = _with(ZONES) + (
        "SELECT 'Tous quartiers' AS OPTION, CAST(NULL AS VARCHAR) AS GEOCODE, 0 AS GROUP_ORDER\n"
        "UNION ALL SELECT GEONAME, GEOCODE, 1 FROM zones")
    q["zone_lookup"] = _with(ZONES) + (
        "SELECT 'code_for_name' AS LOOKUP, GEONAME AS KEY, min(GEOCODE) AS VALUE FROM zones GROUP BY GEONAME\n"
        "UNION ALL SELECT 'name_for_code', GEOCODE, min(GEONAME) FROM zones GROUP BY GEOCODE")
    q["resample_rule"] = _with(ZONES, AIR) + (
        "SELECT MIN_DATE, MAX_DATE, CAST(date_diff('day', MIN_DATE, MAX_DATE) AS INTEGER) AS DELTA_DAYS,\n"
        "  CASE WHEN date_diff('day', MIN_DATE, MAX_DATE) > 730 THEN 'Q'\n"
        "       WHEN date_diff('day', MIN_DATE, MAX_DATE) > 180 THEN 'M'\n"
        "       WHEN date_diff('day', MIN_DATE, MAX_DATE) > 60 THEN 'W' ELSE 'D' END AS RULE\n"
        "FROM (SELECT min(DATE_OBSERVATION) AS MIN_DATE, max(DATE_OBSERVATION) AS MAX_DATE FROM air)")
    for name, rule in (("day", "D"), ("week", "W"), ("month", "M"), ("quarter", "Q")):
        q[f"resample_{name}"] = _with(W_ALL) + ", " + resample_sql(
            "weather_range", "DATE", ("TEMP", "WDSP", "DEWP"), rule, "DATE")
    q["resample_air"] = _with(ZONES, AIR) + ", " + resample_sql(
        f"(SELECT * FROM air_range WHERE NOM_POLLUANT = {POLL})", "DATE_OBSERVATION", ("VALEUR",),
        RULE, "DATE_OBSERVATION")
    air_series = resample_sql(f"(SELECT * FROM air_range WHERE NOM_POLLUANT = {POLL})",
                              "DATE_OBSERVATION", ("VALEUR",), RULE, "BUCKET")
    w_series = resample_sql("weather_range", "DATE", ("TEMP", "WDSP", "DEWP"), RULE, "BUCKET")
    q["paired_series"] = _with(W_ALL) + (
        f", a AS (WITH {air_series}), w AS (WITH {w_series})\n"
        "SELECT coalesce(a.BUCKET, w.BUCKET) AS BUCKET, a.VALEUR, w.TEMP, w.WDSP, w.DEWP\n"
        "FROM a FULL OUTER JOIN w ON a.BUCKET = w.BUCKET")
    q["kpi_global"] = _with(DASH, KPI) + "SELECT * FROM kpi"
    fmt = lambda c, d, unit: (
        f"coalesce(printf('%.{d}f', {c})" + (f" || '{unit}'" if unit else "")
        + ", 'N/A')")
    q["kpi_formatted"] = _with(DASH, KPI) + (
        f"SELECT {fmt('AVG_POLLUANT', 2, '')} AS VAL_POLLUANT, {fmt('AVG_TEMP', 1, ' °C')} AS VAL_TEMP, "
        f"{fmt('AVG_WIND', 1, ' km/h')} AS VAL_WIND FROM kpi")
    q["zone_detail"] = _with(DASH) + (
        "SELECT GEOCODE, GEONAME AS TITLE,\n"
        "  'Borough: ' || BOROUGH || ' | Stations locales : ' || CAST(NB_STATIONS AS VARCHAR) AS CAPTION,\n"
        "  MEAN_POLLUANT AS AVG_POLLUANT, W_TEMP AS AVG_TEMP, W_WIND AS AVG_WIND\n"
        f"FROM display WHERE GEOCODE = {ZONE}\n"
        "ORDER BY GEOCODE, GEONAME, BOROUGH, MEAN_POLLUANT, W_TEMP, W_WIND, W_DEWP, NB_STATIONS LIMIT 1")
    q["active_stations"] = _with(W_ALL, ACTIVE) + "SELECT * FROM active"
    q["stations_near_center"] = _with(W_ALL, ACTIVE) + (
        "SELECT c.LAT_C AS LATITUDE_CENTER, c.LON_C AS LONGITUDE_CENTER,\n"
        "  CAST((SELECT count(*) FROM active s WHERE "
        + hav("c.LON_C", "c.LAT_C", "s.LONGITUDE", "s.LATITUDE") + f" <= {RADIUS}) AS INTEGER) AS NB_VISIBLE\n"
        "FROM (SELECT avg(LATITUDE_ZONE) AS LAT_C, avg(LONGITUDE_ZONE) AS LON_C FROM zones) c")
    q["stations_near_zone"] = _with(W_ALL, ACTIVE, SEL_ZONE) + (
        f"SELECT {ZONE} AS GEOCODE, CAST(count(*) AS INTEGER) AS NB_VISIBLE FROM active s, sel c WHERE "
        + hav("c.LONGITUDE_ZONE", "c.LATITUDE_ZONE", "s.LONGITUDE", "s.LATITUDE") + f" <= {RADIUS}")
    q["local_weather"] = _with(W_ALL, SEL_ZONE) + (
        "SELECT w.ID_STATION, w.NAME, w.LATITUDE, w.LONGITUDE, w.DATE, w.TEMP, w.DEWP, w.WDSP\n"
        "FROM weather_range w WHERE w.ID_STATION IN (SELECT s.ID_STATION FROM stations s, sel c WHERE "
        + hav("c.LONGITUDE_ZONE", "c.LATITUDE_ZONE", "s.LONGITUDE", "s.LATITUDE") + f" <= {RADIUS})")
    q["zone_display_sparse"] = q["zone_display"].replace(DASH, DASH_SPARSE)
    q["kpi_global_sparse"] = _with(DASH_SPARSE, KPI) + "SELECT * FROM kpi"
    q["kpi_formatted_no_station"] = q["kpi_formatted"].replace(DASH, DASH_NO_STATION)
    q["kpi_global_no_measurement"] = _with(DASH_NO_MEASUREMENT, KPI) + "SELECT * FROM kpi"
    q["resample_air_empty"] = _with(ZONES, AIR) + ", " + resample_sql(
        "(SELECT * FROM air_range WHERE NOM_POLLUANT = 'none such')", "DATE_OBSERVATION", ("VALEUR",), RULE, "DATE_OBSERVATION")
    near_zone = ("(SELECT w.* FROM weather_range w WHERE w.ID_STATION IN (SELECT s.ID_STATION FROM stations s, sel c WHERE "
                 + hav("c.LONGITUDE_ZONE", "c.LATITUDE_ZONE", "s.LONGITUDE", "s.LATITUDE") + f" <= {SPARSE_RADIUS}))")
    a_days = resample_sql(f"(SELECT * FROM air_range WHERE NOM_POLLUANT = {POLL} AND GEOJOIN_ID = {ZONE})",
                          "DATE_OBSERVATION", ("VALEUR",), "D", "BUCKET")
    w_days = resample_sql(near_zone, "DATE", ("TEMP", "WDSP", "DEWP"), "D", "BUCKET")
    q["paired_series_sparse"] = _with(W_SPARSE, SEL_ZONE) + (
        f", a AS (WITH {a_days}), w AS (WITH {w_days})\n"
        "SELECT coalesce(a.BUCKET, w.BUCKET) AS BUCKET, a.VALEUR, w.TEMP, w.WDSP, w.DEWP\n"
        "FROM a FULL OUTER JOIN w ON a.BUCKET = w.BUCKET")
    local_w = ("(SELECT w.* FROM weather_range w WHERE w.ID_STATION IN (SELECT s.ID_STATION FROM stations s, sel c"
               " WHERE " + hav("c.LONGITUDE_ZONE", "c.LATITUDE_ZONE", "s.LONGITUDE", "s.LATITUDE")
               + f" <= {RADIUS}))")
    a_series = resample_sql(f"(SELECT * FROM air_range WHERE NOM_POLLUANT = {POLL} AND GEOJOIN_ID = {ZONE})",
                            "DATE_OBSERVATION", ("VALEUR",), RULE, "BUCKET")
    lw_series = resample_sql(local_w, "DATE", ("TEMP", "WDSP", "DEWP"), RULE, "BUCKET")
    q["paired_series_local"] = _with(W_ALL, SEL_ZONE) + (
        f", a AS (WITH {a_series}), w AS (WITH {lw_series})\n"
        "SELECT coalesce(a.BUCKET, w.BUCKET) AS BUCKET, a.VALEUR, w.TEMP, w.WDSP, w.DEWP\n"
        "FROM a FULL OUTER JOIN w ON a.BUCKET = w.BUCKET")
    fine = ", ".join(f"round_even({v} * 1e{k}, 0) / 1e{k} AS {v}" for v, k in (("VALEUR", 7), ("TEMP", 9), ("WDSP", 9), ("DEWP", 9)))
    q["paired_series_local"] = f"SELECT BUCKET, {fine} FROM ({q['paired_series_local']})"
    q["paired_series_sparse"] = f"SELECT BUCKET, {fine} FROM ({q['paired_series_sparse']})"
    sums = ", ".join(f"round_even(sum({v}) * 1e6, 0) / 1e6 AS S_{v}, count({v}) AS N_{v}" for v in ("TEMP", "WDSP", "DEWP"))
    q["weather_daily"] = _with(W_ALL) + (
        f"SELECT ID_STATION, LATITUDE, LONGITUDE, DATE, {sums} FROM weather GROUP BY ID_STATION, LATITUDE, LONGITUDE, DATE")
    q["air_daily"] = _with(ZONES, AIR) + (
        "SELECT GEOJOIN_ID, DATE_OBSERVATION, NOM_POLLUANT, round_even(sum(VALEUR) * 1e2, 0) / 1e2 AS S_VALEUR,\n"
        "  count(VALEUR) AS N_VALEUR FROM air_clean GROUP BY GEOJOIN_ID, DATE_OBSERVATION, NOM_POLLUANT")
    q["zone_display_daily"] = q["zone_display"]
    q["paired_series_daily"] = f"SELECT BUCKET, {fine} FROM ({q['paired_series']})"
    q["box_stats"] = _box_sql(_with(W_ALL), "weather_range")
    q["box_stats_local"] = _box_sql(_with(W_ALL, SEL_ZONE), local_w)
    return q


def _box_sql(prefix: str, src: str) -> str:
    return prefix + (
        f", src AS (SELECT * FROM {src}),\n"
        "long AS (SELECT 'TEMP' AS VARIABLE, TEMP AS v FROM src UNION ALL\n"
        "  SELECT 'WDSP', WDSP FROM src UNION ALL SELECT 'DEWP', DEWP FROM src),\n"
        "q AS (SELECT VARIABLE,\n"
        + ",\n".join(f"  quantile_cont(v, {p}) AS {n}"
                     for p, n in ((0.25, "Q1"), (0.5, "MEDIAN"), (0.75, "Q3")))
        + "\n  FROM long WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY VARIABLE),\n"
        "f AS (SELECT *, Q1 - 1.5e0 * (Q3 - Q1) AS lf, Q3 + 1.5e0 * (Q3 - Q1) AS uf FROM q)\n"
        f"SELECT f.VARIABLE, {r6('f.Q1')} AS Q1, {r6('f.MEDIAN')} AS MEDIAN, {r6('f.Q3')} AS Q3, count(*) AS N,\n"
        "  min(CASE WHEN v >= lf THEN v END) AS LOWER_WHISKER, max(CASE WHEN v <= uf THEN v END) AS UPPER_WHISKER,\n"
        "  count(CASE WHEN NOT (v >= lf AND v <= uf) THEN 1 END) AS N_OUTLIERS\n"
        "FROM long JOIN f ON long.VARIABLE = f.VARIABLE WHERE v IS NOT NULL AND NOT isnan(v)\n"
        "GROUP BY f.VARIABLE, f.Q1, f.MEDIAN, f.Q3")


# --- ingest side ------------------------------------------------------------

STATION_LIST = """station_list AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') || CASE WHEN s_suppkey % 6 = 0 THEN '  ' ELSE '' END AS USAF,
         '00' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS WBAN,
         CASE WHEN s_suppkey % 10 <> 9 THEN s_name END AS "STATION NAME",
         CASE WHEN s_suppkey % 10 <> 7 THEN 40.4e0 + ((s_suppkey * 37) % 100) * 0.006e0 END AS LAT,
         (-74.4e0 + ((s_suppkey * 53) % 100) * 0.0075e0) - CASE WHEN s_suppkey % 10 = 5 THEN 3e0 ELSE 0e0 END AS LON
  FROM supplier),
keyed AS (
  SELECT USAF, WBAN, "STATION NAME", LAT AS LATITUDE, LON AS LONGITUDE, trim(USAF) || trim(WBAN) AS STN_ID
  FROM station_list),
kept AS (SELECT * FROM keyed WHERE LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL AND "STATION NAME" IS NOT NULL),
boxed AS (SELECT * FROM kept WHERE LATITUDE BETWEEN 40.0e0 AND 41.5e0 AND LONGITUDE BETWEEN -75.0e0 AND -73.0e0)"""

MANIFEST = """files AS (
  SELECT *, CAST(year(DATE) AS INTEGER) AS YEAR,
         lpad(ID_STATION, 6, '0') || '00' || lpad(CAST(S_NATIONKEY AS VARCHAR), 3, '0') AS STN_ID
  FROM weather_raw WHERE (CAST(ID_STATION AS BIGINT) + year(DATE)) % 7 <> 0),
landed AS (SELECT DISTINCT YEAR, STN_ID FROM files),
manifest AS (
  SELECT s.STN_ID, CAST(y.YEAR AS INTEGER) AS YEAR, CAST(y.YEAR AS VARCHAR) || '/' || s.STN_ID || '.csv' AS REL_PATH
  FROM (SELECT DISTINCT STN_ID FROM boxed WHERE STN_ID IS NOT NULL) s
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(YEAR) FROM landed), (SELECT max(YEAR) FROM landed))) AS YEAR) y)"""

FEED = """feed AS (
  SELECT CASE WHEN o.o_orderkey % 101 = 0 THEN '999' ELSE CAST(c.c_nationkey AS VARCHAR) END AS GEOJOIN_ID,
         CASE WHEN o.o_orderkey % 83 = 7 THEN '31/31/1998'
              ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS DATE_MESURE_BRUTE,
         o.o_orderpriority AS NOM_POLLUANT,
         CASE WHEN o.o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o.o_totalprice AS VARCHAR) END AS VALEUR_BRUTE,
         CAST(o.o_orderkey AS VARCHAR) AS col_1,
         '{"owner":' || CAST(o.o_custkey AS VARCHAR) || '}' AS col_3,
         CASE o.o_orderkey % 89 WHEN 3 THEN 19 WHEN 5 THEN 21 ELSE 20 END AS WIDTH
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

AIR_OF_FEED = air_sql(*SPAN, raw="SELECT * FROM feed WHERE WIDTH = 20")

# vertices of the zones' geometry, in thousandths of a degree from the centre; codes divisible by m have them
VERTICES = """verts(part, ring, k, dx, dy, m) AS (VALUES
  (0, 0, 0, -10, -10, 1), (0, 0, 1, 12, -10, 1), (0, 0, 2, 15, 4, 1), (0, 0, 3, 0, 11, 1), (0, 0, 4, -9, 6, 1),
  (0, 0, 5, -10, -10, 1), (0, 1, 0, 2, -3, 2), (0, 1, 1, 6, -3, 2), (0, 1, 2, 2, 1, 2), (0, 1, 3, 2, -3, 2),
  (1, 0, 0, 20, 20, 4), (1, 0, 1, 27, 20, 4), (1, 0, 2, 20, 23, 4), (1, 0, 3, 20, 20, 4)),
geometry AS (
  SELECT z.GEOCODE, v.part, v.ring, v.k, z.LONGITUDE_ZONE + v.dx * 0.001e0 AS x, z.LATITUDE_ZONE + v.dy * 0.001e0 AS y,
         row_number() OVER (PARTITION BY z.GEOCODE ORDER BY v.part, v.ring, v.k) AS nth
  FROM zones z JOIN verts v ON CAST(z.GEOCODE AS BIGINT) % v.m = 0),
vertex_sums AS (
  SELECT GEOCODE, round_even(sum(nth * x) * 1e6, 0) / 1e6 AS X_SUM, round_even(sum(nth * y) * 1e6, 0) / 1e6 AS Y_SUM,
         count(*) AS N_POINTS, count(DISTINCT (part, ring)) AS N_RINGS, count(DISTINCT part) AS N_POLYGONS
  FROM geometry GROUP BY GEOCODE)"""


def _cone() -> tuple[float, float, float, float, float]:
    """Eccentricity, n, F, rho0 and axis of the conic (EPSG:2263 on GRS80, metres, no false easting)."""
    f = 1 / 298.257222101
    e = math.sqrt(2 * f - f * f)
    lat = lambda d, m: math.radians(d + m / 60)
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    n = math.log(m(lat(41, 2)) / m(lat(40, 40))) / math.log(t(lat(41, 2)) / t(lat(40, 40)))
    big_f = m(lat(41, 2)) / (n * t(lat(41, 2)) ** n)
    return e, n, big_f, 6378137.0 * big_f * t(lat(40, 10)) ** n, 6378137.0


def centroid_sql(projected: bool) -> str:
    """CTE centroid(GEOCODE, lon, lat): by the shoelace formula, in degrees or in the conic's plane."""
    e, n, big_f, rho0, axis = (f"{v!r}e0" if "e" not in repr(v) else repr(v) for v in _cone())
    pi = f"{math.pi!r}e0"
    x, y = "x", "y"
    planar = "plane AS (SELECT GEOCODE, part, ring, k, x, y FROM geometry)"
    if projected:
        es = f"({e} * sin(radians(y)))"
        t = f"(tan({pi} / 4e0 - radians(y) / 2e0) / pow((1e0 - {es}) / (1e0 + {es}), {e} / 2e0))"
        rho, theta = f"({axis} * {big_f} * pow({t}, {n}))", f"({n} * radians(x + 74e0))"
        planar = f"""plane AS (SELECT GEOCODE, part, ring, k, {rho} * sin({theta}) AS x,
  {rho0} - {rho} * cos({theta}) AS y FROM geometry)"""
    out = f"""{planar},
near AS (SELECT *, {x} - min({x}) OVER (PARTITION BY GEOCODE) AS u, {y} - min({y}) OVER (PARTITION BY GEOCODE) AS v,
         min({x}) OVER (PARTITION BY GEOCODE) AS x0, min({y}) OVER (PARTITION BY GEOCODE) AS y0 FROM plane),
edges AS (SELECT *, lead(u) OVER w AS u2, lead(v) OVER w AS v2 FROM near WINDOW w AS (PARTITION BY GEOCODE, part, ring ORDER BY k)),
rings AS (SELECT GEOCODE, part, ring, any_value(x0) AS x0, any_value(y0) AS y0, sum(u * v2 - u2 * v) AS a,
          sum((u + u2) * (u * v2 - u2 * v)) AS mx, sum((v + v2) * (u * v2 - u2 * v)) AS my
          FROM edges WHERE u2 IS NOT NULL GROUP BY GEOCODE, part, ring),
middle AS (SELECT GEOCODE, any_value(x0) + sum(s * mx) / (3e0 * sum(s * a)) AS x, any_value(y0) + sum(s * my) / (3e0 * sum(s * a)) AS y
           FROM (SELECT *, sign(a) * CASE WHEN ring = 0 THEN 1 ELSE -1 END AS s FROM rings) GROUP BY GEOCODE)"""
    if not projected:
        return out + ",\ncentroid AS (SELECT GEOCODE, x AS lon, y AS lat FROM middle)"
    out += f""",
polar AS (SELECT GEOCODE, atan2(x, {rho0} - y) / {n} AS theta,
          pow(sqrt(x * x + ({rho0} - y) * ({rho0} - y)) / ({axis} * {big_f}), 1e0 / {n}) AS t FROM middle),
turn0 AS (SELECT *, {pi} / 2e0 - 2e0 * atan(t) AS phi FROM polar)"""
    for i in range(8):
        es = f"({e} * sin(phi))"
        out += f""",
turn{i + 1} AS (SELECT GEOCODE, theta, t, {pi} / 2e0 - 2e0 * atan(t * pow((1e0 - {es}) / (1e0 + {es}), {e} / 2e0)) AS phi
          FROM turn{i})"""
    return out + ",\ncentroid AS (SELECT GEOCODE, degrees(theta) - 74e0 AS lon, degrees(phi) AS lat FROM turn8)"

_EVEN = "(CAST(GEOCODE AS BIGINT) % 2 = 0)"


def ingest_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base = _with(ZONES, WEATHER_RAW, STATION_LIST, MANIFEST)
    q["scan_stations_csv"] = _with(STATION_LIST) + "SELECT * FROM station_list"
    q["station_key"] = _with(STATION_LIST) + "SELECT * FROM keyed"
    q["drop_null_subset"] = _with(STATION_LIST) + "SELECT * FROM kept"
    q["bbox_filter"] = _with(STATION_LIST) + "SELECT * FROM boxed"
    q["ingest_manifest"] = base + "SELECT * FROM manifest"
    q["manifest_existing"] = base + \
        "SELECT * FROM manifest m WHERE EXISTS (SELECT 1 FROM landed l WHERE l.YEAR = m.YEAR AND l.STN_ID = m.STN_ID)"
    q["required_inputs"] = f"SELECT REL_PATH FROM ({q['manifest_existing']})"
    q["manifest_missing"] = base + \
        "SELECT * FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.YEAR = m.YEAR AND l.STN_ID = m.STN_ID)"
    rows = "SELECT ID_STATION, NAME, LATITUDE, LONGITUDE, {} AS DATE, TEMP, DEWP, WDSP FROM files f " \
        "WHERE EXISTS (SELECT 1 FROM manifest m WHERE m.YEAR = f.YEAR AND m.STN_ID = f.STN_ID)"
    files = base + rows.format("CAST(DATE AS VARCHAR)")
    q["scan_weather_csv"] = files
    q["weather_etl"] = base + rows.format("DATE")
    q["stream_ingest_weather"] = files
    q["weather_lite"] = _with(ZONES, WEATHER_RAW) + \
        "SELECT ID_STATION, NAME, LATITUDE, LONGITUDE, DATE, TEMP, DEWP, WDSP FROM weather_raw"
    q["sink_parquet_roundtrip"] = _with(ZONES, WEATHER_RAW) + (
        "SELECT ID_STATION, NAME, LATITUDE, LONGITUDE, DATE, TEMP, DEWP, WDSP FROM weather_raw")
    q["layer_year_1998"] = q["sink_parquet_roundtrip"] + " WHERE year(DATE) = 1998"
    q["scan_json_rows"] = _with(FEED) + "SELECT * EXCLUDE (WIDTH) FROM feed WHERE WIDTH = 20"
    q["scan_json_envelope"] = q["scan_json_array"] = q["scan_json_rows"]
    q["rejected_json_records"] = _with(FEED) + \
        "SELECT CAST(WIDTH AS INTEGER) AS WIDTH, count(*) AS N_RECORDS FROM feed WHERE WIDTH <> 20 GROUP BY WIDTH"
    kind = f"CASE WHEN {_EVEN} THEN 'MultiPolygon' ELSE 'Polygon' END AS GEOM_TYPE"
    q["sink_geojson"] = _with(ZONES, VERTICES) + (
        f"SELECT GEOCODE, 'Feature' AS FEATURE_TYPE, {kind}, X_SUM, Y_SUM FROM zones JOIN vertex_sums USING (GEOCODE)")
    q["scan_geojson"] = _with(ZONES, VERTICES) + (
        f"SELECT GEOCODE, GEONAME, BOROUGH, {kind}, CAST(N_POLYGONS AS INTEGER) AS N_POLYGONS,\n"
        "  CAST(N_RINGS AS INTEGER) AS N_RINGS, CAST(N_POINTS AS INTEGER) AS N_POINTS, X_SUM, Y_SUM\n"
        "FROM zones JOIN vertex_sums USING (GEOCODE)")
    for name, projected, digits in (("zone_centroid", False, "1e9"), ("zone_centroid_projected", True, "1e6")):
        q[name] = _with(ZONES, VERTICES, centroid_sql(projected)) + (
            f"SELECT GEOCODE, round_even(lat * {digits}, 0) / {digits} AS LATITUDE_ZONE,\n"
            f"  round_even(lon * {digits}, 0) / {digits} AS LONGITUDE_ZONE FROM centroid")
    q["stream_ingest_air"] = _with(ZONES, FEED, AIR_OF_FEED) + "SELECT * FROM air"
    q["air_etl"] = _with(ZONES, FEED, AIR_OF_FEED, VERTICES, centroid_sql(False)) + (
        "SELECT GEOJOIN_ID, DATE_OBSERVATION, NOM_POLLUANT, VALEUR, GEONAME,\n"
        "  round_even(c.lat * 1e9, 0) / 1e9 AS LATITUDE_ZONE, round_even(c.lon * 1e9, 0) / 1e9 AS LONGITUDE_ZONE\n"
        "FROM air JOIN centroid c ON air.GEOJOIN_ID = c.GEOCODE")
    return q


def queries_sql() -> dict[str, str]:
    return {**dashboard_sql(), **ingest_sql()}
