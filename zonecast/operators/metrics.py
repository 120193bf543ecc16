"""Aggregations behind the zone map, the indicators and the station views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.geo import idw_weight
from zonecast.functions.numeric import round_half_even
from zonecast.functions.text import format_fixed
from zonecast.operators.clean import STATION_COLUMNS, lit_date
from zonecast.operators.membership import semi_join_filtered
from zonecast.operators.partials import mean, present, totals
from zonecast.operators.spatial import radius_join_left, radius_pairs

WEATHER_VARS = ("TEMP", "WDSP", "DEWP")
# zone metric name for each weather variable
ZONE_METRIC = {"TEMP": "W_TEMP", "WDSP": "W_WIND", "DEWP": "W_DEWP"}
ZONE_KEY = ("GEOCODE", "LATITUDE_ZONE", "LONGITUDE_ZONE")
SPREAD = 16        # groups of a station's variants
ALL_ZONES_LABEL = "Tous quartiers"   # fixed value: the "all zones" option label


def station_means(weather_in_range: DataFrame) -> DataFrame:
    """Mean TEMP, WDSP, DEWP per station id (NULLs skipped; hash aggregate
    with map-side partial sums, so a hot station costs one row per task).
    Rows without a station id form no group (as a pandas groupby)."""
    return (weather_in_range.where(F.col("ID_STATION").isNotNull())
            .groupBy("ID_STATION").agg(*[mean(weather_in_range, v).alias(v) for v in WEATHER_VARS]))


def stations_with_means(weather: DataFrame, start, end, names: DataFrame | None = None) -> DataFrame:
    """Station dimension rows (all dates) carrying their station's means over
    [start, end]; stations without a row in range are dropped.

    One pass over the observations: a renamed or moved station keeps one
    row per variant, each with the id-level mean (the fan-out of the model).
    Variants are mergeable partial sums, spread over SPREAD groups an id, so
    that an id with very many of them never meets in one task.

    With ``names`` (ID_STATION, NAME), the observations carry no name and
    the name dimension is joined after aggregation: the shuffle then moves
    one row per station position instead of every observation.
    """
    keys = [c for c in STATION_COLUMNS if c != "NAME" or names is None]
    in_range = F.col("DATE").between(lit_date(start), lit_date(end))
    parts = {"_rows": F.count(F.when(in_range, F.lit(1)))}
    for v in WEATHER_VARS:
        parts[f"_s_{v}"], parts[f"_n_{v}"] = totals(weather, v, in_range)
    per_variant = weather.where(F.col("ID_STATION").isNotNull()).groupBy(*keys).agg(
        *[agg.alias(c) for c, agg in parts.items()])
    total = [F.sum(c).alias(c) for c in parts]
    # an id's variants lie in SPREAD groups; each group gets the sums of all of them, and keeps its own variants
    variant = F.struct(*[c for c in keys if c != "ID_STATION"])
    groups = (per_variant.groupBy("ID_STATION", F.pmod(F.xxhash64(variant), F.lit(SPREAD)).alias("_g"))
              .agg(*total, F.collect_list(variant).alias("_v")))
    shared = groups.select("ID_STATION", *parts, F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_to"),
                           F.when(F.col("_to") == F.col("_g"), F.col("_v")).alias("_v"))
    by_id = (shared.groupBy("ID_STATION", "_to").agg(*total, F.first("_v", ignorenulls=True).alias("_v"))
             .where("_v IS NOT NULL AND _rows > 0"))
    means = [F.when(F.col(f"_n_{v}") > 0, F.col(f"_s_{v}") / F.col(f"_n_{v}")).alias(v) for v in WEATHER_VARS]
    out = by_id.select("ID_STATION", *means, F.explode("_v").alias("_v")).select(
        "ID_STATION", *[F.col(f"_v.{c}") for c in keys if c != "ID_STATION"], *WEATHER_VARS)
    if names is not None:
        out = out.join(names, "ID_STATION", "inner")
    return out.select(*STATION_COLUMNS, *WEATHER_VARS)


def zone_weather_idw(zones: DataFrame, stations: DataFrame, radius_km: float) -> DataFrame:
    """Inverse-distance-weighted TEMP/WDSP/DEWP per zone row.

    w = 1 / (km + 0.1) over the station rows within the radius; a variable
    with any NULL among those rows gives NULL (weighted mean of a NaN).
    Zones without a station keep NULL metrics and NB_STATIONS = 0.
    """
    z = zones.select(*ZONE_KEY)
    pairs = radius_pairs(z.distinct(), stations, radius_km,
                         left_lat="LATITUDE_ZONE", left_lon="LONGITUDE_ZONE",
                         right_lat="LATITUDE", right_lon="LONGITUDE")
    w = idw_weight("DIST_KM")
    n_rows = F.count(F.lit(1))
    aggs = [round_half_even(F.when(F.count(v) == n_rows, F.sum(w * F.col(v)) / F.sum(w)), 1)
            .alias(ZONE_METRIC[v]) for v in WEATHER_VARS]
    per_zone = (pairs.groupBy(*ZONE_KEY).agg(*aggs, n_rows.alias("NB_STATIONS"))
                .withColumnsRenamed({k: f"_{k}" for k in ZONE_KEY}))
    # back to every zone row: duplicates keep their multiplicity, zones
    # without a station keep NULL metrics and a count of 0
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ZONE_KEY]
    return (z.join(per_zone, on, "left")
            .select(F.col("GEOCODE"), *[F.col(m) for m in ZONE_METRIC.values()],
                    F.coalesce(F.col("NB_STATIONS"), F.lit(0)).cast("int").alias("NB_STATIONS")))


def radius_join(zones: DataFrame, stations: DataFrame, radius_km: float, dense: int | None = None) -> DataFrame:
    """Zone x station rows within the radius (left outer on zones); at most
    ``dense`` stations meet in one place, if it is given."""
    z = zones.select(*ZONE_KEY)
    s = stations.select(*STATION_COLUMNS)
    return radius_join_left(z, s, radius_km, left_key=list(ZONE_KEY),
                            left_lat="LATITUDE_ZONE", left_lon="LONGITUDE_ZONE",
                            right_lat="LATITUDE", right_lon="LONGITUDE", dense=dense)


def pollutant_zone_mean(air: DataFrame, zones: DataFrame, pollutant: str,
                        start=None, end=None) -> DataFrame:
    """Mean VALEUR per zone for one pollutant (and date range).

    Aggregated before meeting the zone table (one row per zone id instead of
    every measurement); the semi join keeps only ids the zone table knows.
    """
    rows = air.where(F.col("NOM_POLLUANT") == pollutant)
    if start is not None:
        rows = rows.where(F.col("DATE_OBSERVATION").between(lit_date(start), lit_date(end)))
    means = rows.groupBy("GEOJOIN_ID").agg(mean(rows, "VALEUR").alias("MEAN_POLLUANT"))
    known = zones.select(F.col("GEOCODE").cast("string").alias("GEOJOIN_ID"))
    return (means.join(known, "GEOJOIN_ID", "left_semi")
            .withColumnRenamed("GEOJOIN_ID", "GEOCODE"))


def zone_display(zones: DataFrame, pollutant_means: DataFrame, zone_weather: DataFrame,
                 keep_position: bool = False) -> DataFrame:
    """Every zone with its pollutant mean and weather metrics.

    Missing mean -> 0 then rounded to 2 decimals (ties to even); missing
    W_TEMP -> 0; missing count -> 0. W_WIND and W_DEWP stay NULL.
    """
    d = (zones.join(pollutant_means, "GEOCODE", "left")
         .join(zone_weather, "GEOCODE", "left"))
    cols = [F.col("GEOCODE"), F.col("GEONAME"), F.col("BOROUGH"),
            round_half_even(F.coalesce(F.col("MEAN_POLLUANT"), F.lit(0.0)), 2).alias("MEAN_POLLUANT"),
            F.coalesce(F.col("W_TEMP"), F.lit(0.0)).alias("W_TEMP"),
            F.col("W_WIND"), F.col("W_DEWP"),
            F.coalesce(F.col("NB_STATIONS"), F.lit(0)).cast("int").alias("NB_STATIONS")]
    if keep_position:
        cols += [F.col("LATITUDE_ZONE"), F.col("LONGITUDE_ZONE")]
    return d.select(*cols)


def kpi_global(display: DataFrame) -> DataFrame:
    """City indicators: unweighted means over zones with a pollutant mean > 0;
    0 doubles as missing for temperature and wind. No such zone -> all 0."""
    valid = display.where(F.col("MEAN_POLLUANT") > 0)
    n = F.count(F.lit(1))

    def guarded(c: Column) -> Column:
        return F.when(n == 0, F.lit(0.0)).otherwise(F.avg(c))

    return valid.agg(
        guarded(F.col("MEAN_POLLUANT")).alias("AVG_POLLUANT"),
        guarded(F.nullif(F.col("W_TEMP"), F.lit(0.0))).alias("AVG_TEMP"),
        guarded(F.nullif(F.col("W_WIND"), F.lit(0.0))).alias("AVG_WIND"),
        n.cast("int").alias("NB_ZONES"))


def kpi_formatted(kpi: DataFrame) -> DataFrame:
    """Indicator cards: 2 decimals for the pollutant, 1 with unit otherwise,
    'N/A' for a missing value."""
    def fmt(c: str, digits: int, unit: str = "") -> Column:
        text = format_fixed(c, digits)
        if unit:
            text = F.concat(text, F.lit(unit))
        return F.coalesce(text, F.lit("N/A"))

    return kpi.select(fmt("AVG_POLLUANT", 2).alias("VAL_POLLUANT"),
                      fmt("AVG_TEMP", 1, " °C").alias("VAL_TEMP"),
                      fmt("AVG_WIND", 1, " km/h").alias("VAL_WIND"))


def first_zone_row(df: DataFrame, geocode: str) -> DataFrame:
    """The first row for one zone code (stable order, top-1 is the feature)."""
    return df.where(F.col("GEOCODE") == geocode).orderBy(*df.columns).limit(1)


def zone_detail(display: DataFrame, geocode: str) -> DataFrame:
    """Indicators of one zone: its display row as is."""
    row = first_zone_row(display, geocode)
    return row.select(
        F.col("GEOCODE"), F.col("GEONAME").alias("TITLE"),
        F.format_string("Borough: %s | Stations locales : %d",
                        F.col("BOROUGH"), F.col("NB_STATIONS")).alias("CAPTION"),
        F.col("MEAN_POLLUANT").alias("AVG_POLLUANT"),
        F.col("W_TEMP").alias("AVG_TEMP"), F.col("W_WIND").alias("AVG_WIND"))


def active_stations(with_means: DataFrame) -> DataFrame:
    """Station dimension rows of the ids that report in the range, from
    :func:`stations_with_means` (one pass over the observations)."""
    return with_means.select(*STATION_COLUMNS).distinct()


def _point(df: DataFrame, lat: Column, lon: Column) -> tuple[Column, Column]:
    """(lat, lon) fields of ONE struct-valued scalar subquery: every use
    refers to the same subquery, which Spark evaluates once and reuses."""
    p = df.select(F.struct(lat.alias("lat"), lon.alias("lon"))).scalar()
    return p["lat"], p["lon"]


def city_centre(zones: DataFrame) -> tuple[Column, Column]:
    """Mean zone centroid (lat, lon), as a scalar subquery."""
    return _point(zones.agg(F.avg("LATITUDE_ZONE").alias("a"), F.avg("LONGITUDE_ZONE").alias("o")),
                  F.col("a"), F.col("o"))


def centre_row(zones: DataFrame) -> DataFrame:
    """The mean zone centroid as one row."""
    return zones.agg(F.avg("LATITUDE_ZONE").alias("LATITUDE_CENTER"), F.avg("LONGITUDE_ZONE").alias("LONGITUDE_CENTER"))


def zone_row(zones: DataFrame, geocode: str) -> DataFrame:
    """The position of the first row of one zone, as one row (none for an unknown code)."""
    row = first_zone_row(zones.select(*ZONE_KEY), geocode)
    return row.select(F.col("LATITUDE_ZONE").alias("LATITUDE_CENTER"), F.col("LONGITUDE_ZONE").alias("LONGITUDE_CENTER"))


def stations_near(point: DataFrame, stations: DataFrame, radius_km: float) -> DataFrame:
    """Station rows within the radius of a one-row point."""
    return radius_pairs(point, stations, radius_km, left_lat="LATITUDE_CENTER", left_lon="LONGITUDE_CENTER",
                        right_lat="LATITUDE", right_lon="LONGITUDE")


def count_near(point: DataFrame, stations: DataFrame, radius_km: float) -> DataFrame:
    """Number of station rows within the radius of a one-row point."""
    return stations_near(point, stations, radius_km).agg(F.count(F.lit(1)).cast("int").alias("NB_VISIBLE"))


def local_ids(stations: DataFrame, point: DataFrame, radius_km: float) -> DataFrame:
    """Ids of the stations within the radius of a one-row point."""
    return stations_near(point, stations, radius_km).select("ID_STATION").distinct()


def local_weather(weather_in_range: DataFrame, stations: DataFrame, point: DataFrame,
                  radius_km: float) -> DataFrame:
    """Observations of the stations within the radius of one zone: rows are
    tested against a Bloom filter of those ids where they are read; the exact
    semi join then meets only what passed."""
    return semi_join_filtered(weather_in_range, local_ids(stations, point, radius_km), "ID_STATION")


def pollutant_list(air_in_range: DataFrame) -> DataFrame:
    """Pollutants with at least one value in the range, sorted."""
    return (air_in_range.where(present(air_in_range, "VALEUR"))
            .select("NOM_POLLUANT").distinct().orderBy("NOM_POLLUANT"))


def date_bounds(air: DataFrame, date_col: str = "DATE_OBSERVATION") -> DataFrame:
    return air.agg(F.min(date_col).alias("MIN_DATE"), F.max(date_col).alias("MAX_DATE"))


def zone_options(zones: DataFrame) -> DataFrame:
    """Selector options: one "all zones" row, then zone names in order."""
    head = zones.sparkSession.range(1).select(F.lit(ALL_ZONES_LABEL).alias("OPTION"),
                                 F.lit(None).cast("string").alias("GEOCODE"),
                                 F.lit(0).alias("GROUP_ORDER"))
    body = zones.select(F.col("GEONAME").alias("OPTION"), F.col("GEOCODE"),
                        F.lit(1).alias("GROUP_ORDER"))
    return head.unionByName(body).orderBy("GROUP_ORDER", "OPTION", "GEOCODE")


def zone_lookup(zones: DataFrame) -> DataFrame:
    """Name -> code and code -> name (first match in sort order)."""
    by_name = zones.groupBy("GEONAME").agg(F.min("GEOCODE").alias("VALUE")).select(
        F.lit("code_for_name").alias("LOOKUP"), F.col("GEONAME").alias("KEY"), "VALUE")
    by_code = zones.groupBy("GEOCODE").agg(F.min("GEONAME").alias("VALUE")).select(
        F.lit("name_for_code").alias("LOOKUP"), F.col("GEOCODE").alias("KEY"), "VALUE")
    return by_name.unionByName(by_code)
