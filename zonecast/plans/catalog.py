"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each runs over the whole driver tables through the entity adapters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.geo import haversine_km
from zonecast.functions.numeric import round_half_even
from zonecast.functions.time import resample_rule
from zonecast.operators import clean, metrics
from zonecast.plans.dashboard import Dashboard, Params
from zonecast.session import scratch_path
from zonecast.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


#: Widget values of the registered queries; the date range is the data's own.
FIXTURE = {"pollutant": "1-URGENT", "zone": "1"}
#: Decimals of series whose means come from sums in any order: fine enough that no mean lies on a tie.
FINE = {"VALEUR": 7, "TEMP": 9, "WDSP": 9, "DEWP": 9}
CROWDED = 4             # stations of a grid cell from which it is divided; low, as the test tables' cells hold few
#: A short range and a small circle: zones without measurements or stations, days without observations.
SPARSE = {"start": dt.date(1998, 1, 1), "end": dt.date(1998, 2, 28), "radius_km": 5.0}
NO_STATION = {"radius_km": 0.01}        # no station within any circle
YEAR_1998 = {"start": dt.date(1998, 1, 1), "end": dt.date(1998, 12, 31)}


def _dash(spark: SparkSession, sf_dir: str, **overrides) -> Dashboard:
    return Dashboard.from_tables(spark, sf_dir, Params(**{**FIXTURE, **overrides}))


# --- stage 1: weather cleaning and the zone map -------------------------

@query("unit_convert")
def q_unit_convert(spark, d):
    return clean.unit_convert(tables.weather_raw(spark, d).select(*clean.WEATHER_LITE_COLUMNS))


@query("outlier_filter")
def q_outlier_filter(spark, d):
    return _dash(spark, d).weather


@query("date_range_filter")
def q_date_range_filter(spark, d):
    return _dash(spark, d, **YEAR_1998).weather_in_range


@query("station_dim")
def q_station_dim(spark, d):
    return _dash(spark, d).stations


@query("station_means")
def q_station_means(spark, d):
    return _dash(spark, d).station_means()


@query("haversine")
def q_haversine(spark, d):
    dash = _dash(spark, d)
    lat, lon = metrics.city_centre(dash.zones)
    with_centre = dash.stations.withColumns({"_c_lat": lat, "_c_lon": lon})
    dist = round_half_even(haversine_km("_c_lon", "_c_lat", "LONGITUDE", "LATITUDE"), 6)
    return with_centre.withColumn("DIST_CENTER_KM", dist).drop("_c_lat", "_c_lon")


def _radius(out):
    return out.select("GEOCODE", "LATITUDE_ZONE", "LONGITUDE_ZONE", *clean.STATION_COLUMNS,
                      round_half_even("DIST_KM", 6).alias("DIST_KM"))


@query("radius_join")
def q_radius_join(spark, d):
    return _radius(_dash(spark, d).radius_join())


@query("radius_join_grid")
def q_radius_join_grid(spark, d):
    return _radius(_dash(spark, d).radius_join())


@query("radius_join_divided")
def q_radius_join_divided(spark, d):
    """The same pairs with crowded cells divided, over a station table written first."""
    dash = _dash(spark, d)
    path = scratch_path(spark, "stations")
    dash.stations_with_means().write.parquet(path)
    return _radius(metrics.radius_join(dash.zones, spark.read.parquet(path), dash.p.radius_km, dense=CROWDED))


@query("zone_weather_idw")
def q_zone_weather_idw(spark, d):
    return _dash(spark, d).zone_weather()


@query("pollutant_zone_mean")
def q_pollutant_zone_mean(spark, d):
    return _dash(spark, d).pollutant_means()


@query("zone_display")
def q_zone_display(spark, d):
    return _dash(spark, d).display()


@query("zone_display_1998")
def q_zone_display_1998(spark, d):
    return _dash(spark, d, **YEAR_1998).display()


# --- stage 2: air cleaning, bounds, options ------------------------------

@query("clean_air")
def q_clean_air(spark, d):
    return _dash(spark, d).air_clean


@query("air_zone_join")
def q_air_zone_join(spark, d):
    return _dash(spark, d).air


@query("date_bounds")
def q_date_bounds(spark, d):
    return metrics.date_bounds(_dash(spark, d).air)


@query("pollutant_list")
def q_pollutant_list(spark, d):
    return _dash(spark, d).pollutant_list()


@query("zone_options")
def q_zone_options(spark, d):
    return metrics.zone_options(tables.zones(spark, d))


@query("zone_lookup")
def q_zone_lookup(spark, d):
    return metrics.zone_lookup(tables.zones(spark, d))


# --- stage 3: time series -----------------------------------------------

@query("resample_rule")
def q_resample_rule(spark, d):
    b = metrics.date_bounds(_dash(spark, d).air)
    return b.select("MIN_DATE", "MAX_DATE",
                    F.datediff("MAX_DATE", "MIN_DATE").alias("DELTA_DAYS"),
                    resample_rule(F.col("MIN_DATE"), F.col("MAX_DATE")).alias("RULE"))


def _resample(rule):
    def run(spark, d):
        return _dash(spark, d).resample_weather(rule)
    return run


for _name, _rule in (("day", "D"), ("week", "W"), ("month", "M"), ("quarter", "Q")):
    QUERIES[f"resample_{_name}"] = _resample(_rule)


@query("resample_air")
def q_resample_air(spark, d):
    return _dash(spark, d).resample_air()


@query("paired_series")
def q_paired_series(spark, d):
    return _dash(spark, d).paired_series()


# --- sparse widget states: what is missing, and how it shows ---------------

@query("zone_display_sparse")
def q_zone_display_sparse(spark, d):
    return _dash(spark, d, **SPARSE).display()


@query("kpi_global_sparse")
def q_kpi_global_sparse(spark, d):
    return _dash(spark, d, **SPARSE).kpi_global()


@query("kpi_formatted_no_station")
def q_kpi_formatted_no_station(spark, d):
    return _dash(spark, d, **NO_STATION).kpi_formatted()


@query("kpi_global_no_measurement")
def q_kpi_global_no_measurement(spark, d):
    return _dash(spark, d, pollutant="none such").kpi_global()


@query("paired_series_sparse")
def q_paired_series_sparse(spark, d):
    """Daily series of one zone; days without an observation stay, empty."""
    out = _dash(spark, d, **SPARSE).local_paired_series()
    return out.withColumns({v: round_half_even(v, k) for v, k in FINE.items()})


@query("resample_air_empty")
def q_resample_air_empty(spark, d):
    """The series of a pollutant that nobody measured: no bucket at all."""
    return _dash(spark, d, pollutant="none such").resample_air()


# --- daily layers, which the page is answered from ------------------------

@query("weather_daily")
def q_weather_daily(spark, d):
    days = _dash(spark, d).daily().observations
    return days.select("ID_STATION", "LATITUDE", "LONGITUDE", "DATE", *[c for v in metrics.WEATHER_VARS for c in (
        round_half_even(f"S_{v}", 6).alias(f"S_{v}"), F.col(f"N_{v}"))])


@query("air_daily")
def q_air_daily(spark, d):
    days = _dash(spark, d).daily().air_clean
    return days.withColumn("S_VALEUR", round_half_even("S_VALEUR", 2))


@query("zone_display_daily")
def q_zone_display_daily(spark, d):
    return _dash(spark, d).daily().display()


@query("paired_series_daily")
def q_paired_series_daily(spark, d):
    out = _dash(spark, d).daily().paired_series()
    return out.withColumns({v: round_half_even(v, k) for v, k in FINE.items()})


# --- stage 4: indicators and the one-zone view ----------------------------

@query("kpi_global")
def q_kpi_global(spark, d):
    return _dash(spark, d).kpi_global()


@query("kpi_formatted")
def q_kpi_formatted(spark, d):
    return _dash(spark, d).kpi_formatted()


@query("zone_detail")
def q_zone_detail(spark, d):
    return _dash(spark, d).zone_detail()


@query("active_stations")
def q_active_stations(spark, d):
    return _dash(spark, d).active_stations()


@query("stations_near_center")
def q_stations_near_center(spark, d):
    return _dash(spark, d).stations_near_center()


@query("stations_near_zone")
def q_stations_near_zone(spark, d):
    return _dash(spark, d).stations_near_zone()


@query("local_weather")
def q_local_weather(spark, d):
    return _dash(spark, d).local_weather()


@query("box_stats")
def q_box_stats(spark, d):
    return _dash(spark, d).box_stats()


@query("paired_series_local")
def q_paired_series_local(spark, d):
    out = _dash(spark, d).local_paired_series()
    return out.withColumns({v: round_half_even(v, k) for v, k in FINE.items()})


@query("box_stats_local")
def q_box_stats_local(spark, d):
    return _dash(spark, d).local_box_stats()


# ingest-side queries register themselves on import
from zonecast.plans import ingest_queries  # noqa: E402,F401
