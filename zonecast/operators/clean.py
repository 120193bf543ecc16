"""Cleaning, typing, unit conversion and filters (projections and predicates)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from zonecast.functions.numeric import nan_to_null

WEATHER_LITE_COLUMNS = ("ID_STATION", "NAME", "LATITUDE", "LONGITUDE", "DATE", "TEMP", "DEWP", "WDSP")
STATION_COLUMNS = ("ID_STATION", "NAME", "LATITUDE", "LONGITUDE")

# Fixed values of the model: conversions and outlier ceilings (after conversion).
KNOT_TO_KMH = 1.852
WDSP_MAX_KMH = 150.0
DEWP_MAX_C = 40.0

# Fixed values of the ingest: New York bounding box, inclusive on all sides.
BBOX = {"min_lat": 40.0, "max_lat": 41.5, "min_lon": -75.0, "max_lon": -73.0}


def as_date_col(df: DataFrame, name: str) -> Column:
    """A date column from a date or text column; unparsable text gives NULL."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, DateType):
        return F.col(name)
    if isinstance(dtype, StringType):
        return F.try_to_date(F.col(name))
    return F.to_date(F.col(name))


def lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def unit_convert(weather: DataFrame) -> DataFrame:
    """Fahrenheit -> Celsius for TEMP and DEWP, knots -> km/h for WDSP.

    NaN is scrubbed to NULL on the way (the model treats both as missing).
    """
    def f_to_c(c: str) -> Column:
        return ((nan_to_null(c) - 32.0) * 5.0) / 9.0

    return weather.withColumns({
        "DATE": as_date_col(weather, "DATE"),
        "TEMP": f_to_c("TEMP"),
        "DEWP": f_to_c("DEWP"),
        "WDSP": nan_to_null("WDSP") * KNOT_TO_KMH,
    })


def outlier_filter(weather: DataFrame, temp_max: float | None = None) -> DataFrame:
    """Keep WDSP <= 150 km/h and DEWP <= 40 C; NULL fails both. TEMP is not
    filtered by default (a missing-value code in TEMP passes, as in the
    model); ``temp_max`` (Celsius) turns values above it into NULL."""
    kept = weather.where((F.col("WDSP") <= WDSP_MAX_KMH) & (F.col("DEWP") <= DEWP_MAX_C))
    if temp_max is not None:
        kept = kept.withColumn("TEMP", F.when(F.col("TEMP") <= temp_max, F.col("TEMP")))
    return kept


def clean_weather(weather_raw: DataFrame, temp_max: float | None = None) -> DataFrame:
    """The eight working columns (those present), converted and outlier-filtered."""
    cols = [c for c in WEATHER_LITE_COLUMNS if c in weather_raw.columns]
    return outlier_filter(unit_convert(weather_raw.select(*cols)), temp_max)


def date_range_filter(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Both ends inclusive, compared as dates (pushed to the scan when possible)."""
    return df.where(F.col(date_col).between(lit_date(start), lit_date(end)))


def station_dim(weather: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Distinct (id, name, position) over every date: a renamed or moved
    station keeps one row per variant (partial aggregation map-side).

    With ``names`` (ID_STATION, NAME) the observations carry no name: the
    distinct (id, position) set is built first and then meets the names."""
    if names is None:
        return weather.select(*STATION_COLUMNS).distinct()
    positions = weather.select("ID_STATION", "LATITUDE", "LONGITUDE").distinct()
    return positions.join(names, "ID_STATION", "inner").select(*STATION_COLUMNS).distinct()


def clean_air(air_raw: DataFrame) -> DataFrame:
    """Typed air measurements; unparsable value or date text becomes NULL
    (no exception) and rows without a value are dropped."""
    return (air_raw
            .select(F.col("GEOJOIN_ID").cast("string").alias("GEOJOIN_ID"),
                    as_date_col(air_raw, "DATE_MESURE_BRUTE").alias("DATE_OBSERVATION"),
                    F.col("NOM_POLLUANT"),
                    nan_to_null(F.col("VALEUR_BRUTE").try_cast("double")).alias("VALEUR"))
            .where(F.col("VALEUR").isNotNull()))


def air_zone_join(air: DataFrame, zones: DataFrame) -> DataFrame:
    """Air rows to zone names and centroids on GEOJOIN_ID = GEOCODE (inner).

    Keys are compared as strings. The zone table is a small dimension; the
    planner broadcasts it when its measured size is under the threshold.
    """
    z = zones.select(F.col("GEOCODE").cast("string").alias("GEOCODE"),
                     "GEONAME", "LATITUDE_ZONE", "LONGITUDE_ZONE")
    return air.join(z, air.GEOJOIN_ID == z.GEOCODE, "inner").drop("GEOCODE")


def station_key(stations: DataFrame) -> DataFrame:
    """STN_ID = trim(USAF) || trim(WBAN) (NULL if either is NULL); LAT/LON renamed."""
    return (stations
            .withColumn("STN_ID", F.concat(F.trim("USAF"), F.trim("WBAN")))
            .withColumnsRenamed({"LAT": "LATITUDE", "LON": "LONGITUDE"}))


def drop_null_subset(df: DataFrame, subset=("LATITUDE", "LONGITUDE", "STATION NAME")) -> DataFrame:
    return df.na.drop(subset=list(subset))


def bbox_filter(df: DataFrame, lat="LATITUDE", lon="LONGITUDE", box: dict | None = None) -> DataFrame:
    b = box or BBOX
    return df.where(F.col(lat).between(b["min_lat"], b["max_lat"])
                    & F.col(lon).between(b["min_lon"], b["max_lon"]))


def weather_lite(raw_layer: DataFrame) -> DataFrame:
    """The eight serving columns of the raw weather layer (column pruning)."""
    return raw_layer.select(*WEATHER_LITE_COLUMNS)
