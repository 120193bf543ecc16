"""Ingest ETL (entries A and B) and the serving extracts.

A: station inventory CSV -> key, null and bounding-box filters -> manifest
   of (station, year) -> landed daily CSV files -> raw weather layer
   (parquet, one directory per year).
B: air-quality feed (JSON) -> typed, cleaned rows -> zones from GeoJSON
   (centroid added when absent) -> inner join -> air extract (parquet).
The weather extract is the eight serving columns of the raw layer. The
dashboard reads both extracts; date filters then prune whole years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.operators import clean
from zonecast.operators.spatial import with_centroid
from zonecast.sources import csv, geojson, jsonfeed, manifest, parquet
from zonecast.sources.jsonsplit import kept


def stations_in_box(spark: SparkSession, stations_csv) -> DataFrame:
    st = clean.station_key(csv.read_station_csv(spark, stations_csv))
    return clean.bbox_filter(clean.drop_null_subset(st))


def weather_layer(spark: SparkSession, stations_csv, weather_base: str,
                  first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Raw weather rows of the in-box stations' landed files (fails when
    no file of the manifest has landed). Years default to those landed."""
    landed = manifest.landed_files(spark, weather_base)
    low, high = manifest.year_span(landed)
    m = manifest.ingest_manifest(stations_in_box(spark, stations_csv), first_year or low, last_year or high)
    existing = manifest.manifest_existing(m, landed)
    manifest.require_inputs(existing)
    return manifest.read_manifest_files(spark, weather_base, existing)


def write_weather_layer(layer: DataFrame, out: str) -> None:
    parquet.write_partitioned(layer, out, "DATE")


def ensure_centroid(zones: DataFrame, projected: bool = True) -> DataFrame:
    """Add LATITUDE_ZONE / LONGITUDE_ZONE from the geometry unless present
    (decided at plan time from the schema)."""
    if "LATITUDE_ZONE" in zones.columns:
        return zones
    return with_centroid(zones, projected=projected)


def air_extract(spark: SparkSession, feed_path, zones_path, envelope: bool = True,
                projected: bool = True, layout: str | None = None,
                zones_collection: bool = False) -> DataFrame:
    """Air extract from the feed (``layout``: envelope, lines or array;
    ``envelope`` is the older switch between the first two); fails when the
    feed holds no record (an empty ``data`` array stops the load)."""
    layout = layout or ("envelope" if envelope else "lines")
    records = jsonfeed.read_records(spark, feed_path, layout)
    if layout != "lines":               # records of documents are found once, for the guard and the extract
        records = kept(records, "feed-records")
    manifest.require_inputs(records, "air-quality record in the feed")
    air = clean.clean_air(jsonfeed.to_air_raw(jsonfeed.name_fields(jsonfeed.whole_records(records))))
    zones = ensure_centroid(geojson.read_geojson(spark, zones_path, collection=zones_collection),
                            projected)
    return clean.air_zone_join(air, zones)


def write_extracts(air: DataFrame, weather_layer_df: DataFrame, air_out: str, weather_out: str) -> None:
    parquet.write_partitioned(air, air_out, "DATE_OBSERVATION")
    parquet.write_partitioned(clean.weather_lite(weather_layer_df), weather_out, "DATE")
