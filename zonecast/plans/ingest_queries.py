"""Registered queries of the ingest side (files are written to a fresh
folder under the shared checkpoint location, then read back)."""

from __future__ import annotations

import weakref

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from zonecast.functions.numeric import round_half_even
from zonecast.operators import clean
from zonecast.operators.spatial import with_centroid
from zonecast.plans import etl
from zonecast.plans.catalog import query
from zonecast.session import scratch_path
from zonecast.sources import csv, geojson, jsonfeed, manifest, parquet, tables

_WRITTEN: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _once(spark, kind, d, write):
    """The path of an input the adapters write, once a session and scale."""
    made = _WRITTEN.setdefault(spark, {})
    if (kind, d) not in made:
        path = scratch_path(spark, kind)
        write(path)
        made[kind, d] = path
    return made[kind, d]


def _stations_csv(spark, d):
    return _once(spark, "stations-csv", d, lambda p: csv.write_station_csv(tables.station_list(spark, d), p))


def _weather_files(spark, d):
    return _once(spark, "weather-csv", d, lambda p: csv.write_weather_csv(tables.weather_files_frame(spark, d), p))


def _keyed_stations(spark, d):
    return clean.station_key(tables.station_list(spark, d))


@query("scan_stations_csv")
def q_scan_stations_csv(spark, d):
    return csv.read_station_csv(spark, _stations_csv(spark, d))


@query("station_key")
def q_station_key(spark, d):
    return _keyed_stations(spark, d)


@query("drop_null_subset")
def q_drop_null_subset(spark, d):
    return clean.drop_null_subset(_keyed_stations(spark, d))


@query("bbox_filter")
def q_bbox_filter(spark, d):
    return clean.bbox_filter(clean.drop_null_subset(_keyed_stations(spark, d)))


def _manifest_and_landed(spark, d):
    base = _weather_files(spark, d)
    landed = manifest.landed_files(spark, base)
    st = clean.bbox_filter(clean.drop_null_subset(_keyed_stations(spark, d)))
    return base, manifest.ingest_manifest(st, *manifest.year_span(landed)), landed


@query("ingest_manifest")
def q_ingest_manifest(spark, d):
    return _manifest_and_landed(spark, d)[1]


@query("manifest_existing")
def q_manifest_existing(spark, d):
    _, m, landed = _manifest_and_landed(spark, d)
    return manifest.manifest_existing(m, landed)


@query("manifest_missing")
def q_manifest_missing(spark, d):
    _, m, landed = _manifest_and_landed(spark, d)
    return manifest.manifest_missing(m, landed)


@query("required_inputs")
def q_required_inputs(spark, d):
    """The files of the manifest behind the gate that stops an ingest without any."""
    _, m, landed = _manifest_and_landed(spark, d)
    return manifest.require_inputs(manifest.manifest_existing(m, landed)).select("REL_PATH")


@query("scan_weather_csv")
def q_scan_weather_csv(spark, d):
    base, m, landed = _manifest_and_landed(spark, d)
    rows = manifest.read_manifest_files(spark, base, manifest.manifest_existing(m, landed))
    return clean.weather_lite(rows)


@query("weather_etl")
def q_weather_etl(spark, d):
    """Entry A end to end: inventory CSV + daily CSVs -> raw layer -> read back."""
    layer = etl.weather_layer(spark, _stations_csv(spark, d), _weather_files(spark, d))
    out = scratch_path(spark, "weather-layer")
    etl.write_weather_layer(layer, out)
    return clean.weather_lite(parquet.read_layer(spark, out))


@query("weather_lite")
def q_weather_lite(spark, d):
    return clean.weather_lite(tables.weather_raw(spark, d))


@query("sink_parquet_roundtrip")
def q_sink_parquet_roundtrip(spark, d):
    """Weather extract written by year and read back whole."""
    out = scratch_path(spark, "weather-extract")
    parquet.write_partitioned(clean.weather_lite(tables.weather_raw(spark, d)), out, "DATE")
    return clean.weather_lite(parquet.read_layer(spark, out))


@query("layer_year_1998")
def q_layer_year(spark, d):
    """One year of the weather extract: the other year directories are pruned."""
    out = scratch_path(spark, "weather-extract")
    parquet.write_partitioned(clean.weather_lite(tables.weather_raw(spark, d)), out, "DATE")
    return clean.weather_lite(parquet.read_layer(spark, out).where(F.col("YEAR") == 1998))


_FEED_WRITERS = {"lines": jsonfeed.write_json_rows, "envelope": jsonfeed.write_json_envelopes,
                 "array": jsonfeed.write_json_arrays}


def _feed_path(spark, d, layout: str):
    return _once(spark, f"feed-{layout}", d, lambda p: _FEED_WRITERS[layout](tables.air_feed_lines(spark, d), p))


def _feed(spark, d, layout: str):
    return jsonfeed.read_records(spark, _feed_path(spark, d, layout), layout)


def _feed_columns(records):
    named = jsonfeed.name_fields(jsonfeed.whole_records(records))
    return named.select(F.col("GEOJOIN_ID_BRUT").alias("GEOJOIN_ID"), "DATE_MESURE_BRUTE",
                        "NOM_POLLUANT", F.col("VALEUR_MESURE_BRUTE").alias("VALEUR_BRUTE"),
                        "col_1", "col_3")


@query("scan_json_rows")
def q_scan_json_rows(spark, d):
    return _feed_columns(_feed(spark, d, "lines"))


@query("scan_json_envelope")
def q_scan_json_envelope(spark, d):
    return _feed_columns(_feed(spark, d, "envelope"))


@query("scan_json_array")
def q_scan_json_array(spark, d):
    return _feed_columns(_feed(spark, d, "array"))


@query("rejected_json_records")
def q_rejected_json_records(spark, d):
    return jsonfeed.rejected_records(_feed(spark, d, "lines"))


def _zones_file(spark, d):
    return _once(spark, "zones-geojson", d, lambda p: geojson.write_geojson(geojson.shaped_zones(tables.zones(spark, d)), p))


def _vertex_sums(coordinates):
    """Both coordinates of all vertices, weighted by their place."""
    points = F.flatten(F.flatten(coordinates))
    weighted = lambda axis: F.aggregate(F.transform(points, lambda p, i: (i + 1) * p[axis]), F.lit(0.0), lambda a, v: a + v)
    return round_half_even(weighted(0), 6).alias("X_SUM"), round_half_even(weighted(1), 6).alias("Y_SUM")


@query("sink_geojson")
def q_sink_geojson(spark, d):
    """Zones written as GeoJSON Features, read back as plain JSON text."""
    lines = spark.read.text(_zones_file(spark, d))
    j = F.col("value")
    return lines.select(F.get_json_object(j, "$.properties.GEOCODE").alias("GEOCODE"),
                        F.get_json_object(j, "$.type").alias("FEATURE_TYPE"),
                        F.get_json_object(j, "$.geometry.type").alias("GEOM_TYPE"),
                        *_vertex_sums(geojson.coordinates(F.get_json_object(j, "$.geometry.type"),
                                                          F.get_json_object(j, "$.geometry.coordinates"))))


@query("scan_geojson")
def q_scan_geojson(spark, d):
    z = geojson.read_geojson(spark, _zones_file(spark, d))
    c = F.col("COORDINATES")
    return z.select("GEOCODE", "GEONAME", "BOROUGH", "GEOM_TYPE",
                    F.size(c).alias("N_POLYGONS"),
                    F.aggregate(F.transform(c, lambda p: F.size(p)), F.lit(0), lambda a, b: a + b)
                    .alias("N_RINGS"),
                    F.aggregate(F.transform(c, lambda p: F.aggregate(
                        F.transform(p, lambda r: F.size(r)), F.lit(0), lambda a, b: a + b)),
                        F.lit(0), lambda a, b: a + b).alias("N_POINTS"), *_vertex_sums(c))


def _centroids(spark, d, projected: bool, digits: int):
    z = with_centroid(geojson.read_geojson(spark, _zones_file(spark, d)), projected=projected)
    return z.select("GEOCODE", round_half_even("LATITUDE_ZONE", digits).alias("LATITUDE_ZONE"),
                    round_half_even("LONGITUDE_ZONE", digits).alias("LONGITUDE_ZONE"))


@query("zone_centroid")
def q_zone_centroid(spark, d):
    return _centroids(spark, d, projected=False, digits=9)


@query("zone_centroid_projected")
def q_zone_centroid_projected(spark, d):
    return _centroids(spark, d, projected=True, digits=6)


@query("air_etl")
def q_air_etl(spark, d):
    """Entry B end to end: feed envelope + zone GeoJSON -> air extract ->
    read back (centroids from the geometry, reported to 1e-9 degrees)."""
    air = etl.air_extract(spark, _feed_path(spark, d, "envelope"), _zones_file(spark, d), envelope=True, projected=False)
    out = scratch_path(spark, "air-extract")
    parquet.write_partitioned(air, out, "DATE_OBSERVATION")
    back = parquet.read_layer(spark, out)
    return back.select("GEOJOIN_ID", "DATE_OBSERVATION", "NOM_POLLUANT", "VALEUR", "GEONAME",
                       round_half_even("LATITUDE_ZONE", 9).alias("LATITUDE_ZONE"),
                       round_half_even("LONGITUDE_ZONE", 9).alias("LONGITUDE_ZONE"))


@query("stream_ingest_weather")
def q_stream_ingest_weather(spark, d):
    """Daily files landed incrementally by the file stream, read back."""
    from zonecast.streaming import ingest
    base = _weather_files(spark, d)
    layer = scratch_path(spark, "weather-stream-layer")
    ingest.land_new_files(spark, base, layer, scratch_path(spark, "weather-stream-ckpt"),
                          etl.stations_in_box(spark, _stations_csv(spark, d)))
    return clean.weather_lite(ingest.read_landed(spark, layer))


@query("stream_ingest_air")
def q_stream_ingest_air(spark, d):
    """Air feed files landed incrementally into the air extract, read back."""
    from zonecast.streaming import ingest
    out = scratch_path(spark, "air-stream-extract")
    ingest.land_new_feed_lines(spark, _feed_path(spark, d, "lines"), tables.zones(spark, d), out,
                               scratch_path(spark, "air-stream-ckpt"))
    return parquet.read_layer(spark, out).drop("YEAR")
