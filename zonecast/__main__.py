"""Command line: ``python -m zonecast etl ...`` and ``python -m zonecast dashboard ...``.

etl        station inventory CSV + daily weather files + air feed + zone GeoJSON
           -> raw weather layer and the two serving extracts (parquet, by year)
dashboard  serving extracts + zone GeoJSON + widget values -> every view as parquet
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

if not __package__:     # run as a script (spark-submit zonecast/__main__.py ...)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonecast.plans import etl  # noqa: E402
from zonecast.plans.dashboard import Dashboard, Params  # noqa: E402
from zonecast.session import build_session  # noqa: E402
from zonecast.sources import geojson, parquet  # noqa: E402


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="zonecast")
    sub = p.add_subparsers(dest="command", required=True)
    e = sub.add_parser("etl", help="ingest raw files into the serving extracts")
    e.add_argument("--stations", required=True, help="station inventory CSV")
    e.add_argument("--weather", required=True, help="daily files root ({year}/{station}.csv)")
    e.add_argument("--first-year", type=int, help="default: the first year that has landed")
    e.add_argument("--last-year", type=int, help="default: the last one")
    e.add_argument("--feed", required=True, help="air-quality feed (JSON envelopes or lines)")
    e.add_argument("--feed-layout", choices=("envelope", "lines", "array"), default="envelope",
                   help="envelope documents, one record array per line, or bare list-of-lists documents")
    e.add_argument("--zones", required=True, help="zone GeoJSON (Feature per line)")
    e.add_argument("--zones-collection", action="store_true", help="zones are FeatureCollection documents")
    e.add_argument("--out", required=True, help="output root")
    d = sub.add_parser("dashboard", help="compute every view for one set of widget values")
    d.add_argument("--extracts", required=True, help="root written by etl")
    d.add_argument("--zones", required=True)
    d.add_argument("--zones-collection", action="store_true")
    d.add_argument("--start", type=_date, help="default: the first date of the air measurements")
    d.add_argument("--end", type=_date, help="default: the last one")
    d.add_argument("--pollutant", help="default: the first in the list")
    d.add_argument("--radius-km", type=float, default=Params.radius_km)
    d.add_argument("--zone", help="adds the one-zone views")
    d.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None, spark=None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session(app=f"zonecast-{args.command}")
    if args.command == "etl":
        layer = etl.weather_layer(spark, args.stations, args.weather, args.first_year, args.last_year)
        etl.write_weather_layer(layer, f"{args.out}/weather_raw")
        raw = parquet.read_layer(spark, f"{args.out}/weather_raw").drop("YEAR")
        air = etl.air_extract(spark, args.feed, args.zones, layout=args.feed_layout,
                              zones_collection=args.zones_collection)
        etl.write_extracts(air, raw, f"{args.out}/air", f"{args.out}/weather")
        return
    etl.ensure_centroid(geojson.read_geojson(spark, args.zones, collection=args.zones_collection)) \
        .write.mode("overwrite").parquet(f"{args.out}/zones")
    zones = spark.read.parquet(f"{args.out}/zones").drop("COORDINATES")      # centroids computed once
    params = Params(start=args.start, end=args.end, pollutant=args.pollutant,
                    radius_km=args.radius_km, zone=args.zone)
    dash = Dashboard.from_extracts(spark, f"{args.extracts}/air", f"{args.extracts}/weather",
                                   zones, params).persist()
    dash.require_pollutants()
    views = {**dash.views(), "box": dash.box_stats()}
    if args.zone is not None:
        views |= {"detail": dash.zone_detail(), "local_weather": dash.local_weather(),
                  "local_series": dash.local_paired_series()}
    for name, df in views.items():
        df.write.mode("overwrite").parquet(f"{args.out}/{name}")
    dash.unpersist()


if __name__ == "__main__":
    main()
