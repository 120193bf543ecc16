"""Entries A and B end to end, and the dashboard served from the extracts."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonecast.plans import etl
from zonecast.plans.catalog import FIXTURE, QUERIES, YEAR_1998
from zonecast.plans.dashboard import Dashboard, Params
from zonecast.sources import csv, geojson, jsonfeed, parquet, tables


def _rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_dashboard_from_extracts_equals_from_tables(spark, tmp_path):
    direct = Dashboard.from_tables(spark, SF_SMALL, Params(**FIXTURE))
    air_out, weather_out = str(tmp_path / "air_x"), str(tmp_path / "weather_x")
    etl.write_extracts(direct.air, tables.weather_raw(spark, SF_SMALL), air_out, weather_out)
    zones = tables.zones(spark, SF_SMALL)
    served = Dashboard.from_extracts(spark, air_out, weather_out, zones, Params(**FIXTURE, **YEAR_1998))
    windowed = Dashboard.from_tables(spark, SF_SMALL, Params(**FIXTURE, **YEAR_1998))
    assert _rows(served.display()) == _rows(windowed.display())
    assert _rows(served.kpi_formatted()) == _rows(windowed.kpi_formatted())
    assert served.views()["weather_series"].count() == 12           # 1998 by month
    # the year filter reaches the scan as a partition filter
    plan = served._weather_range_src._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "YEAR" in plan
    whole = Dashboard.from_extracts(spark, air_out, weather_out, zones, Params(**FIXTURE)).persist()
    assert whole.range == direct.range and whole.rule == "Q"
    assert _rows(whole.display()) == _rows(direct.display())
    whole.unpersist()


def test_extracts_with_a_zone_listed_twice(spark, tmp_path):
    from tests.test_dashboard import dash
    direct = dash(spark)
    air_out, weather_out = str(tmp_path / "air_x"), str(tmp_path / "weather_x")
    etl.write_extracts(direct.air, direct._input("weather_raw"), air_out, weather_out)
    served = Dashboard.from_extracts(spark, air_out, weather_out, direct.zones, direct.p)
    for view in ("display", "resample_air", "paired_series", "pollutant_list", "box_stats"):
        assert _rows(getattr(served, view)()) == _rows(getattr(direct, view)()), view


def test_zone_centroid_added_only_when_absent(spark):
    z = geojson.shaped_zones(tables.zones(spark, SF_SMALL))
    with_c = etl.ensure_centroid(z, projected=True)
    assert {"LATITUDE_ZONE", "LONGITUDE_ZONE"} <= set(with_c.columns)
    again = etl.ensure_centroid(with_c.withColumn("LATITUDE_ZONE", F.lit(1.0)))
    assert again.select("LATITUDE_ZONE").first()[0] == 1.0


def test_command_line_etl_then_dashboard(spark, tmp_path):
    from zonecast.__main__ import main
    d = SF_SMALL
    stations_csv, weather_csv = str(tmp_path / "st"), str(tmp_path / "daily")
    csv.write_station_csv(tables.station_list(spark, d), stations_csv)
    csv.write_weather_csv(tables.weather_files_frame(spark, d), weather_csv)
    feed, zones_path = str(tmp_path / "feed"), str(tmp_path / "zones")
    jsonfeed.write_json_envelopes(tables.air_feed_lines(spark, d), feed)
    geojson.write_geojson(geojson.shaped_zones(tables.zones(spark, d)), zones_path)
    out, views = str(tmp_path / "x"), str(tmp_path / "views")
    main(["etl", "--stations", stations_csv, "--weather", weather_csv,
          "--feed", feed, "--zones", zones_path, "--out", out], spark=spark)
    main(["dashboard", "--extracts", out, "--zones", zones_path, "--out", views, "--zone", "1"], spark=spark)
    disp = spark.read.parquet(f"{views}/display")
    assert {r.GEOCODE for r in disp.collect()} == {r.GEOCODE for r in tables.zones(spark, d).collect()}
    assert spark.read.parquet(f"{views}/kpi").count() == 1
    assert spark.read.parquet(f"{views}/detail").first().GEOCODE == "1"
    landed = parquet.read_layer(spark, f"{out}/weather_raw")
    assert landed.count() == QUERIES["weather_etl"](spark, d).count()
    with pytest.raises(LookupError):
        main(["dashboard", "--extracts", out, "--zones", zones_path, "--out", views, "--start", "1980-01-01",
              "--end", "1980-12-31"], spark=spark)


def test_persist_and_unpersist_layers(spark):
    dash = Dashboard.from_tables(spark, SF_SMALL, Params(**FIXTURE)).persist()
    assert dash.observations.is_cached and dash.air_clean.is_cached
    page = dash.with_params(Params(pollutant="2-HIGH"))
    assert page.observations is dash.observations             # layers shared across interactions
    dash.resample_weather("M").count()
    dash.unpersist()
    assert not dash.observations.is_cached and not dash.air_clean.is_cached


def test_daily_page_equals_the_page_and_reads_no_fact(spark):
    from scripts.audit import input_rows
    raw = Dashboard.from_tables(spark, SF_SMALL, Params(**FIXTURE))
    days = raw.daily().persist()
    assert days.observations.is_cached and days.air_clean.is_cached
    days.observations.count(), days.air_clean.count()
    for params in (Params(**FIXTURE), Params(**YEAR_1998, pollutant="2-HIGH", radius_km=25.0, zone="3")):
        page, want = days.with_params(params), raw.with_params(params)
        for name, view in page.views().items():
            rounded = lambda df: sorted((tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
            assert rounded(view) == rounded(want.views()[name]), name
            read = input_rows(view)
            assert read["lineitem"] == read["orders"] == 0, name
        assert _rows(page.box_stats()) == _rows(want.box_stats())
        assert _rows(page.zone_detail()) == _rows(want.zone_detail())
    warm = days.with_params(Params(**FIXTURE, temp_max=20.0))
    assert _rows(warm.display()) == _rows(raw.with_params(Params(**FIXTURE, temp_max=20.0)).display())
    days.unpersist()


def test_daily_page_from_extracts(spark, tmp_path):
    direct = Dashboard.from_tables(spark, SF_SMALL, Params(**FIXTURE))
    air_out, weather_out = str(tmp_path / "air_x"), str(tmp_path / "weather_x")
    etl.write_extracts(direct.air, tables.weather_raw(spark, SF_SMALL), air_out, weather_out)
    served = Dashboard.from_extracts(spark, air_out, weather_out, tables.zones(spark, SF_SMALL), Params(**FIXTURE)).daily().persist()
    assert _rows(served.display()) == _rows(direct.display())
    assert _rows(served.pollutant_list()) == _rows(direct.pollutant_list())
    served.unpersist()
