"""Every registered query plans without Python evaluation or all-pairs joins."""

import pytest

from scripts.audit import input_rows, plan_facts, plan_text, raw_shuffles, shuffled_rows
from tests.conftest import SF_SMALL
from zonecast.plans.catalog import QUERIES


def queries():
    return QUERIES


# these read files that the adapters have written, not the tables
OF_FILES = {"scan_stations_csv", "ingest_manifest", "manifest_existing", "manifest_missing", "scan_weather_csv",
            "weather_etl", "sink_parquet_roundtrip", "layer_year_1998", "scan_json_rows", "scan_json_envelope",
            "scan_json_array", "rejected_json_records", "sink_geojson", "scan_geojson", "zone_centroid",
            "zone_centroid_projected", "air_etl", "stream_ingest_weather", "stream_ingest_air"}


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_has_no_python_and_no_pairs(spark, name):
    df = queries()[name](spark, SF_SMALL)
    facts = plan_facts(df)
    assert facts["python"] == 0, plan_text(df)
    assert "CartesianProduct" not in plan_text(df)
    assert facts["pair_joins"] == 0, plan_text(df)


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    text = plan_text(queries()["pollutant_zone_mean"](spark, SF_SMALL))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)" in text \
        or "EqualTo(o_orderpriority,1-URGENT)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double," in text
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_flagship_reads_observations_once(spark):
    text = plan_text(queries()["zone_display"](spark, SF_SMALL))
    assert text.count("lineitem.parquet") == 1
    assert text.count("orders.parquet") == 1


ONE_SCAN = {"resample_day": ("lineitem",), "resample_week": ("lineitem",), "resample_month": ("lineitem",),
            "resample_quarter": ("lineitem",), "resample_air": ("orders",), "paired_series": ("lineitem", "orders"),
            "active_stations": ("lineitem",), "stations_near_center": ("lineitem",), "stations_near_zone": ("lineitem",),
            "zone_display": ("lineitem", "orders"), "kpi_global": ("lineitem", "orders")}


@pytest.mark.parametrize("name", sorted(ONE_SCAN))
def test_facts_are_read_once(spark, name):
    read = input_rows(queries()[name](spark, SF_SMALL))
    for table in ONE_SCAN[name]:
        assert read[table] == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_query_leaves_a_cache(spark, name):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    queries()[name](spark, SF_SMALL).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("name", ["box_stats", "box_stats_local", "local_weather", "radius_join", "resample_day"])
def test_building_a_view_runs_no_job(spark, name):
    from zonecast.plans.catalog import FIXTURE, YEAR_1998
    from zonecast.plans.dashboard import Dashboard, Params
    dash = Dashboard.from_tables(spark, SF_SMALL, Params(**FIXTURE, **YEAR_1998))
    build = {"box_stats": dash.box_stats, "box_stats_local": dash.local_box_stats, "local_weather": dash.local_weather,
             "radius_join": dash.radius_join, "resample_day": lambda: dash.resample_weather("D")}[name]
    dash.zones, dash.observations, dash.station_names, dash.weather      # schemas are read here
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    build()
    spark.sparkContext.setJobGroup("", "")
    assert list(tracker.getJobIdsForGroup(f"build-{name}")) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - OF_FILES))
def test_fact_rows_are_never_shuffled_raw(spark, name):
    """No exchange moves raw observation or measurement rows: aggregates run
    map-side first and the bounded sides are broadcast, so a station or zone
    holding a third of all rows costs one partial row per task."""
    df = queries()[name](spark, SF_SMALL)
    assert raw_shuffles(df, "lineitem.parquet") == []
    assert raw_shuffles(df, "orders.parquet") == []


def test_raw_shuffle_checker_flags_a_raw_join(spark):
    from zonecast.sources import tables
    li = tables.table(spark, SF_SMALL, "lineitem")
    su = tables.table(spark, SF_SMALL, "supplier")
    joined = li.join(su.hint("merge"), li.l_suppkey == su.s_suppkey)
    assert raw_shuffles(joined, "lineitem.parquet") != []


WEATHER_AGGREGATES = ["zone_weather_idw", "radius_join_grid", "station_dim", "station_means",
                      "active_stations", "stations_near_center", "stations_near_zone", "haversine",
                      "resample_day", "resample_week", "resample_month", "resample_quarter"]


@pytest.fixture(scope="module")
def no_auto_broadcast(spark):
    """A session where no side is broadcast unless explicitly size-checked:
    the plans a cluster gets when every dimension is large."""
    s = spark.newSession()
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    s.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return s


@pytest.mark.parametrize("name", WEATHER_AGGREGATES)
def test_weather_aggregates_never_shuffle_raw_rows_with_large_dimensions(no_auto_broadcast, name):
    df = queries()[name](no_auto_broadcast, SF_SMALL)
    assert raw_shuffles(df, "lineitem.parquet") == []


@pytest.mark.parametrize("name", ["local_weather", "box_stats_local", "paired_series_local"])
def test_local_views_move_no_rows_of_other_stations(no_auto_broadcast, name):
    """Without any broadcast, only observations of the nearby stations (and what
    a Bloom filter lets through by chance) are shuffled."""
    df = queries()[name](no_auto_broadcast, SF_SMALL)
    assert raw_shuffles(df, "lineitem.parquet") == []
    whole = no_auto_broadcast.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    near = queries()["local_weather"](no_auto_broadcast, SF_SMALL).count()
    moved = shuffled_rows(queries()[name](no_auto_broadcast, SF_SMALL), "lineitem.parquet")
    assert near < whole / 2 and all(n <= near + whole / 100 for n in moved)
    assert moved or name == "paired_series_local"


def test_no_window_on_the_station(spark):
    for name in ("zone_weather_idw", "zone_display", "active_stations", "radius_join"):
        assert "Window" not in plan_text(queries()[name](spark, SF_SMALL))


def test_box_statistics_read_the_observations_twice(spark):
    from zonecast.operators import metrics, stats
    from zonecast.sources import tables
    rows = tables.weather_observations(spark, SF_SMALL)
    read = input_rows(stats.box_stats(rows, metrics.WEATHER_VARS))
    assert read["lineitem"] == 2 * rows.count()
