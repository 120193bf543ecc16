"""Dashboard semantics on edge rows; expected values are worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tests import edge_data as E
from zonecast.operators import metrics
from zonecast.plans.dashboard import Dashboard, Params


def _spark_df(spark, pdf, schema):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), schema)


ZSCHEMA = "GEOCODE string, GEONAME string, BOROUGH string, LATITUDE_ZONE double, LONGITUDE_ZONE double"
WSCHEMA = ("ID_STATION string, NAME string, LATITUDE double, LONGITUDE double, DATE date, "
           "TEMP double, DEWP double, WDSP double")
ASCHEMA = "GEOJOIN_ID string, DATE_MESURE_BRUTE string, NOM_POLLUANT string, VALEUR_BRUTE string"


def dash(spark, **kw):
    args = dict(start=E.START, end=E.END, pollutant="PM", radius_km=E.RADIUS, zone="1")
    p = Params(**{**args, **kw})
    return Dashboard(_spark_df(spark, E.ZONES, ZSCHEMA), _spark_df(spark, E.AIR, ASCHEMA),
                     _spark_df(spark, E.WEATHER, WSCHEMA), p)


def test_edge_semantics(spark):
    d = {r.GEOCODE: r for r in dash(spark).display().collect()}
    assert d["2"].MEAN_POLLUANT == 0.12            # 0.125 rounds half to even
    assert d["2"].W_TEMP == 0.0                    # all TEMP NULL near zone 2 -> NULL -> 0
    assert d["2"].W_WIND is not None
    assert d["3"].NB_STATIONS == 0 and d["3"].W_WIND is None
    assert d["5"].MEAN_POLLUANT == 0.0
    # A, both rows of moved station B, C and E are within 15 km of zone 1;
    # C's NULL temperatures make the weighted temperature NULL (shown 0)
    assert d["1"].NB_STATIONS == 5 and d["1"].W_TEMP == 0.0


def test_station_fan_out(spark):
    sw = {(r.ID_STATION, r.NAME) for r in dash(spark).stations_with_means().collect()}
    assert ("B", "Bravo") in sw and ("B", "Bravo New") in sw
    assert not any(s == "D" for s, _ in sw)        # every row an outlier
    assert not any(s == "F" for s, _ in sw)        # no row in range


def test_duplicate_zone_keeps_both_rows(spark):
    rows = dash(spark).display().collect()
    assert sorted(r.GEOCODE for r in rows) == ["1", "2", "3", "4", "4", "4", "4", "5"]   # two rows x their two metric rows
    assert {r.MEAN_POLLUANT for r in rows if r.GEOCODE == "4"} == {7.0}
    assert {r.MEAN_POLLUANT for r in rows if r.GEOCODE == "1"} == {11.25}                # 10 and 12.5


def test_kpis(spark):
    k = dash(spark).kpi_global().first()
    # zones 1 (11.25), 2 (0.12), 4 (7.0, four rows), 3 (9.0: 1999 lies in the range)
    assert k.NB_ZONES == 7
    assert k.AVG_POLLUANT == pytest.approx((11.25 + 0.12 + 4 * 7.0 + 9.0) / 7)


def test_kpis_without_valid_zone_are_zero(spark):
    k = dash(spark, pollutant="NONE").kpi_global().first()
    assert (k.AVG_POLLUANT, k.AVG_TEMP, k.AVG_WIND, k.NB_ZONES) == (0.0, 0.0, 0.0, 0)


def test_kpi_formatting(spark):
    df = spark.createDataFrame([(195619.545, None, 22.25)], "AVG_POLLUANT double, AVG_TEMP double, AVG_WIND double")
    r = metrics.kpi_formatted(df).first()
    assert r.VAL_POLLUANT == f"{195619.545:.2f}"
    assert r.VAL_TEMP == "N/A"
    assert r.VAL_WIND == f"{22.25:.1f} km/h"


def test_air_cleaning_never_raises(spark):
    a = dash(spark).air_clean.collect()
    assert all(r.VALEUR is not None for r in a)
    assert any(r.DATE_OBSERVATION is None for r in a)      # bad date kept as NULL
    joined = {r.GEOJOIN_ID for r in dash(spark).air.collect()}
    assert "99" not in joined


def test_zone_detail_and_local_views(spark):
    d = dash(spark)
    det = d.zone_detail().first()
    assert det.TITLE == "Alpha" and det.CAPTION == "Borough: North | Stations locales : 5"
    ids = {r.ID_STATION for r in d.local_weather().collect()}
    assert ids == {"A", "B", "C", "E"}
    assert d.stations_near_zone().first().NB_VISIBLE == 5


def test_resample_by_hand(spark):
    days = {str(r.DATE): r for r in dash(spark).resample_weather("M").collect()}
    assert len(days) == 26 and min(days) == "1998-01-31" and max(days) == "2000-02-29"   # every month between
    jan = days["1998-01-31"]          # A on the 4th and 31st (TEMP NULL), and the row without a station
    assert jan.TEMP == pytest.approx(((50 - 32) * 5 / 9 + (10 - 32) * 5 / 9) / 2)
    assert jan.WDSP == pytest.approx((5 + 6 + 1) * 1.852 / 3)
    assert days["1998-05-31"].TEMP is None and days["1998-05-31"].WDSP == pytest.approx(3.25 * 1.852)
    assert days["1999-06-30"].TEMP is None and days["1999-06-30"].WDSP is None           # an empty bucket
    quarters = [str(r.DATE) for r in dash(spark).resample_weather("Q").orderBy("DATE").collect()]
    assert quarters[0] == "1998-03-31" and quarters[-1] == "2000-03-31" and len(quarters) == 9
    weeks = [str(r.DATE) for r in dash(spark).resample_weather("W").orderBy("DATE").collect()]
    assert weeks[0] == "1998-01-04" and weeks[1] == "1998-01-11"                          # they end on Sundays


def test_resample_empty_input(spark):
    d = dash(spark, pollutant="NONE")
    assert d.resample_air("D").count() == 0


def test_paired_series_full_outer(spark):
    rows = dash(spark).paired_series("M").collect()
    buckets = [r.BUCKET for r in rows]
    assert len(buckets) == len(set(buckets))
    assert any(r.VALEUR is None and r.TEMP is not None for r in rows)


def test_box_stats_edge(spark):
    out = {r.VARIABLE: r for r in dash(spark).box_stats().collect()}
    assert set(out) == {"TEMP", "WDSP", "DEWP"}
    # TEMP: A 50 and 41, B 60 and 62, E 82 in 2000, and the row without a station; NULLs don't count
    assert out["TEMP"].N == 6
    c = sorted((f - 32) * 5 / 9 for f in (50, 41, 60, 62, 82, 10))
    assert out["TEMP"].MEDIAN == pytest.approx((c[2] + c[3]) / 2, abs=1e-6)


def test_box_stats_count_a_station_with_two_names_once(spark):
    import datetime as dt
    one = spark.createDataFrame([("X", 40.7, -74.0, dt.date(1998, 1, 1), 50.0, 30.0, 5.0)],
                                "ID_STATION string, LATITUDE double, LONGITUDE double, DATE date, TEMP double, DEWP double, WDSP double")
    names = spark.createDataFrame([("X", "Old"), ("X", "New")], "ID_STATION string, NAME string")
    d = Dashboard(_spark_df(spark, E.ZONES, ZSCHEMA), _spark_df(spark, E.AIR, ASCHEMA), None,
                  Params(start=E.START, end=E.END), observations=one, station_names=names)
    assert {r.N for r in d.box_stats().collect()} == {1}


def test_open_range_and_pollutant_are_the_data_s_own(spark):
    import datetime as dt
    d = dash(spark, start=None, end=None, pollutant=None)
    assert d.range == (dt.date(1998, 1, 5), dt.date(1999, 6, 1)) and d.rule == "M"
    assert d.pollutant == "NO2"
    with pytest.raises(LookupError):
        dash(spark, start=dt.date(1980, 1, 1), end=dt.date(1980, 2, 1)).require_pollutants()
    with pytest.raises(ValueError):
        dash(spark, zone=None).zone_detail()


def test_no_weather_in_range(spark):
    import datetime as dt
    d = dash(spark, start=dt.date(1980, 1, 1), end=dt.date(1980, 12, 31))
    rows = d.display().collect()
    assert all(r.NB_STATIONS == 0 and r.W_WIND is None and r.W_TEMP == 0.0 for r in rows)
    assert d.resample_weather("D").count() == 0
    k = d.kpi_global().first()
    assert (k.AVG_POLLUANT, k.NB_ZONES) == (0.0, 0)


def test_single_day_range(spark):
    import datetime as dt
    day = dt.date(1998, 1, 4)
    d = dash(spark, start=day, end=day)
    assert d.rule == "D"
    series = d.resample_weather().collect()
    assert [r.DATE for r in series] == [day]
    assert d.display().where("GEOCODE = '1'").first().NB_STATIONS == 1     # only A reports that day


def test_temp_ceiling_is_optional(spark):
    import datetime as dt
    rows = [("X", "X", 40.7, -74.0, dt.date(1998, 1, 1), 9999.9, 30.0, 5.0),
            ("X", "X", 40.7, -74.0, dt.date(1998, 1, 2), 50.0, 30.0, 5.0)]
    w = spark.createDataFrame(rows, WSCHEMA)
    from zonecast.operators import clean
    kept = [r.TEMP for r in clean.clean_weather(w).orderBy("DATE").collect()]
    assert kept[0] > 5000                                   # compatible default: not filtered
    capped = [r.TEMP for r in clean.clean_weather(w, temp_max=60.0).orderBy("DATE").collect()]
    assert capped[0] is None and capped[1] == kept[1]


def test_keyed_resample_equals_filter_then_resample(spark):
    from zonecast.operators.timeseries import resample_mean
    w = _spark_df(spark, E.WEATHER, WSCHEMA)
    keys = spark.createDataFrame([("A",), ("B",), ("B",), ("E",)], "ID_STATION string")
    for rule in ("D", "W", "M", "Q"):
        keyed = resample_mean(w, "DATE", ("TEMP", "WDSP"), rule, keep_keys=keys).orderBy("DATE").collect()
        plain = resample_mean(w.where("ID_STATION IN ('A', 'B', 'E')"), "DATE", ("TEMP", "WDSP"), rule) \
            .orderBy("DATE").collect()
        assert [r.DATE for r in keyed] == [r.DATE for r in plain]
        for a, b in zip(keyed, plain):
            for c in ("TEMP", "WDSP"):
                assert (a[c] is None and b[c] is None) or abs(a[c] - b[c]) < 1e-9


def test_views_and_display_positions(spark):
    d = dash(spark)
    views = d.views()
    assert set(views) == {"display", "kpi", "pollutants", "air_series", "weather_series", "paired"}
    assert [r.NOM_POLLUANT for r in views["pollutants"].collect()] == ["NO2", "PM"]
    with_pos = d.display(keep_position=True)
    assert with_pos.columns[-2:] == ["LATITUDE_ZONE", "LONGITUDE_ZONE"]
    assert with_pos.where("GEOCODE = '1'").first().LATITUDE_ZONE == 40.70


def test_sparse_states_reach_their_gaps():
    """The sparse queries meet what they are there for (by their SQL, on the smallest tables)."""
    import duckdb

    from tests.conftest import SF_SMALL
    from zonecast.oracle import queries_sql
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sql = queries_sql()
    rows = con.sql(f"SELECT MEAN_POLLUANT, W_WIND, NB_STATIONS FROM ({sql['zone_display_sparse']})").fetchall()
    assert any(r[0] == 0 for r in rows) and any(r[0] > 0 for r in rows)              # P17, P18
    assert any(r[1] is None and r[2] == 0 for r in rows)                             # P19, P20
    assert con.sql(sql["kpi_formatted_no_station"]).fetchall()[0][1:] == ("N/A", "N/A")   # P23
    assert con.sql(f"SELECT AVG_TEMP, NB_ZONES FROM ({sql['kpi_global_no_measurement']})").fetchall() == [(0.0, 0)]
    assert con.sql(sql["resample_air_empty"]).fetchall() == []                       # T4
    gaps = con.sql(f"SELECT count(*), count(VALEUR), count(TEMP) FROM ({sql['paired_series_sparse']})").fetchall()[0]
    assert gaps[1] < gaps[0]                                                         # T3
