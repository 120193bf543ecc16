"""The stage counts and display values FIXTURES.md lists, at two scales."""

import pytest

from zonecast.plans import catalog
from zonecast.plans.dashboard import Dashboard, Params

COUNTS = {
    "/root/testdata/sf0.001": dict(weather=5633, air=1470, dim=11, ids2=1, means=10,
                                   zones_with_station=23, zones_with_mean=19),
    "/root/testdata/sf0.01": dict(weather=56394, air=14698, dim=110, ids2=10, means=100,
                                  zones_with_station=25, zones_with_mean=25),
}
DISPLAY = {
    "/root/testdata/sf0.001": [("0", 0.0, 15.1, 22.2, 1.0, 1), ("1", 225575.92, 15.3, 22.9, 1.4, 3),
                               ("2", 207063.79, 14.5, 21.3, 1.1, 1)],
    "/root/testdata/sf0.01": [("0", 212738.74, 16.0, 22.2, 2.0, 15), ("1", 242002.16, 15.3, 22.5, 1.4, 19),
                              ("2", 238435.87, 16.3, 22.5, 2.1, 14)],
}
KPIS = {"/root/testdata/sf0.001": (195619.543684, 15.876471, 22.364706, 19),
        "/root/testdata/sf0.01": (246079.21, 16.04, 22.18, 25)}


def _dash(spark, sf_dir):
    return Dashboard.from_tables(spark, sf_dir, Params(**catalog.FIXTURE, **catalog.YEAR_1998))


@pytest.mark.parametrize("sf_dir", sorted(COUNTS))
def test_stage_counts(spark, sf_dir):
    dash = _dash(spark, sf_dir)
    got = dict(weather=dash.weather.count(), air=dash.air.count(), dim=dash.stations.count(),
               ids2=dash.stations.groupBy("ID_STATION").count().where("count = 2").count(),
               means=dash.station_means().count(),
               zones_with_station=dash.zone_weather().where("NB_STATIONS > 0").count(),
               zones_with_mean=dash.pollutant_means().count())
    assert got == COUNTS[sf_dir]


@pytest.mark.parametrize("sf_dir", sorted(COUNTS))
def test_display_rows_and_kpis(spark, sf_dir):
    rows = (_dash(spark, sf_dir).display().where("GEOCODE IN ('0', '1', '2')")
            .orderBy("GEOCODE").collect())
    assert [(r.GEOCODE, r.MEAN_POLLUANT, r.W_TEMP, r.W_WIND, r.W_DEWP, r.NB_STATIONS) for r in rows] \
        == DISPLAY[sf_dir]
    k = _dash(spark, sf_dir).kpi_global().first()
    assert (round(k.AVG_POLLUANT, 6), round(k.AVG_TEMP, 6), round(k.AVG_WIND, 6), k.NB_ZONES) \
        == pytest.approx(KPIS[sf_dir])
