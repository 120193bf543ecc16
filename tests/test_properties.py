"""Property tests on generated stations and zones."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.test_spatial import _km
from zonecast.plans.dashboard import Dashboard, Params

ZSCHEMA = "GEOCODE string, GEONAME string, BOROUGH string, LATITUDE_ZONE double, LONGITUDE_ZONE double"
WSCHEMA = ("ID_STATION string, NAME string, LATITUDE double, LONGITUDE double, DATE date, "
           "TEMP double, DEWP double, WDSP double")
ASCHEMA = "GEOJOIN_ID string, DATE_MESURE_BRUTE string, NOM_POLLUANT string, VALEUR_BRUTE string"

coord = st.tuples(st.floats(40.5, 40.9), st.floats(-74.2, -73.8))
station = st.tuples(coord, st.lists(st.floats(-20, 100), min_size=1, max_size=4),
                    st.floats(0, 60), st.floats(0, 40))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(zones=st.lists(coord, min_size=1, max_size=6), stations=st.lists(station, min_size=1, max_size=8),
       radius=st.floats(1, 40))
def test_idw_between_extremes_and_one_row_per_zone(spark, zones, stations, radius):
    zrows = [(str(i), f"Z{i}", "B", la, lo) for i, (la, lo) in enumerate(zones)]
    wrows = []
    for j, ((la, lo), temps, dewp, wdsp) in enumerate(stations):
        for k, t in enumerate(temps):
            wrows.append((f"S{j}", f"S{j}", la, lo, dt.date(2000, 1, 1 + k), t, dewp, wdsp))
    z = spark.createDataFrame(zrows, ZSCHEMA)
    w = spark.createDataFrame(wrows, WSCHEMA)
    a = spark.createDataFrame([("0", "2000-01-01", "PM", "1.0")], ASCHEMA)
    p = Params(start=dt.date(2000, 1, 1), end=dt.date(2000, 1, 31), pollutant="PM", radius_km=radius)
    d = Dashboard(z, a, w, p)
    disp = d.display().collect()
    assert sorted(r.GEOCODE for r in disp) == sorted(r[0] for r in zrows)      # each zone once
    means = {r.ID_STATION: r for r in d.stations_with_means().collect()}
    for r, (code, _, _, la, lo) in zip(sorted(disp, key=lambda r: int(r.GEOCODE)), zrows):
        near = [m for m in means.values()
                if _km(lo, la, m.LONGITUDE, m.LATITUDE) <= radius - 1e-9]
        far = [m for m in means.values()
               if _km(lo, la, m.LONGITUDE, m.LATITUDE) > radius + 1e-9]
        assert len(near) <= r.NB_STATIONS <= len(means) - len(far)
        if r.NB_STATIONS and near and len(near) == r.NB_STATIONS:
            temps = [m.TEMP for m in near]
            assert min(temps) - 0.05 <= r.W_TEMP <= max(temps) + 0.05 or r.W_TEMP == 0.0


day = st.dates(min_value=dt.date(1999, 11, 1), max_value=dt.date(2001, 3, 31))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(day, st.one_of(st.none(), st.floats(-50, 50))), min_size=1, max_size=40))
def test_resample_covers_every_bucket_once(spark, rows):
    from zonecast.operators.timeseries import resample_mean
    df = spark.createDataFrame(rows, "DATE date, TEMP double")
    days = sorted(d for d, _ in rows)
    for rule, step in (("D", dt.timedelta(1)), ("W", dt.timedelta(7))):
        got = resample_mean(df, "DATE", "TEMP", rule).orderBy("DATE").collect()
        ends = [r.DATE for r in got]
        assert all(b - a == step for a, b in zip(ends, ends[1:]))
        assert ends[0] - step < days[0] <= ends[0] and ends[-1] - step < days[-1] <= ends[-1]
        for r in got:
            held = [t for d, t in rows if r.DATE - step < d <= r.DATE and t is not None]
            assert (r.TEMP is None) == (not held) and (not held or abs(r.TEMP - sum(held) / len(held)) < 1e-9)
