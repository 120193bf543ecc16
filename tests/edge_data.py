"""Hand-built rows covering the edge cases of the model."""

import datetime as dt

import pandas as pd

D = dt.date

ZONES = pd.DataFrame([
    ("1", "Alpha", "North", 40.70, -74.00),
    ("2", "Beta", "North", 40.80, -73.90),
    ("3", "Gamma", "South", 41.40, -74.90),     # no station in reach
    ("4", "Delta", "South", 40.60, -74.05),     # listed twice (duplicate zone)
    ("4", "Delta", "South", 40.60, -74.05),
    ("5", "Eps", "East", 40.75, -73.95),       # no air measurement
], columns=["GEOCODE", "GEONAME", "BOROUGH", "LATITUDE_ZONE", "LONGITUDE_ZONE"])


def _w(sid, name, lat, lon, day, temp, dewp, wdsp):
    return (sid, name, lat, lon, day, temp, dewp, wdsp)


WEATHER = pd.DataFrame([
    # A: on zone 1, one NULL temperature
    _w("A", "Alpha St", 40.70, -74.00, D(1998, 1, 4), 50.0, 30.0, 5.0),     # a Sunday
    _w("A", "Alpha St", 40.70, -74.00, D(1998, 1, 31), None, 31.0, 6.0),    # month end
    _w("A", "Alpha St", 40.70, -74.00, D(1998, 3, 31), 41.0, 32.0, 7.0),    # quarter end
    # B: moved and renamed mid-period (two dimension rows, both weighted)
    _w("B", "Bravo", 40.72, -74.01, D(1998, 2, 1), 60.0, 35.0, 4.0),
    _w("B", "Bravo New", 40.73, -74.01, D(1998, 9, 1), 62.0, 36.0, 4.5),
    # C: every TEMP NULL, near zone 2 -> zone 2 W_TEMP NULL
    _w("C", "Charlie", 40.79, -73.91, D(1998, 5, 5), None, 20.0, 3.0),
    _w("C", "Charlie", 40.79, -73.91, D(1998, 5, 6), None, 21.0, 3.5),
    # D: outliers only -> station disappears
    _w("D", "Delta St", 40.61, -74.04, D(1998, 6, 1), 70.0, 9999.9, 5.0),
    _w("D", "Delta St", 40.61, -74.04, D(1998, 6, 2), 70.0, 40.0, 999.9),
    # E: NULL wind row dropped; one valid row near zone 4
    _w("E", "Echo", 40.62, -74.06, D(1998, 7, 1), 80.0, 50.0, None),
    _w("E", "Echo", 40.62, -74.06, D(2000, 2, 29), 82.0, 52.0, 8.0),      # leap day
    # no station id: forms no station
    _w(None, "Ghost", 40.70, -74.00, D(1998, 1, 5), 10.0, 5.0, 1.0),
    # F: only outside the date range
    _w("F", "Fox", 40.76, -73.96, D(1990, 1, 1), 40.0, 20.0, 2.0),
], columns=["ID_STATION", "NAME", "LATITUDE", "LONGITUDE", "DATE", "TEMP", "DEWP", "WDSP"])

AIR = pd.DataFrame([
    ("1", "1998-01-05", "PM", "10.0"),
    ("1", "1998-01-06", "PM", "12.5"),
    ("2", "1998-02-01", "PM", "0.125"),        # rounding tie: 0.12 (half to even)
    ("2", "1998-02-02", "NO2", "3.0"),
    ("4", "1998-03-01", "PM", "7.0"),
    ("1", "not a date", "PM", "4.0"),          # unparsable date: kept, no date
    ("1", "1998-01-07", "PM", "n/a"),          # unparsable value: dropped
    ("99", "1998-01-07", "PM", "5.0"),         # unknown zone: dropped by the join
    ("3", "1999-06-01", "PM", "9.0"),          # out of range
], columns=["GEOJOIN_ID", "DATE_MESURE_BRUTE", "NOM_POLLUANT", "VALEUR_BRUTE"])

START, END = D(1998, 1, 1), D(2000, 12, 31)
RADIUS = 15.0
