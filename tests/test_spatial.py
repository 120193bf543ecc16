"""Distance joins and centroids against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from zonecast.operators import spatial
from zonecast.operators.spatial import LambertConic, radius_pairs, with_centroid


def _points(spark, rows, prefix):
    return spark.createDataFrame(rows, f"{prefix}_ID long, {prefix}_LAT double, {prefix}_LON double")


def _pairs(df):
    return sorted((r.L_ID, r.R_ID) for r in df.select("L_ID", "R_ID").collect())


def _km(lon1, lat1, lon2, lat2):
    """Great-circle distance from the chord between unit vectors (another formula than the library's)."""
    (x1, y1, z1), (x2, y2, z2) = (
        (math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la))
        for lo, la in ((math.radians(lon1), math.radians(lat1)), (math.radians(lon2), math.radians(lat2))))
    chord = math.sqrt((x1 - x2) ** 2 + (y1 - y2) ** 2 + (z1 - z2) ** 2)
    return 6371.0 * 2 * math.asin(min(1.0, chord / 2))


def _brute(left, right, r):
    out = []
    for lid, la, lo in left:
        for rid, ra, ro in right:
            if _km(lo, la, ro, ra) <= r:
                out.append((lid, rid))
    return sorted(out)


@pytest.mark.parametrize("radius", [1.0, 15.0, 100.0])
def test_grid_equals_brute_force(spark, radius):
    rnd = random.Random(int(radius))
    left = [(i, 40.5 + rnd.uniform(-1, 1), -74 + rnd.uniform(-1, 1)) for i in range(60)]
    right = [(i, 40.5 + rnd.uniform(-1, 1), -74 + rnd.uniform(-1, 1)) for i in range(400)]
    right += [(1000 + i, left[i][1], left[i][2]) for i in range(5)]          # on top of a zone
    L, R = _points(spark, left, "L"), _points(spark, right, "R")
    kw = dict(left_lat="L_LAT", left_lon="L_LON", right_lat="R_LAT", right_lon="R_LON")
    assert _pairs(radius_pairs(L, R, radius, **kw)) == _brute(left, right, radius)


def test_grid_near_poles_and_antimeridian(spark):
    rnd = random.Random(9)
    left = [(i, rnd.uniform(80, 89.99), rnd.uniform(-180, 180)) for i in range(20)]
    left += [(100 + i, rnd.uniform(-60, 60), rnd.choice([179.99, -179.99])) for i in range(20)]
    right = [(i, rnd.uniform(79, 90), rnd.uniform(-180, 180)) for i in range(300)]
    right += [(1000 + i, rnd.uniform(-61, 61), rnd.uniform(179.5, 180)) for i in range(200)]
    right += [(2000 + i, rnd.uniform(-61, 61), rnd.uniform(-180, -179.5)) for i in range(200)]
    L, R = _points(spark, left, "L"), _points(spark, right, "R")
    kw = dict(left_lat="L_LAT", left_lon="L_LON", right_lat="R_LAT", right_lon="R_LON")
    for radius in (25.0, 100.0):
        assert _pairs(radius_pairs(L, R, radius, **kw)) == _brute(left, right, radius)


@pytest.mark.parametrize("dense", [1, 7, 50])
def test_divided_cells_give_the_same_pairs(spark, dense):
    rnd = random.Random(dense)
    left = [(i, 40.7 + rnd.uniform(-.3, .3), -74 + rnd.uniform(-.3, .3)) for i in range(25)]
    left += [(100 + i, rnd.uniform(-80, 89.99), rnd.choice([179.99, -179.99, 180.0])) for i in range(15)]
    right = [(i, 40.7 + rnd.gauss(0, .02), -74 + rnd.gauss(0, .02)) for i in range(200)]         # a city
    right += [(1000 + i, 40.71, -74.01) for i in range(60)]                                      # one position
    right += [(2000 + i, rnd.uniform(-81, 90), rnd.choice([-1, 1]) * rnd.uniform(179.9, 180)) for i in range(150)]
    right += [(3000, None, 1.0), (3001, 1.0, None)]
    L, R = _points(spark, left, "L"), _points(spark, right, "R")
    kw = dict(left_lat="L_LAT", left_lon="L_LON", right_lat="R_LAT", right_lon="R_LON")
    for radius in (2.0, 30.0):
        got = radius_pairs(L, R, radius, dense=dense, **kw)
        assert _pairs(got) == _brute(left, [p for p in right if None not in p], radius)
        assert got.columns == radius_pairs(L, R, radius, **kw).columns


def test_no_place_holds_more_than_its_bound(spark):
    """A third of all stations in one city, and many at one position."""
    rnd = random.Random(4)
    right = [(i, rnd.uniform(35, 45), rnd.uniform(-80, -70)) for i in range(2000)]
    right += [(5000 + i, 40.7 + rnd.gauss(0, .01), -74 + rnd.gauss(0, .01)) for i in range(700)]
    right += [(9000 + i, 40.75, -74.02) for i in range(300)]
    kw = dict(left_lat="L_LAT", left_lon="L_LON", right_lat="R_LAT", right_lon="R_LON")
    left, rights = _points(spark, [(1, 40.7, -74.0)], "L"), _points(spark, right, "R")
    lcells, rcells = spatial._search_cells(left, "L_LAT", "L_LON", 15.0), spatial._home_cell(rights, "R_LAT", "R_LON", 15.0)
    _, placed, keys = spatial._divided(lcells, rcells, 15.0, 50, **kw)
    assert placed.count() == len(right)
    assert rcells.groupBy("_cy", "_cx").count().agg(F.max("count")).first()[0] > 600
    assert placed.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 75       # parts by hash: about 50 each


def test_point_exactly_at_the_radius_is_inside(spark):
    L = _points(spark, [(1, 40.7, -74.0)], "L")
    R = _points(spark, [(7, 40.8, -73.9)], "R")
    kw = dict(left_lat="L_LAT", left_lon="L_LON", right_lat="R_LAT", right_lon="R_LON")
    exact = radius_pairs(L, R, 1000.0, **kw).first().DIST_KM
    assert _pairs(radius_pairs(L, R, exact, **kw)) == [(1, 7)]


def _shoelace(polys):
    """Exact (rational) centroid of polygons given as lists of rings, ring 0
    the shell, any orientation."""
    from fractions import Fraction as Q
    area = cx = cy = Q(0)
    for rings in polys:
        for i, ring in enumerate(rings):
            pts = [(Q(x), Q(y)) for x, y in ring]
            a = mx = my = Q(0)
            for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1]):
                cr = x1 * y2 - x2 * y1
                a += cr
                mx += (x1 + x2) * cr
                my += (y1 + y2) * cr
            s = (1 if a > 0 else -1) * (1 if i == 0 else -1)
            area += s * a
            cx += s * mx
            cy += s * my
    return float(cx / (3 * area)), float(cy / (3 * area))


def test_centroid_holes_parts_and_orientation(spark):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole_cw = [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]          # off-centre hole
    shell_cw = [[10, 0], [10, 2], [12, 2], [12, 0], [10, 0]]   # clockwise shell
    cases = [[[square]], [[square, hole_cw]], [[square, hole_cw], [shell_cw]]]
    shift = [(-74.0 + x / 100, 40.7 + y / 100) for x, y in [(0, 0)]][0]

    def moved(polys):
        return [[[[shift[0] + x / 100, shift[1] + y / 100] for x, y in ring] for ring in rings]
                for rings in polys]
    rows = [(i, moved(c)) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "ID int, COORDINATES array<array<array<array<double>>>>")
    got = {r.ID: (r.LONGITUDE_ZONE, r.LATITUDE_ZONE) for r in with_centroid(df).collect()}
    for i, c in rows:
        x, y = _shoelace(c)
        assert got[i][0] == pytest.approx(x, abs=1e-12)
        assert got[i][1] == pytest.approx(y, abs=1e-12)


def test_centroid_moves_with_translation(spark):
    ring = [[0.0, 0.0], [3.0, 0.0], [3.0, 1.0], [0.0, 2.0], [0.0, 0.0]]
    rows = [(k, [[[[x + k, y + 2 * k] for x, y in ring]]]) for k in range(5)]
    df = spark.createDataFrame(rows, "ID int, COORDINATES array<array<array<array<double>>>>")
    got = {r.ID: (r.LONGITUDE_ZONE, r.LATITUDE_ZONE) for r in with_centroid(df).collect()}
    for k in range(1, 5):
        assert got[k][0] - got[0][0] == pytest.approx(k, abs=1e-12)
        assert got[k][1] - got[0][1] == pytest.approx(2 * k, abs=1e-12)


def test_lambert_round_trip(spark):
    proj = LambertConic()
    rnd = random.Random(1)
    pts = [(rnd.uniform(-74.3, -73.7), rnd.uniform(40.5, 40.95)) for _ in range(100)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    x, y = proj.forward(F.col("lon"), F.col("lat"))
    back = proj.inverse_columns(df.withColumns({"x": x, "y": y}), "x", "y", "lon2", "lat2")
    for r in back.collect():
        assert r.lon2 == pytest.approx(r.lon, abs=1e-12)
        assert r.lat2 == pytest.approx(r.lat, abs=1e-12)
    # scale at the standard parallels is 1: a 1e-4 degree step east at 41 deg 02'
    lat1 = 41 + 2 / 60
    d = df.limit(1).select(*proj.forward(F.lit(-74.0), F.lit(lat1)), *proj.forward(F.lit(-73.9999), F.lit(lat1))).first()
    planar = math.hypot(d[2] - d[0], d[3] - d[1])
    a, e2 = 6378137.0, proj.e ** 2
    n_radius = a / math.sqrt(1 - e2 * math.sin(math.radians(lat1)) ** 2)
    assert planar == pytest.approx(n_radius * math.cos(math.radians(lat1)) * math.radians(1e-4), rel=1e-7)


def test_degenerate_polygon_has_null_centroid(spark):
    flat = [[[[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [0.0, 0.0]]]]
    df = spark.createDataFrame([(1, flat)], "ID int, COORDINATES array<array<array<array<double>>>>")
    r = with_centroid(df).first()
    assert r.LATITUDE_ZONE is None and r.LONGITUDE_ZONE is None


def test_empty_rings_have_null_centroid(spark):
    good = [[[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]], []]]       # an empty hole
    rows = [(1, [[[]]]), (2, [[]]), (3, []), (4, None), (5, good), (6, [[[]], good[0]])]
    df = spark.createDataFrame(rows, "ID int, COORDINATES array<array<array<array<double>>>>")
    for projected in (False, True):
        got = {r.ID: r for r in with_centroid(df, projected=projected).collect()}
        assert [got[i].LATITUDE_ZONE for i in (1, 2, 3, 4)] == [None] * 4
    got = {r.ID: r for r in with_centroid(df).collect()}
    assert all((got[i].LONGITUDE_ZONE, got[i].LATITUDE_ZONE) == (1.0, 1.0) for i in (5, 6))
