"""Distance joins and polygon centroids.

Spark has no native distance join; this one is an equi-join on grid cells.
Each right row sits in its single home cell; each left row is expanded to the
cells overlapping the bounding box of its search circle (exact bounds, so
nothing within the radius is missed), then the exact haversine predicate is
applied. Each (left, right) pair meets in exactly one cell, so no pair
repeats. It scales like a hash join and lets AQE split a crowded cell; with a
bound on the right rows of a cell (``dense``) crowded cells are divided.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.geo import angular_radius_deg, haversine_km, lon_half_extent_deg

KM_PER_DEG = 111.0          # a little under 111.19, so cells are never too small
EPS_DEG = 1e-9              # guard against rounding at the circle's edge
MAX_SPLIT = 64              # of a crowded cell, a side; what stays crowded is dealt by hash


def _grid(radius_km: float) -> tuple[int, float]:
    """Number of cells around 360 degrees and the cell size (degrees)."""
    approx = max(radius_km, 1e-3) / KM_PER_DEG
    ncols = max(1, int(360.0 // approx))
    return ncols, 360.0 / ncols


def _home_cell(df: DataFrame, lat: str, lon: str, radius_km: float) -> DataFrame:
    ncols, size = _grid(radius_km)
    return df.withColumns({
        "_cy": F.floor((F.col(lat) + 90.0) / size),
        "_cx": F.pmod(F.floor((F.col(lon) + 180.0) / size), F.lit(ncols)),
    })


def _search_cells(df: DataFrame, lat: str, lon: str, radius_km: float) -> DataFrame:
    """One row per grid cell overlapping the bounding box of the search circle."""
    ncols, size = _grid(radius_km)
    d_lat = angular_radius_deg(radius_km) + EPS_DEG
    d_lon = lon_half_extent_deg(F.col(lat), radius_km) + EPS_DEG
    lo_x = F.floor((F.col(lon) - d_lon + 180.0) / size)
    hi_x = F.floor((F.col(lon) + d_lon + 180.0) / size)
    all_x = F.sequence(F.lit(0), F.lit(ncols - 1)).cast("array<bigint>")
    xs = F.when(d_lon.isNull() | (hi_x - lo_x + 1 >= ncols), all_x).otherwise(F.sequence(lo_x, hi_x))
    ys = F.sequence(F.floor((F.col(lat) - d_lat + 90.0) / size),
                    F.floor((F.col(lat) + d_lat + 90.0) / size))
    return (df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
            .withColumn("_cy", F.explode(ys))
            .withColumn("_cx", F.explode(xs))
            .withColumn("_cx", F.pmod(F.col("_cx"), F.lit(ncols))))


def _within(at: Column, cell: Column, k: Column) -> Column:
    """The one of ``k`` equal slices of a cell that ``at`` (in cells) lies in; the nearest one for places outside."""
    return F.greatest(F.lit(0), F.least(F.floor((at - cell) * k), k - 1)).cast("int")


def _divided(lcells: DataFrame, rcells: DataFrame, radius_km: float, dense: int, *,
             left_lat: str, left_lon: str, right_lat: str, right_lon: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the keys they meet by once cells of more than ``dense`` right rows are divided.

    Such a cell becomes k x k slices, k by its count; a left row goes to the
    slices its bounding box overlaps. A slice that still holds too many rows
    (a cluster, or one position) is dealt into parts by a hash of the row,
    and the left rows go to every part. A right row stays in one place, so
    pairs still meet once.
    """
    ncols, size = _grid(radius_km)
    cell, keys = ["_cy", "_cx"], ["_cy", "_cx", "_sy", "_sx"]
    k = F.coalesce("_k", F.lit(1))
    crowded = (rcells.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > dense)
               .select(*cell, F.least(F.ceil(F.sqrt(F.col("_n") / dense)), F.lit(MAX_SPLIT)).cast("int").alias("_k")))

    y, x = (F.col(right_lat) + 90.0) / size, (F.col(right_lon) + 180.0) / size
    columns = [c for c in rcells.columns if c not in cell]
    placed = (rcells.join(crowded, cell, "left")
              .withColumns({"_sy": _within(y, F.floor(y), k), "_sx": _within(x, F.floor(x), k)}))
    parts = (placed.where("_k IS NOT NULL").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > dense)
             .select(*keys, F.ceil(F.col("_n") / dense).cast("int").alias("_parts")))
    n_parts = F.coalesce("_parts", F.lit(1))
    rights = (placed.join(parts, keys, "left")
              .withColumn("_part", F.pmod(F.xxhash64(*columns), n_parts).cast("int")).drop("_k", "_parts"))

    d_lat = angular_radius_deg(radius_km) + EPS_DEG
    d_lon = lon_half_extent_deg(F.col(left_lat), radius_km) + EPS_DEG
    lo, hi = (F.col(left_lon) - d_lon + 180.0) / size, (F.col(left_lon) + d_lon + 180.0) / size
    around = d_lon.isNull() | (F.floor(hi) - F.floor(lo) + 1 >= ncols)
    turned = F.floor(lo) + F.pmod(F.col("_cx") - F.floor(lo), F.lit(ncols))        # the cell, counted on from the box
    sx = F.when(around, F.sequence(F.lit(0), k - 1)).otherwise(F.sequence(_within(lo, turned, k), _within(hi, turned, k)))
    cy = F.col("_cy")
    sy = F.sequence(_within((F.col(left_lat) - d_lat + 90.0) / size, cy, k), _within((F.col(left_lat) + d_lat + 90.0) / size, cy, k))
    lefts = (lcells.join(crowded, cell, "left").withColumn("_sy", F.explode(sy)).withColumn("_sx", F.explode(sx))
             .join(parts, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n_parts - 1))).drop("_k", "_parts"))
    return lefts, rights, [*keys, "_part"]


def radius_pairs(left: DataFrame, right: DataFrame, radius_km: float, *,
                 left_lat: str, left_lon: str, right_lat: str, right_lon: str,
                 dist_col: str = "DIST_KM", dense: int | None = None) -> DataFrame:
    """Every (left row, right row) with haversine distance <= ``radius_km``
    (inclusive), plus the distance. Column names of the sides must differ.

    ``dense`` bounds the right rows that meet in one place, whatever their
    positions (see :func:`_divided`). The right side is then counted before
    it is joined: give a table, not a long plan."""
    places = {"left_lat": left_lat, "left_lon": left_lon, "right_lat": right_lat, "right_lon": right_lon}
    lcells = _search_cells(left, left_lat, left_lon, radius_km)
    rcells = _home_cell(right.where(F.col(right_lat).isNotNull() & F.col(right_lon).isNotNull()),
                        right_lat, right_lon, radius_km)
    keys = ["_cy", "_cx"]
    if dense is not None:
        lcells, rcells, keys = _divided(lcells, rcells, radius_km, dense, **places)
    dist = haversine_km(left_lon, left_lat, right_lon, right_lat)
    return (lcells.join(rcells, keys, "inner")
            .drop(*keys)
            .withColumn(dist_col, dist)
            .where(F.col(dist_col) <= radius_km))


def radius_join_left(left: DataFrame, right: DataFrame, radius_km: float, *, left_key: list[str],
                     left_lat: str, left_lon: str, right_lat: str, right_lon: str,
                     dist_col: str = "DIST_KM", dense: int | None = None) -> DataFrame:
    """Left-outer form: left rows with no right row within the radius are
    kept once, with NULL right columns. The unmatched rows come from an
    anti join on the distinct matched keys (an aggregate), not from a
    per-key window, so a key with a third of all pairs stays spread out."""
    pairs = radius_pairs(left, right, radius_km, left_lat=left_lat, left_lon=left_lon,
                         right_lat=right_lat, right_lon=right_lon, dist_col=dist_col, dense=dense)
    matched = pairs.select(*left_key).distinct()
    alone = left.join(matched, left_key, "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# Polygon centroids (shoelace over nested geometry arrays, per row)
# ---------------------------------------------------------------------------
# Geometry is MultiPolygon coordinates: array(polygon) of array(ring) of
# array(point) of [x, y]. Ring 0 of each polygon is its shell, the rest holes.

def _ring_sums(ring: Column, x0: Column, y0: Column) -> Column:
    """struct(a, mx, my): twice the signed area and the first moments (x6)."""
    n = F.size(ring)

    def step(acc, k):
        p = ring[k]
        q = ring[F.pmod(k + 1, n)]
        x1, y1 = p[0] - x0, p[1] - y0
        x2, y2 = q[0] - x0, q[1] - y0
        cr = x1 * y2 - x2 * y1
        return F.struct((acc["a"] + cr).alias("a"),
                        (acc["mx"] + (x1 + x2) * cr).alias("mx"),
                        (acc["my"] + (y1 + y2) * cr).alias("my"))

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    steps = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, zero, step)


def _sum_structs(arr: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    return F.aggregate(arr, zero, lambda acc, s: F.struct(
        (acc["a"] + s["a"]).alias("a"), (acc["mx"] + s["mx"]).alias("mx"),
        (acc["my"] + s["my"]).alias("my")))


def _polygon_sums(polygon: Column, x0: Column, y0: Column) -> Column:
    """Shell counts positive, holes negative, whatever the ring orientation.
    Each ring is summed once; the signs are applied to the summed structs."""
    rings = F.transform(polygon, lambda ring: _ring_sums(ring, x0, y0))

    def signed(s, i):
        sign = F.signum(s["a"]) * F.when(i == 0, 1.0).otherwise(-1.0)
        return F.struct((s["a"] * sign).alias("a"), (s["mx"] * sign).alias("mx"),
                        (s["my"] * sign).alias("my"))
    return _sum_structs(F.transform(rings, signed))


def with_centroid(df: DataFrame, coords: str = "COORDINATES", lat: str = "LATITUDE_ZONE",
                  lon: str = "LONGITUDE_ZONE", projected: bool = False,
                  proj: "LambertConic | None" = None) -> DataFrame:
    """Add the area-weighted centroid of each row's multipolygon.

    Coordinates are shifted to the first vertex before summing, which keeps
    the cross products small and the result exact to rounding. With
    ``projected`` the sums run in the Lambert conformal conic plane and the
    centroid is mapped back to lon/lat. Every stage is its own column so no
    expression is evaluated twice.
    """
    src = F.col(coords)
    tmp = ["_c_planar", "_c_x0", "_c_y0", "_c_tot", "_c_x", "_c_y"]
    if projected:
        proj = proj or LambertConic()

        def fwd(pt):
            x, y = proj.forward(pt[0], pt[1])
            return F.array(x, y)
        df = df.withColumn("_c_planar", F.transform(src, lambda poly: F.transform(
            poly, lambda ring: F.transform(ring, fwd))))
        src = F.col("_c_planar")
    # the first vertex there is; without one every sum is 0 and the centroid NULL
    first = F.get(F.flatten(F.flatten(src)), F.lit(0))
    df = df.withColumns({"_c_x0": F.get(first, F.lit(0)), "_c_y0": F.get(first, F.lit(1))})
    x0, y0 = F.col("_c_x0"), F.col("_c_y0")
    df = df.withColumn("_c_tot", _sum_structs(F.transform(src, lambda poly: _polygon_sums(poly, x0, y0))))
    tot = F.col("_c_tot")
    # a degenerate (zero-area) geometry has no centroid: NULL, not an error
    area3 = F.when(tot["a"] != 0, tot["a"] * 3.0)
    df = df.withColumns({"_c_x": x0 + tot["mx"] / area3, "_c_y": y0 + tot["my"] / area3})
    if projected:
        df, tmp = proj.inverse_columns(df, "_c_x", "_c_y", lon, lat), tmp + proj.TEMP_COLUMNS
    else:
        df = df.withColumns({lon: F.col("_c_x"), lat: F.col("_c_y")})
    return df.drop(*[c for c in tmp if c in df.columns])


# ---------------------------------------------------------------------------
# Lambert conformal conic (two standard parallels), ellipsoidal forward and
# inverse as Column expressions (Snyder 1987, USGS PP 1395, eq. 15-1..15-11).
# ---------------------------------------------------------------------------

class LambertConic:
    """EPSG:2263 (NAD83 / New York Long Island) on GRS80,
    parallels 41 deg 02', 40 deg 40', origin 40 deg 10' N, 74 deg W. False
    easting and units are omitted: a centroid is invariant to both."""

    def __init__(self, a=6378137.0, inv_f=298.257222101, lat1=41.0 + 2.0 / 60.0,
                 lat2=40.0 + 40.0 / 60.0, lat0=40.0 + 10.0 / 60.0, lon0=-74.0):
        f = 1.0 / inv_f
        self.e = math.sqrt(2 * f - f * f)
        self.a = a
        self.lon0 = math.radians(lon0)
        p1, p2, p0 = math.radians(lat1), math.radians(lat2), math.radians(lat0)
        m1, m2 = self._m(p1), self._m(p2)
        t1, t2, t0 = self._t(p1), self._t(p2), self._t(p0)
        self.n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        self.F = m1 / (self.n * t1 ** self.n)
        self.rho0 = a * self.F * t0 ** self.n

    def _m(self, phi):
        return math.cos(phi) / math.sqrt(1 - (self.e * math.sin(phi)) ** 2)

    def _t(self, phi):
        es = self.e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (self.e / 2)

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        phi = F.radians(lat)
        es = F.sin(phi) * self.e
        t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - es) / (1 + es), self.e / 2)
        rho = F.pow(t, self.n) * (self.a * self.F)
        theta = (F.radians(lon) - self.lon0) * self.n
        return rho * F.sin(theta), self.rho0 - rho * F.cos(theta)

    TEMP_COLUMNS = ["_p_dy", "_p_t", "_p_phi"]

    def inverse_columns(self, df: DataFrame, x: str, y: str, lon: str, lat: str,
                        steps: int = 6) -> DataFrame:
        """Add ``lon``/``lat`` (degrees) for planar ``x``/``y``; the latitude
        iteration runs as successive columns (each step reads the last)."""
        sgn = 1.0 if self.n > 0 else -1.0
        X = F.col(x)
        df = df.withColumn("_p_dy", F.lit(self.rho0) - F.col(y))
        dy = F.col("_p_dy")
        rho = F.sqrt(X * X + dy * dy) * sgn
        df = df.withColumn("_p_t", F.pow(rho / (self.a * self.F), 1.0 / self.n))
        theta = F.atan2(X * sgn, dy * sgn)
        df = df.withColumns({lon: F.degrees(theta / self.n + self.lon0),
                             "_p_phi": math.pi / 2 - 2 * F.atan(F.col("_p_t"))})
        for _ in range(steps):
            es = F.sin(F.col("_p_phi")) * self.e
            df = df.withColumn("_p_phi", math.pi / 2 - 2 * F.atan(
                F.col("_p_t") * F.pow((1 - es) / (1 + es), self.e / 2)))
        return df.withColumn(lat, F.degrees(F.col("_p_phi")))
