"""Zone boundaries as GeoJSON.

Writing produces GeoJSON text sequences (one Feature per line), so both
the write and the read split across tasks. FeatureCollection documents
are read too (one document per file, by as many tasks as it has splits). Geometry is normalised to
MultiPolygon coordinates: array(polygon) of array(ring) of array([x, y]).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.sources.jsonsplit import array_elements

PROPERTIES = ("GEOCODE", "GEONAME", "BOROUGH")
_FEATURE = ("struct<type:string,properties:struct<GEOCODE:string,GEONAME:string,BOROUGH:string>,"
            "geometry:struct<type:string,coordinates:string>>")
_POLYGON = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"



def coordinates(geom_type: Column, text: Column) -> Column:
    """MultiPolygon coordinates from the JSON text of a geometry's coordinates."""
    return (F.when(geom_type == "Polygon", F.array(F.from_json(text, _POLYGON)))
            .when(geom_type == "MultiPolygon", F.from_json(text, _MULTI)))


def _normalise(df: DataFrame) -> DataFrame:
    """Properties as columns; coordinates typed by geometry type (a Polygon
    becomes a one-part MultiPolygon)."""
    g = F.col("f.geometry")
    coords = coordinates(g["type"], g["coordinates"])
    return df.select(*[F.col(f"f.properties.{p}").alias(p) for p in PROPERTIES],
                     g["type"].alias("GEOM_TYPE"), coords.alias("COORDINATES"))


def read_geojson(spark: SparkSession, path, collection: bool = False) -> DataFrame:
    """Zones from GeoJSON: a text sequence of Features (default) or, with
    ``collection=True``, FeatureCollection documents."""
    if collection:
        feats = array_elements(spark, path, key="features", objects=True).withColumnRenamed("element", "value")
    else:
        feats = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return _normalise(feats.select(F.from_json("value", _FEATURE).alias("f")))


def geometry_json(geom_type: Column, coords: Column) -> Column:
    """GeoJSON geometry text from normalised coordinates."""
    poly = F.to_json(F.struct(F.lit("Polygon").alias("type"), coords[0].alias("coordinates")))
    multi = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates")))
    return F.when(geom_type == "Polygon", poly).otherwise(multi)


def write_geojson(zones: DataFrame, path: str) -> None:
    """One Feature per line with the three properties and the geometry."""
    props = F.to_json(F.struct(*[F.col(p) for p in PROPERTIES]))
    line = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'),
                    geometry_json(F.col("GEOM_TYPE"), F.col("COORDINATES")), F.lit("}"))
    zones.select(line.alias("value")).write.mode("overwrite").text(path)


#: Rings of the adapters' zones in thousandths of a degree from the zone centre: part, codes that have it, vertices.
SHAPES = [
    (0, 1, [(-10, -10), (12, -10), (15, 4), (0, 11), (-9, 6), (-10, -10)]),
    (0, 2, [(2, -3), (6, -3), (2, 1), (2, -3)]),                 # a hole
    (1, 4, [(20, 20), (27, 20), (20, 23), (20, 20)]),            # a second part
]


def shaped_zones(zones: DataFrame) -> DataFrame:
    """Geometry for zones without one: a lopsided pentagon; for even codes with
    a hole, as a MultiPolygon; for codes divisible by four in two parts."""
    x, y, code = F.col("LONGITUDE_ZONE"), F.col("LATITUDE_ZONE"), F.col("GEOCODE").try_cast("long")

    def ring(vertices) -> Column:
        return F.array(*[F.array(x + dx * 0.001, y + dy * 0.001) for dx, dy in vertices])

    (_, _, shell), (_, even, hole), (_, fourth, second) = SHAPES
    holed = F.array(ring(shell), ring(hole))
    coords = (F.when(code % fourth == 0, F.array(holed, F.array(ring(second))))
              .when(code % even == 0, F.array(holed)).otherwise(F.array(F.array(ring(shell)))))
    return zones.select(*PROPERTIES, F.when(code % even == 0, "MultiPolygon").otherwise("Polygon").alias("GEOM_TYPE"),
                        coords.alias("COORDINATES"))
