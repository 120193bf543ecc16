"""Entity adapters over the driver's parquet tables.

The model's entities (zones, raw weather observations, raw air-quality
records, the station list) are derived lazily from the star-schema tables
so every query's work grows with them. Integer arithmetic on keys only and
double literals throughout, so any SQL engine reproduces the same values.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType


_SCHEMAS: "weakref.WeakKeyDictionary[SparkSession, dict[str, StructType]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables. Its schema is read once a session instead
    of by a job a query; its files are listed anew each time."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schemas = _SCHEMAS.setdefault(spark, {})
    if path not in schemas:
        schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(schemas[path]).parquet(path)


def as_date(df: DataFrame, name: str) -> Column:
    """Calendar date of a timestamp column, independent of the session zone."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(name)) / 86400).cast("int"))
    if isinstance(dtype, TimestampNTZType):
        return F.to_date(F.col(name))
    return F.col(name).cast("date")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEOCODE, GEONAME, BOROUGH, LATITUDE_ZONE, LONGITUDE_ZONE (nation x region)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
            .select(key.cast("string").alias("GEOCODE"),
                    F.col("n_name").alias("GEONAME"),
                    F.col("r_name").alias("BOROUGH"),
                    (F.lit(40.5) + ((key * 7) % 25) * 0.02).alias("LATITUDE_ZONE"),
                    (F.lit(-74.25) + ((key * 11) % 25) * 0.025).alias("LONGITUDE_ZONE")))


def _weather_columns(date: Column, s: Column | None = None, with_name: bool = True) -> list[Column]:
    s = F.col("s_suppkey") if s is None else s
    pk = F.col("l_partkey")
    qty = F.col("l_quantity")
    moved = (s % 10 == 3) & (date >= F.lit("1999-01-01").cast("date"))
    return [
        s.cast("string").alias("ID_STATION"),
        *([F.col("s_name").alias("NAME")] if with_name else []),
        date.alias("DATE"),
        (F.lit(40.4) + ((s * 37) % 100) * 0.006
         + F.when(moved, F.lit(0.05)).otherwise(F.lit(0.0))).alias("LATITUDE"),
        (F.lit(-74.4) + ((s * 53) % 100) * 0.0075).alias("LONGITUDE"),
        F.when(pk % 50 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(20.0) + qty * 1.6).alias("TEMP"),
        F.when(pk % 40 == 1, F.lit(9999.9))
         .otherwise(F.lit(10.0) + qty * 1.2 - F.col("l_discount") * 100.0).alias("DEWP"),
        F.when(pk % 30 == 2, F.lit(999.9))
         .otherwise(F.lit(2.0) + F.col("l_tax") * 100.0 + (pk % 13)).alias("WDSP"),
    ]


def weather_raw(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Daily station observations in Fahrenheit / knots (lineitem x supplier).

    Both sides are large at scale (supplier grows with the data), so no
    broadcast hint: AQE converts to a broadcast join only when the runtime
    size of the supplier side is below the threshold, and splits skewed
    supplier keys otherwise.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    joined = li.join(su, li.l_suppkey == su.s_suppkey, "inner")
    return joined.select(*_weather_columns(as_date(li, "l_shipdate")), *extra)


def weather_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same observations without the station name: every column comes
    from lineitem alone (station id = l_suppkey), so aggregations over them
    need no join of the raw rows."""
    return observations_from(table(spark, sf_dir, "lineitem"))


def observations_from(lineitem: DataFrame) -> DataFrame:
    li = lineitem.select("l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    return li.select(*_weather_columns(as_date(li, "l_shipdate"), F.col("l_suppkey"), with_name=False))


def station_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station name dimension (supplier): ID_STATION, NAME."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ID_STATION"), F.col("s_name").alias("NAME"))


def air_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-quality records with the feed's text values; the date is typed, so
    that a date range reaches the scan."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ok = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(F.when(ok % 101 == 0, F.lit("999"))
                     .otherwise(F.col("c_nationkey").cast("string")).alias("GEOJOIN_ID"),
                    as_date(o, "o_orderdate").alias("DATE_MESURE_BRUTE"),
                    F.col("o_orderpriority").alias("NOM_POLLUANT"),
                    F.when(ok % 97 == 0, F.lit("n/a"))
                     .otherwise(F.col("o_totalprice").cast("string")).alias("VALEUR_BRUTE")))


def station_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station inventory as its CSV carries it (supplier): USAF, WBAN with
    leading zeros, 'STATION NAME', LAT, LON. Of ten stations one has no name,
    one no latitude and one lies outside the box; every sixth id is padded."""
    s = F.col("s_suppkey")
    here = (F.lit(-74.4) + ((s * 53) % 100) * 0.0075)
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lpad(s.cast("string"), 6, "0"), F.when(s % 6 == 0, "  ").otherwise("")).alias("USAF"),
        F.concat(F.lit("00"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0")).alias("WBAN"),
        F.when(s % 10 != 9, F.col("s_name")).alias("STATION NAME"),
        F.when(s % 10 != 7, F.lit(40.4) + ((s * 37) % 100) * 0.006).alias("LAT"),
        F.when(s % 10 == 5, here - 3.0).otherwise(here).alias("LON"))


def station_id(s: Column, nationkey: Column) -> Column:
    """Inventory key of a supplier-station: USAF (6 digits) || WBAN (00 + 3)."""
    return F.concat(F.lpad(s.cast("string"), 6, "0"), F.lit("00"),
                    F.lpad(nationkey.cast("string"), 3, "0"))


def weather_files_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather as the daily files carry it (text dates, file column
    names) plus the layout columns: year and station inventory id. The files
    of one station and year in seven have not landed."""
    w = weather_raw(spark, sf_dir, extra=("s_nationkey", "s_suppkey"))
    return w.where((F.col("s_suppkey") + F.year("DATE")) % 7 != 0).select(F.col("ID_STATION").alias("STATION"), F.col("DATE").cast("string").alias("DATE"),
                    "LATITUDE", "LONGITUDE", "NAME", "TEMP", "DEWP", "WDSP",
                    F.year("DATE").alias("YEAR"),
                    station_id(F.col("s_suppkey"), F.col("s_nationkey")).alias("STN_ID"))


def air_feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air records as feed lines: 20-element JSON arrays with the data at
    positions 10/14/17/18, a number at 1 (the record id) and an object at 3;
    some with a bad date, some an element short or long."""
    from zonecast.sources.jsonfeed import json_text, record_line
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ok = F.col("o_orderkey")
    geo = F.when(ok % 101 == 0, F.lit("999")).otherwise(F.col("c_nationkey").cast("string"))
    value = F.when(ok % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    line = record_line({
        1: ok.cast("string"),
        3: F.concat(F.lit('{"owner":'), F.col("o_custkey").cast("string"), F.lit("}")),
        10: json_text(F.col("o_orderpriority")), 14: json_text(geo),
        17: json_text(F.when(ok % 83 == 7, F.lit("31/31/1998")).otherwise(as_date(o, "o_orderdate").cast("string"))),
        18: json_text(value),
    })
    line = (F.when(ok % 89 == 3, F.regexp_replace(line, r",null\]$", "]"))        # a record too short
            .when(ok % 89 == 5, F.regexp_replace(line, r"\]$", ",null]")).otherwise(line))   # and one too long
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(line.alias("line"))
