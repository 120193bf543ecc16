"""Rows whose key occurs more than once, with one shuffle of narrow rows; rows whose key another table may have, with none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64
HOT_KEYS = 20_000
SAMPLE = 64
PART = 1 << 15              # bits of one of Spark's bitmaps
BITS = 64                   # a wanted key
PARTS = 4096                # at most 16 MB are broadcast


def repeated(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The rows whose ``key`` other rows have too, and whether it is ``hot``.

    Hot keys are those frequent in a hash sample of one row in SAMPLE (by
    ``order``); at most HOT_KEYS by their share of that sample. Their rows all
    stay and are dealt to SALTS parts, so no part holds a hot key alone. For
    the others a neighbour in the sorted part shows that a key repeats, so no
    group is ever gathered.
    """
    some = rows.where(F.pmod(F.xxhash64(order, F.lit(7)), F.lit(SAMPLE)) == 0)
    often = max(16, some.count() // HOT_KEYS)
    hot = some.groupBy(key).count().where(F.col("count") >= often).select(key, F.lit(True).alias("hot"))
    rows = rows.join(F.broadcast(hot), key, "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    rows = rows.withColumn("_salt", F.when(F.col("hot"), F.pmod(F.xxhash64(order), F.lit(SALTS))).otherwise(F.lit(0)))
    same = Window.partitionBy(key, "_salt").orderBy(order)
    rows = rows.withColumns({"_back": F.lag(order).over(same), "_ahead": F.lead(order).over(same)})
    return rows.where("hot OR _back IS NOT NULL OR _ahead IS NOT NULL").drop("_salt", "_back", "_ahead")


def likely(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be among those of ``wanted``, found without a shuffle of ``rows``.

    All that are stay, and of the others about one in BITS: those whose hash
    meets a bit of a wanted key in a broadcast bitmap. Beyond PARTS * PART / BITS
    wanted keys more of the others stay. A join must follow.
    """
    parts = min(PARTS, 1 + wanted.count() * BITS // PART)
    place = F.pmod(F.xxhash64(key), F.lit(parts * PART))
    bits = wanted.select(place.alias("_place")).groupBy(F.expr(f"_place div {PART}").alias("_part")).agg(
        F.bitmap_construct_agg(F.col("_place") % PART).alias("_bits"))
    marked = rows.withColumn("_place", place).withColumn("_part", F.expr(f"_place div {PART}")).join(F.broadcast(bits), "_part")
    byte = F.expr(f"CAST(conv(hex(substring(_bits, CAST(_place % {PART} div 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    return marked.where(F.getbit(byte, F.expr("CAST(_place % 8 AS INT)")) == 1).select(rows.columns)
