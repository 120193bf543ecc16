"""Semi joins of large row sets with few keys, filtered before any exchange.

The keys' Bloom filter is a table of fixed size (WORDS longs, 128 KiB), built by
one aggregate and given to the scan as a scalar subquery, so a row whose key
is surely not wanted goes no further, whether or not the planner broadcasts
the keys. The exact semi join behind it removes the few that passed by
chance. With very many keys the filter lets more pass; it never drops a row
that the join would keep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 14
HASHES = 3


def _bits(key: Column) -> list[Column]:
    """Positions of a key in the filter."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(64 * WORDS)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, key: str) -> DataFrame:
    """One row: ``bits``, an array of WORDS longs (null without a key)."""
    at = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_bits(F.col(key)))).alias("at"))
    set_ = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits"))
    every = keys.sparkSession.range(WORDS).select(F.col("id").alias("word")).join(set_, "word", "left")
    listed = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return every.agg(F.when(F.count("bits") > 0, listed["bits"]).alias("bits"))


def may_contain(bits: Column, key: Column) -> Column:
    tests = [F.getbit(F.get(bits, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1 for at in _bits(key)]
    return tests[0] & tests[1] & tests[2]


def semi_join_filtered(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is in ``keys``; null is in none."""
    tested = rows.withColumn("_bits", bloom_filter(keys, key).scalar()).where(may_contain(F.col("_bits"), F.col(key))).drop("_bits")
    return tested.join(keys, key, "left_semi")
