"""Contiguous shards of near equal bytes from global prefix sums.

Documents get a global order (by the hash of their text, so equal texts are
neighbours), spread over parts. Totals per part, summed up over the parts,
give each part its start; a running sum inside a part then gives every
document its place in bytes and in rows. Shards are cut at equal targets.

A group of equal texts moves as one, by the place of its first document. The
groups of more than GROUP_SHARE of a shard's bytes (at most
shards / GROUP_SHARE of them) would make shards uneven that way, so they are
placed first: the largest first, whole, in the emptiest shard as long as it
has room. One that fits in no shard is cut where shards are full, and only
there: its documents have a running sum of their own, in as many ordered parts
as it needs. The other groups then fill the shards in order, each up to what
is left of its target.

Scale. Texts are read once; one narrow row a document is shuffled by part and
sorted there. Parts hold about PART_ROWS documents, whatever the size of a
group. The large groups (a row each) are planned on the driver and broadcast.

Defined cases: a null text has no bytes (size 8); null ids come first within
a text; repeated rows are separate rows; very long texts count whole; columns
are picked by position, others may have any names; an empty table gives no
rows. Groups of equal size are placed in the order of their hash.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.llm.storage import discard, documents, picked, written
from zonecast.llm.text import whole

SHARDS = 24
PART_ROWS = 20_000
LEAST_PARTS = 64
GROUP_SHARE = 0.01
ROW_BYTES = 8


def plan_groups(groups: list[tuple[int, int]], total: int, shards: int) -> tuple[dict[int, list[tuple[int, int]]], list[int]]:
    """Shards of the large groups (h, bytes): per h (first byte, shard) of each piece; and what the shards then hold."""
    target = -(-total // shards)
    free = [(-target, s) for s in range(shards)]              # emptiest first
    pieces: dict[int, list[tuple[int, int]]] = {}
    rest = []
    for h, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        if -free[0][0] >= size:
            room, s = heapq.heappop(free)
            heapq.heappush(free, (room + size, s))
            pieces[h] = [(0, s)]
        else:
            rest.append((h, size))
    for h, size in rest:                                      # cut where a shard is full
        pieces[h], at = [], 0
        while at < size:
            room, s = heapq.heappop(free)
            take = min(size - at, -room) if room < 0 else size - at
            pieces[h].append((at, s))
            heapq.heappush(free, (room + take, s))
            at += take
    return pieces, [target + room for room, _ in sorted(free, key=lambda f: f[1])]


def _prefix(rows: DataFrame, keys: list[str], order: list[str], first: list[str]) -> DataFrame:
    """``rows`` with the bytes and rows before each one (``begin``, ``row``), counted from each change of ``first``.

    ``keys``, which begin with ``first``, name the parts; ``order`` sorts a part.
    """
    totals = rows.groupBy(*keys).agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    over = (Window.partitionBy(*first) if first else Window.partitionBy()).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, F.coalesce(F.sum("_bytes").over(over), F.lit(0)).alias("_bytes0"),         # a row a part
                           F.coalesce(F.sum("_rows").over(over), F.lit(0)).alias("_rows0"))
    run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns({"_upto": F.sum("size").over(run), "_nth": F.row_number().over(run)}).join(starts, keys)
    return placed.withColumns({"begin": F.col("_bytes0") + F.col("_upto") - F.col("size"), "row": F.col("_rows0") + F.col("_nth") - 1}).drop(
        "_upto", "_nth", "_bytes0", "_rows0")


def _slots(rows: DataFrame, place: Column) -> DataFrame:
    """Rows of shards that are contiguous in ``place``: numbered from 0 in each."""
    rows = rows.withColumn("_place", place)
    first = rows.groupBy("shard").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))             # `shards` rows
    return rows.join(F.broadcast(first), "shard").withColumn("slot", F.col("_place") - F.col("_first"))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, part_rows: int = PART_ROWS,
                   group_share: float = GROUP_SHARE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row a document."""
    spark, text = docs.sparkSession, whole(F.col("text"))
    slim = picked(docs, "doc_id", "text").select(
                       "doc_id", (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(text).alias("h"),
                       F.monotonically_increasing_id().alias("rid"))
    slim = written(slim, "sizes")
    n, total = slim.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    large = slim.groupBy("h").agg(F.sum("size").alias("g"), F.count("*").alias("n")).where(
        (F.col("g") > group_share * total / shards) & (F.col("n") > 1)).collect()             # at most shards / group_share rows
    pieces, held = plan_groups([(r["h"], r["g"]) for r in large], total, shards)
    plan = spark.createDataFrame(
        [(r["h"], max(1, -(-r["n"] // part_rows)), [a for a, _ in pieces[r["h"]]], [s for _, s in pieces[r["h"]]]) for r in large],
        "h long, parts long, cuts array<long>, shards array<int>")
    rows = slim.join(F.broadcast(plan), "h", "left")

    # the others: in the order of their hash, up to what is left of each shard's target
    parts = max(LEAST_PARTS, -(-n // part_rows))
    few = rows.where("parts IS NULL").drop("parts", "cuts", "shards").withColumn("unit", F.xxhash64("h"))
    few = _prefix(few.withColumn("part", F.pmod("unit", F.lit(parts))), ["part"], ["unit", "h", "doc_id", "rid"], [])
    group = Window.partitionBy("part", "unit", "h").orderBy("doc_id", "rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounds, upto = [], 0
    for s in range(shards):
        bounds.append(upto)
        upto += max(0, -(-total // shards) - held[s])
    of_group = F.first("begin").over(group)
    few = few.withColumn("shard", F.greatest(F.lit(0), F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b <= of_group)) - 1)
                         .cast("int"))
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "_n"]
    few = written(_slots(few, F.col("row")).select(*columns), "small-groups")

    # the large ones: by their own running sums, behind the others of their shard
    many = rows.where("parts IS NOT NULL").withColumn("part", F.pmod(F.xxhash64("h", "rid"), F.col("parts")))
    many = _prefix(many, ["h", "part"], ["doc_id", "rid"], ["h"])
    at = F.size(F.filter("cuts", lambda c: c <= F.col("begin")))
    many = written(many.select("doc_id", "size", "text_crc32", "h", "row", F.element_at("shards", at).alias("shard"), at.alias("piece")), "large-groups")
    runs = many.groupBy("shard", "h", "piece").agg(F.min("row").alias("_row0"), F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("h", "piece").rowsBetween(Window.unboundedPreceding, -1)    # at most a piece a shard and group
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).join(
        few.select("shard", "_n").distinct(), "shard", "left")
    many = many.join(F.broadcast(runs), ["shard", "h", "piece"]).withColumn(
        "slot", F.coalesce("_n", F.lit(0)) + F.col("_before") + F.col("row") - F.col("_row0"))
    out = written(few.drop("_n").unionByName(many.select(*columns[:-1])), "shards")
    discard(slim)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir))
