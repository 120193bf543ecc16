"""Exact deduplication by deterministic block naming.

The normalised text of a document (each run of ASCII white space as one
space, null as empty) is cut into blocks of ``BLOCK`` bytes. Equal blocks are
sorted together and get one integer name, the number of their first
occurrence. Adjacent names are then paired and the pairs named in the same
way until each document has a single name. Names stand for contents, never
for hashes, so two documents have the same (level, name) if and only if their
normalised texts are equal.

Scale. The text is shuffled once, for the names of the first level; the
levels above move two integers a block, and only for documents of more than
one block. A block that many documents share (at least 1/2000 of all blocks,
so at most 2000 such blocks) is named in ``SALTS`` parts, whose names meet by
way of one representative a part: at most 2000 * SALTS rows.

Defined cases: null and white-space-free empty texts are the empty text; the
row with the smallest ``doc_id`` stays (null ids last, of repeated rows one);
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.llm.storage import column_of, documents, numbered, picked, written
from zonecast.llm.text import one_spaced, whole

BLOCK = 8192
HOT_SHARE = 2000
SALTS = 64


def _blocks(docs: DataFrame, block: int) -> DataFrame:
    """One row a block: oid numbers all blocks, so a document's follow each other."""
    norm = docs.select("doc_id", one_spaced(F.col("text")).alias("norm"))
    cut = norm.select("doc_id", F.sha2("norm", 256).alias("sha"), F.col("norm").cast("binary").alias("bytes"))
    cut = cut.withColumn("n", F.greatest(F.lit(1), F.ceil(F.length("bytes") / block).cast("int")))
    parts = F.expr(f"transform(sequence(0, n - 1), i -> substring(bytes, i * {block} + 1, {block}))")
    rows = cut.select("doc_id", "sha", "n", F.posexplode(parts).alias("pos", "block"))
    return rows.select(F.monotonically_increasing_id().alias("oid"), "pos", "n", "block",
                       F.xxhash64("block").alias("h"),
                       F.when(F.col("pos") == 0, F.col("doc_id")).alias("doc_id"),
                       F.when(F.col("pos") == 0, F.col("sha")).alias("sha"))


def _first_names(docs: DataFrame, block: int) -> DataFrame:
    """(oid, pos, n, doc_id, sha, name): equal blocks have equal names."""
    bytes_ = F.octet_length(whole(F.col("text")))
    total = docs.select(F.sum(F.floor(bytes_ / block) + 1).alias("t")).first()["t"] or 0
    often = max(64, total // HOT_SHARE)                     # so at most HOT_SHARE blocks are hot
    rows = _blocks(docs, block)
    hot = (rows.groupBy("h").count().where(F.col("count") >= often)
           .select("h", F.lit(True).alias("hot")))
    rows = rows.join(F.broadcast(hot), "h", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("oid"), F.lit(SALTS))).otherwise(F.lit(-1)))
    same = Window.partitionBy("h", "block", "salt").orderBy("oid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    named = rows.withColumn("name", F.first("oid").over(same)).select(
        "oid", "pos", "n", "doc_id", "sha", "name",
        F.when(F.col("hot") & (F.col("name") == F.col("oid")), F.col("block")).alias("shown"))
    named = written(named, "blocks")
    shown = named.where(F.col("shown").isNotNull()).select("name", "shown")
    least = shown.groupBy("shown").agg(F.min("name").alias("common"))
    met = shown.join(least, "shown").select("name", "common")   # at most HOT_SHARE * SALTS rows
    return named.join(F.broadcast(met), "name", "left").select(
        "oid", "pos", "n", "doc_id", "sha", F.coalesce("common", "name").alias("name"))


def name_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rid, doc_id, sha, level, name): one row a document, named by content."""
    named = _first_names(picked(docs, "doc_id", "text"), block)
    done = [named.where("n = 1").select(F.col("oid").alias("rid"), "doc_id", "sha",
                                        F.lit(0).alias("level"), "name")]
    left = named.where("n > 1").select((F.col("oid") - F.col("pos")).alias("rid"), "pos", "n",
                                       "doc_id", "sha", "name")
    most = left.agg(F.max("n").alias("m")).first()["m"] or 1
    level = 0
    while most > 1:
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = left.groupBy("rid", F.expr("pos div 2").cast("int").alias("half")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
            F.max("n").alias("n"), F.max("doc_id").alias("doc_id"), F.max("sha").alias("sha"))
        pairs = written(pairs.withColumnRenamed("half", "pos"), f"pairs{level}")
        number = F.col("rid") + F.col("pos") * F.lit(2 ** level)   # of the pair's first block
        names = pairs.groupBy("a", "b").agg(F.min(number).alias("name"))
        named = pairs.join(names, ["a", "b"]).select(
            "rid", "pos", F.ceil(F.col("n") / 2).cast("int").alias("n"), "doc_id", "sha", "name")
        named = written(named, f"names{level}")
        done.append(named.where("n = 1").select("rid", "doc_id", "sha", F.lit(level).alias("level"), "name"))
        left = named.where("n > 1")
        most = (most + 1) // 2
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_dedup(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    ids = name_documents(docs, block)
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    groups = ids.groupBy("level", "name").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    return ids.join(groups, ["level", "name"]).select(
        "doc_id", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    kept = exact_dedup(docs).where("kept").select(key(F.col("doc_id")).alias("id"), F.col("text_sha256").alias("sha"))
    rows = numbered(docs)
    keyed = rows.withColumns({"id": key(column_of(docs, "doc_id")),
                              "sha": F.sha2(one_spaced(column_of(docs, "text")), 256)})
    one = keyed.dropDuplicates(["id", "sha"])               # of repeated rows one, before the shuffle
    return one.join(kept, ["id", "sha"], "left_semi").select(rows.columns).toDF(*docs.columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
