"""Elements of one JSON array, read by many tasks however large the document.

A document is read as text pieces that end at each closing bracket, so Spark
splits it at byte ranges. What a piece means depends on what came before: is
it inside a string, and how deep? Each piece is summed up for both cases
(quotes, brackets opened and closed); running sums inside a split, then over
the splits of a file (a row a split), give every piece its state. An element
ends where a closing bracket comes back to the array's depth; pieces of one
element, also of one that crosses splits, are joined by its number.

The pieces are parsed once and kept as a table with what they change: states
come from its numbers alone, and only the elements read its text again, which
is shuffled by split (at most ``spark.sql.files.maxPartitionBytes``) and by
element. Windows run
over one split or over the rows of a file's splits. Compressed files are one
split. A document that breaks off in an element ends it there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.session import scratch_path

_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'        # a string, or the part of one that has begun
_REST = r'(?s)^[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'          # the rest of a string
_SPLIT = ("_file", "_block")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own under the shared checkpoint folder: read again, not computed again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _quotes(text: Column) -> Column:
    plain = F.regexp_replace(text, r"(?s)\\.", "")
    return (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))) % 2


def _outside(text: Column) -> Column:
    return F.regexp_replace(text, _STRING, "")


def _depth(outside: Column) -> Column:
    return F.length(F.regexp_replace(outside, r"[^\[{]", "")) - F.length(F.regexp_replace(outside, r"[^\]}]", ""))


def _pieces(spark: SparkSession, path, close: str, head: str) -> DataFrame:
    """Text pieces with their place and, for a start outside (0) and inside (1) a string, what they change."""
    rows = spark.read.text(path, lineSep=close).select(
        F.col("value").alias("_v0"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    rows = rows.withColumns({"_v1": F.regexp_replace("_v0", _REST, ""), "_p": _quotes(F.col("_v0"))})
    for k in (0, 1):
        text, out = F.col(f"_v{k}"), _outside(F.col(f"_v{k}"))
        before = F.regexp_extract(text, head, 1)
        empty = F.concat(_outside(F.regexp_replace(text, head, "")), F.lit(close)).rlike(r"^\s*+\]")
        rows = rows.withColumns({
            f"_d{k}": _depth(out) - F.when(F.col("_p") == k, 1).otherwise(0),       # the bracket behind the piece
            f"_closes{k}": F.concat(out, F.lit(close)).rlike(r"^\s*+\]"),
            f"_at{k}": F.when(text.rlike(head) & (_quotes(before) == 0) & ~empty, _depth(_outside(before)))})
    return rows.drop("_v1")


def _within(rows: DataFrame) -> DataFrame:
    """State of each piece as its split alone shows it, for both states at the split's start."""
    before = Window.partitionBy(*_SPLIT).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_q", F.coalesce(F.sum("_p").over(before), F.lit(0)) % 2)
    for k in (0, 1):
        rows = rows.withColumn(f"_e{k}", F.when(F.col("_q") == k, F.col("_d0")).otherwise(F.col("_d1")))
        rows = rows.withColumn(f"_c{k}", F.coalesce(F.sum(f"_e{k}").over(before), F.lit(0)))
    return rows


def _placed(rows: DataFrame) -> DataFrame:
    """Pieces (``_within`` their splits) with their depth at the start and whether they start inside a string."""
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)   # a row a split
    splits = rows.groupBy(*_SPLIT).agg((F.sum("_p") % 2).alias("_p"), F.sum("_e0").alias("_e0"), F.sum("_e1").alias("_e1"))
    splits = splits.withColumn("_in", F.coalesce(F.sum("_p").over(before), F.lit(0)) % 2)
    splits = splits.withColumn("_from", F.coalesce(
        F.sum(F.when(F.col("_in") == 0, F.col("_e0")).otherwise(F.col("_e1"))).over(before), F.lit(0)))
    rows = rows.join(splits.select(*_SPLIT, "_in", "_from"), list(_SPLIT))
    inside = (F.col("_q") + F.col("_in")) % 2
    pick = lambda name: F.when(F.col("_inside") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    rows = rows.withColumn("_inside", inside).withColumn(
        "_depth", F.col("_from") + F.when(F.col("_in") == 0, F.col("_c0")).otherwise(F.col("_c1")))
    ends = F.when(F.col("_inside") == 0, F.col("_p") == 0).otherwise(F.col("_p") == 1)        # outside a string again
    return rows.withColumns({"_after": F.col("_depth") + pick("_d"), "_ends": ends, "_closes": pick("_closes"), "_at": pick("_at")})


def array_elements(spark: SparkSession, path, key: str | None = None, objects: bool = False) -> DataFrame:
    """``element``: the JSON text of each array (or object) in the documents' array.

    The array is the document itself, or the value of its top-level ``key``.
    Elements of another kind (nulls, numbers) are left out.
    """
    close, begin = ("}", "{") if objects else ("]", "[")
    base = 1 if key is None else 2
    head = r"(?s)^(\s*+)\[" if key is None else rf'(?s)^(.*?)"{key}"\s*+:\s*+\['
    rows = kept(_within(_pieces(spark, path, close, head)), "json-pieces")
    place = F.struct("_block", "_row")
    starts = F.col("_depth") + F.col("_at") == base - 1
    ends = F.col("_ends") & (F.col("_after") == base)
    closes = F.col("_closes") & (F.col("_depth") == base)

    numbers = _placed(rows.drop("_v0"))                       # what the splits hold: numbers only
    facts = numbers.groupBy(*_SPLIT).agg(
        F.count(F.when(ends, 1)).alias("_n"), F.min(F.when(starts, place)).alias("_start"),
        F.collect_list(F.when(closes, place)).alias("_close"))            # arrays right below the top, few
    of_file = Window.partitionBy("_file")
    in_order = of_file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    facts = facts.select(*_SPLIT, F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_n"), F.min("_start").over(of_file).alias("_start"),
                         F.flatten(F.collect_list("_close").over(of_file)).alias("_close"))
    facts = facts.withColumn("_stop", F.array_min(F.filter("_close", lambda c: c > F.col("_start")))).drop("_close")

    main = _placed(rows).join(facts, list(_SPLIT))
    before = Window.partitionBy(*_SPLIT).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    main = main.withColumn("_element", F.col("_n") + F.coalesce(F.sum(ends.cast("int")).over(before), F.lit(0)))
    main = main.where((place >= F.col("_start")) & (F.col("_stop").isNull() | (place < F.col("_stop"))))
    text = F.when(F.col("_inside") == 0, F.col("_v0")).otherwise(F.regexp_replace("_v0", _REST, ""))
    text = F.when(place == F.col("_start"), F.regexp_replace(text, head, "")).otherwise(F.col("_v0"))
    parts = main.select("_file", "_element", F.struct("_block", "_row", F.concat(text, F.lit(close)).alias("t"), ends.alias("e")).alias("_part"))
    whole = parts.groupBy("_file", "_element").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    whole = whole.where(F.exists("_parts.e", lambda e: e))    # one that never ends isn't an element
    return whole.select(F.regexp_replace(F.array_join("_parts.t", ""), rf"(?s)^[^\{begin}]*+", "").alias("element"))
