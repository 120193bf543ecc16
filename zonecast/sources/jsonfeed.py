"""The air-quality open-data feed: records are positional JSON arrays.

Three layouts are read: JSON lines (one record array per line), envelope
documents ``{"data": [[...], ...]}`` and bare list-of-lists documents
``[[...], ...]`` (one document per file, read by as many tasks as it has
splits, see ``jsonsplit``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.sources.jsonsplit import array_elements

# Fixed values of the feed: record width and the positions that carry data.
RECORD_WIDTH = 20
NAMED_FIELDS = {10: "NOM_POLLUANT", 14: "GEOJOIN_ID_BRUT", 17: "DATE_MESURE_BRUTE",
                18: "VALEUR_MESURE_BRUTE"}
ENVELOPE_ROWS = 100_000


def read_json_rows(spark: SparkSession, path) -> DataFrame:
    """One record array per line; numbers and objects inside arrive as text."""
    lines = spark.read.text(path)
    return lines.select(F.from_json("value", "array<string>").alias("r")).where(F.col("r").isNotNull())


def read_json_envelope(spark: SparkSession, path) -> DataFrame:
    """Records under the top-level ``data`` key of each document; a file
    without any record contributes nothing."""
    return _parsed(array_elements(spark, path, key="data"))


def read_json_array(spark: SparkSession, path) -> DataFrame:
    """Records of bare list-of-lists documents (``[[...], [...]]``)."""
    return _parsed(array_elements(spark, path))


def _parsed(elements: DataFrame) -> DataFrame:
    return elements.select(F.from_json("element", "array<string>").alias("r")).where(F.col("r").isNotNull())


def read_records(spark: SparkSession, path, layout: str = "envelope") -> DataFrame:
    """Record arrays from a feed laid out as ``envelope`` documents, JSON
    ``lines`` (one record per line, splittable) or bare ``array`` documents."""
    readers = {"envelope": read_json_envelope, "lines": read_json_rows, "array": read_json_array}
    if layout not in readers:
        raise ValueError(f"unknown feed layout {layout!r}")
    return readers[layout](spark, path)


def whole_records(records: DataFrame) -> DataFrame:
    """The records of the right width; see :func:`rejected_records`."""
    return records.where(F.size("r") == RECORD_WIDTH)


def rejected_records(records: DataFrame) -> DataFrame:
    """Records that are too short or too long, counted by their width."""
    return (records.where(F.size("r") != RECORD_WIDTH).groupBy(F.size("r").alias("WIDTH"))
            .agg(F.count("*").alias("N_RECORDS")))


def name_fields(records: DataFrame) -> DataFrame:
    """Twenty named text columns from the record arrays."""
    return records.select(*[F.get("r", i).alias(NAMED_FIELDS.get(i, f"col_{i}"))
                            for i in range(RECORD_WIDTH)])


def to_air_raw(named: DataFrame) -> DataFrame:
    """The four fields the model uses, under the raw-layer names."""
    return named.select(F.col("GEOJOIN_ID_BRUT").alias("GEOJOIN_ID"), "DATE_MESURE_BRUTE",
                        "NOM_POLLUANT", F.col("VALEUR_MESURE_BRUTE").alias("VALEUR_BRUTE"))


def json_text(c: Column) -> Column:
    """JSON literal of a text column ("..." with escapes, or null)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def record_line(cells: dict[int, Column]) -> Column:
    """A record array as JSON text; ``cells`` maps position -> JSON text."""
    parts = []
    for i in range(RECORD_WIDTH):
        if i:
            parts.append(F.lit(","))
        parts.append(cells.get(i, F.lit("null")))
    return F.concat(F.lit("["), *parts, F.lit("]"))


def write_json_arrays(lines: DataFrame, path: str, rows_per_doc: int = ENVELOPE_ROWS) -> None:
    """Bare list-of-lists documents of at most ``rows_per_doc`` records, one per file."""
    _write_documents(lines, path, rows_per_doc, "[", "]")


def write_json_rows(lines: DataFrame, path: str) -> None:
    lines.select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def write_json_envelopes(lines: DataFrame, path: str, rows_per_doc: int = ENVELOPE_ROWS) -> None:
    """Envelope documents of at most ``rows_per_doc`` records, one per file."""
    _write_documents(lines, path, rows_per_doc, '{"data":[', "]}")


def _write_documents(lines: DataFrame, path: str, rows_per_doc: int, head: str, tail: str) -> None:
    """Chunks never cross input partitions (the id's high bits are the
    partition), so no group exceeds the bound."""
    chunk = F.floor(F.monotonically_increasing_id() / rows_per_doc)
    docs = (lines.withColumn("_chunk", chunk).groupBy("_chunk")
            .agg(F.concat(F.lit(head), F.concat_ws(",", F.collect_list("line")), F.lit(tail)).alias("value")))
    # one directory per chunk, so every file holds exactly one document
    docs.write.mode("overwrite").partitionBy("_chunk").text(path)
