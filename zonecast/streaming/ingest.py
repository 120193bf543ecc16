"""Incremental landing of daily weather files into the raw layer.

The reference re-walks every (station, year) path and skips files already
on disk. A file stream source does this natively: its checkpoint records
every file already committed, so each run (``availableNow``) reads only
new files, in bounded micro-batches, and the parquet sink commits each
batch exactly once (a failed batch is retried from the log).

The driver of a file stream holds every file it has ever seen. Daily files in
a folder of the shared file system are therefore listed by tasks: those not
listed yet are appended to a table beside the checkpoint's logs, a file a batch,
and that table is what is streamed; the tasks of a batch open its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators import clean
from zonecast.session import scratch_path
from zonecast.sources import jsonfeed, manifest
from zonecast.sources.csv import DAILY_SCHEMA, OPEN_COST, few_listing_tasks, read_listed_csv, set_while
from zonecast.sources.manifest import path_keys

MAX_FILES_PER_TRIGGER = 20_000      # daily files are small: a batch holds some 100 MB
LISTED = "listed"                   # the table of daily files, in the checkpoint's folder
LISTED_SCHEMA = "path string, YEAR int, STN_ID string"


def weather_file_stream(spark: SparkSession, source_dir: str,
                        max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming rows of the daily files under ``source_dir``
    (``{year}/{station}.csv``), with YEAR and STN_ID from the path."""
    rows = (spark.readStream.schema(DAILY_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir))
    return rows.withColumnRenamed("STATION", "ID_STATION").select("*", *path_keys("_metadata.file_path"))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _list_new(spark: SparkSession, source_dir: str, listed: str, most: int) -> None:
    """Append the daily files under ``source_dir`` that ``listed`` doesn't have to it, at most ``most`` a file.

    Files of the table appear whole. What a run has listed and not landed is landed by the next one, from the table.
    """
    found = manifest._csv_paths(spark, source_dir).select("path", *path_keys("path")).where("YEAR IS NOT NULL")
    before = _exists(spark, listed)
    if before:
        found = found.join(spark.read.schema(LISTED_SCHEMA).parquet(listed), "path", "left_anti")
    out = scratch_path(spark, "new-files")
    found.write.parquet(out)
    new = spark.read.schema(LISTED_SCHEMA).parquet(out)
    count = new.count()
    if count or not before:
        new.repartition(count // most + 1).write.mode("append").option("maxRecordsPerFile", most).parquet(listed)


def listed_file_stream(spark: SparkSession, source_dir: str, checkpoint: str, stations: DataFrame | None = None,
                       max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming rows of the daily files under ``source_dir``, a folder of the
    shared file system, with YEAR from the path; ``stations`` as below."""
    listed = f"{checkpoint.rstrip('/')}/{LISTED}"
    _list_new(spark, source_dir, listed, max_files_per_trigger)
    files = spark.readStream.schema(LISTED_SCHEMA).option("maxFilesPerTrigger", 1).parquet(listed)
    if stations is not None:
        files = files.join(stations.select("STN_ID").distinct(), "STN_ID", "left_semi")
    return read_listed_csv(files.select("path", "YEAR").repartition(spark.sparkContext.defaultParallelism))


def _rows_in(spark: SparkSession, path: str) -> int:
    """Rows a sink has committed (0 before its first batch)."""
    store = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = store.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(store) or not any(s.getPath().getName().startswith("YEAR=") for s in files.listStatus(store)):
        return 0
    return spark.read.parquet(path).count()


def land_new_files(spark: SparkSession, source_dir: str, layer_path: str, checkpoint: str,
                   stations: DataFrame | None = None,
                   max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> int:
    """Append every not-yet-landed file to the raw layer (partitioned by
    year); returns the number of rows written by this run. ``stations``
    (STN_ID) restricts the load to their files, as the manifest does."""
    logs = checkpoint.rstrip("/")
    by_files = _exists(spark, f"{logs}/sources") and not _exists(spark, f"{logs}/{LISTED}")     # begun so, it goes on so
    if manifest.shared_folder(spark, source_dir) is None or by_files:
        rows = weather_file_stream(spark, source_dir, max_files_per_trigger).where("YEAR IS NOT NULL")
        if stations is not None:
            rows = rows.join(stations.select("STN_ID").distinct(), "STN_ID", "left_semi")
        rows = rows.drop("STN_ID")
    else:
        rows = listed_file_stream(spark, source_dir, checkpoint, stations, max_files_per_trigger)
    before = _rows_in(spark, layer_path)
    # the file source asks the session for these in each batch, so they hold until the last one
    with few_listing_tasks(spark), set_while(spark, {"spark.sql.files.openCostInBytes": OPEN_COST}):
        q = (rows.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).partitionBy("YEAR")
             .trigger(availableNow=True).start(layer_path))
        q.awaitTermination()
    return _rows_in(spark, layer_path) - before


def read_landed(spark: SparkSession, layer_path: str) -> DataFrame:
    """The raw layer as committed by the stream (reads through the sink's
    metadata log, so files of an unfinished batch are never seen)."""
    return spark.read.parquet(layer_path)


def land_new_feed_lines(spark: SparkSession, feed_dir: str, zones: DataFrame, extract_path: str,
                        checkpoint: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> int:
    """Append the air records of not-yet-landed feed files (one record array
    per line) to the air extract, partitioned by year.

    Records are typed and cleaned as in the batch ETL, then joined to the
    zone table (a stream-static join: the zone side is a small static
    dimension, re-read each micro-batch). Returns the rows written by this run.
    """
    before = _rows_in(spark, extract_path)
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger",
                                                          max_files_per_trigger).text(feed_dir)
    records = lines.select(F.from_json("value", "array<string>").alias("r")).where(F.col("r").isNotNull())
    named = jsonfeed.name_fields(jsonfeed.whole_records(records))
    air = clean.air_zone_join(clean.clean_air(jsonfeed.to_air_raw(named)), zones)
    q = (air.withColumn("YEAR", F.year("DATE_OBSERVATION"))
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("YEAR")
         .trigger(availableNow=True).start(extract_path))
    q.awaitTermination()
    return _rows_in(spark, extract_path) - before
