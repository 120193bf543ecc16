"""Ingest manifest: which (station, year) daily files to load.

The manifest is a DataFrame (stations exploded over a year sequence), the
landed files come from one recursive listing that reads paths only, and both
meet by (year, station), the two parts of a file's path
``{base}/{year}/{station}.csv``.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import reduce
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import scratch_path
from zonecast.sources.csv import DAILY_SCHEMA, LISTING_TASKS, OPEN_COST, read_listed_csv, read_weather_csv, set_while

PATHS_PER_READ = 10_000
TASKS_PER_READ = 16         # Spark's own number is a task for 32 small files
PLANNED = 10_000            # files of a manifest that the driver plans with; it would hold some 1 KB a file
FILES_A_TASK = 5_000        # of more than these
NAMES = 10_000              # listed by a task at once
GLOB = re.compile(r"([\\*?\[\]{}])")       # characters that paths would be expanded by
DAILY_PATH = r"/([0-9]{4})/([^/]+)\.csv$"
HIDDEN = re.compile(r"(?!_common_metadata|_metadata)(\.|_[^=]*$|.*\._COPYING_$)", re.S)      # names that Spark's own listing skips


def path_keys(path: str) -> list[Column]:
    """YEAR and STN_ID (NULL outside the layout) of a daily file's path."""
    return [F.regexp_extract(path, DAILY_PATH, 1).try_cast("int").alias("YEAR"),
            F.nullif(F.regexp_extract(path, DAILY_PATH, 2), F.lit("")).alias("STN_ID")]


def ingest_manifest(stations: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Every (station id, year) with its relative location. Ids are
    de-duplicated first: a path listed twice would be read twice."""
    return (stations.select("STN_ID").where(F.col("STN_ID").isNotNull()).distinct()
            .withColumn("YEAR", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))))
            .withColumn("REL_PATH", F.concat(F.col("YEAR").cast("string"), F.lit("/"), F.col("STN_ID"), F.lit(".csv"))))


def landed_files(spark: SparkSession, base: str) -> DataFrame:
    """(YEAR, STN_ID) of every landed file under ``base``. File contents are
    never read. The listing is kept as a table: what is asked of it later sees
    the same files and lists none."""
    landed = _csv_paths(spark, base).select(*path_keys("path")).where("YEAR IS NOT NULL AND STN_ID IS NOT NULL").distinct()
    out = scratch_path(spark, "landed")
    with set_while(spark, {"spark.sql.files.openCostInBytes": OPEN_COST}):
        landed.write.parquet(out)
    return spark.read.schema(landed.schema).parquet(out)


def shared_folder(spark: SparkSession, base: str) -> str | None:
    """``base`` as the tasks open it, where it is a folder of the shared file system and not a pattern."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = path.toUri().getPath()
    return None if store.getUri().getScheme() != "file" or GLOB.search(base) or not os.path.isdir(top) else top


def _csv_names(batches: Iterator[pa.RecordBatch], top: str) -> Iterator[pa.RecordBatch]:
    """The CSV files under the folders given, NAMES at once; those of ``top`` itself without the folders in it, which have tasks."""
    found = lambda names: pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["path"])
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            left = [folder]
            while left:
                at, names = left.pop(), []
                with os.scandir(at) as entries:
                    for entry in entries:
                        if HIDDEN.match(entry.name):
                            continue
                        if entry.is_dir():
                            if folder != top:
                                left.append(entry.path)
                        elif entry.name.endswith(".csv"):
                            names.append(f"{at}/{entry.name}")
                        if len(names) == NAMES:
                            yield found(names)
                            names = []
                yield found(names)


def _csv_paths(spark: SparkSession, base: str) -> DataFrame:
    """``path`` of the CSV files under ``base``: in a folder of the shared file
    system a task lists each of its folders by names alone; elsewhere, or by a
    pattern, Spark's file listing asks for each file's status."""
    top = shared_folder(spark, base)
    if top is None:
        return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.csv").load(base).select("path"))

    folders = [top, *(e.path for e in os.scandir(top) if e.is_dir() and not HIDDEN.match(e.name))]
    tasks = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(min(len(folders), LISTING_TASKS))
    return tasks.mapInArrow(lambda batches: _csv_names(batches, top), "path string")


def year_span(landed: DataFrame) -> tuple[int, int]:
    """First and last landed year."""
    low, high = landed.agg(F.min("YEAR"), F.max("YEAR")).first()
    if low is None:
        raise FileNotFoundError("no daily weather file found")
    return low, high


def manifest_existing(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    return manifest.join(landed, ["YEAR", "STN_ID"], "left_semi")


def manifest_missing(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Entries not landed yet (what an incremental load still has to fetch)."""
    return manifest.join(landed, ["YEAR", "STN_ID"], "left_anti")


def require_inputs(df: DataFrame, what: str = "daily weather file for the manifest") -> DataFrame:
    """Fail fast when there is nothing to load (one row is enough to pass)."""
    if df.isEmpty():
        raise FileNotFoundError(f"no {what} found")
    return df


def read_manifest_files(spark: SparkSession, base: str, existing: DataFrame,
                        paths_per_read: int = PATHS_PER_READ) -> DataFrame:
    """Daily weather rows of the landed files of a manifest; no other file is
    opened or listed. Up to PLANNED files come to the driver, which plans file reads
    in any case, as an iterator of batches; each batch is one read of its files, by
    at most TASKS_PER_READ tasks (a daily file has a line a day). More of them, in
    a folder of the shared file system, are opened by the tasks."""
    top = shared_folder(spark, base)
    if top and not existing.select("REL_PATH").offset(PLANNED).isEmpty():
        files = existing.select(F.concat(F.lit(f"{top.rstrip('/')}/"), "REL_PATH").alias("path"))
        return read_listed_csv(files.repartition(max(TASKS_PER_READ, files.count() // FILES_A_TASK)))
    rows = [read_weather_csv(spark, batch).coalesce(TASKS_PER_READ) for batch in batched(
        (f"{base.rstrip('/')}/{GLOB.sub(r'\\\1', r[0])}" for r in existing.select("REL_PATH").orderBy("REL_PATH").toLocalIterator()),
        paths_per_read)]
    none = spark.createDataFrame([], DAILY_SCHEMA).withColumnRenamed("STATION", "ID_STATION")
    return reduce(DataFrame.unionByName, rows) if rows else none
