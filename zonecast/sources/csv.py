"""Station inventory and daily weather CSV files."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# Fixed values of the daily weather file format: the 28 fields in file order.
DAILY_SCHEMA = StructType([
    StructField("STATION", StringType()),
    StructField("DATE", StringType()),
    StructField("LATITUDE", DoubleType()),
    StructField("LONGITUDE", DoubleType()),
    StructField("ELEVATION", DoubleType()),
    StructField("NAME", StringType()),
    StructField("TEMP", DoubleType()),
    StructField("TEMP_ATTRIBUTES", StringType()),
    StructField("DEWP", DoubleType()),
    StructField("DEWP_ATTRIBUTES", StringType()),
    StructField("SLP", DoubleType()),
    StructField("SLP_ATTRIBUTES", StringType()),
    StructField("STP", DoubleType()),
    StructField("STP_ATTRIBUTES", StringType()),
    StructField("VISIB", DoubleType()),
    StructField("VISIB_ATTRIBUTES", StringType()),
    StructField("WDSP", DoubleType()),
    StructField("WDSP_ATTRIBUTES", StringType()),
    StructField("MXSPD", DoubleType()),
    StructField("GUST", DoubleType()),
    StructField("MAX", DoubleType()),
    StructField("MAX_ATTRIBUTES", StringType()),
    StructField("MIN", DoubleType()),
    StructField("MIN_ATTRIBUTES", StringType()),
    StructField("PRCP", DoubleType()),
    StructField("PRCP_ATTRIBUTES", StringType()),
    StructField("SNDP", DoubleType()),
    StructField("FRSHHT", StringType()),
])
DAILY_COLUMNS = [f.name for f in DAILY_SCHEMA.fields]

RENAMES = 16                # at once, from the driver
OPEN_COST = "64k"           # of a daily file: more of them a task than by Spark's 4 MB
LISTING_TASKS = 64          # of one read; Spark's own number is a task a path
BLOCK = 1 << 20             # bytes of daily files that a task reads and sends at once
BLANK = bytes(range(33))    # what Spark trims from a line to see whether it is empty

STATION_FIELDS = ("USAF", "WBAN", "STATION NAME", "LAT", "LON")


def read_station_csv(spark: SparkSession, path) -> DataFrame:
    """Station inventory by header name; every cell is read as text (so id
    columns keep their leading zeros), coordinates are then typed; text
    that does not parse becomes NULL."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(F.col("USAF"), F.col("WBAN"), F.col("`STATION NAME`"),
                      F.col("LAT").try_cast("double").alias("LAT"),
                      F.col("LON").try_cast("double").alias("LON"))


def write_station_csv(stations: DataFrame, path: str) -> None:
    stations.select(*[F.col(f"`{c}`") for c in STATION_FIELDS]) \
        .write.mode("overwrite").option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_weather_csv(spark: SparkSession, paths) -> DataFrame:
    """Many daily weather files at once with the fixed 28-field schema
    (applied by position; malformed or short cells become NULL). The
    station column is renamed ID_STATION for the raw layer."""
    reader = spark.read.option("header", True).option("sep", ",").option("mode", "PERMISSIVE")
    paths = paths if isinstance(paths, str) else list(paths)
    with few_listing_tasks(spark):
        rows = reader.schema(DAILY_SCHEMA).csv(paths)
    return rows.withColumnRenamed("STATION", "ID_STATION")


def _line_blocks(file: str) -> Iterator[bytes]:
    """The lines below the header of a file in blocks of whole lines, each ended by a line feed."""
    rest, header, begun = b"", True, False
    with open(file, "rb") as f:
        while True:
            piece = f.read(BLOCK)
            block, rest = rest + piece, b""
            if piece:
                cut = max(block.rfind(b"\n"), block.rfind(b"\r", 0, -1)) + 1      # a last \r may belong to a \n not read yet
                block, rest = block[:cut], block[cut:]
            elif block and block[-1] not in b"\r\n":
                block += b"\n"
            if block and not begun:
                block, begun = block.removeprefix(b"\xef\xbb\xbf"), True
            if b"\r" in block:
                block = block.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
            while header and block:                           # the first line that isn't empty
                line, _, block = block.partition(b"\n")
                header = not line.strip(BLANK)
            if block:
                yield block
            if not piece:
                return


def _listed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``line`` of the files at ``path``, beside the other columns."""
    def lines(batch, at, blocks):
        data = np.frombuffer(b"".join(blocks), np.uint8)
        ends = np.flatnonzero(data == 10)
        offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
        text = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data[data != 10]))
        rows = pa.array(np.repeat(at, [b.count(b"\n") for b in blocks]))
        names = [n for n in batch.schema.names if n != "path"]
        return pa.RecordBatch.from_arrays([*[batch.column(n).take(rows) for n in names], text], names=[*names, "line"])

    for batch in batches:
        at, blocks, size = [], [], 0
        for k, file in enumerate(batch.column("path").to_pylist()):
            for block in _line_blocks(file):
                at.append(k)
                blocks.append(block)
                size += len(block)
                if size >= BLOCK:
                    yield lines(batch, at, blocks)
                    at, blocks, size = [], [], 0
        if blocks:
            yield lines(batch, at, blocks)


def read_listed_csv(files: DataFrame) -> DataFrame:
    """The rows that ``read_weather_csv`` gives of the files of the shared file system at ``path``, followed by the
    other columns of ``files``. The tasks open the files: no path passes through the driver, and a task holds BLOCK."""
    other = [c for c in files.columns if c != "path"]
    kinds = [f"{c} {files.schema[c].dataType.simpleString()}" for c in other]
    lines = files.mapInArrow(_listed_lines, ", ".join([*kinds, "line string"])).where(F.col("line").rlike(r"[^\x00-\x20]"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DAILY_SCHEMA)
    rows = lines.select(F.from_csv("line", schema, {"mode": "PERMISSIVE"}).alias("row"), *other).select("row.*", *other)
    return rows.withColumnRenamed("STATION", "ID_STATION")


@contextmanager
def set_while(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what is started inside."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def few_listing_tasks(spark: SparkSession):
    """Many given paths are looked up by LISTING_TASKS tasks."""
    return set_while(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTING_TASKS)})


def write_weather_csv(weather: DataFrame, base: str) -> None:
    """The layout the daily files are published in: ``{base}/{year}/{station}.csv``.

    ``weather`` has file columns (missing ones are left empty) and the layout
    columns YEAR and STN_ID. One task holds all rows of a station and year.
    """
    cols = [F.col(c) if c in weather.columns else F.lit(None).cast(DAILY_SCHEMA[c].dataType).alias(c)
            for c in DAILY_COLUMNS]
    rows = weather.select(*cols, "YEAR", "STN_ID").repartition("YEAR", "STN_ID")
    path = weather.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    store = path.getFileSystem(weather.sparkSession.sparkContext._jsc.hadoopConfiguration())
    if store.getUri().getScheme() == "file":
        _write_named(rows, path.toUri().getPath())
    else:
        _write_renamed(rows, base)


def _write_named(rows: DataFrame, base: str) -> None:
    """Each task writes its files under their own names into the shared folder.

    Spark formats the lines; those of a file are written at once. A file appears whole, by one rename, and a task
    that runs again replaces it by the same rows.
    """
    header = (",".join(DAILY_COLUMNS) + "\n").encode()

    def name(value) -> str:                                  # as Spark writes it in paths
        if value == "":
            return "__HIVE_DEFAULT_PARTITION__"
        return re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda c: f"%{ord(c[0]):02X}", value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, made, now, out, part = 0, set(), None, None, None

        def close():
            out.close()
            os.replace(part, f"{base}/{now[0]}/{now[1]}.csv")

        for batch in batches:
            if not batch.num_rows:
                continue
            year, station, line = (c.cast(pa.large_string()) for c in batch.columns)
            at = np.frombuffer(line.buffers()[1], np.int64)[line.offset:line.offset + len(line) + 1]
            text = memoryview(line.buffers()[2])
            new = pc.or_(pc.not_equal(year[1:], year[:-1]), pc.not_equal(station[1:], station[:-1]))
            heads = np.concatenate([[0], np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1])
            for head, end in zip(heads.tolist(), [*heads[1:].tolist(), len(line)], strict=True):
                key = name(year[head].as_py()), name(station[head].as_py())
                if key != now:
                    if out:
                        close()
                    if key[0] not in made:
                        os.makedirs(f"{base}/{key[0]}", exist_ok=True)
                        made.add(key[0])
                    now, files = key, files + 1
                    part = f"{base}/{key[0]}/.{uuid.uuid4().hex}"
                    out = open(part, "wb")
                    out.write(header)
                out.write(text[at[head]:at[end]])
        if out:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    lines = rows.sortWithinPartitions("YEAR", "STN_ID").select(
        text("YEAR"), text("STN_ID"), F.concat(F.to_csv(F.struct(*DAILY_COLUMNS)), F.lit("\n")).alias("line"))
    lines.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def _write_renamed(rows: DataFrame, base: str) -> None:
    """Where tasks reach the storage through Spark only: a directory a file in
    ``{base}-parts``, from where the driver renames each file."""
    # tasks commit their own files; the folder is new and nobody else reads it
    (rows.write.mode("overwrite").partitionBy("YEAR", "STN_ID").option("header", True)
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").csv(f"{base}-parts"))
    context = rows.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    files = path(base).getFileSystem(context._jsc.hadoopConfiguration())

    def rename(station, name):
        parts = files.globStatus(path(station, "part-*.csv"))
        if len(parts) != 1:
            raise OSError(f"{len(parts)} files instead of one in {station}")
        files.rename(parts[0].getPath(), path(f"{base}/{name}/{station.getName().split('=', 1)[1]}.csv"))

    with ThreadPoolExecutor(RENAMES) as pool:
        for year in files.listStatus(path(f"{base}-parts")):
            if year.isDirectory():
                name = year.getPath().getName().split("=", 1)[1]
                files.mkdirs(path(f"{base}/{name}"))
                list(pool.map(lambda s: rename(s.getPath(), name), files.listStatus(year.getPath())))
