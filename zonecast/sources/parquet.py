"""Parquet layers: the raw weather layer and the two serving extracts.

A layer is replaced without a moment at which it is missing or half written:
each write makes a folder of its own under ``versions``, and one empty file
under ``commits``, created when the write is complete, makes it the current
one. A job that fails leaves the layer as it was. The version before the
current one stays for readers that have planned with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS, COMMITS = "versions", "commits"
KEPT = 2


def _store(spark: SparkSession, path: str):
    """The Hadoop file system of a path and its path class."""
    jvm = spark.sparkContext._jvm
    cls = jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), cls


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of every commit of a layer, in order."""
    files, cls = _store(spark, path)
    folder = cls(f"{path}/{COMMITS}")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted((int(n), version) for n, _, version in (name.partition("-") for name in names if not name.startswith(".")))


def write_partitioned(df: DataFrame, path: str, date_col: str, year_col: str = "YEAR") -> None:
    """Replace the layer at ``path``, one directory per year of ``date_col``
    (readers filtering on dates then skip whole years).

    Rows are rebalanced on the year first: each task then writes a single
    year (no tasks x years small files), and AQE splits a heavy year into
    advisory-size pieces instead of one straggler task.
    """
    if dict(df.dtypes)[date_col] != "date":         # text dates are typed, so that row groups prune too
        df = df.withColumn(date_col, F.try_to_date(date_col))
    spark, version = df.sparkSession, uuid.uuid4().hex
    files, cls = _store(spark, path)
    folder = f"{path}/{VERSIONS}/{version}"
    try:
        (df.withColumn(year_col, F.year(date_col)).hint("rebalance", year_col)
         .write.partitionBy(year_col).parquet(folder))
    except Exception:
        files.delete(cls(folder), True)
        raise
    before = commits(spark, path)
    number = before[-1][0] + 1 if before else 0
    files.mkdirs(cls(f"{path}/{COMMITS}"))
    files.createNewFile(cls(f"{path}/{COMMITS}/{number:012d}-{version}"))       # of two at once the greater name counts
    for old, gone in commits(spark, path)[:-KEPT]:
        files.delete(cls(f"{path}/{COMMITS}/{old:012d}-{gone}"), False)
        files.delete(cls(f"{path}/{VERSIONS}/{gone}"), True)


def current(spark: SparkSession, path: str) -> str:
    """The folder of a layer's current version (the path itself where nothing was committed: a stream's layer)."""
    done = commits(spark, path)
    return f"{path}/{VERSIONS}/{done[-1][1]}" if done else path


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current(spark, path))
