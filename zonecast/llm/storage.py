"""Tables between the steps of an operator, and bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import scratch_path

ARROW_BATCH_BYTES = 16 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again.

    Cuts the lineage: what follows survives lost executors without
    recomputing (or renumbering) what was written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned and nothing reads any more (what did is written itself)."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._written)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Python workers get at most this many bytes at once (one row at least)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def _first(docs: DataFrame, name: str) -> str:
    if name not in docs.columns:
        raise ValueError(f"no column {name!r} among {docs.columns}")
    return f"_c{docs.columns.index(name)}"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named _c0, _c1, ...: no name clashes with one of ours."""
    return docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])


def column_of(docs: DataFrame, name: str) -> Column:
    """The column of ``numbered(docs)`` that is called exactly ``name`` in ``docs``."""
    return F.col(_first(docs, name))


def picked(docs: DataFrame, *names: str) -> DataFrame:
    """Only the columns called exactly ``names``, whatever else ``docs`` has."""
    return numbered(docs).select(*[column_of(docs, n).alias(n) for n in names])
