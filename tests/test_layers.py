"""A layer is replaced whole or not at all."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from zonecast.sources import parquet


def rows(spark, n, tag):
    day = F.date_add(F.lit(dt.date(2001, 1, 1)), (F.col("id") % 900).cast("int"))
    return spark.range(n).select("id", day.alias("DATE"), F.lit(tag).alias("TAG"))


def test_a_failed_write_leaves_the_old_layer(spark, tmp_path):
    path = str(tmp_path / "layer")
    parquet.write_partitioned(rows(spark, 3000, "old"), path, "DATE")
    broken = rows(spark, 3000, "new").withColumn("TAG", F.when(F.col("id") == 2500, F.raise_error(F.lit("lost"))).otherwise(F.col("TAG")))
    with pytest.raises(Exception, match="lost") as fault:
        parquet.write_partitioned(broken.repartition(4), path, "DATE")
    assert isinstance(fault.value, PySparkException) or "lost" in str(fault.value)
    layer = parquet.read_layer(spark, path)
    assert [tuple(r) for r in layer.groupBy("TAG").count().collect()] == [("old", 3000)]
    assert len(os.listdir(f"{path}/versions")) == 1


def test_readers_see_one_version_whole(spark, tmp_path):
    path = str(tmp_path / "layer")
    parquet.write_partitioned(rows(spark, 100, "a"), path, "DATE")
    planned = parquet.read_layer(spark, path)
    half = f"{path}/versions/unfinished/YEAR=2001"
    rows(spark, 5, "half").drop("DATE").write.parquet(half)                  # a write that has not committed
    assert parquet.read_layer(spark, path).count() == 100
    parquet.write_partitioned(rows(spark, 40, "b"), path, "DATE")
    assert {r.TAG for r in planned.collect()} == {"a"} and planned.count() == 100
    assert {r.TAG for r in parquet.read_layer(spark, path).collect()} == {"b"}
    for tag in "cde":
        parquet.write_partitioned(rows(spark, 10, tag), path, "DATE")
    assert len(parquet.commits(spark, path)) == parquet.KEPT
    assert {r.TAG for r in parquet.read_layer(spark, path).collect()} == {"e"}


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    rows(spark, 7, "plain").write.parquet(str(tmp_path / "p"))
    assert parquet.read_layer(spark, str(tmp_path / "p")).count() == 7
