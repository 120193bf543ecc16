"""Column functions against numpy / Python references."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_spatial import _km
from zonecast.functions.geo import haversine_km
from zonecast.functions.numeric import round_half_even
from zonecast.functions.text import format_fixed
from zonecast.functions.time import bucket_label, resample_rule_for_span

TIES = [0.25, 20.05, 0.125, 2.675, -0.125, 195619.545, 1.005, 0.5, 1.5, 2.5, -2.5, 0.0, 1234.5678]


def test_round_half_even_is_numpy_round(spark):
    vals = TIES + [random.Random(7).uniform(-1e4, 1e4) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for digits in (1, 2):
        got = [r[0] for r in df.select(round_half_even("x", digits)).collect()]
        assert got == [float(np.round(v, digits)) for v in vals]


def test_format_fixed_is_python_format(spark):
    rnd = random.Random(11)
    vals = TIES + [rnd.uniform(-1e6, 1e6) for _ in range(500)] + [rnd.randint(0, 10**6) / 1000 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for digits in (1, 2):
        got = [r[0] for r in df.select(format_fixed("x", digits)).collect()]
        assert got == [f"{v:.{digits}f}" for v in vals]


def test_haversine_matches_numpy_and_is_symmetric(spark):
    rnd = random.Random(3)
    pts = [(rnd.uniform(-180, 180), rnd.uniform(-89, 89), rnd.uniform(-180, 180), rnd.uniform(-89, 89))
           for _ in range(200)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    rows = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y"),
                     haversine_km("a", "b", "a", "b").alias("z")).collect()
    want = [_km(*p) for p in pts]
    for r, w in zip(rows, want):
        assert r.x == pytest.approx(w, rel=1e-12, abs=1e-9)
        assert r.x == pytest.approx(r.y, rel=1e-12, abs=1e-9)
        assert r.z == 0.0
    one_degree = df.limit(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert one_degree == pytest.approx(6371 * np.pi / 180)


@pytest.mark.parametrize("days,rule", [(0, "D"), (60, "D"), (61, "W"), (180, "W"), (181, "M"),
                                       (730, "M"), (731, "Q")])
def test_resample_rule_thresholds(days, rule):
    assert resample_rule_for_span(days) == rule


def test_bucket_labels_match_pandas(spark):
    rnd = random.Random(5)
    days = [dt.date(1999, 12, 31) + dt.timedelta(days=rnd.randint(0, 800)) for _ in range(300)]
    days += [dt.date(2000, 2, 29), dt.date(2000, 3, 31), dt.date(2000, 1, 2), dt.date(2000, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for rule, alias in (("W", "W"), ("M", "ME"), ("Q", "QE")):
        got = [r[0] for r in df.select(bucket_label(F.col("d"), rule)).collect()]
        s = pd.Series(1.0, index=pd.to_datetime(days))
        labels = s.resample(alias).mean().index
        for d, g in zip(days, got):
            # the bucket containing d is the first label on or after d
            want = labels[labels.searchsorted(pd.Timestamp(d))].date()
            assert g == want, (rule, d)


def test_scale_conf_sizes_partitions():
    from zonecast.session import scale_conf
    small = scale_conf(10 << 20)
    assert small["spark.sql.shuffle.partitions"] == "200"
    huge = scale_conf(100 << 40, executor_memory_gb=32, executor_cores=8)   # 100 TB
    assert int(huge["spark.sql.shuffle.partitions"]) == 200_000
    assert huge["spark.sql.files.maxPartitionBytes"] == "256m"
    tight = scale_conf(1 << 40, executor_memory_gb=4, executor_cores=4)
    assert tight["spark.sql.files.maxPartitionBytes"] == "128m"
