"""Exact distributed quantiles and box statistics against numpy."""

import random

import numpy as np
import pytest

from zonecast.operators import stats
from zonecast.operators.stats import box_stats, exact_quantiles


def quantiles(df, probs):
    got = exact_quantiles(df, "g", "v", {f"p{i}": p for i, p in enumerate(probs)}).collect()
    return {r.g: {p: r[f"p{i}"] for i, p in enumerate(probs)} for r in got}


def _frame(spark, groups):
    rows = [(g, v) for g, vals in groups.items() for v in vals]
    return spark.createDataFrame(rows, "g string, v double")


def test_quantiles_match_numpy_linear(spark):
    rnd = random.Random(2)
    groups = {
        "uniform": [rnd.uniform(-50, 50) for _ in range(3001)],
        "hot": [7.25] * 1000 + [rnd.gauss(0, 1) for _ in range(2000)],     # a third on one value
        "ties": [float(rnd.randint(0, 5)) for _ in range(999)],
        "tiny": [rnd.uniform(0, 1e-9) + 1.0 for _ in range(50)],          # values ulps apart
        "one": [3.0],
        "two": [1.0, 2.0],
    }
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = quantiles(_frame(spark, groups), probs)
    for g, vals in groups.items():
        for p in probs:
            assert got[g][p] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-15, abs=1e-15), (g, p)


def test_quantiles_with_wide_brackets_and_infinities(spark, monkeypatch):
    monkeypatch.setattr(stats, "ACCURACY", 50)
    rnd = random.Random(3)
    groups = {"wide": [rnd.gauss(0, 9) for _ in range(5000)], "inf": [float("inf")] * 30 + [float(k) for k in range(70)]}
    got = quantiles(_frame(spark, groups), (0.25, 0.5))
    for g, vals in groups.items():
        assert [got[g][p] for p in (0.25, 0.5)] == pytest.approx([np.percentile(vals, p) for p in (25, 50)])


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0)], "g string, v double")
    assert quantiles(df, (0.5,))["a"][0.5] == 2.0


def test_box_stats_whiskers_and_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0, -50.0]
    df = spark.createDataFrame([(v, v * 2) for v in vals], "A double, B double")
    out = {r.VARIABLE: r for r in box_stats(df, ["A", "B"]).collect()}
    for name, k in (("A", 1.0), ("B", 2.0)):
        x = np.array(vals) * k
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        lf, uf = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = out[name]
        assert (r.Q1, r.MEDIAN, r.Q3) == pytest.approx((q1, med, q3))
        assert r.LOWER_WHISKER == x[x >= lf].min() and r.UPPER_WHISKER == x[x <= uf].max()
        assert r.N_OUTLIERS == int(((x < lf) | (x > uf)).sum()) == 2
        assert r.N == len(vals)


def test_quantiles_with_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 5.0), ("a", 2.0), ("a", 4.0)], "g string, v double")
    got = quantiles(df, (0.5,))
    assert got[None][0.5] == 3.0 and got["a"][0.5] == 3.0
