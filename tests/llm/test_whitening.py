import math
from collections import Counter

import numpy as np
import pytest

from tests.llm import data
from zonecast.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, schema=SCHEMA):
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], schema)
    return df.select("*", "label", "label").toDF(*df.columns, "x", "e")


def plain(vectors):
    """Fit list, exact sums, eigenpairs by a dense solver."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = (fit * n - sums).astype(float) / n
    v = centred.T @ centred / n
    values, columns = np.linalg.eigh(v)
    return x, n, sums, values[::-1], columns[:, ::-1], np.trace(v)


def check(spark, vectors, components=16, guard=16, digits=9):
    got = whitening.whiten(frame(spark, vectors), components, guard).collect()
    x, n, sums, values, columns, trace = plain(vectors)
    k = min(components, int((values > len(values) * 2.3e-16 * trace).sum()))
    assert Counter(r.vec_id for r in got) == {i: k for i in range(len(x))}
    assert {r.component for r in got} == set(range(1, k + 1))
    white = np.zeros((len(x), k))
    for r in got:
        white[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9) and 0 <= r.identity_error < 1e-9
    want = (np.array(x, dtype=float) - np.array([s / n for s in sums])) @ columns[:, :k] / np.sqrt(values[:k])
    sign = np.sign((want * white).sum(0))
    assert np.abs(want * sign - white).max() < 10 ** -digits * max(1, np.abs(want).max())


def normal(seed, n, spread):
    return (np.random.default_rng(seed).standard_normal((n, len(spread))) * spread).astype(np.float32).tolist()


def test_flat_spectrum(spark):
    check(spark, normal(1, 900, np.full(64, 0.12)))


def test_steep_spectrum(spark):
    check(spark, normal(2, 500, 20.0 * 0.7 ** np.arange(48)))


def test_one_value_far_above(spark):
    check(spark, normal(3, 700, np.r_[3000.0, np.full(59, 0.5)]), digits=6)      # rounding of the first over the gaps of the others


def test_few_dimensions_and_few_components(spark):
    check(spark, normal(4, 60, np.full(5, 0.3)))
    check(spark, normal(5, 400, np.linspace(2, 0.1, 40)), components=3, guard=4)


def test_low_rank_gives_only_components_with_variance(spark):
    part = np.array(normal(6, 300, np.r_[8.0, 4.0, 2.0]))
    vectors = np.concatenate([part, np.zeros((300, 37))], 1)
    check(spark, vectors.tolist())


def test_copies_are_fitted_once(spark):
    vectors = normal(7, 200, np.full(8, 0.4))
    check(spark, vectors + [vectors[0]] * 300)


def test_unusable_rows_are_left_out(spark):
    good = normal(8, 50, np.full(4, 0.4))
    bad = [None, [], [1.0, None, 0.0, 0.0], [math.nan, 0.0, 0.0, 0.0], [math.inf, 0.0, 0.0, 0.0], [3e38, 0.0, 0.0, 0.0], [1.0, 2.0]]
    got = whitening.whiten(frame(spark, good + bad)).collect()
    assert {r.vec_id for r in got} == set(range(50)) and len(got) == 200
    assert got[0].n == len({tuple(r) for r in plain(good)[0]})


def test_no_rows_or_no_variance(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [None, []])).collect() == []
    assert whitening.whiten(frame(spark, [[0.5, 0.25]] * 9)).collect() == []


def test_large_entries_stay_exact(spark):
    schema = "vec_id long, embedding array<double>, label int"
    vectors = [[2.0 ** 40 + i, float(i)] for i in range(9)]
    got = whitening.whiten(frame(spark, vectors, schema)).where("component = 1").collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    sums = np.array(x, dtype=object).sum(0)
    assert {r.vec_id: r.deviation for r in got} == {i: int(sum((9 * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for i, v in enumerate(x)}


def test_deviation_beyond_a_long_is_null():
    x = np.array([[2 ** 40], [0]])
    assert whitening._deviation(x, 2, [2 ** 40]) == [None, None]


def test_query_is_whole_and_white(spark):
    rows = spark.read.parquet(f"{data.SMALL}/embeddings.parquet").collect()
    got = whitening.op12_whitening(spark, data.SMALL).collect()
    assert len(got) == 16 * len(rows) and max(r.identity_error for r in got) < 1e-9
    found = np.zeros((len(rows), 16))
    place = {r.vec_id: i for i, r in enumerate(rows)}
    for r in got:
        found[place[r.vec_id], r.component - 1] = r.whitened
    x, n, sums, values, columns, _ = plain([r.embedding for r in rows])
    want = (np.array(x, dtype=float) - np.array([s / n for s in sums])) @ columns[:, :16] / np.sqrt(values[:16])
    assert np.abs(np.abs(want) - np.abs(found)).max() < 1e-8
