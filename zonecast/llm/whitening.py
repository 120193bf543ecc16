"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers, x = floor(64 c) + 1000000, and the distinct x vectors
are the fit list. A pass over it multiplies the centred covariance V with a
block Q of columns, as the sum of X'(XQ) over its parts; V itself is never
formed. Each round sends the block through a Chebyshev polynomial of V by its
three-term recurrence, one pass a degree, which damps the spectrum between a
lower bound and the block's smallest Ritz value. QR and Rayleigh-Ritz follow.
The lower bound comes from a Lanczos sequence that takes one more column of
the first passes. A pair is certified when its residual is under TOLERANCE of
the largest eigenvalue, or no longer falls (rounding) and is under CERTIFIED
of it; it then leaves the block, which stays orthogonal to it. A last pass
gives the covariance of the whitened fit list, whose distance from the
identity is reported.

Scale. A pass reads the fit list, packed to blocks of at most BLOCK_BYTES, and
gives one block of d x c sums a task, added up by Spark before d * c numbers
reach the driver. The fit list comes from one distinct, with equal vectors
merged before the shuffle. Rows of the table are only read to be projected.

Defined cases: a row is left out if its vector is null, empty, holds a null or
non-finite entry, an entry of 2 ** 46 or more in size, or has another length
than most (of equally frequent lengths the longest counts); repeated rows are
projected each and fitted once; components without variance (up to rounding)
aren't given, so one distinct vector or an empty table gives no rows; a null
vec_id is kept; a deviation beyond a long is null; columns are picked by
position, others may have any names. Eigenvalues that tie have any basis.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.storage import bound_batches, picked, written

COMPONENTS = 16
GUARD = 16              # columns beside the wanted ones
DEGREE = 12             # passes of a round
ROUNDS = 60
LOG_APART = np.log(1e8)  # of how much a round may amplify the first column over the last wanted one
TOLERANCE = 2e-15
CERTIFIED = 1e-11
SHIFT, SCALE = 1_000_000, 64
LARGEST = 1 << 46
BLOCK_BYTES = 1 << 20


@dataclass(frozen=True)
class Fit:
    n: int
    sums: list[int]                     # exact, a dimension each
    trace: float
    values: np.ndarray                  # eigenvalues, falling
    vectors: np.ndarray                 # d x components
    residuals: np.ndarray               # of the largest eigenvalue
    identity_error: float
    passes: int


def usable(rows: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, x of the rows that have a vector of finite entries and of the common length, and this length."""
    rows = picked(rows, "vec_id", "embedding").withColumn("e", F.col("embedding").cast("array<double>")).where(
        F.size("e") > 0).where(~F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST)))
    length = rows.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = length["d"] if length else 1
    return rows.where(F.size("e") == d).select("vec_id", F.transform("e", lambda c: F.floor(c * SCALE) + SHIFT).alias("x")), d


def _packed(fit: DataFrame) -> DataFrame:
    """Blocks of at most BLOCK_BYTES: vectors as little-endian longs, end to end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            step = max(1, BLOCK_BYTES // (8 * x.shape[1])) if len(x) else 1
            blocks = [x[a:a + step].astype("<i8").tobytes() for a in range(0, len(x), step)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["block"])

    return fit.mapInArrow(run, "block binary")


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy()
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 1)


def _sums(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """Vectors and exact sum of each dimension (halves of the longs are summed apart)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                x = np.frombuffer(block, "<i8").reshape(-1, d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d + 1), pa.int32()), pa.array(np.append((x >> 32).sum(0), 0), pa.int64()),
                     pa.array(np.append((x & 0xFFFFFFFF).sum(0), len(x)), pa.int64())], names=["i", "high", "low"])

    total = blocks.mapInArrow(run, "i int, high long, low long").groupBy("i").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]).collect()
    sums = {r["i"]: int(r["high"]) * 2 ** 32 + int(r["low"]) for r in total}
    return sums.get(d, 0), [sums.get(i, 0) for i in range(d)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n as doubles: the whole part is subtracted exactly first."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole).astype(float) - np.array([(s % n) / n for s in sums])


def _summed(blocks: DataFrame, d: int, shape: tuple[int, int], of) -> np.ndarray:
    """The sum over the fit list's blocks of the matrices ``of`` (vectors) gives."""
    size = shape[0] * shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for block in batch.column(0).to_pylist():
                total += of(np.frombuffer(block, "<i8").reshape(-1, d)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["i", "v"])

    out = np.zeros(size)
    for i, v in blocks.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v")).collect():     # d * c rows
        out[i] = v
    return out.reshape(shape)


def _lowest(alpha: list[float], beta: list[float]) -> float:
    """A lower bound of the spectrum from the Lanczos numbers, at least 0."""
    steps = np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(steps)[0]) - beta[-1])


def fit(x: DataFrame, d: int, components: int = COMPONENTS, guard: int = GUARD) -> Fit:
    """Eigenpairs of the covariance of the distinct vectors in ``x``, certified by their residuals."""
    blocks = written(_packed(x.select("x").distinct()), "fit")
    n, sums = _sums(blocks, d)
    wanted, width = min(components, d), min(d, components + guard)
    trace, passes = 0.0, 0
    if n:
        trace = float(_summed(blocks, d, (1, d), lambda v: (_centred(v, n, sums) ** 2).sum(0)).sum()) / n
    if not trace > 0:
        return Fit(n, sums, trace, np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0, 0)

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(v: np.ndarray) -> np.ndarray:
            c = _centred(v, n, sums)
            return c.T @ (c @ q)

        return _summed(blocks, d, q.shape, product) / n

    start = np.random.default_rng(12).standard_normal((d, width + 1))
    q, z = np.linalg.qr(start[:, :width])[0], start[:, width] / np.linalg.norm(start[:, width])
    done, ready = np.zeros((d, 0)), np.zeros(0)                       # pairs that are certified already, by falling value
    basis, alpha, beta, low, best, largest, residual = [z], [], [], 0.0, np.inf, 0.0, np.zeros(0)

    def beside(v: np.ndarray) -> np.ndarray:
        return v - done @ (done.T @ v)

    for _ in range(ROUNDS):
        product = beside(times(q))
        theta, turn = np.linalg.eigh(q.T @ product)
        theta, turn = theta[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        largest, left = max(largest, theta[0]), wanted - done.shape[1]
        off = np.linalg.norm(product - q * theta, axis=0)[:left] / largest
        worst = float(off.max())
        stalled = worst <= CERTIFIED and worst > best / 2
        settled = left if stalled else int(np.argmax(np.append(off > TOLERANCE, True)))
        best = min(best, worst)
        residual = np.append(residual, off[:settled])
        done, ready = np.column_stack([done, q[:, :settled]]), np.append(ready, theta[:settled])
        if settled == left:
            break
        q, product, theta = q[:, settled:], product[:, settled:], theta[settled:]
        cut = max(float(theta[-1]), low)
        middle, half = (cut + low) / 2, max((cut - low) / 2, 1e-12 * largest)
        t = np.maximum((theta - middle) / half, 1.0)
        growth = t + np.sqrt(t * t - 1)
        apart = np.log(growth[0] / growth[left - settled - 1])            # what one pass adds to the first over the last wanted
        degree = DEGREE if apart * DEGREE < LOG_APART else max(2, int(LOG_APART / apart))
        before, now = q, beside(product - middle * q) / half
        for _ in range(degree - 1):
            if low == 0.0 and len(alpha) < min(DEGREE, d):              # at first one more column, for the low end
                both = times(np.column_stack([now, basis[-1]]))
                again, w = both[:, :-1], both[:, -1]
                alpha.append(float(basis[-1] @ w))
                for _ in range(2):
                    w = w - np.array(basis).T @ (np.array(basis) @ w)
                beta.append(float(np.linalg.norm(w)))
                basis.append(w / beta[-1] if beta[-1] > 1e-10 * largest else np.zeros(d))
            else:
                again = times(now)
            before, now = now, beside(2 * (again - middle * now) / half - before)
            size = np.maximum(np.linalg.norm(now, axis=0), 1e-300)       # columns of one recurrence share their scale
            before, now = before / size, now / size
        if low == 0.0 and alpha:
            low = _lowest(alpha, beta)
        q = np.linalg.qr(beside(now))[0]
        q = np.linalg.qr(beside(q))[0]
    else:
        raise ArithmeticError(f"not certified after {ROUNDS} rounds: residual {worst:.1e} of the largest eigenvalue")
    order = np.argsort(-ready, kind="stable")
    theta, q, residuals = ready[order], done[:, order], residual[order]
    keep = [i for i in range(wanted) if theta[i] > d * np.finfo(float).eps * trace]
    values, vectors = theta[keep], q[:, keep]
    white = vectors / np.sqrt(values)

    def squares(v: np.ndarray) -> np.ndarray:
        w = _centred(v, n, sums) @ white
        return w.T @ w

    covariance = _summed(blocks, d, (len(keep), len(keep)), squares) / n
    error = float(np.abs(covariance - np.eye(len(keep))).max())
    return Fit(n, sums, trace, values, vectors, residuals[keep], error, passes)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S) squared, exact; null beyond a long."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    apart = x - whole
    largest = n * (int(np.abs(apart).max()) + 1) if len(x) else 0
    if largest ** 2 * x.shape[1] < 2 ** 63:
        return ((n * apart - rest) ** 2).sum(1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [v if v < 2 ** 63 else None for v in exact]


def project(x: DataFrame, found: Fit) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row each vector and component."""
    kind = x.schema["vec_id"].dataType.simpleString()
    n, sums, k = found.n, found.sums, len(found.values)
    white, explained = found.vectors / np.sqrt(found.values), found.values / max(found.trace, 1e-300)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1))
            rows = len(v) if k else 0
            each = np.repeat(np.arange(rows), k)
            w = _centred(v, n, sums) @ white if rows else np.zeros((0, k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                 pa.array(np.full(rows * k, n), pa.int64()),
                 pa.array(_deviation(v, n, sums) if rows else [], pa.int64()).take(pa.array(each)), pa.array(w.ravel()),
                 pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, found.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                             "explained double, identity_error double")


def whiten(rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> DataFrame:
    """The whitened components of every usable row of ``rows`` (vec_id, embedding)."""
    bound_batches(rows.sparkSession)
    x, d = usable(rows)
    return project(x, fit(x, d, components, guard))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
