"""Whitening of vectors by Chebyshev-filtered subspace iteration.

The covariance V of the distinct vectors is never formed: V Q comes from a pass over the rows, each
task adding up (x - mean)' ((x - mean) Q) for its own rows, and Spark adding up the tasks' sums row
by row of V Q. A round takes the Chebyshev polynomial of V that is small on the unwanted part of
the spectrum, from zero to the smallest Ritz value of the block, and grows quickly above it: the
three-term recurrence is one pass a degree. A QR step and a Rayleigh-Ritz step with one more pass give new
vectors, values and residuals. Rounds go on until all residuals of the wanted components are
certified: below ``TOLERANCE`` of the largest eigenvalue, or no longer falling, which is what
double precision allows. Last, a pass over the whitened vectors measures how far their covariance is
from the identity.

All sums that results depend on are of centred numbers: n * x - S in whole numbers first, then
divided by n. The driver holds blocks of (dimensions x components) only.

Null vectors and vectors that hold null or non-finite numbers are left out. Shorter vectors are
filled up with zero components. Products with the scale count up to 2**31 in size. Repeated vectors
count once in the fit and are whitened like any other. Directions without variance, and components beyond the
dimensions, have no rows: one vector alone, or equal vectors, give an empty table, and so does an empty
one. Equal eigenvalues may come in any order of their common space. A deviation beyond 64 bits is
null. Extra columns are dropped, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.vectors import matrix, whole_numbers
from shelfcast.session import forget, written

LIMIT = 1 << 31
GUARD = 16          # vectors in the block beyond the wanted ones
DEGREE = 8          # of the polynomial, so many passes a round
ROUNDS = 60
TOLERANCE = 1e-14   # of the largest eigenvalue, for a residual
CERTIFIED = 1e-10   # the same, for residuals that do not fall any more
NO_VARIANCE = 1e-13


@dataclass
class Whitening:
    """The fitted transform: x goes to (x - S / n) vectors / sqrt(values)."""

    n: int
    sums: list[int]
    values: np.ndarray     # falling
    vectors: np.ndarray    # dimensions x components, unit columns
    trace: float
    residual: float        # largest of the components, relative to the largest eigenvalue
    passes: int
    identity_error: float = 0.0


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, rounded once."""
    return (x * n - sums) / n if abs(n) < 1 << 30 else (x - sums // n) - (sums % n) / n


def _summed(rows: DataFrame, function, width: int) -> np.ndarray:
    """The sum over all rows of a matrix with ``width`` columns that ``function(x)`` gives for a
    block of rows. A task sends one row for each row of its own sum."""
    names = [f"c{j}" for j in range(width)]

    def run(batches):
        total = None
        for batch in batches:
            made = function(matrix(batch.column("x")))
            total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int64()), *(pa.array(total[:, j]) for j in range(width))], names=["i", *names])

    partial = rows.select("x").mapInArrow(run, T.StructType(
        [T.StructField("i", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in names)]))
    found = partial.groupBy("i").agg(*(F.expr(f"sum({c}) as {c}") for c in names)).toPandas().sort_values("i")
    return found[names].to_numpy(dtype=np.float64)


def _moments(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension."""
    def run(batches):
        n, total = 0, None
        for batch in batches:
            x = matrix(batch.column("x"))
            total = x.sum(axis=0) if total is None else total + x.sum(axis=0)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total), pa.array([n] * len(total))], names=["i", "s", "n"])

    partial = rows.select("x").mapInArrow(run, "i bigint, s bigint, n bigint")
    found = partial.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    by_place = {r["i"]: r for r in found}
    return (by_place[0]["n"], [int(by_place[i]["s"]) for i in range(len(by_place))]) if by_place else (0, [])


def fit(rows: DataFrame, components: int = 16, seed: int = 7) -> Whitening | None:
    """The leading components of the covariance of ``x`` over the rows, each counted; None if
    nothing varies."""
    n, exact = _moments(rows)
    if n < 2:
        return None
    sums, width = np.array(exact, dtype=np.int64), len(exact)
    passes = 0

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def block(x):
            c = _centred(x, n, sums)
            return c.T @ (c @ q)

        return _summed(rows, block, q.shape[1]) / n

    trace = float(_summed(rows, lambda x: np.square(_centred(x, n, sums)).sum(axis=0)[:, None], 1).sum()) / n
    if not trace > 0:
        return None
    size = min(width, components + GUARD)
    wanted = min(components, size)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))[0]
    best, stuck = np.inf, 0
    for _ in range(ROUNDS):
        values, q, vq = _ritz(q, times(q))
        residual = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max() / values[0])
        if residual <= TOLERANCE or size == width:
            break
        stuck = stuck + 1 if residual > best / 2 else 0
        best = min(best, residual)
        if stuck >= 2 and residual <= CERTIFIED:
            break
        q = np.linalg.qr(_filtered(q, vq, times, max(float(values[-1]), 0.0), float(values[0])))[0]
    else:
        raise ValueError(f"residual {residual} after {passes} passes")
    kept = int((values[:wanted] > NO_VARIANCE * values[0]).sum())
    fitted = Whitening(n, exact, values[:kept], q[:, :kept], trace, residual, passes)
    fitted.identity_error = _identity_error(rows, fitted)
    return fitted


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, their vectors, and V times those."""
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def _filtered(q: np.ndarray, vq: np.ndarray, times, upper: float, largest: float, degree: int = DEGREE) -> np.ndarray:
    """The scaled Chebyshev polynomial of V times q: at most one on [0, upper], one at ``largest``.
    ``vq`` is V q, known already."""
    half = max(upper, np.finfo(float).eps * largest) / 2  # centre and half width of the damped interval
    sigma = first = half / (largest - half)
    before, now = q, (vq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, 2 * following / half * (times(now) - half * now) - sigma * following * before
        sigma = following
    return now


def _identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    sums, scale = np.array(fitted.sums, dtype=np.int64), fitted.vectors / np.sqrt(fitted.values)

    def block(x):
        w = _centred(x, fitted.n, sums) @ scale
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = _summed(rows, block, scale.shape[1]) / fitted.n
    return float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(scale.shape[1])).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S) squared for every row, exactly; None beyond 64 bits."""
    away = x - np.array([s // n for s in sums], dtype=np.int64)  # n x - S = n away - S mod n
    rest = np.array([s % n for s in sums], dtype=np.int64)
    far = np.abs(away).max(axis=1, initial=0).astype(np.float64) + 1
    small = (far * n) ** 2 * max(1, x.shape[1]) < 2.0 ** 62
    out: list[int | None] = [None] * len(x)
    for k, value in zip(np.flatnonzero(small).tolist(), ((away[small] * n - rest) ** 2).sum(axis=1).tolist()):
        out[k] = value
    for k in np.flatnonzero(~small & (far * n / 2 < 2.0 ** 33)).tolist():
        value = sum((a * n - r) ** 2 for a, r in zip(away[k].tolist(), rest.tolist()))
        out[k] = value if value < 1 << 63 else None
    return out


def whiten(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 16, scale: float = 64.0, shift: int = 1_000_000,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, residual, passes) for every
    kept row and component, the fit made over the distinct whole-number vectors."""
    rows, _ = whole_numbers(df, vector, scale, shift, LIMIT, 1, {id_column: "id"})
    distinct = written(rows.select("x").distinct(), "distinct_vectors")
    fitted = fit(distinct, components)
    forget(distinct)
    fields = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, residual double, passes int"
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(fields).fields])
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    sums, turn = np.array(fitted.sums, dtype=np.int64), fitted.vectors / np.sqrt(fitted.values)
    explained = fitted.values / fitted.trace

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x"))
            k, size = turn.shape[1], len(x)
            white = _centred(x, fitted.n, sums) @ turn
            again = pa.array(np.repeat(np.arange(size), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, fitted.n)), pa.array(_deviations(x, fitted.n, fitted.sums), pa.int64()).take(again),
                pa.array(white.reshape(-1)), pa.array(np.tile(explained, size)), pa.array(np.full(size * k, fitted.identity_error)),
                pa.array(np.full(size * k, fitted.residual)), pa.array(np.full(size * k, fitted.passes, dtype=np.int32)),
            ], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)
