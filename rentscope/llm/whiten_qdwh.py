"""Embedding whitening: principal components by QDWH divide and conquer.

1. Vectors become integers ``x = floor(1024 c) + 100000``.  One aggregate gives
   the count and the sums per dimension.  A second pass centres at the nearest
   integer of the mean, multiplies, and sums: in integers, so that the result
   is exact and the same for every partitioning.  What is left of the mean (half
   a unit at most) is subtracted exactly: the covariance is the rational number
   itself, rounded once.
2. ``eigenpairs`` splits the covariance without an eigenvalue routine: the
   polar factor U of ``V - s I`` (QDWH iterations: QR factors, no inverse) is +1
   on the eigenspace above the shift s and -1 below, so ``(U + I) / 2`` is the
   spectral projector.  An orthonormal basis of its range and of the rest cuts
   V in two blocks, and each is split in turn until it is one component, or a
   multiple of the identity.  Only the driver does this, on a matrix whose size is
   the vectors' dimension, whatever the number of vectors.
3. Mean and components are sent to the executors with the tasks, and each
   vector is projected.  A last aggregate over all whitened vectors measures
   how far their covariance is from the identity.

Defined cases: vectors that are null, empty, or hold a null or non-finite entry
(or one whose x is no 64-bit integer) are left out, as are vectors of another
length than the commonest (the longer one on ties).  Components of no variance
(constant dimensions, fewer vectors than dimensions) cannot be whitened and are
not returned.  Equal eigenvalues have any orthonormal basis of their space.
Repeated rows and null ids are kept and returned each.  An empty table, or one
without variance, gives an empty result.  ``deviation`` is exact; where it is
too large for a 64-bit integer it is null, and ``deviation_exact`` holds it.
Extra columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMB = 60                  # bits of the lower part of a sum of products
EPS = float(np.finfo(float).eps)


# ------------------------------------------------------------- eigenproblem

def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH: dynamically
    weighted Halley steps in their QR form, cubically convergent."""
    n = len(a)
    x = a / np.linalg.norm(a)                     # singular values in (0, 1]
    low = EPS                                     # a lower bound of them, up to rounding
    eye = np.eye(n)
    for _ in range(40):
        d = (4.0 * (1.0 - low ** 2) / low ** 4) ** (1.0 / 3.0) if low < 1.0 else 0.0
        wa = np.sqrt(1.0 + d) + 0.5 * np.sqrt(8.0 - 4.0 * d + 8.0 * (2.0 - low ** 2) / (low ** 2 * np.sqrt(1.0 + d)))
        wb = (wa - 1.0) ** 2 / 4.0
        wc = wa + wb - 1.0
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2.0
        low = min(1.0, low * (wa + wb * low ** 2) / (1.0 + wc * low ** 2))
        moved = np.linalg.norm(new - x)
        x = new
        if low >= 1.0 - 10 * EPS and moved <= np.sqrt(n) * 1e-15 ** (1.0 / 3.0):
            break
    return x


def _range_basis(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of its complement."""
    start = np.random.default_rng(rank).standard_normal((len(projector), rank))
    q, _ = np.linalg.qr(projector @ start)
    q, _ = np.linalg.qr(projector @ q)            # a second application: rounding left outside the range goes
    full, _ = np.linalg.qr(q, mode="complete")
    return full[:, :rank], full[:, rank:]


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Places to split at.  The median of the diagonal halves the spectrum in
    the usual case; the mean of the eigenvalues always lies between them."""
    diagonal = np.sort(np.diag(a))
    mean, width = float(diagonal.mean()), np.linalg.norm(a - np.eye(len(a)) * diagonal.mean())
    yield float(np.median(diagonal))
    yield mean
    for part in (0.25, -0.25, 0.1, -0.1, 0.03, -0.03, 0.01, -0.01):
        yield mean + part * float(width) / np.sqrt(len(a))


def eigenpairs(a: np.ndarray, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues in falling order, eigenvectors as columns) of a symmetric matrix."""
    n = len(a)
    a = (a + a.T) / 2.0
    scale = float(np.linalg.norm(a)) if scale is None else scale
    centre = np.trace(a) / n
    if n == 1 or np.linalg.norm(a - centre * np.eye(n)) <= n * EPS * scale:   # a multiple of the identity
        order = np.argsort(-np.diag(a), kind="stable")
        return np.diag(a)[order].copy(), np.eye(n)[:, order]
    best = None
    for shift in _shifts(a):
        shifted = a - shift * np.eye(n)
        if np.linalg.norm(shifted) <= EPS * scale:
            continue
        projector = (polar_factor(shifted) + np.eye(n)) / 2.0
        rank = int(round(float(np.trace(projector))))
        if not 0 < rank < n:
            continue
        upper, lower = _range_basis(projector, rank)
        mixed = float(np.linalg.norm(lower.T @ a @ upper))    # zero for invariant subspaces
        if best is None or mixed < best[0]:
            best = (mixed, upper, lower)
        if mixed <= 10 * n * EPS * scale:
            break
    if best is None:
        raise ArithmeticError("no shift splits the spectrum")
    _, upper, lower = best
    e1, v1 = eigenpairs(upper.T @ a @ upper, scale)
    e2, v2 = eigenpairs(lower.T @ a @ lower, scale)
    values, vectors = np.concatenate([e1, e2]), np.hstack([upper @ v1, lower @ v2])
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ------------------------------------------------------------------ on Spark

def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x): usable vectors as 64-bit integers."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    x = F.transform(entries, lambda c: F.floor(c * SCALE))
    # null, NaN and infinite entries fail the comparison, as do those beyond 64 bits
    usable = (F.size(entries) > 0) & F.forall(entries, lambda c: F.coalesce(F.abs(c) < 2.0 ** 52, F.lit(False)))
    return rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       F.when(usable, F.transform(x, lambda v: v.cast("bigint") + SHIFT)).alias("x")).where("x is not null")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _products(y: np.ndarray) -> np.ndarray:
    """y'y in exact integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top * len(y) < 2 ** 53:               # sums of integers below 2^53 are exact in doubles, too
        z = y.astype(float)
        return (z.T @ z).astype(np.int64).astype(object)
    if top * top * len(y) < 2 ** 63:
        return (y.T @ y).astype(object)
    z = y.astype(object)
    return z.T @ z


def moments(vectors: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """(n, sums per dimension, covariance): covariance of exact integers, rounded once."""
    sized = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sized is None:
        return 0, [], np.zeros((0, 0))
    d, n = sized["d"], sized["n"]
    same = vectors.where(F.size("x") == d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, object)
        for b in batches:
            x = _matrix(b.column(0), d)
            low = x & (2 ** 32 - 1)                # two halves: neither sum can overflow
            total += (x >> 32).sum(axis=0).astype(object) * 2 ** 32 + low.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([int(t) >> LIMB for t in total], pa.int64()),
                                          pa.array([int(t) % 2 ** LIMB for t in total], pa.int64())], names=["i", "hi", "lo"])

    def limbs(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(F.sum("hi").cast("decimal(38,0)").alias("hi"),
                                        F.sum(F.col("lo").cast("decimal(20,0)")).cast("decimal(38,0)").alias("lo"))

    def whole(r) -> int:
        return int(r["hi"]) * 2 ** LIMB + int(r["lo"])

    sums = {r["i"]: whole(r) for r in limbs(map_arrow(same.select("x"), add, "i int, hi bigint, lo bigint"), "i").collect()}
    s = [sums[i] for i in range(d)]
    centre = np.array([(2 * v + n) // (2 * n) for v in s], np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for b in batches:
            total += _products(_matrix(b.column(0), d) - centre)
        at = [(i, j) for i in range(d) for j in range(i, d)]
        v = [int(total[i, j]) for i, j in at]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()),
             pa.array([Decimal(t >> LIMB) for t in v], pa.decimal128(38, 0)), pa.array([t % 2 ** LIMB for t in v], pa.int64())],
            names=["i", "j", "hi", "lo"])

    cov = np.zeros((d, d))
    rest = [v - n * int(c) for v, c in zip(s, centre)]      # sums of the centred integers
    for r in limbs(map_arrow(same.select("x"), multiply, "i int, j int, hi decimal(38,0), lo bigint"), "i", "j").collect():
        i, j = r["i"], r["j"]
        cov[i, j] = cov[j, i] = float(Fraction(n * whole(r) - rest[i] * rest[j], n * n))
    return n, s, cov


def whiten(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error,
    deviation_exact), a row per usable vector and component."""
    spark = rows.sparkSession
    schema = (f"`{id_col}` bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double, deviation_exact decimal(38,0)")
    vectors = integer_vectors(rows, id_col, vector)
    n, s, cov = moments(vectors)
    d = len(s)
    if not n or not np.trace(cov) > 0:
        return spark.createDataFrame([], schema)
    values, axes = eigenpairs(cov)
    k = int((values[:components] > d * EPS * values[0]).sum())
    share = values[:k] / np.trace(cov)
    weights = axes[:, :k] / np.sqrt(values[:k])
    whole = np.array([v // n for v in s], np.int64)         # mean = whole + part, so that x - mean keeps all digits
    part = np.array([float(Fraction(v % n, n)) for v in s])
    same = vectors.where(F.size("x") == d)
    sent = spark.sparkContext.broadcast((whole, part, weights))     # d (k + 2) numbers

    def project(x: np.ndarray) -> np.ndarray:
        whole, part, weights = sent.value
        return ((x - whole).astype(float) - part) @ weights

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = project(_matrix(b.column(0), d))
            total += w.sum(axis=0)
            square += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist() + square.ravel().tolist()], pa.list_(pa.float64()))], names=["v"])

    # the whitened vectors are centred: their mean is a rounding error, subtracted all the same
    sums = map_arrow(same.select("x"), measure, "v array<double>").select(F.posexplode("v").alias("i", "v")) \
        .groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(k + k * k)
    for r in sums:
        flat[r["i"]] = r["v"] / n
    error = float(np.abs(flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k]) - np.eye(k)).max())
    sums_array = np.array(s, object)

    def deviations(x: np.ndarray) -> list[int]:
        off = [max(abs(n * int(lo) - t), abs(n * int(hi) - t)) for lo, hi, t in zip(x.min(axis=0), x.max(axis=0), s)]
        if sum(v * v for v in off) < 2 ** 63:
            # n (x - whole) - S mod n: small factors, all within 64 bits
            y = n * (x - whole) - np.array([v % n for v in s], np.int64)
            return (y * y).sum(axis=1).tolist()
        y = n * x.astype(object) - sums_array
        return [int(v) for v in (y * y).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), d)
            m = len(x)
            dev = deviations(x)
            ids = b.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            each = [v for v in dev for _ in range(k)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n, np.int64)),
                 pa.array([v if v < 2 ** 63 else None for v in each], pa.int64()), pa.array(project(x).ravel()),
                 pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                 pa.array([Decimal(v) if v < 10 ** 38 else None for v in each], pa.decimal128(38, 0))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return map_arrow(same, run, schema)
