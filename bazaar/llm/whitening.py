"""Embedding whitening by Chebyshev-filtered subspace iteration.

1. Entries become integers x = floor(64 c) + 1,000,000. The distinct x vectors (the fit
   list) are found by a map-side combined group and written once; their number n, the
   sums S by dimension and the trace of the covariance V are sums over that list.
2. A pass computes V Q = Xc'(Xc Q) / n for a block Q of vectors: every task centres its
   rows before it multiplies and gives one partial sum by entry, the sums are added by
   entry, and what reaches the driver is one small matrix, whatever the number of rows.
3. A few Lanczos passes bound the spectrum from below. A Chebyshev polynomial of V,
   applied to the block by its three-term recurrence (one pass a degree), damps all
   eigenvalues between that bound and the least one of the block. QR makes the block
   orthonormal again, and Rayleigh-Ritz gives eigenvalue estimates and residuals.
   This is repeated until the residuals of the wanted components certify them.
4. Every row is projected on the components; the covariance of the whitened fit list is
   measured in one more pass.

Defined cases: vectors that are null or hold null or non-finite entries are dropped; so
are vectors of another length than the most frequent one (of equally frequent lengths the
greatest). Entries beyond 2^40 in size are taken as 2^40. Components whose eigenvalue is
zero to rounding (constant dimensions, few rows) cannot be whitened and are left out, so a
table of one distinct vector gives no rows, and an empty table gives none. Repeated rows
count once in the fit and are repeated in the result. A deviation beyond 64 bits is an
error. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.staging import Scratch

COMPONENTS = 16
#: Vectors in the iterated block: the wanted components and those that shield them.
BLOCK = 40
DEGREE = 12
LANCZOS_STEPS = 10
#: Residual norm, as a share of the largest eigenvalue, that certifies a component.
CERTIFIED = 1e-14
#: Beyond this many rounds the best block so far must pass a looser bound, or it is an error.
ROUNDS = 30
LOOSE = 1e-12
#: Eigenvalues below this share of the trace are rounding errors.
ZERO = 1e-13
LARGEST = float(1 << 40)
ROWS = 8_192

Multiply = Callable[[np.ndarray], np.ndarray]


def quantised(vectors: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(vec_id, x) of the vectors that take part, and their length (0 if there is none)."""
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c")).where(
        F.col("c").isNotNull() & F.forall("c", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))  # NaN exceeds infinity
    )
    lengths = fine.groupBy(F.size("c").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    d = top.d if top else 0
    bounded = lambda c: F.greatest(F.least(F.lit(64.0) * c, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform("c", lambda c: F.floor(bounded(c)) + F.lit(1_000_000).cast("long"))
    return scratch.table(fine.where(F.size("c") == d).select("vec_id", x.alias("x")), "rows"), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def _blocks(batches: Iterator[pa.RecordBatch], name: str, d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield _matrix(batch.column(name).slice(at, ROWS), d)


@dataclass
class FitList:
    """The distinct vectors, their number, sums by dimension, and passes over them."""

    rows: DataFrame
    d: int
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        # S / n correctly rounded, whatever the size of S
        return np.array([s / self.n for s in self.sums])

    def summed(self, of_block: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """Sum over the list of ``of_block`` of its centred rows."""
        d, mean, size = self.d, self.mean, int(np.prod(shape))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for block in _blocks(batches, "x", d):
                total += of_block(block - mean)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total.ravel())], names=["i", "v"])

        out = np.zeros(size)
        for i, v in self.rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v")).collect():
            out[i] = v
        return out.reshape(shape)

    def times_covariance(self, q: np.ndarray) -> np.ndarray:
        """V q, in one pass."""
        return self.summed(lambda c: c.T @ (c @ q), q.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda c: (c * c).sum(0), (self.d,)).sum()) / self.n


def fit_list(rows: DataFrame, d: int, scratch: Scratch) -> FitList:
    distinct = scratch.table(rows.groupBy("x").agg(F.lit(1).alias("_")).select("x"), "fit-list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)  # Python integers do not overflow
        for block in _blocks(batches, "x", d):
            n += len(block)
            total += block.sum(0).astype(object)  # 8,192 numbers of at most 41 bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d + 1), pa.int64()), pa.array([str(v) for v in [*total, n]])], names=["i", "v"]
        )

    if not d:
        return FitList(distinct, 0, 0, [])
    sums = [0] * (d + 1)
    added = distinct.mapInArrow(run, "i long, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    for i, v in added.collect():
        sums[i] = int(v)
    return FitList(distinct, d, sums[d], sums[:d])


# -- Chebyshev-filtered subspace iteration ------------------------------------


def spectrum_floor(multiply: Multiply, d: int, steps: int, rng: np.random.Generator) -> float:
    """A bound near the least eigenvalue: the least Ritz value of some Lanczos steps, less its residual."""
    basis = [(v := rng.standard_normal(d)) / np.linalg.norm(v)]
    alpha, beta = [], []
    for _ in range(min(steps, d)):
        w = multiply(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        for _ in range(2):  # full orthogonalisation, twice is enough
            w -= np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(abs(alpha[0]), 1e-300):
            break
        basis.append(w / beta[-1])
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1))
    return max(0.0, float(values[0] - abs(beta[-1] * vectors[-1, 0])))


def chebyshev_filter(multiply: Multiply, q: np.ndarray, degree: int, low: float, cut: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of V on q that is small on [low, cut], scaled to one at ``top``."""
    half, centre = (cut - low) / 2, (cut + low) / 2
    sigma = first = half / (top - centre)
    y = (multiply(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        q, y = y, (multiply(y) - centre * y) * (2 * after / half) - (sigma * after) * q
        sigma = after
    return y


def leading_components(
    multiply: Multiply, d: int, want: int, block: int = BLOCK, degree: int = DEGREE, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` greatest eigenvalues, falling, and their unit vectors as columns.

    A block of all dimensions leaves nothing to damp: its Rayleigh-Ritz step is final.
    """
    rng = np.random.default_rng(seed)
    block = min(max(block, want), d)
    q = np.linalg.qr(rng.standard_normal((d, block)))[0]
    low = spectrum_floor(multiply, d, LANCZOS_STEPS, rng) if block < d else 0.0
    best = (np.inf, np.zeros(0), np.zeros((d, 0)))
    for k in range(ROUNDS):
        vq = multiply(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q = q @ turn
        residual = np.linalg.norm(vq @ turn - q * values, axis=0)[:want].max() / max(values[0], 1e-300)
        if residual < best[0]:
            best = (residual, values[:want].copy(), q[:, :want].copy())
        elif k > 2 and best[0] <= LOOSE:
            break  # rounding is all that is left
        if best[0] <= CERTIFIED or block == d:
            break
        cut = float(values[-1])
        if not low < cut < values[0]:
            low = min(low, 0.5 * cut)
        if not cut < values[0]:
            break  # the whole block has one eigenvalue: any basis of it is one of eigenvectors
        q = np.linalg.qr(chebyshev_filter(multiply, q, degree, low, cut, float(values[0])))[0]
    if best[0] > LOOSE and block < d and best[1][0] > 0:
        raise RuntimeError(f"components are not certified: residual {best[0]:.1e} of the largest eigenvalue")
    return best[1], best[2]


# -- whitening ------------------------------------------------------------------

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n x - S)^2, exact."""
    most = max([0, int(np.abs(x).max())]) * n + max([0, *map(abs, sums)]) if x.size else 0
    if most * most * len(sums) < 1 << 62:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(1).tolist()
    # the mean is near: offsets may fit where products do not
    found = []
    for row in x.tolist():
        total = sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True))
        if total >= 1 << 63:
            raise OverflowError("a deviation exceeds 64 bits")
        found.append(total)
    return found


def whiten(vectors: DataFrame, components: int = COMPONENTS, block: int = BLOCK, degree: int = DEGREE) -> DataFrame:
    """One row per remaining vector and component: see the module's text for what it holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    rows, d = quantised(vectors, scratch)
    fit = fit_list(rows, d, scratch)
    empty = spark.createDataFrame([], SCHEMA)
    total = fit.trace() if fit.n else 0.0
    if total <= 0:
        scratch.keep()
        return empty
    values, vectors_ = leading_components(fit.times_covariance, d, min(components, d), block, degree)
    real = values > ZERO * total
    values, vectors_ = values[real], vectors_[:, real]
    k = len(values)
    project = vectors_ / np.sqrt(values)
    gram = fit.summed(lambda c: (c @ project).T @ (c @ project), (k, k)) / fit.n
    error = float(np.abs(gram - np.eye(k)).max())
    scratch.keep("rows")
    n, sums, mean, explained = fit.n, fit.sums, fit.mean, values / total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x = _matrix(batch.column("x"), d)
                white = (x - mean) @ project
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n)),
                        pa.array(np.repeat(np.array(deviations(x, n, sums), np.int64), k)),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=[field.split()[0] for field in SCHEMA.split(", ")],
                )

    return rows.mapInArrow(run, SCHEMA)
