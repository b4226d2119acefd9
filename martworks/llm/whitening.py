"""Principal components and whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With X the centred rows, each step multiplies once by X and once by its transpose, in one pass over the rows: every task
forms its part of ``t = X v - b u`` and sums ``X' t``, ``U' t`` and ``t't``. From these the driver, which holds vectors as
long as a row only, orthogonalises t against all left vectors before it and the next right vector against all right vectors
(full reorthogonalisation). Left vectors are as long as the table; they are not stored, since a task rebuilds its part of
them from its rows and the few numbers of each earlier step. The small bidiagonal matrix B with X V = U B gives the
singular values of X, and so the deviations, and by its right singular vectors the components.

A step that ends in an invariant subspace (equal eigenvalues, few distinct rows) goes on from a new direction, so
that components of equal variance are all found. Steps end at the dimension, or, with more than ``FULL`` dimensions, when
the asked components have settled; of components of exactly equal variance one may be missed then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.scratch import Scratch, only
from martworks.llm.vectors import matrix, rows_of, summed, task_sum, usable

# A singular value below this share of the largest is no direction of the data.
NOTHING = 1e-12
# Up to so many dimensions all steps are taken.
FULL = 256
# Residual of the asked singular values, as a share of the largest, at which the steps end.
SETTLED = 1e-15


def _integers(scale: int, shift: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = np.floor(matrix(batch.column("vector"), dims).astype(np.float64) * scale) + shift
            if scaled.size and np.abs(scaled).max() >= 2.0**53:
                raise ArithmeticError("a component is too large for exact integers")
            yield pa.record_batch([batch.column("vec_id"), rows_of(scaled.astype(np.int64))], ["vec_id", "x"])

    return run


class Centred:
    """What every task needs to centre rows: their number and the sums of each dimension, both exact."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.dims = len(sums)

    def exact(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, as integers of 64 bits where they fit."""
        if self.n * max(1, int(np.abs(x).max(initial=0))) + max(map(abs, self.sums), default=0) < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, column: pa.Array) -> np.ndarray:
        return self.exact(matrix(column, self.dims)).astype(np.float64) / self.n


class Steps:
    """The bidiagonalisation so far; ``left`` rebuilds a task's part of the left vectors."""

    def __init__(self, dims: int):
        self.right = np.zeros((dims, 0))
        self.alpha, self.beta, self.fix, self.images = [], [], [], []

    def raw(self, x: np.ndarray, left: np.ndarray) -> np.ndarray:
        t = x @ self.right[:, -1]
        return t - self.beta[-1] * left[:, -1] if left.shape[1] and self.beta[-1] else t

    def left(self, x: np.ndarray) -> np.ndarray:
        done = len(self.alpha)
        out = np.zeros((len(x), done))
        products = x @ self.right[:, :done]
        for j in range(done):
            if self.alpha[j]:
                t = products[:, j]
                if j:
                    t = t - self.beta[j - 1] * out[:, j - 1]
                out[:, j] = (t - out[:, :j] @ self.fix[j]) / self.alpha[j]
        return out


def _step(centred: Centred, steps: Steps):
    def add(batch: pa.RecordBatch) -> np.ndarray:
        x = centred.rows(batch.column("x"))
        left = steps.left(x)
        t = steps.raw(x, left)
        return np.concatenate([[t @ t], left.T @ t, x.T @ t])

    return task_sum(add)


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def _new_direction(rng: np.random.Generator, basis: np.ndarray) -> np.ndarray:
    v = _orthogonal(rng.standard_normal(len(basis)), basis)
    return v / np.linalg.norm(v)


def _decomposed(steps: Steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = len(steps.alpha)
    b = np.diag(steps.alpha) + np.diag(steps.beta[: k - 1], 1)
    p, s, q = np.linalg.svd(b)
    return p, s, q


def bidiagonalise(rows: DataFrame, centred: Centred, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """Singular values of the centred rows in falling order, their right vectors as columns, and the number of steps."""
    rng, steps, dims = np.random.default_rng(seed), Steps(centred.dims), centred.dims
    v = _new_direction(rng, steps.right)
    scale = 0.0
    while True:
        steps.right = np.column_stack([steps.right, v])
        total = np.array(summed(rows.mapInArrow(_step(centred, steps), "total array<double>"), "total", "double"))
        j = len(steps.alpha)
        squared, fix, image = total[0], total[1: 1 + j], total[1 + j:]
        # t loses what it has in common with earlier left vectors; so do its length and its image.
        length = np.sqrt(max(squared - fix @ fix, 0.0))
        scale = max(scale, length, np.linalg.norm(image) / max(length, 1e-300) if length else 0.0)
        if length <= NOTHING * scale:
            length = 0.0
        steps.fix.append(fix)
        steps.alpha.append(float(length))
        if length:
            image = (image - (np.column_stack(steps.images) @ fix if j else 0.0)) / length
            w = _orthogonal(image - length * v, steps.right)
        else:
            image, w = np.zeros(dims), np.zeros(dims)
        steps.images.append(image)
        if j + 1 == dims:
            break
        beta = float(np.linalg.norm(w))
        if beta <= NOTHING * scale:
            steps.beta.append(0.0)
            v = _new_direction(rng, steps.right)
            continue
        steps.beta.append(beta)
        v = w / beta
        if j + 1 >= max(wanted, FULL):
            p, s, _ = _decomposed(steps)
            if np.abs(beta * p[-1, :wanted]).max() <= SETTLED * s[0] and len(s) > wanted:
                break
    _, s, q = _decomposed(steps)
    return s, steps.right @ q.T, len(steps.alpha)


def whiten(embeddings: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Whitened coordinates of all usable vectors, as a row for each vector and component.

    An entry c is taken as the integer ``floor(scale * c) + shift``. Columns: ``vec_id, component`` (from 1, by falling
    variance), ``n`` (vectors), ``deviation`` (exact squared distance of ``n * x`` from the sums; null if it does not fit a
    long), ``whitened, explained`` (share of the total variance) and ``identity_error`` (largest entry by which the covariance of
    the whitened coordinates differs from the identity).

    Null vectors and vectors with null or non-finite entries are left out, and vectors of another length than the most
    frequent one (the longer of equally frequent ones); repeated rows count each time; rows without an id are returned.
    Components without variance are left out, so equal vectors, a single vector and an empty table give no rows.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "whitening")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    own = only(embeddings, vec_id=id_col, vector=vector_col).where(usable(F.col("vector")))
    sizes = own.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not sizes or not sizes[0].dims:
        return spark.createDataFrame([], schema)
    dims, n = sizes[0].dims, sizes[0]["count"]
    rows = scratch.keep("integers", own.where(F.size("vector") == dims).select(
        F.col("vec_id").cast("long").alias("vec_id"), "vector").mapInArrow(
        _integers(scale, shift, dims), "vec_id long, x array<long>"))
    centred = Centred(n, [int(v) for v in summed(rows, "x", "decimal(38,0)")])
    wanted = min(components, dims)
    values, vectors, _ = bidiagonalise(rows.select("x"), centred, wanted)
    real = values[:wanted] > 1e-10 * values[0] if len(values) and values[0] > 0 else np.zeros(0, bool)
    if not real.any():
        return spark.createDataFrame([], schema)
    wanted = int(real.sum())
    variance, axes = values[:wanted] ** 2 / n, vectors[:, :wanted] / (values[:wanted] / np.sqrt(n))

    def coordinates(batch: pa.RecordBatch) -> np.ndarray:
        return centred.rows(batch.column("x")) @ axes

    def spread(batch: pa.RecordBatch) -> np.ndarray:
        x = centred.rows(batch.column("x"))
        return np.concatenate([coordinates(batch).sum(axis=0), [(x * x).sum()]])

    first = np.array(summed(rows.mapInArrow(task_sum(spread), "total array<double>"), "total", "double"))
    mean, trace = first[:wanted] / n, first[wanted] / n

    def products(batch: pa.RecordBatch) -> np.ndarray:
        w = coordinates(batch) - mean
        return (w.T @ w).ravel()

    covariance = np.array(summed(rows.mapInArrow(task_sum(products), "total array<double>"), "total", "double")) / n
    error = float(np.abs(covariance.reshape(wanted, wanted) - np.eye(wanted)).max())
    explained = variance / trace

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                m = part.num_rows
                exact = centred.exact(matrix(part.column("x"), dims))
                if exact.dtype == object or dims * int(np.abs(exact).max()) ** 2 >= 1 << 63:
                    exact = exact.astype(object)
                deviation = [v if v < 1 << 63 else None for v in (exact * exact).sum(axis=1).tolist()]
                yield pa.record_batch([
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), wanted))),
                    pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), m)), pa.array(np.full(m * wanted, n)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), wanted))),
                    pa.array(coordinates(part).ravel()), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * wanted, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(out, schema)
