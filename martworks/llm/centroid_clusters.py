"""Clusters around centroids by rounds of exact assignment, read from a file of vector approximations.

Every vector is approximated by a cell of ``BITS`` bits for each dimension. For a centroid c and the mean m of all centroids,
``|x - c|**2 - |x - m|**2 = |c - m|**2 - 2 (x - m)(c - m)``; the subtrahend is the same for all centroids, so the right side
orders them as the distances do. A lookup table by dimension and cell gives its least and greatest share, and the sums are an
interval for each centroid. Only centroids whose interval overlaps the one that ends first can be nearest. Where that is
one, the vector is assigned without being read; otherwise the full vector is fetched and compared with those few.

A round reads the approximations and the last assignment, and fetches the vectors whose intervals overlap or whose cluster
changed: sums of clusters are kept exactly and moved by the changed vectors only. The first round reads all vectors, because
their sums are needed, and so does the last assignment, because it returns distances. Arithmetic is in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.scratch import Scratch, only
from martworks.llm.vectors import matrix, rows_of, summed, usable

BITS = 5
# Approximations to fetch for, of some 100 bytes each, that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 250_000
# Integer components of this size and more are refused: squared distances would not fit a long.
LARGEST = 1 << 27


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * scale)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ArithmeticError(f"a component of {LARGEST // scale} or more: squared distances would not fit a long")
    return scaled.astype(np.int64)


class Grid:
    """Equal cells between the least and the greatest integer of each dimension; cell j holds ``low[j]`` to ``high[j]``."""

    def __init__(self, least: np.ndarray, most: np.ndarray, bits: int):
        self.bits = bits
        cells = 1 << bits
        steps = np.arange(1, cells)
        span = (most - least + 1)[:, None]
        self.border = least[:, None] + (span * steps + cells - 1) // cells  # first integer of each cell but the first
        self.low = np.concatenate([least[:, None], self.border], axis=1)
        self.high = np.concatenate([self.border - 1, most[:, None]], axis=1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, x[:, d], side="right") for d, b in enumerate(self.border)], axis=1).astype(np.uint8)

    def packed(self, cells: np.ndarray) -> list[bytes]:
        bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits:]
        return [row.tobytes() for row in np.packbits(bits.reshape(len(cells), -1), axis=1)]

    def unpacked(self, column: pa.Array) -> np.ndarray:
        dims = len(self.low)
        raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
        bits = np.unpackbits(raw, axis=1)[:, : dims * self.bits].reshape(len(column), dims, self.bits)
        return bits @ (1 << np.arange(self.bits - 1, -1, -1)).astype(np.uint8)


class Centroids:
    """Integer centroids with the lookup tables of their intervals."""

    def __init__(self, points: np.ndarray, grid: Grid):
        self.points, self.grid = points, grid
        middle = points.mean(axis=0)
        off = points - middle
        near = -2.0 * off[:, :, None] * (grid.low - middle[:, None])[None]
        far = -2.0 * off[:, :, None] * (grid.high - middle[:, None])[None]
        self.least = np.ascontiguousarray(np.minimum(near, far).transpose(1, 2, 0))  # dimension, cell, centroid
        self.most = np.ascontiguousarray(np.maximum(near, far).transpose(1, 2, 0))
        self.apart = (off * off).sum(axis=1)
        # What rounding can add up to; intervals are widened by it, so that no nearest centroid falls out.
        size = np.maximum(np.abs(self.least), np.abs(self.most)).max(axis=(1, 2), initial=0).sum() + self.apart.max(initial=0)
        self.slack = 1e-12 * size + 1e-9

    def possible(self, cells: np.ndarray) -> np.ndarray:
        """Which centroids may be nearest to the vectors of these cells."""
        least = np.tile(self.apart, (len(cells), 1))
        most = least.copy()
        for d in range(cells.shape[1]):
            least += self.least[d][cells[:, d]]
            most += self.most[d][cells[:, d]]
        return least <= most.min(axis=1, keepdims=True) + self.slack

    def nearest(self, x: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest possible centroid (the smaller number of equal ones) and its squared distance."""
        best, distance = np.full(len(x), -1), np.full(len(x), np.iinfo(np.int64).max)
        for c, point in enumerate(self.points):
            rows = np.flatnonzero(possible[:, c])
            off = x[rows] - point
            own = (off * off).sum(axis=1)
            closer = rows[own < distance[rows]]
            distance[closer] = own[own < distance[rows]]
            best[closer] = c
        return best, distance

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in self.points.tolist()]


def _cluster_sums(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Count and component sums of each cluster, one after the other."""
    out = np.zeros((k, 1 + x.shape[1]), np.int64)
    np.add.at(out[:, 0], cluster, 1)
    np.add.at(out[:, 1:], cluster, x)
    return out.ravel()


_PLACED = "row long, cells binary, cluster int, sums array<long>"


def _placed(row, cells, cluster, sums=None) -> pa.RecordBatch:
    n = len(row)
    return pa.record_batch([pa.array(row, pa.int64()), pa.array(cells, pa.binary()), pa.array(cluster, pa.int32()),
                            pa.array([None] * n if sums is None else [sums], pa.list_(pa.int64()))],
                           ["row", "cells", "cluster", "sums"])


def _to_integers(scale: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(matrix(batch.column("vector"), dims), scale)
            yield pa.record_batch([batch.column("row"), batch.column("vec_id"), rows_of(x)], ["row", "vec_id", "x"])

    return run


def _approximated(grid: Grid, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = grid.packed(grid.cells(matrix(batch.column("x"), dims)))
            yield pa.record_batch([batch.column("row"), batch.column("vec_id"), batch.column("x"), pa.array(cells, pa.binary())],
                                  ["row", "vec_id", "x", "cells"])

    return run


def _first(centroids: Centroids, dims: int):
    """Assign every vector; at the end of a task the sums of its clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            cluster, _ = centroids.nearest(x, centroids.possible(centroids.grid.unpacked(batch.column("cells"))))
            total = total + _cluster_sums(x, cluster, len(centroids.points))
            yield _placed(batch.column("row"), batch.column("cells"), cluster)
        if not np.isscalar(total):
            yield _placed([None], [None], [None], total.tolist())

    return run


def _looked_up(centroids: Centroids):
    """From approximations alone: ``sure`` is the cluster where only one is possible, else -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            possible = centroids.possible(centroids.grid.unpacked(batch.column("cells")))
            sure = np.where(possible.sum(axis=1) == 1, possible.argmax(axis=1), -1)
            yield pa.record_batch([batch.column("row"), batch.column("cells"), batch.column("cluster"),
                                   pa.array(sure.astype(np.int32))], ["row", "cells", "cluster", "sure"])

    return run


def _fetched(centroids: Centroids, dims: int):
    """Assign fetched vectors; at the end of a task what moved between the sums of clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved = 0
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            old = batch.column("cluster").to_numpy()
            cluster, _ = centroids.nearest(x, centroids.possible(centroids.grid.unpacked(batch.column("cells"))))
            away = np.flatnonzero(cluster != old)
            k = len(centroids.points)
            moved = moved + _cluster_sums(x[away], cluster[away], k) - _cluster_sums(x[away], old[away], k)
            yield _placed(batch.column("row"), batch.column("cells"), cluster)
        if not np.isscalar(moved):
            yield _placed([None], [None], [None], moved.tolist())

    return run


def _final(centroids: Centroids, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            cluster, distance = centroids.nearest(x, centroids.possible(centroids.grid.unpacked(batch.column("cells"))))
            yield pa.record_batch([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                                  ["vec_id", "cluster", "distance"])

    return run


def _start(vectors: DataFrame, k: int, prefix: str) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(digest.alias("digest"), "x").orderBy(F.asc_nulls_last("digest"), "x").limit(k).collect()
    return np.array([r.x for r in rows], np.int64)


def clusters(embeddings: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, prefix: str = "1:",
             bits: int = BITS, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, dict]:
    """Clusters of all vectors with ``dims`` finite components, each taken as the integer ``floor(scale * x)``.

    Columns: ``vec_id, cluster, distance`` (squared), ``cluster_inertia, inertia`` (sums of distances) and
    ``centroid_sha256``. Centroids start as the ``k`` vectors of the smallest SHA-256 of ``prefix`` and id (of equal ids the
    smaller vector first, rows without an id last); with fewer vectors there are fewer centroids. In each round every vector
    goes to the nearest centroid (the smaller number of equal ones) and a centroid with vectors becomes the floor of their
    mean. The second result holds the final ``centroids`` and for each later round how many vectors were ``fetched``.

    Null vectors, other lengths, null and non-finite entries are left out; repeated rows count each time; rows without an id
    are assigned and returned. An empty table gives no rows. A component of 2**27 / scale or more raises ArithmeticError.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "clusters")
    own = only(embeddings, vec_id=id_col, vector=vector_col).where(usable(F.col("vector")) & (F.size("vector") == dims))
    numbered = own.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "vector")
    plain = scratch.keep("integers", numbered.mapInArrow(_to_integers(scale, dims), "row long, vec_id long, x array<long>"))
    ranges = plain.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(
        F.min("v").alias("least"), F.max("v").alias("most")).orderBy("k").collect()
    if not ranges:
        empty = spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                          "centroid_sha256 string")
        return empty, {"centroids": [], "fetched": []}
    grid = Grid(np.array([r.least for r in ranges]), np.array([r.most for r in ranges]), bits)
    vectors = scratch.keep("vectors", plain.mapInArrow(
        _approximated(grid, dims), "row long, vec_id long, x array<long>, cells binary"))
    scratch.drop(plain)
    centroids = Centroids(_start(vectors, k, prefix), grid)

    sums, placed, fetched = None, None, []
    for turn in range(rounds):
        if turn == 0:
            step = scratch.keep("round-0", vectors.mapInArrow(_first(centroids, dims), _PLACED))
            sums = np.array([int(v) for v in summed(step, "sums", "decimal(38,0)")], object)
            placed = step.where("row is not null").select("row", "cells", "cluster")
        else:
            looked = scratch.keep(f"looked-{turn}", placed.mapInArrow(
                _looked_up(centroids), "row long, cells binary, cluster int, sure int"))
            need = looked.where("sure <> cluster").drop("sure")
            fetched.append(need.count())
            wanted = F.broadcast(need) if fetched[-1] <= BROADCAST_ROWS else need
            step = scratch.keep(f"round-{turn}", vectors.select("row", "x").join(wanted, "row").mapInArrow(
                _fetched(centroids, dims), _PLACED))
            moved = summed(step, "sums", "decimal(38,0)")
            if moved:
                sums = sums + np.array([int(v) for v in moved], object)
            placed = looked.where("sure = cluster").select("row", "cells", "cluster").unionByName(
                step.where("row is not null").select("row", "cells", "cluster"))
        totals = sums.reshape(len(centroids.points), 1 + dims)
        centroids = Centroids(np.array([[s // t[0] for s in t[1:]] if t[0] else p.tolist()
                                        for t, p in zip(totals, centroids.points, strict=True)], np.int64), grid)

    final = scratch.keep("assigned", vectors.mapInArrow(_final(centroids, dims), "vec_id long, cluster int, distance long"))
    inertia = {r.cluster: int(r.d) for r in final.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    fits = lambda v: v if v < 1 << 63 else None
    known = spark.createDataFrame([(c, fits(inertia.get(c, 0)), fits(sum(inertia.values())), digest)
                                   for c, digest in enumerate(centroids.digests())],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = final.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return out, {"centroids": centroids.points.tolist(), "fetched": fetched}
