import hashlib
import math
import random

import numpy as np
import pytest

from martworks.llm import centroid_clusters, whitening
from martworks.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, row long, cells string, cluster string, x string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, 1, "c", "k", "x", "n") for i, v in rows], SCHEMA)


def blobs(n, dims=64, seed=1, spread=0.1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 0.3, (7, dims))
    return [(k, [float(np.float32(v)) for v in middle[k % 7] + rng.normal(0, spread, dims)]) for k in range(n)]


def odd(dims=64):
    nan, inf = float("nan"), float("inf")
    fine = [0.5] * dims
    return [(9001, None), (9002, []), (9003, fine[:-1]), (9004, [None, *fine[1:]]), (9005, [nan, *fine[1:]]),
            (9006, [-inf, *fine[1:]]), (9007, fine + [1.0]), (None, fine), (9008, fine), (9008, fine), (9009, [-0.0] * dims)]


def integer_rows(rows, shift=0):
    out = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [math.floor(64 * np.float64(np.float32(x))) + shift for x in v]))
    return out


def brute_clusters(rows, k=16, rounds=3, dims=64):
    kept = [(i, x) for i, x in integer_rows(rows) if len(x) == dims]
    digest = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "~"
    points = [x for _, x in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    away = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    nearest = lambda x: min((away(x, c), j) for j, c in enumerate(points))
    for _ in range(rounds):
        own = {}
        for _, x in kept:
            own.setdefault(nearest(x)[1], []).append(x)
        points = [[sum(c) // len(own[j]) for c in zip(*own[j], strict=True)] if j in own else p for j, p in enumerate(points)]
    found = [(i, *nearest(x)) for i, x in kept]
    inertia = {}
    for _, d, j in found:
        inertia[j] = inertia.get(j, 0) + d
    name = lambda j: hashlib.sha256(",".join(map(str, points[j])).encode()).hexdigest()
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), name(j)) for i, d, j in found), key=repr)


@pytest.mark.parametrize("broadcast", [250_000, 0])
def test_clusters_equal_brute_force(spark, rows, monkeypatch, broadcast):
    monkeypatch.setattr(centroid_clusters, "BROADCAST_ROWS", broadcast)
    data = blobs(300, spread=0.02) + odd()
    random.Random(5).shuffle(data)
    found, told = centroid_clusters.clusters(frame(spark, data).repartition(6))
    assert rows(found) == brute_clusters(data)
    assert len(told["fetched"]) == 2
    assert max(told["fetched"]) < 250  # separate groups: most vectors are assigned from their cells


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_any_number_of_bits_gives_the_same(spark, rows, bits):
    data = blobs(120, dims=5, seed=3, spread=0.3)
    assert rows(centroid_clusters.clusters(frame(spark, data), dims=5, bits=bits, k=4)[0]) == brute_clusters(data, 4, dims=5)


def test_intervals_hold_every_distance():
    rng = np.random.default_rng(2)
    x = rng.integers(-40, 40, (500, 12))
    grid = centroid_clusters.Grid(x.min(axis=0), x.max(axis=0), 3)
    assert (grid.unpacked(grid_column := centroid_clusters.pa.array(grid.packed(grid.cells(x)))) == grid.cells(x)).all()
    assert len(grid_column[0].as_py()) == 5  # 12 * 3 bits
    for scale in (1, 20):
        centroids = centroid_clusters.Centroids(rng.integers(-40, 40, (9, 12)) * scale, grid)
        possible = centroids.possible(grid.cells(x))
        distance = ((x[:, None, :] - centroids.points[None]) ** 2).sum(axis=2)
        assert possible[np.arange(500), distance.argmin(axis=1)].all()
        assert (possible | (distance > distance.min(axis=1, keepdims=True))).all()  # ties too


def test_few_equal_or_no_vectors(spark, rows):
    same = [(k, [0.25] * 64) for k in range(30)]
    assert rows(centroid_clusters.clusters(frame(spark, same))[0]) == brute_clusters(same)
    three = blobs(3)
    assert rows(centroid_clusters.clusters(frame(spark, three))[0]) == brute_clusters(three)
    for none in ([], odd()[:7]):
        assert centroid_clusters.clusters(frame(spark, none))[0].collect() == []


def test_too_large_components_are_told():
    with pytest.raises(ArithmeticError):
        centroid_clusters.integers(np.array([[3e6]]), 64)


def test_cluster_query_over_the_whole_table(spark, rows):
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    found = QUERIES["op12_centroid_clustering"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows(found) == brute_clusters(data)


def whitened(found, components):
    out = {}
    for r in found.collect():
        out.setdefault(r.vec_id, []).append(r)
    return out


def check_whitening(found, data, components=32, dims=64):
    kept = [(i, x) for i, x in integer_rows(data, 1_000_000) if len(x) == dims]
    n, sums = len(kept), [sum(c) for c in zip(*(x for _, x in kept), strict=True)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in kept}
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in kept])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = min(components, int((values > 1e-9 * values[0]).sum()))
    by_id = whitened(found, components)
    assert set(by_id) == set(deviation)
    assert sum(map(len, by_id.values())) == n * real
    for i, own in by_id.items():
        assert {r.component for r in own} == set(range(1, real + 1))
        assert {(r.n, r.deviation) for r in own} == {(n, deviation[i])}
        assert all(abs(r.explained / (values[r.component - 1] / np.trace(covariance)) - 1) < 1e-9 for r in own)
        assert all(r.identity_error < 1e-6 for r in own)
    once = [k for k, (i, _) in enumerate(kept) if sum(j == i for j, _ in kept) == 1]
    w = np.array([[r.whitened for r in sorted(by_id[kept[k][0]], key=lambda r: r.component)] for k in once])
    gaps = np.min(np.abs(values[:real, None] - values[None, :]) + np.eye(real, len(values)) * values[0], axis=1)
    for c in np.flatnonzero(gaps > 1e-6 * values[0]):  # where the component is one direction
        expected = centred[once] @ vectors[:, c] / np.sqrt(values[c])
        assert min(np.abs(w[:, c] - expected).max(), np.abs(w[:, c] + expected).max()) < 1e-6 * max(1, np.abs(expected).max())


def test_whitening_equals_an_eigensolver(spark):
    data = blobs(400, spread=0.15) + odd()
    random.Random(6).shuffle(data)
    check_whitening(whitening.whiten(frame(spark, data).repartition(5)), data)


def test_equal_variances_few_dimensions_and_few_rows(spark):
    # The corners of a cube: all variances are equal, so a single start direction spans one of three components.
    cube = [(k, [float(k >> d & 1) for d in range(3)]) for k in range(8)]
    found = whitening.whiten(frame(spark, cube)).collect()
    assert len(found) == 24
    assert all(abs(r.explained - 1 / 3) < 1e-12 and r.identity_error < 1e-9 for r in found)
    check_whitening(whitening.whiten(frame(spark, blobs(10)), components=32), blobs(10))  # rank 9


def test_whitening_of_nothing(spark):
    for none in ([], [(1, None), (2, [])], [(1, [0.5] * 64)], [(k, [0.25] * 8) for k in range(9)]):
        assert whitening.whiten(frame(spark, none)).collect() == []


def test_whitening_query_over_the_whole_table(spark):
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check_whitening(QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001"), data)
