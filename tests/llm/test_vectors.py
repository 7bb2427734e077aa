"""Whitening and clustering of embeddings against plain numpy and plain integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from weirflow.llm import whitening
from weirflow.llm.laesa import chosen_pivots, cluster_vectors, distances, nearest
from weirflow.llm.whitening import whiten, whitened_components

INF, NAN = math.inf, math.nan
SCHEMA = "vec_id long, vector array<float>, x string, id string, index int, part int, cluster int, pivots int"


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "x", "i", 1, 2, 3, 4) for i, v in vectors], schema)


def drawn(n, width, seed=1):
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(width, width)) / 8
    return [np.float32(row).tolist() for row in rng.normal(size=(n, width)) @ mixing + rng.normal(size=width)]


def by_numpy(vectors, components=32):
    """Whole numbers, exact deviations, and covariance of the centred rows."""
    whole = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(whole), [sum(column) for column in zip(*whole, strict=True)]
    deviations = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in whole]
    centred = np.array([[(n * x - s) / n for x, s in zip(row, sums, strict=True)] for row in whole])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    return n, deviations, values / np.trace(centred.T @ centred / n), centred @ directions / np.sqrt(values)


@pytest.mark.parametrize(("rows", "blocks", "n"), [(1024, 16, 300), (16, 2, 300), (7, 1, 100)])
def test_whitening_matches_numpy(spark, monkeypatch, rows, blocks, n):
    monkeypatch.setattr(whitening, "ROWS", rows)
    monkeypatch.setattr(whitening, "BLOCKS", blocks)
    vectors = drawn(n, 40)
    dropped = [None, [], [1.0] * 39 + [NAN], [1.0] * 39 + [INF], [1.0] * 39 + [-INF], [1.0] * 39 + [None], [1.0] * 39, [1e30] * 40]
    given = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, v) for i, v in enumerate(dropped)]
    got = whitened_components(frame(spark, given).repartition(5), "vec_id", "vector").collect()
    n, deviations, explained, white = by_numpy(vectors)
    assert len(got) == n * 32
    assert {r.n for r in got} == {n}
    assert all(r.deviation == deviations[r.vec_id] for r in got)
    assert all(abs(r.explained - explained[r.component - 1]) <= 1e-9 * explained[r.component - 1] for r in got)
    ours = np.zeros((n, 32))
    for r in got:
        ours[r.vec_id, r.component - 1] = r.whitened
    signs = np.sign((ours * white).sum(axis=0))
    assert np.abs(ours - white * signs).max() < 1e-6
    (error,) = {r.identity_error for r in got}
    assert error < 1e-9
    assert np.abs(ours.T @ ours / n - np.eye(32)).max() < 1e-9


def test_directions_without_variance_are_no_components(spark):
    vectors = [(i, [float(i % 7), 2.0 * (i % 7), 5.0, float(i % 3)]) for i in range(60)]
    found = whiten(frame(spark, vectors), "vec_id", "vector")
    assert len(found.variances) == 2
    assert abs(sum(found.explained) - 1) < 1e-12


def test_repeated_rows_and_null_ids_are_rows(spark):
    vectors = drawn(30, 3)
    given = [(7, v) for v in vectors] * 2 + [(None, vectors[0])] * 3
    got = whitened_components(frame(spark, given), "vec_id", "vector").collect()
    assert len(got) == 63 * 3
    assert len({(r.component, r.whitened) for r in got if r.vec_id is None}) == 3
    assert {r.n for r in got} == {63}


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(4)], [(1, None), (2, [])]])
def test_tables_without_variance_give_no_rows(spark, vectors):
    got = whitened_components(frame(spark, vectors), "vec_id", "vector")
    assert got.count() == 0
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_that_fits_no_long_is_null(spark):
    got = whitened_components(frame(spark, [(i, [4e6 * i, 0.5 * (i % 2)]) for i in range(9)]), "vec_id", "vector").collect()
    assert {r.vec_id: r.deviation is None for r in got} == {i: i not in (3, 4, 5) for i in range(9)}


def clusters_by_hand(vectors, clusters=40, rounds=5):
    """(id, cluster, distance, inertia of the cluster, inertia, sha256), in whole Python numbers."""
    whole = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors]
    order = sorted(whole, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:clusters]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids)) for _, v in whole]

    for _ in range(rounds):
        found = assigned()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, j) in zip(whole, found, strict=True) if j == k]
            if own:
                centroids[k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = assigned()
    inertia = {}
    for d, k in found:
        inertia[k] = inertia.get(k, 0) + d
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, k, d, inertia[k], sum(inertia.values()), named[k]) for (i, _), (d, k) in zip(whole, found, strict=True)), key=repr
    )


def clustered(spark, rows, vectors, **settings):
    return rows(cluster_vectors(frame(spark, vectors).repartition(4), "vec_id", "vector", dimensions=8, **settings))


def test_clusters_match_whole_number_arithmetic(spark, rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    vectors = [(i, np.float32(centres[i % 6] + rng.normal(size=8) / 5).tolist()) for i in range(400)]
    assert clustered(spark, rows, vectors) == clusters_by_hand(vectors)
    assert clustered(spark, rows, vectors, pivots=1, clusters=3, rounds=2) == clusters_by_hand(vectors, 3, 2)


def test_ties_repeats_and_empty_centroids(spark, rows):
    # Few distinct points, many copies: centroids coincide, so ties decide and some stay empty.
    vectors = [(i, [float(i % 2)] * 4 + [-1.5] * 4) for i in range(90)] + [(5, [0.5] * 8)] * 3 + [(None, [2.0] * 8)] * 2
    assert clustered(spark, rows, vectors) == clusters_by_hand(vectors)


def test_what_is_left_out(spark, rows):
    kept = [(1, [0.25] * 8), (2, [-0.001] * 8)]
    dropped = [None, [], [1.0] * 7, [1.0] * 9, [NAN] + [1.0] * 7, [INF] * 8, [None] + [1.0] * 7, [1e30] * 8]
    vectors = kept + [(100 + i, v) for i, v in enumerate(dropped)]
    assert clustered(spark, rows, vectors) == clusters_by_hand(kept)
    assert clustered(spark, rows, vectors[2:]) == []


def test_pivots_spare_exact_distances_and_change_nothing():
    rng = np.random.default_rng(9)
    centres = rng.integers(-2000, 2000, size=(40, 64))
    points = centres[rng.integers(0, 40, size=3000)] + rng.integers(-60, 60, size=(3000, 64))
    pivots = chosen_pivots(centres, 8)
    table = np.sqrt(np.stack([distances(points, p) for p in pivots], axis=1).astype(float))
    best, far, taken = nearest(points, table, centres, pivots)
    every = np.stack([distances(points, c) for c in centres], axis=1)
    assert (best == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert taken < 0.3 * every.size
    equal, _, _ = nearest(points, table, np.repeat(centres[:3], 2, axis=0), pivots)
    assert set(equal.tolist()) <= {0, 2, 4}
