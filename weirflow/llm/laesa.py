"""Centroid clustering in whole numbers, with a table of pivot distances that spares most exact ones."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .whitening import usable, whole_numbers

#: Entries are taken as whole numbers of 1 / SCALE. Larger ones than LARGEST of
#: them have no squared distance that fits into a long, and count as not finite.
DIMENSIONS, SCALE, LARGEST = 64, 256, 1 << 27
PIVOTS = 8
#: Rows worked on at a time within a task.
ROWS = 2048
#: Bounds are floating point; they are loosened by this share before they rule anything out.
SLACK = 1e-9


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows from one point."""
    return np.square(rows - point).sum(axis=1)


def chosen_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Of the given points some that lie far apart: each next one farthest from all before, summed."""
    chosen = [0]
    far = np.sqrt(distances(points, points[0]))
    while len(chosen) < min(count, len(points)):
        far[chosen] = -1.0
        chosen.append(int(far.argmax()))
        far += np.sqrt(distances(points, points[chosen[-1]]))
    return points[chosen]


def nearest(
    rows: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, exact squared distance, how many exact ones were taken).

    By the triangle inequality a row is at least as far from a centroid as their
    distances from a pivot differ. The centroid with the smallest such bound is
    measured first; another is measured only for rows whose bound does not exceed
    the best distance so far. Of equally near centroids the smaller number wins.
    """
    to_pivots = np.sqrt(np.stack([distances(centroids, p) for p in pivots], axis=1).astype(np.float64))
    bounds = np.zeros((len(rows), len(centroids)))
    for i in range(len(pivots)):
        np.maximum(bounds, np.abs(table[:, i, None] - to_pivots[None, :, i]), out=bounds)
    bounds = bounds - SLACK * (table.max(axis=1)[:, None] + to_pivots.max(axis=1)[None, :])
    bounds = np.square(np.maximum(bounds, 0.0))
    best = bounds.argmin(axis=1)
    far = np.square(rows - centroids[best]).sum(axis=1)
    first, taken = best.copy(), len(rows)
    for j in range(len(centroids)):
        left = np.flatnonzero((bounds[:, j] <= far) & (first != j))
        taken += len(left)
        exact = distances(rows[left], centroids[j])
        closer = (exact < far[left]) | ((exact == far[left]) & (j < best[left]))
        best[left[closer]], far[left[closer]] = j, exact[closer]
    return best, far, taken


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind, copy=False)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _assigner(centroids: np.ndarray, pivots: np.ndarray) -> Callable:
    """Assigns the rows of a batch whose last two columns are ``x`` and ``pivots``."""

    def assign(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = _matrix(batch.column("x"), centroids.shape[1], np.int64)
        best, far, _ = nearest(rows, _matrix(batch.column("pivots"), len(pivots), np.float64), centroids, pivots)
        return rows, best, far

    return assign


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """How many vectors each centroid gets, and their exact sums: one small row per task and centroid moves."""
    assign = _assigner(centroids, pivots)
    count, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, sums = np.zeros(count, np.int64), np.zeros((count, width), np.int64)
        for batch in _pieces(batches):
            rows, best, _ = assign(batch)
            order = best.argsort(kind="stable")
            found, starts = np.unique(best[order], return_index=True)
            sizes += np.bincount(best, minlength=count)
            sums[found] += np.add.reduceat(rows[order], starts, axis=0)
        met = np.flatnonzero(sizes)
        counted = np.concatenate([sizes[met, None], sums[met]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counted.tolist(), pa.list_(pa.int64()))], ["cluster", "sums"])

    told = table.select("x", "pivots").mapInArrow(run, "cluster int, sums array<long>")
    each = told.select("cluster", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i").agg(F.sum("s").alias("s"))
    sizes, sums = np.zeros(count, np.int64), [[0] * width for _ in range(count)]
    for cluster, i, s in each.collect():
        if i == 0:
            sizes[cluster] = s
        else:
            sums[cluster][i - 1] = s
    return sizes, sums


def cluster_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    clusters: int = 40,
    rounds: int = 5,
    seed: int = 2,
    dimensions: int = DIMENSIONS,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Per vector the number of its centroid and its squared distance, after some rounds of k-means.

    Vectors are whole numbers ``floor(256 * x)``. Centroids start as those with
    the smallest sha256 of ``<seed>:<id>``. In each round every vector goes to the
    nearest centroid (ties: the smaller number), and each centroid that has some
    becomes the floor of their mean; at last all are assigned once more. All sums
    and distances are exact, so results do not hang on how rows are dealt out.

    The distances of every vector from ``pivots`` fixed points, chosen among the
    first centroids, are stored once, with the vectors; each round reads them and
    takes exact distances only where they leave a centroid possible (see
    :func:`nearest`). A round moves one row per task and centroid; centroids and
    pivots, a few kilobytes, go to the tasks with the code.

    Returns the id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``
    and ``centroid_sha256``. Left out are vectors that are null, have another
    length or hold null, infinite or absurdly large entries (2^27 / 256 and more).
    Repeated rows are rows like others; a null id comes last when centroids are
    chosen, and of equal ids the smaller vector first. With fewer vectors than
    clusters there are as many centroids as vectors; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_column)
    kept = vectors.where((F.size(vector) == dimensions) & usable(vector, SCALE, LARGEST)).select(
        F.col(id_column).alias("id"), whole_numbers(vector, SCALE).cast("array<int>").alias("x")
    )
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = kept.orderBy(F.asc_nulls_last(rank), "x").limit(clusters).select("x").collect()
    names = {"id": id_column}
    if not first:
        kind = vectors.schema[id_column].dataType.simpleString()
        return spark.createDataFrame(
            [],
            f"`{id_column}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string",
        )
    centroids = np.array([r["x"] for r in first], np.int64)
    fixed = chosen_pivots(centroids, pivots)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            rows = _matrix(batch.column("x"), dimensions, np.int64)
            far = np.sqrt(np.stack([distances(rows, p) for p in fixed], axis=1).astype(np.float64))
            lists = pa.array(far.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "pivots"])

    kind = kept.schema["id"].dataType.simpleString()
    table = stored(kept.select("id", "x").mapInArrow(measured, f"id {kind}, x array<int>, pivots array<double>"), "pivot-table")

    for _ in range(rounds):
        sizes, sums = _sums(table, centroids, fixed)
        for j in np.flatnonzero(sizes):
            centroids[j] = [s // int(sizes[j]) for s in sums[j]]

    assign = _assigner(centroids.copy(), fixed)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            _, best, far = assign(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(best, pa.int32()), pa.array(far, pa.int64())], ["id", "cluster", "distance"]
            )

    assigned = stored(table.mapInArrow(told, f"id {kind}, cluster int, distance long"), "assigned")
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    named = [
        (j, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest())
        for j in sorted(inertia)
    ]
    centroid = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    found = assigned.join(F.broadcast(centroid), "cluster")
    return found.select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").withColumnsRenamed(names)
