"""Whitening of embeddings by distributed block matrices."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Entries are taken as whole numbers of 1 / SCALE, counted from -ORIGIN.
SCALE, ORIGIN = 64, 1_000_000
#: Whole numbers beyond this cannot be summed and squared exactly; they count as not finite.
LARGEST = 1 << 31
#: Rows and columns of a block, and row blocks that meet in one task when they are multiplied.
ROWS, COLUMNS, BLOCKS = 1024, 1024, 16
#: Directions whose variance is below this share of the largest one hold rounding errors only.
LEAST_VARIANCE = 1e-11


def usable(vector: Column, scale: int, largest: int) -> Column:
    """Whether a vector has entries, all of them finite, and none too large for exact sums."""
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < largest)),
        F.lit(False),
    )


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every entry, as longs; for usable vectors."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


@dataclass(frozen=True)
class Whitening:
    """What :func:`whiten` found: a row per vector, and one value per component."""

    #: (id, index, deviation, whitened array<double>) of every vector that was fitted
    rows: DataFrame
    n: int
    variances: tuple[float, ...]
    explained: tuple[float, ...]
    identity_error: float


def _indexed(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(index, id, x) of the usable vectors of the most frequent length, numbered from 0 without gaps."""
    vector = F.col(vector_column)
    kept = vectors.where(usable(vector, SCALE, LARGEST)).select(
        F.col(id_column).alias("id"), whole_numbers(vector, SCALE).alias("x")
    )
    width = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    placed = stored(kept.where(F.size("x") == (width["d"] if width else 0)).withColumn("at", F.monotonically_increasing_id()), "vectors")
    # A row's place says which task wrote it and as how many-th; one count per task makes places gapless.
    part = F.shiftright("at", 33)
    written = sorted(placed.groupBy(part.alias("part")).count().collect())
    before, offsets = 0, []
    for number, count in written:
        offsets.append((number, before))
        before += count
    given = vectors.sparkSession.createDataFrame(offsets, "part long, before long")
    numbered = placed.withColumn("part", part).join(F.broadcast(given), "part")
    return numbered.select((F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("index"), "id", "x")


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """How many rows there are, and the exact sum of each dimension."""
    found = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    sums = sorted(found.collect())
    return (sums[0]["n"] if sums else 0), [r["s"] for r in sums]


def _block_matrix(rows: DataFrame, entries: Column) -> BlockMatrix:
    """The rows (index, array of doubles) as a matrix of blocks; nothing of it leaves the JVM."""
    plain = rows.select("index", array_to_vector(entries).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(plain, "vector")).toBlockMatrix(ROWS, COLUMNS)


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix transposed times itself.

    All products end up in one small block, but are made where row blocks meet:
    the middle dimension is split, so a task gets some BLOCKS row blocks however
    many rows there are. (Python's ``multiply`` has no argument for the splits.)
    """
    splits = max(1, -(-matrix.numRows() // (ROWS * BLOCKS)))
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, COLUMNS, COLUMNS).toLocalMatrix().toArray()


def _projected(matrix: BlockMatrix, by: np.ndarray) -> DataFrame:
    """(index, whitened) of the matrix times a small local one, decoded a block at a time."""
    spark_context = matrix.blocks.context
    block = DenseMatrix(*by.shape, by.flatten(order="F"))
    width = by.shape[1]
    local = BlockMatrix(spark_context.parallelize([((0, 0), block)], 1), COLUMNS, COLUMNS, *by.shape)
    # A block is one row here, so that numbers go to Python and back as arrays and not one by one.
    packed = matrix.multiply(local).blocks.map(
        lambda found: (found[0][0], np.ascontiguousarray(found[1].toArray()).tobytes())
    )

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(data, np.float64)
                n = len(values) // width
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(n) + number * ROWS, pa.int64()), lists], ["index", "whitened"])

    frame = packed.toDF("block long, data binary")
    return frame.mapInArrow(unpacked, "index long, whitened array<double>")


def _identity_error(rows: DataFrame, n: int, width: int) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity, as measured on them."""
    means = dict(
        rows.select(F.posexplode("whitened").alias("i", "y")).groupBy("i").agg((F.sum("y") / n).alias("m")).collect()
    )
    mean = np.array([means[i] for i in range(width)])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = batch.column(0).flatten().to_numpy().reshape(-1, width) - mean
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], ["total"])

    sums = rows.select("whitened").mapInArrow(products, "total array<double>").select(F.posexplode("total").alias("i", "t"))
    found = dict(sums.groupBy("i").agg(F.sum("t").alias("t")).collect())
    covariance = np.array([found[i] for i in range(width * width)]).reshape(width, width) / n
    return float(np.abs(covariance - np.eye(width)).max())


def whiten(vectors: DataFrame, id_column: str, vector_column: str, components: int = 32) -> Whitening | None:
    """Rows projected on their principal components, each divided by its deviation.

    Entries become whole numbers, so counts, sums and deviations are exact. Rows
    less their mean are indexed into a BlockMatrix; it transposed times itself is
    the scatter matrix, whose eigenvectors are worked out locally (a matrix of the
    number of dimensions, not of rows); the BlockMatrix times the eigenvectors
    over the roots of their eigenvalues gives the whitened rows. Components are
    numbered by falling eigenvalue; the largest entry of each is positive.

    Null vectors, empty ones and those with null, infinite or absurdly large
    entries (beyond 2^31 / 64) are left out, and so are those of another length
    than the most frequent one (of two, the longer). Repeated rows and null ids
    are rows like others. Directions without variance are no components, so there
    may be fewer than asked for; None if there is none at all, which is so for an
    empty table, a single row and equal rows. ``deviation`` (the squared distance
    from the mean times n squared) is null where it does not fit into a long.
    """
    rows = _indexed(vectors, id_column, vector_column)
    n, sums = _sums(rows)
    if n == 0:
        return None
    totals = F.lit(sums)
    scaled = F.zip_with("x", totals, lambda x, s: x * F.lit(n).cast("long") - s)
    rows = rows.select("index", "id", scaled.alias("scaled"))
    matrix = _block_matrix(rows, F.transform("scaled", lambda x: x.cast("double") / F.lit(float(n))))
    covariance = _scatter(matrix) / n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    values, directions = values[::-1], directions[:, ::-1]
    kept = int((values > LEAST_VARIANCE * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    width = min(components, kept)
    if width == 0:
        return None
    directions = directions[:, :width]
    largest = np.abs(directions).argmax(axis=0)
    directions = directions * np.sign(directions[largest, np.arange(width)])
    projected = stored(_projected(matrix, directions / np.sqrt(values[:width])), "whitened")
    deviation = F.aggregate(
        "scaled", F.lit(0).cast("long"), lambda total, x: F.try_add(total, F.try_multiply(x, x))
    )
    return Whitening(
        rows.select("index", "id", deviation.alias("deviation")).join(projected, "index"),
        n,
        tuple(values[:width].tolist()),
        tuple((values[:width] / np.trace(covariance)).tolist()),
        _identity_error(projected, n, width),
    )


def whitened_components(vectors: DataFrame, id_column: str, vector_column: str, components: int = 32) -> DataFrame:
    """The same as one row per vector and component, with what holds for the component and the whole.

    Returns the id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``; no rows where :func:`whiten` gives None.
    """
    spark = vectors.sparkSession
    found = whiten(vectors, id_column, vector_column, components)
    kind = vectors.schema[id_column].dataType.simpleString()
    if found is None:
        return spark.createDataFrame(
            [],
            f"`{id_column}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
        )
    shares = F.lit(list(found.explained))
    each = found.rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        F.col("id").alias(id_column),
        (F.col("at") + 1).alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )
