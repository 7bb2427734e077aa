"""Document fingerprints by winnowing: of every window of k-gram hashes the smallest, with its position."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import CHUNK_BYTES, identity, map_texts
from .prob_minhash import mixed

#: Matches shorter than NOISE code points are never seen, those of GUARANTEE or more always.
NOISE, GUARANTEE = 20, 50
#: Windows worked on at a time, so that a text of any length takes bounded memory.
BLOCK = 1 << 17

#: An odd number and its inverse modulo 2^64: the base of the rolling hash.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@cache
def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(powers)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """The rolling hash of every run of ``k`` code points, 32 bits each.

    A run c0..ck-1 has the polynomial sum of c_j * B^(k-1-j). Instead of rolling
    from one run to the next, all are taken at once as differences of running
    sums of c_i * B^-i, which B^(i+k-1) brings back to the same scale.
    """
    n = len(points)
    with np.errstate(over="ignore"):
        terms = (points.astype(np.uint64) + np.uint64(1)) * _powers(_INVERSE, _reach(n))[:n]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        hashes = (sums[k:] - sums[:-k]) * _powers(_BASE, _reach(n))[k - 1 : n]
    # Low bits of such a sum hang on few code points only, so they are spread first.
    return (mixed(hashes, k) >> np.uint64(32)).astype(np.uint64)


def _reach(n: int) -> int:
    """Lengths of power tables: one for short runs, and one for whole blocks."""
    return 1 << max(12, int(n).bit_length())


def smallest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row, by windows that double."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def winnow(points: np.ndarray, noise: int = NOISE, guarantee: int = GUARANTEE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a text's fingerprint, in order of position.

    Of the hashes of each ``guarantee - noise + 1`` runs that follow each other
    the smallest is chosen, of equal ones the rightmost; one chosen by several
    windows is kept once. Two texts with a passage of ``guarantee`` code points in
    common thus both choose the same run within it. A text with fewer runs is one
    window, one shorter than ``noise`` one run; one without code points has none.
    """
    n = len(points)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    k = min(noise, n)
    width = min(guarantee - noise + 1, n - k + 1)
    windows = n - k + 1 - width + 1
    found = []
    for start in range(0, windows, BLOCK):
        stop = min(start + BLOCK, windows)
        hashes = gram_hashes(points[start : stop + width - 1 + k - 1], k)
        # Position, counted down, decides between equal hashes: the rightmost is smallest.
        places = np.arange(start, start + len(hashes), dtype=np.uint64)
        best = smallest_in_windows((hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - places), width)
        found.append(best[np.concatenate([[True], best[1:] != best[:-1]])])
    # A run chosen at the end of one block may be chosen again at the start of the next.
    chosen = np.concatenate(found)
    chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
    return chosen >> np.uint64(32), (np.uint64(0xFFFFFFFF) - (chosen & np.uint64(0xFFFFFFFF))).astype(np.int64)


def written(hashes: np.ndarray, positions: np.ndarray) -> str:
    """A fingerprint as text: ``hash@position``, hashes of eight hex digits, joined by blanks."""
    return " ".join(map("%08x@%d".__mod__, zip(hashes.tolist(), positions.tolist(), strict=True)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct hashes of two fingerprints that both have; 1 if neither has any."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def document_fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    noise: int = NOISE,
    guarantee: int = GUARANTEE,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_chars`` and ``marks``, an array of (hash, position).

    One narrow pass. Null and empty texts have no marks; equal texts have equal
    ones. Ids may be null or repeated and are handed on as they are; other columns
    are not read. An empty table gives no rows.
    """

    def start():
        def one(text: bytes | None) -> tuple:
            points = code_points((text or b"").decode("utf-8", "replace"))
            hashes, positions = winnow(points, noise, guarantee)
            marks = [{"hash": h, "position": p} for h, p in zip(hashes.tolist(), positions.tolist(), strict=True)]
            return len(points), marks

        return one

    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = map_texts(given, ["id"], F.col("text"), "n_chars long, marks array<struct<hash: bigint, position: bigint>>", start)
    return found.select(F.col("id").alias(id_column), "n_chars", "marks")


#: Rows that a range of ids holds on average, and at most so many ranges: their
#: first ids are broadcast, half a megabyte at most.
RANGE_ROWS, MOST_RANGES = 2_000, 1 << 16
#: Ids looked at per range to choose the ranges' first ids.
LOOKED_AT = 4


def _range_starts(ids: DataFrame) -> list[int]:
    """Ids at which ranges of about equally many rows start, falling; the first is the largest id."""
    told = ids.agg(F.count("*").alias("n"), F.max("id").alias("top")).first()
    if told["top"] is None:
        return []
    ranges = max(1, min(MOST_RANGES, told["n"] // RANGE_ROWS))
    share = min(1.0, ranges * LOOKED_AT / told["n"])
    parts = 1 << 30
    drawn = ids.where(F.pmod(F.xxhash64(F.lit(29), "id"), F.lit(parts)) < int(share * parts)).where("id IS NOT NULL")
    looked_at = drawn.distinct().orderBy(F.desc("id")).limit(2 * LOOKED_AT * MOST_RANGES).toArrow().column("id").to_pylist()
    return sorted({told["top"], *looked_at[LOOKED_AT::LOOKED_AT]}, reverse=True)


def _dealt(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(range, guest, id, row, text): every row in its range of ids, in order within a partition.

    The first rows of a range are also the last ones, as guests, of the range
    before, so the row that follows is at hand in every range; those of the first
    range are guests of the last one.
    """
    given = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        identity(id_column, text_column).alias("row"),
    )
    starts = _range_starts(given.select("id"))
    n = max(1, len(starts))
    rising = np.array(starts[::-1], np.int64)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        # A range holds the ids from its start down to the next one; null ids are last of all.
        at = n - 1 - np.searchsorted(rising, known, "left") if len(rising) else np.zeros(len(known), np.int64)
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), n - 1, at).astype(np.int32))

    @F.arrow_udf("boolean")
    def starts_range(ids: pa.Array) -> pa.Array:
        if not len(rising):
            return ids.is_null()
        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(rising, known, "left"), len(rising) - 1)
        return pa.array((rising[at] == known) & ids.is_valid().to_numpy(zero_copy_only=False))

    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(n)).cast("int").alias("range"), F.lit(True).alias("guest"))
    seated = given.select("id", "row", "text", range_of("id").alias("range"), starts_range("id").alias("first")).select(
        "id", "row", "text", F.explode(F.when(F.col("first"), F.array(own, before)).otherwise(F.array(own))).alias("seat")
    )
    order = ["range", "guest", F.desc_nulls_last("id"), "row"]
    return seated.select("seat.range", "seat.guest", "id", "row", "text").repartition("range").sortWithinPartitions(*order)


_FIELDS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def edited_fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    noise: int = NOISE,
    guarantee: int = GUARANTEE,
) -> DataFrame:
    """Per row its fingerprint, and that of its text with the last half taken from the next row.

    Rows follow each other by falling id (an integer), null ids last, rows of one
    id by a hash of the text; behind the last comes the first. ``edited_sha256``
    is of the text whose last ``floor(n_chars / 2)`` code points are replaced by
    the first as many of the next text, or all of it. ``near_edited`` and
    ``near_next`` tell how many distinct hashes the fingerprint shares with those
    of the edited and of the next text (1 if neither has any).

    Texts move once, to ranges of ids that each task reads in order; a row waits
    for its successor, and nothing else is held. Rows of one id are in one range,
    so they should be few. A null text is an empty one. A single row is its own
    successor, an empty table gives no rows, and other columns are not read.
    """
    made = StructType.fromDDL(f"id long, {_FIELDS}")
    schema = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(one: tuple, after: tuple) -> tuple:
            _, doc, text, marks = one
            half = len(text) // 2
            edited = text[: len(text) - half] + after[2][:half]
            marked = winnow(code_points(edited), noise, guarantee)
            return (
                doc,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                written(*marks),
                written(*marked),
                likeness(marks[0], marked[0]),
                likeness(marks[0], after[3][0]),
            )

        waits = None
        ready, size = [], 0
        for batch in batches:
            for at, guest, doc, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if guest and waits is None:
                    continue
                here = (at, doc, text, winnow(code_points(text), noise, guarantee))
                if waits is not None:
                    ready.append(row(waits, here))
                    size += 64 + len(ready[-1][3]) + len(ready[-1][4])
                    if size > CHUNK_BYTES:
                        yield _batch(ready, schema)
                        ready, size = [], 0
                waits = None if guest else here
        if waits is not None:
            raise RuntimeError("a range of ids came without the row that follows it; were rows changed meanwhile?")
        yield _batch(ready, schema)

    found = _dealt(docs, id_column, text_column).mapInArrow(run, made)
    return found.select(F.col("id").cast(docs.schema[id_column].dataType).alias(id_column), *made.names[1:])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, schema.types, strict=True)], schema.names
    )
