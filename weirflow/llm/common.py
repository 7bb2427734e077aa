"""Helpers the operators of this subpackage share: tables, stored steps, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from weirflow.operators.transforms import quoted
from weirflow.scratch import scratch_dir

#: What separates words, as a Java pattern: ASCII that is neither digit nor letter.
#: It is applied after A-Z have become a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The same rule on the bytes of UTF-8: every byte of a longer character is 0x80 or more.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    This cuts the lineage: what is read later is the same whatever executor is
    lost in between, so row numbers given before it stay as they are. With
    ``batch_rows``, no Arrow batch holds more rows while it is written.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(ARROW_ROWS)
    if batch_rows and not 0 < int(before) <= batch_rows:
        spark.conf.set(ARROW_ROWS, batch_rows)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def byte_words(data: bytes | None) -> list[bytes]:
    """The lower-cased words of a text given as UTF-8; none for null."""
    return data.translate(WORD_BYTES).split() if data else []


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` does just that where all is ASCII, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words_of(text: Column) -> Column:
    """The words of a text as an array of strings, empty for null and for text without any."""
    plain = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def crc_of(key: Column) -> Column:
    """crc32 of a key written as text, as an unsigned long."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def bit_set(values: DataFrame, bits: int) -> Column:
    """A set of ``bits`` bits (a power of two) with the bit of every hash in the only column.

    The result is a scalar subquery: an array of ``bits / 64`` longs, whatever
    the number of values, so it can be broadcast. Each task that reads values
    hands on at most one row per word of the set.
    """
    spark, hashed = values.sparkSession, F.col(values.columns[0])
    at = F.pmod(hashed, F.lit(bits))
    filled = values.select(
        F.shiftright(at, 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("bit"),
    )
    zeros = spark.range(0, bits // 64, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = filled.groupBy("word").agg(F.bit_or("bit").alias("bit")).unionByName(zeros)
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bit"))
    return words.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "bit"))), lambda w: w["bit"])
    ).scalar()


def has_bit(words: Column, hashed: Column, bits: int) -> Column:
    """Whether the bit of a hash is set; never False for a hash that was put in."""
    at = hashed.bitwiseAND(F.lit(bits - 1))
    word = F.get(words, F.shiftright(at, 6).cast("int"))
    return F.call_function("shiftright", word, (at % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def bits_for(n: int, per_value: int, most: int) -> int:
    """The size of a set of ``n`` values: so many bits per value, a power of two, never more than ``most``."""
    bits = 1 << 16
    while bits < min(per_value * n, most):
        bits *= 2
    return bits


def unused(docs: DataFrame, *wanted: str) -> list[str]:
    """Column names like the ones wanted that ``docs`` does not have; case makes no difference to Spark."""
    taken = {c.lower() for c in docs.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def own(docs: DataFrame) -> list[Column]:
    """The columns of ``docs``, whatever signs their names have."""
    return [F.col(quoted(c)) for c in docs.columns]


def identity(id_column: str, text_column: str) -> Column:
    """Names a row by its id and text, wherever and however often it is read: 16 bytes."""
    named = F.coalesce(F.concat(F.lit("1"), F.col(id_column).cast("string")), F.lit("0"))
    text = F.coalesce(F.concat(F.lit("1"), F.col(text_column)), F.lit("0"))
    return F.unhex(F.md5(F.concat(F.char_length(named).cast("string"), F.lit(":"), named, text).cast("binary")))


#: The set of rows to look at: bits per row, and at most so many (16 MB).
BITS_PER_ROW, MOST_ROW_BITS = 32, 1 << 27


def remaining(docs: DataFrame, decided: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    ``decided`` has ``row`` (an :func:`identity`) and ``kept`` for every row. Of
    rows with one identity as many as are kept stay if that is all or none, and
    one otherwise. Rows that nothing is dropped for pass straight through one
    scan; only the others are joined, so no text moves that may stay.
    """
    name, stays, some, hit, whole = unused(docs, "row_identity", "stays", "some", "hit", "whole")
    gone = stored(
        decided.groupBy("row").agg(F.bool_or("kept").alias(stays), F.bool_and("kept").alias("all"))
        .where("NOT all").select(F.col("row").alias(name), stays),
        "gone",
    )
    bits = bits_for(gone.count(), BITS_PER_ROW, MOST_ROW_BITS)
    marked = (
        docs.withColumn(name, identity(id_column, text_column))
        .withColumn(some, bit_set(gone.select(F.xxhash64(name).alias("h")), bits))
        .withColumn(hit, has_bit(F.col(some), F.xxhash64(name), bits))
    )
    columns = own(docs)
    through = marked.where(~F.col(hit)).select(*columns)
    met = marked.where(hit).join(gone, name, "left")
    free = met.where(F.col(stays).isNull()).select(*columns)
    one = met.where(stays).groupBy(name).agg(F.first(F.struct(*columns)).alias(whole)).select(f"{whole}.*")
    return through.unionByName(free).unionByName(one)


#: Texts are handed to Python functions in lists of about so many bytes.
CHUNK_BYTES = 4_000_000

#: Given texts as UTF-8 (None for null), makes a list of rows per text.
TextFunction = Callable[[list[bytes | None]], list[Sequence[tuple]]]


def flat_map_texts(
    df: DataFrame, keep: Sequence[str], text: Column, fields: str, start: Callable[[], TextFunction]
) -> DataFrame:
    """Rows made from each text by Python, behind the columns ``keep`` of its row.

    ``start`` is called once per task and gives the function that is applied to
    lists of texts. Kept columns pass through as they are, whatever their type.
    """
    made = StructType.fromDDL(fields)
    schema = StructType([df.schema[c] for c in keep] + made.fields)
    kinds, names = to_arrow_schema(made).types, schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(len(keep))), 0).to_pylist()
            first = total = 0
            for at, size in enumerate(sizes):
                total += size
                if total >= CHUNK_BYTES or at == len(sizes) - 1:
                    yield part(function, batch.slice(first, at + 1 - first))
                    first, total = at + 1, 0

    def part(function: TextFunction, batch: pa.RecordBatch) -> pa.RecordBatch:
        found = function(batch.column(len(keep)).to_pylist())
        origin = pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int32())
        kept = [batch.column(i).take(origin) for i in range(len(keep))]
        columns = list(zip(*(row for rows in found for row in rows), strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            kept + [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)], names
        )

    return df.select(*keep, text.cast("binary").alias("_text_of_flat_map")).mapInArrow(run, schema)


def map_texts(
    df: DataFrame, keep: Sequence[str], text: Column, fields: str, start: Callable[[], Callable[[bytes | None], tuple]]
) -> DataFrame:
    """One row per text: as :func:`flat_map_texts` for a function of one text."""

    def one_by_one() -> TextFunction:
        function = start()
        return lambda texts: [(function(x),) for x in texts]

    return flat_map_texts(df, keep, text, fields, one_by_one)
