"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_set, bits_for, has_bit, identity, remaining, stored

#: Bits, per row, of the set that stands for the values several rows share, and at
#: most so many (16 MB). The set is the only thing broadcast. When it fills up,
#: beyond some 30 million rows, more rows than needed go on to the next step; no
#: result changes.
BITS_PER_ROW, MOST_BITS = 16, 1 << 27
PREFIX_CHARS = 256


def _shared(hashes: DataFrame, bits: int):
    """The bits on which more than one row falls, as a set that tasks look up."""
    at = F.pmod(F.col(hashes.columns[0]), F.lit(bits)).alias("at")
    return bit_set(hashes.groupBy(at).count().where("count > 1").select("at"), bits)


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    set_bits: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays.

    Returns the id, ``keep_id``, ``group_size``, ``kept`` and ``row``, a number
    of the input row. Three scans refine: lengths alone; a hash of length and
    prefix, for rows whose length others share; a hash of the whole text, for
    rows whose prefix hash others share. Only those are grouped, by sha256 and
    length, and only hashes move. A group of any size is a partial count and
    maximum per task, and its rows meet the result in a join that Spark splits.

    Null counts as the empty text. Of equal texts the row with the largest id
    stays, a null id being smaller than any; of rows that are wholly the same
    exactly one stays. An empty table gives no rows. Other columns are ignored,
    whatever their names.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    base = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    size = F.octet_length("text").cast("long")
    by_size = F.xxhash64(size)
    by_prefix = F.xxhash64(size, F.substring("text", 1, prefix_chars))

    if set_bits is None:
        set_bits = bits_for(docs.count(), BITS_PER_ROW, MOST_BITS)
    sizes = _shared(base.select(by_size.alias("h")), set_bits)
    alike = base.withColumn("sizes", sizes).where(has_bit(F.col("sizes"), by_size, set_bits))
    prefixes = _shared(alike.select(by_prefix.alias("h")), set_bits)

    maybe = F.when(
        has_bit(F.col("sizes"), by_size, set_bits)
        & has_bit(F.col("prefixes"), by_prefix, set_bits),
        F.sha2(F.col("text").cast("binary"), 256),
    )
    rows = stored(
        base.withColumn("sizes", sizes)
        .withColumn("prefixes", prefixes)
        .select(
            F.monotonically_increasing_id().alias("row"), "id", size.alias("size"), maybe.alias("full")
        ),
        "exact-rows",
    )

    alone = rows.where("full IS NULL").select(
        "row", "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    survivors = rows.where("full IS NOT NULL")
    groups = survivors.groupBy("full", "size").agg(
        F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("group_size")
    )
    # Grouped by hash and size, joined by one value of both: both sides are dealt
    # anew for the join alone, which lets Spark split a large group there.
    key = F.concat_ws(":", "full", F.col("size").cast("string"))
    met = survivors.withColumn("key", key).join(
        groups.select(key.alias("key"), "keep", "group_size"), "key"
    )
    grouped = met.select(
        "row",
        "id",
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
    )
    return alone.unionByName(grouped).withColumnRenamed("id", id_column)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The decision is made on narrow rows, named by id and text, and takes effect
    in one more scan. Ties, nulls and empty tables are as in :func:`exact_groups`.
    """
    told = docs.select(
        F.struct(F.col(id_column).alias("id"), identity(id_column, text_column).alias("row")).alias("doc"),
        F.col(text_column).alias("text"),
    )
    decided = exact_groups(told, "doc", "text", **options).select(F.col("doc.row").alias("row"), "kept")
    return remaining(docs, decided, id_column, text_column)
