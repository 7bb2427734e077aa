"""Bounded samples of texts to fit models on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_of

_PARTS = 1 << 30


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a row is kept back from learning: crc32 of its id as text, modulo ``folds``."""
    return F.pmod(crc_of(key), F.lit(folds)) == fold


def thinned(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` of the rows and never more, chosen by a hash of their key."""
    share = min(1.0, most / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64(F.lit(17), key), F.lit(_PARTS)) < int(share * _PARTS)).limit(most)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, target: str, learn: Column, most: int, id_column: str, text_column: str
) -> DataFrame:
    """(label, text) of at most about ``most`` labelled documents for which ``learn`` holds.

    ``learn`` is an expression over ``key``, the document's id. Of several labels
    of one document the largest counts. The sample is drawn from the narrow
    labels; its ids, at most ``most``, are broadcast to one scan of the texts.
    """
    marked = (
        labels.select(F.col(id_column).alias("key"), F.col(target).cast("int").alias("label"))
        .where(F.col("key").isNotNull() & F.col("label").isNotNull() & learn)
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )
    ids = F.broadcast(thinned(marked, "key", most))
    texts = docs.select(F.col(id_column).alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.join(ids, "key").select("label", "text")


def unlabelled_texts(
    docs: DataFrame, labels: DataFrame, learn: Column, most: int, id_column: str, text_column: str
) -> DataFrame:
    """(text) of at most about ``most`` documents without a label, drawn likewise.

    Labelled ones are taken away before the sample is drawn, so its size does not
    depend on how many there are.
    """
    marked = labels.select(F.col(id_column).alias("key"))
    ids = docs.select(F.col(id_column).alias("key")).where(F.col("key").isNotNull() & learn)
    chosen = thinned(ids.join(marked, "key", "left_anti").distinct(), "key", most)
    texts = docs.select(F.col(id_column).alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "key").select("text")
