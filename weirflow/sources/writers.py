"""Batch sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.eventlog import append_new_events
from ..operators.transforms import quoted
from .complete import CompleteTable
from .files import read_merged


def write_landing(
    df: DataFrame,
    path: str,
    files: int | None = None,
    rows_per_file: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write CSV with a header, to stand for files arriving in a landing folder.

    ``files`` sets an exact number of files, at the cost of shuffling every row;
    ``rows_per_file`` bounds their size with no shuffle and suits large data.
    """
    if files is not None:
        df = df.repartition(files)
    writer = df.write.mode(mode).option("header", True)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_complete(df: DataFrame, path: str) -> DataFrame:
    """Replace the whole table at ``path`` by ``df``; gives its rows as they are now.

    Readers use `read_complete`; they see all old rows or all new ones, also when
    a write fails half way (see `CompleteTable`).
    """
    return CompleteTable(df.sparkSession, path).replace(df)


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the table that `write_complete` last replaced as a whole."""
    return CompleteTable(spark, path).read()


def append_merge(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows that may bring new columns; `read_merged` shows them all.

    A column the table has keeps the table's type: narrower numbers and, where
    the table holds text, any value are cast; other types are refused before
    anything is written, since the table could not be read with both.
    """
    there = _schema_of(df, path)
    if there is not None:
        df = df.select(
            *[
                aligned(F.col(quoted(f.name)), f.dataType, there[f.name].dataType, f.name).alias(f.name)
                if f.name in there.fieldNames()
                else F.col(quoted(f.name))
                for f in df.schema.fields
            ]
        )
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_once(df: DataFrame, path: str, key: str = "event_id", within: str | None = None) -> None:
    """Append the rows whose key the table lacks; doing it again adds nothing.

    A NULL key stops the job, and of rows with one key one is taken. Two writers
    at the same time are not kept apart: let one job fill a table.

    ``within`` names a column that a key has one value of, such as its day. The
    table is then partitioned by it, and of the table only the partitions are
    read that the new rows belong to, however long it has grown.
    """
    name = F.col(quoted(key))
    checked = F.when(name.isNull(), F.raise_error(F.lit(f"{key} is NULL")).cast(df.schema[key].dataType))
    df = df.withColumn(key, checked.otherwise(name)).dropDuplicates([key])
    if _schema_of(df, path) is not None:
        there = read_merged(df.sparkSession, path)
        if within is not None:
            met = [r[0] for r in df.select(quoted(within)).distinct().collect()]
            there = there.where(F.col(quoted(within)).isin(met))
        df = append_new_events(df, there, key)
    append_merge(df, path, () if within is None else (within,))


def _schema_of(df: DataFrame, path: str) -> T.StructType | None:
    """The schema of the table at ``path``; None where there is none yet."""
    try:
        return read_merged(df.sparkSession, path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


#: Numbers by width: each fits into those that follow.
_WIDENING = ("byte", "short", "integer", "long")


def fits(have: T.DataType, want: T.DataType) -> bool:
    """Whether every number of the type ``have`` is one of the type ``want``."""
    names = have.typeName(), want.typeName()
    wider = all(n in _WIDENING for n in names) and _WIDENING.index(names[0]) <= _WIDENING.index(names[1])
    return wider or names == ("float", "double")


def aligned(value: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    """``value`` of type ``have`` as a value of the type ``want``, if nothing can be lost."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        known = {f.name: f.dataType for f in want.fields}
        fields = [
            aligned(value[f.name], f.dataType, known.get(f.name, f.dataType), f"{name}.{f.name}").alias(f.name)
            for f in have.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: aligned(x, have.elementType, want.elementType, name))
    if isinstance(have, T.NullType) or fits(have, want):
        return value.cast(want)
    if isinstance(want, T.StringType):
        complex_type = isinstance(have, (T.StructType, T.ArrayType, T.MapType))
        return F.to_json(value) if complex_type else value.cast(want)
    raise ValueError(f"column {name} is {have.simpleString()}, the table holds {want.simpleString()}")
