"""Projections and set operations that flows are made of."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_COLUMN = "InputFileName"
ENTITY_COLUMN = "Entity"
DATE_COLUMN = "IngestionDate"
TIME_COLUMN = "IngestionTime"
RESCUE_COLUMN = "_rescue"

PROVENANCE = (FILE_COLUMN, ENTITY_COLUMN, DATE_COLUMN, TIME_COLUMN)


def strip_provenance(schema: T.StructType) -> T.StructType:
    """The schema without fields the flow itself adds (names compared without case)."""
    added = {name.lower() for name in (*PROVENANCE, RESCUE_COLUMN)}
    return T.StructType([f for f in schema.fields if f.name.lower() not in added])


def without_trailing_provenance(schema: T.StructType) -> T.StructType:
    """The schema without such fields at its end: those before others have a place in the file."""
    kept = {f.name for f in strip_provenance(schema).fields}
    last = max((i for i, f in enumerate(schema.fields) if f.name in kept), default=-1)
    return T.StructType(schema.fields[: last + 1])


def quoted(name: str) -> str:
    """A column name as SQL takes it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def extended(schema: T.StructType, **fields: str | T.DataType) -> T.StructType:
    """A copy of the schema with more fields; `StructType.add` would change the original."""
    longer = T.StructType(list(schema.fields))
    for name, kind in fields.items():
        longer.add(name, kind)
    return longer


def with_entity(df: DataFrame, entity: str) -> DataFrame:
    return df.withColumn(ENTITY_COLUMN, F.lit(entity))


def with_ingestion(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add ingestion date and time: one moment per micro-batch, or the given one."""
    at = F.current_timestamp() if at is None else at
    return df.withColumns({DATE_COLUMN: F.to_date(at), TIME_COLUMN: at})


def with_provenance(df: DataFrame, entity: str, at: Column | None = None) -> DataFrame:
    """Entity and ingestion columns; the readers already add the input file name."""
    return with_ingestion(with_entity(df, entity), at)


def malformed(schema: T.StructType, file_format: str, rescue: str = RESCUE_COLUMN) -> Column:
    """Whether a record could not be read at all, as against in part.

    JSON: the rescued text is no JSON object. Other formats: no field was read.
    """
    if file_format == "json":
        return F.col(rescue).isNotNull() & F.json_object_keys(rescue).isNull()
    nothing_read = [F.col(quoted(f.name)).isNull() for f in strip_provenance(schema).fields]
    return reduce(Column.__and__, nothing_read, F.col(rescue).isNotNull())


def where_sql(df: DataFrame, condition: str) -> DataFrame:
    return df.filter(F.expr(condition))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Positional UNION ALL of any number of frames, batch or streaming.

    Columns are matched by position, as SQL does; so their number and types are
    checked first, since a slip would silently mix columns up.
    """
    if not frames:
        raise ValueError("union_all needs at least one frame")
    first = [f.dataType for f in frames[0].schema.fields]
    for position, frame in enumerate(frames[1:], start=2):
        other = [f.dataType for f in frame.schema.fields]
        if other != first:
            raise ValueError(
                f"frame {position} has columns {frame.schema.simpleString()},"
                f" the first has {frames[0].schema.simpleString()}"
            )
    return reduce(DataFrame.union, frames)
