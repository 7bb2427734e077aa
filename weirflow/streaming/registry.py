"""Which columns and parts the stream tables of a storage root have, as they came to have them."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.transforms import quoted
from ..sources.writers import aligned, fits

_ROWS = "step LONG, name STRING, part STRING, schema STRING"
_NAMES = ("step", "name", "part", "schema")


@dataclass(frozen=True)
class Definition:
    """Columns of a table, and its parts in the order in which they came; no parts if it is whole."""

    schema: T.StructType
    parts: tuple[str, ...] = ()


@dataclass
class Registry:
    """An append-only history of definitions; a row is added only when one changes.

    A column that a table once has stays, with its type or a wider one, so rows
    written at any time can be read by the table's present columns: those written
    before a column came show NULL there. One writer at a time.
    """

    spark: SparkSession
    path: str
    _known: dict[str, Definition] = field(default_factory=dict)
    _step: int = -1

    def refresh(self) -> None:
        """Take in what has been added, by this process or another one."""
        try:
            rows = self.spark.read.schema(_ROWS).json(self.path).where(F.col("step") > self._step).collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return
            raise
        for row in sorted(rows, key=lambda r: r["step"]):
            known = self._known.get(row["name"])
            parts = known.parts if known else ()
            if row["part"] and row["part"] not in parts:
                parts = (*parts, row["part"])
            self._known[row["name"]] = Definition(T.StructType.fromJson(json.loads(row["schema"])), parts)
            self._step = max(self._step, row["step"])

    def get(self, name: str) -> Definition | None:
        if name not in self._known:
            self.refresh()
        return self._known.get(name)

    def declare(self, name: str, schema: T.StructType, part: str = "") -> Definition:
        """Make sure the table can hold rows of ``schema`` in ``part``; gives its definition then."""
        self.declare_all([(name, schema, part)])
        return self._known[name]

    def declare_all(self, wanted: Iterable[tuple[str, T.StructType, str]]) -> None:
        """The same for many tables and parts: the history is read, and added to, once at most."""
        wanted = list(wanted)
        if not self._changes(wanted):
            return
        self.refresh()
        changes = self._changes(wanted)
        if not changes:
            return
        rows = []
        for name, part, definition in changes:
            self._step += 1
            self._known[name] = definition
            rows.append((self._step, name, part, definition.schema.json()))
        self.spark.createDataFrame(pa.Table.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in rows])).coalesce(1).write.mode(
            "append"
        ).json(self.path)

    def _changes(self, wanted: Iterable[tuple[str, T.StructType, str]]) -> list[tuple[str, str, Definition]]:
        """What would have to be added, given what is known: (name, part, the definition then)."""
        known, changes = dict(self._known), []
        for name, schema, part in wanted:
            have = known.get(name)
            if have is not None and bool(have.parts) != bool(part):
                raise ValueError(f"table {name} {'has parts' if have.parts else 'is whole'}; it cannot be filled the other way")
            parts = have.parts if have else ()
            merged = merged_schema(have.schema, schema, name) if have else nullable(schema)
            if have is None or merged != have.schema or part and part not in parts:
                known[name] = Definition(merged, (*parts, part) if part and part not in parts else parts)
                changes.append((name, part, known[name]))
        return changes


def nullable(kind: T.DataType) -> T.DataType:
    """The type with every part of it nullable, as files of different age need it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    return kind


def merged_schema(have: T.StructType, more: T.StructType, name: str) -> T.StructType:
    """The columns of both, by name without case: those there first, each wide enough for both."""
    at = {f.name.lower(): i for i, f in enumerate(have.fields)}
    fields = list(have.fields)
    for new in more.fields:
        i = at.get(new.name.lower())
        if i is None:
            at[new.name.lower()] = len(fields)
            fields.append(T.StructField(new.name, nullable(new.dataType), True))
        else:
            old = fields[i]
            fields[i] = T.StructField(old.name, _wider(old.dataType, new.dataType, f"{name}.{old.name}"), True)
    return T.StructType(fields)


def _wider(have: T.DataType, new: T.DataType, name: str) -> T.DataType:
    new = nullable(new)
    if have == new or isinstance(new, T.NullType) or fits(new, have):
        return have
    if isinstance(have, T.NullType) or fits(have, new):
        return new
    if isinstance(have, T.StructType) and isinstance(new, T.StructType):
        return merged_schema(have, new, name)
    if isinstance(have, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_wider(have.elementType, new.elementType, name), True)
    if isinstance(have, T.StringType):
        return have
    raise ValueError(f"column {name} holds {have.simpleString()}, which cannot become {new.simpleString()}")


def as_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with all columns of the table, in its order: cast to its types, NULL where they have none."""
    given = {f.name.lower(): f for f in df.schema.fields}

    def column(f: T.StructField) -> Column:
        own = given.get(f.name.lower())
        if own is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        value = F.col(quoted(own.name))
        return (value if nullable(own.dataType) == f.dataType else aligned(value, nullable(own.dataType), f.dataType, f.name)).alias(f.name)

    if [f.name for f in df.schema.fields] == schema.fieldNames() and nullable(df.schema) == schema:
        return df
    return df.select(*[column(f) for f in schema.fields])
