"""File sources, batch and incremental, that lose nothing they cannot parse."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.transforms import (
    FILE_COLUMN,
    RESCUE_COLUMN,
    extended,
    quoted,
    strip_provenance,
    without_trailing_provenance,
)


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "csv",
    *,
    streaming: bool = True,
    header: bool = True,
    max_files: int | None = None,
    max_bytes: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A landing folder as rows of ``schema``, plus `_rescue` and `InputFileName`.

    ``streaming`` reads only files not seen before. ``max_files`` and
    ``max_bytes`` bound one micro-batch; with neither, one batch takes all that
    is there. Bound it on a large backlog: a lost driver costs the open batch.

    `_rescue` holds what did not fit: the raw record where a value or the number
    of fields is wrong, and for JSON the keys the schema lacks, at any depth (a
    key whose value lacks some is kept whole). It is NULL for a clean record.
    Formats that carry their own schema have nothing to rescue.

    A CSV header must name the schema's columns in order, else the job stops;
    the option ``enforceSchema=true`` reads by position whatever the header
    says. Fields that the flow itself adds are left out of the result; where
    such a field stands before others in the schema it is read over in the file.
    """
    declared, schema = without_trailing_provenance(schema), strip_provenance(schema)
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if streaming and max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)

    if file_format == "csv":
        if header and "enforceschema" not in {key.lower() for key in options or {}}:
            reader = reader.option("enforceSchema", False)
        return _csv(reader.option("header", header), path, declared, schema)
    if file_format == "json":
        return _json(reader, path, schema, options or {})
    found = reader.format(file_format).schema(schema).load(path)
    return found.select(
        "*", F.lit(None).cast("string").alias(RESCUE_COLUMN), _file_name()
    )


def _file_name() -> Column:
    return F.col("_metadata.file_path").alias(FILE_COLUMN)


def _csv(reader, path: str, declared: T.StructType, schema: T.StructType) -> DataFrame:
    raw = (
        reader.schema(extended(declared, **{RESCUE_COLUMN: "string"}))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUE_COLUMN)
        .csv(path)
    )
    # The parser marks a record corrupt only for the columns it is asked for. So
    # the rescue column is tied to all of them; else a later select of a few
    # columns, or a filter on it, would change which records count as rescued.
    # A hash is never below the least int, but the optimizer does not know that.
    columns = [F.col(quoted(name)) for name in schema.fieldNames()]
    everything = [F.col(quoted(name)) for name in declared.fieldNames()]
    rescued = F.when(F.hash(*everything) >= F.lit(-(2**31)), F.col(RESCUE_COLUMN))
    return raw.select(*columns, rescued.alias(RESCUE_COLUMN), _file_name())


def _json(reader, path: str, schema: T.StructType, options: Mapping[str, str]) -> DataFrame:
    # Lines are read as text, since the JSON reader forgets keys it does not
    # know. Each is parsed once more, to a variant, whose keys at all depths are
    # held against the schema's; only what has others is looked at again.
    if str(options.get("multiLine", "false")).lower() == "true":
        raise ValueError("JSON landing files hold one object per line")
    lines = reader.text(path).select("value", _file_name()).filter(F.trim("value") != "")
    nested = [f for f in schema.fields if _has_struct(f.dataType)]
    known = F.array(*[F.lit(name) for name in schema.fieldNames()]).cast("array<string>")

    def lost(key: Column, text: Column) -> Column:
        deeper = [(key == f.name) & _loses(F.try_parse_json(text), f.dataType) for f in nested]
        return reduce(Column.__or__, deeper, ~F.array_contains(known, key))

    more = F.to_json(F.map_filter(F.from_json("value", "map<string,string>"), lost))
    parsed = lines.select(
        "value",
        FILE_COLUMN,
        F.try_parse_json("value").alias("variant"),
        F.from_json(
            "value",
            extended(schema, **{RESCUE_COLUMN: "string"}),
            {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUE_COLUMN},
        ).alias("parsed"),
    )
    # What is no variant may still be an object to the JSON reader, such as one with
    # a key that stands twice: its own keys are read from the text then.
    own = F.size(F.array_except(F.json_object_keys("value"), known)) > 0
    has_more = F.when(F.col("variant").isNull(), F.coalesce(own, F.lit(False))).otherwise(_loses(F.col("variant"), schema))
    rescued = F.coalesce(F.col(f"parsed.{RESCUE_COLUMN}"), F.when(has_more, more))
    fields = [F.col(f"parsed.{quoted(name)}").alias(name) for name in schema.fieldNames()]
    return parsed.select(*fields, rescued.alias(RESCUE_COLUMN), FILE_COLUMN)


def _has_struct(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_struct(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_struct(kind.valueType)
    return isinstance(kind, T.StructType)


def _loses(value: Column, kind: T.DataType) -> Column:
    """Whether a variant meant for this type holds a key that the type lacks, at any depth; never NULL.

    A variant of another shape than the type (a number for an object) loses
    nothing here: the JSON reader rescues the whole record.
    """
    if isinstance(kind, T.StructType):
        known = F.array(*[F.lit(name) for name in kind.fieldNames()]).cast("array<string>")
        children = F.try_variant_get(value, "$", "map<string,variant>")
        own = F.coalesce(F.size(F.array_except(F.map_keys(children), known)) > 0, F.lit(False))
        deeper = [
            _loses(F.try_variant_get(value, _path(f.name), "variant"), f.dataType) for f in kind.fields if _has_struct(f.dataType)
        ]
        return reduce(Column.__or__, deeper, own)
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        return F.coalesce(F.exists(items, lambda x: _loses(x, kind.elementType)), F.lit(False))
    values = F.map_values(F.try_variant_get(value, "$", "map<string,variant>"))
    return F.coalesce(F.exists(values, lambda x: _loses(x, kind.valueType)), F.lit(False))


def _path(name: str) -> str:
    """The place of a key below a variant; quotes in a name would need the other kind of quotes."""
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"a field of nested JSON cannot have both kinds of quotes in its name: {name}")
    return f"$[{quote}{name}{quote}]"


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column a string."""
    return spark.read.option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table whose files may differ in columns; missing ones are NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)
