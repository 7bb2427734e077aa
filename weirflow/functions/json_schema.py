"""Schema of the JSON documents held in a string column."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_FIELD = "_corrupt_record"


def infer_json_schema(
    df: DataFrame, column: str, sampling_ratio: float | None = None
) -> T.StructType:
    """Infer one struct type that fits every JSON object in ``column``.

    One aggregate over the column, merged map-side first, all in the JVM; only
    the type itself comes to the driver. It costs a pass over the data: give a
    ``sampling_ratio`` or a known schema to avoid that. As with Spark's JSON
    reader, a ``_corrupt_record`` field is added when some text is no JSON.
    """
    texts = df.select(F.col(column).alias("j")).filter("j IS NOT NULL AND trim(j) != ''")
    if sampling_ratio is not None:
        texts = texts.sample(fraction=sampling_ratio, seed=0)
    found = texts.select(F.expr("try_parse_json(j)").alias("v")).agg(
        F.expr("schema_of_variant_agg(v)").alias("ddl"),
        F.count_if(F.col("v").isNull()).alias("broken"),
    ).first()
    inferred = _as_json_reader_type(_parse_variant_ddl(found["ddl"] or "VOID"))
    fields = list(inferred.fields) if isinstance(inferred, T.StructType) else []
    if found["broken"]:
        fields.insert(0, T.StructField(CORRUPT_FIELD, T.StringType()))
    return T.StructType(fields)


def _parse_variant_ddl(ddl: str) -> T.DataType:
    # OBJECT is what variant types call a struct; names in backticks stay as they are.
    parts = re.split(r"(`(?:[^`]|``)*`)", ddl)
    parts[::2] = [part.replace("OBJECT<", "STRUCT<") for part in parts[::2]]
    return T.DataType.fromDDL("".join(parts))


def _as_json_reader_type(found: T.DataType) -> T.DataType:
    """The type Spark's JSON reader would have chosen for the same values."""
    if isinstance(found, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _as_json_reader_type(f.dataType)) for f in found.fields]
        )
    if isinstance(found, T.ArrayType):
        return T.ArrayType(_as_json_reader_type(found.elementType))
    if isinstance(found, T.DecimalType) and found.scale > 0:
        return T.DoubleType()
    if isinstance(found, (T.NullType, T.VariantType)):
        return T.StringType()
    return found
