"""Event-log analysis: JSON text to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_schema import CORRUPT_FIELD, infer_json_schema
from .expectations import METRICS_SCHEMA

# The part of a flow-progress event that the quality metrics live in.
DETAILS_SCHEMA = f"""
flow_progress STRUCT<
  metrics: STRUCT<num_output_rows: BIGINT>,
  data_quality: STRUCT<
    dropped_records: BIGINT,
    expectations: ARRAY<STRUCT<{METRICS_SCHEMA}>>
  >
>
"""


def parse_details(
    df: DataFrame,
    column: str = "details",
    schema: T.StructType | str | None = None,
    target: str = "details_parsed",
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Add ``target``: the JSON text of ``column`` as a typed struct.

    Without a ``schema`` it is inferred first, which is a pass over the column.
    """
    if schema is None:
        schema = infer_json_schema(df, column, sampling_ratio)
    return df.withColumn(
        target, F.from_json(column, schema, {"columnNameOfCorruptRecord": CORRUPT_FIELD})
    )


def json_dataset(
    df: DataFrame, column: str, schema: T.StructType | None = None
) -> DataFrame:
    """The JSON objects of a string column as a table of their own, a column per key."""
    if schema is None:
        schema = infer_json_schema(df, column)
    texts = df.filter(F.trim(column) != "").select(F.col(column).alias("_json"))
    return parse_details(texts, "_json", schema, "_parsed").select("_parsed.*")


def variant_details(df: DataFrame, column: str = "details", target: str = "details_variant") -> DataFrame:
    """Add ``target``: the JSON text of ``column`` as a VARIANT, NULL where it is no JSON.

    Events of any kind fit into it. Nothing is inferred, so there is no pass over
    the data first, and a kind of event that comes later changes no schema. Take
    out what is wanted with :func:`detail` and :func:`exploded_detail`.
    """
    return df.withColumn(target, F.try_parse_json(column))


def detail(path: str, kind: str, column: str = "details_variant") -> Column:
    """One value of a variant: at ``path`` such as ``$.flow_progress.metrics``, as a ``kind`` such as ``bigint``.

    NULL where the event has no such place, or holds there what is no such value.
    """
    return F.try_variant_get(column, path, kind)


def exploded_detail(df: DataFrame, path: str, target: str = "item", column: str = "details_variant") -> DataFrame:
    """One row per element of the array at ``path``, as a VARIANT ``target``; rows without any give none."""
    return df.withColumn(target, F.explode(F.try_variant_get(column, path, "array<variant>")))


def variant_rule_metrics(df: DataFrame, column: str = "details_variant") -> DataFrame:
    """`rule_metric_rows` from variant details: one row per rule of each flow-progress event."""
    kept = [c for c in df.columns if c != column]
    quality = "$.flow_progress.data_quality"
    each = exploded_detail(df, f"{quality}.expectations", "_rule", column)
    dropped = detail(f"{quality}.dropped_records", "bigint", column).alias("dropped_records")
    fields = [detail(f"$.{f.name}", f.dataType.simpleString(), "_rule").alias(f.name) for f in T.StructType.fromDDL(METRICS_SCHEMA)]
    return each.select(*kept, dropped, *fields)


def rule_metrics_to_events(metrics: DataFrame, keys: list[str], details: str = "details") -> DataFrame:
    """Per group of ``keys``, one flow-progress event that holds its rule metrics.

    The input has a row per rule and group (see `rule_metrics_by`), so a group
    is as long as the rule set. Where it has a column ``dropped_records``, events
    say how many rows the drop policy took out, and count the others as output.
    """
    dropped = F.max("dropped_records") if "dropped_records" in metrics.columns else F.lit(0).cast("bigint")
    expectations = F.sort_array(
        F.collect_list(F.struct("name", "dataset", "passed_records", "failed_records"))
    )
    progress = F.struct(
        F.struct(
            F.struct(
                (F.max(F.col("passed_records") + F.col("failed_records")) - dropped).alias("num_output_rows")
            ).alias("metrics"),
            F.struct(
                dropped.alias("dropped_records"),
                expectations.alias("expectations"),
            ).alias("data_quality"),
        ).alias("flow_progress")
    )
    return metrics.groupBy(*keys).agg(F.to_json(progress).alias(details))


def rule_metric_rows(parsed: DataFrame, column: str = "details_parsed") -> DataFrame:
    """One row per rule of each flow-progress event; other events give none."""
    quality = f"{column}.flow_progress.data_quality"
    kept = [c for c in parsed.columns if c != column]
    return parsed.select(
        *kept,
        F.col(f"{quality}.dropped_records").alias("dropped_records"),
        F.inline(f"{quality}.expectations"),
    ).select(*kept, "dropped_records", "name", "dataset", "passed_records", "failed_records")


def append_new_events(
    events: DataFrame, logged: DataFrame | None, key: str = "event_id"
) -> DataFrame:
    """The events the log lacks, so that appending twice adds nothing."""
    if logged is None:
        return events
    return events.join(logged.select(key), key, "left_anti")
