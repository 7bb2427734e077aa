"""The event-log flow: raw log to typed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.eventlog import parse_details
from ..sources.files import read_merged
from ..sources.writers import append_merge, append_once


def run_event_log(
    spark: SparkSession,
    raw_table: str,
    path: str,
    view: str = "event_log",
    key: str | None = "event_id",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Parse the details of a raw event log and append the events to the table at ``path``.

    The parsed log can be queried as ``view`` in this session. With a ``key``
    only events the table lacks are appended, so the flow can be run again;
    without one every run appends all of them. Details that gain fields over
    time add columns; `read_merged` gives the table with all of them.
    """
    parsed = parse_details(spark.table(raw_table), schema=schema)
    parsed.createOrReplaceTempView(view)
    if key is None:
        append_merge(parsed, path)
    else:
        append_once(parsed, path, key)
    return read_merged(spark, path)
