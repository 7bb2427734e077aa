"""JSON held in string columns: inference, parsing, event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    detail,
    json_dataset,
    parse_details,
    rule_metric_rows,
    rule_metrics_by,
    rule_metrics_to_events,
    variant_details,
    variant_rule_metrics,
)
from ..plans.event_log import run_event_log
from ..scratch import scratch_dir
from ..sources import append_merge, append_once, read_merged
from .expectations import RULE_ROWS_SQL
from .inputs import BRONZE_SQL, INVOICE_RULES, INVOICE_RULES_SQL, bronze, table
from .registry import query


@query("""SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events""")
def json_infer_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return parse_details(events, "props").select("event_id", "event_type", "details_parsed.k")


@query("""SELECT k, count(*) AS records FROM (
      SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY k""")
def json_column_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A string column as a table of its own."""
    return (
        json_dataset(table(spark, sf_dir, "events"), "props")
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query(f"""WITH {BRONZE_SQL}
    SELECT file_name, CAST(0 AS BIGINT) AS dropped_records, name, dataset, passed_records, failed_records
    FROM ({RULE_ROWS_SQL.format(keys='file_name, ', group='GROUP BY file_name')})""")
def event_log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule metrics logged as events, parsed back and spread over rows.

    Appended twice under the same event ids: the second time adds nothing.
    """
    path = scratch_dir(spark, "event-log")
    metrics = rule_metrics_by(bronze(spark, sf_dir), INVOICE_RULES, "bronze", ["file_name"])
    events = rule_metrics_to_events(metrics, ["file_name"])
    append_once(events, path, "file_name")
    append_once(events, path, "file_name")
    return rule_metric_rows(parse_details(read_merged(spark, path))).drop("details")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def event_log_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow over a raw log, run twice; the second run adds nothing."""
    path = scratch_dir(spark, "parsed-log")
    raw = "raw_" + path.rsplit("-", 1)[1]
    table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "props AS details"
    ).createOrReplaceTempView(raw)
    for _ in range(2):
        logged = run_event_log(spark, raw, path, view=f"log_{raw}")
    return logged.select("event_id", "details_parsed.k")


@query("""SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL AS segment
    FROM supplier UNION ALL
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def schema_merge_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending rows with one more column; the earlier rows have NULL there."""
    path = scratch_dir(spark, "merge")
    suppliers = table(spark, sf_dir, "supplier")
    append_merge(
        suppliers.selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance"), path
    )
    append_merge(
        table(spark, sf_dir, "customer").selectExpr(
            "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
        ),
        path,
    )
    return read_merged(spark, path).select("id", "name", "balance", "segment")


# Three kinds of events in one column, as they stand in an event log; the same in Spark and DuckDB.
EVENT_DETAILS = """CASE event_id % 3
    WHEN 0 THEN concat('{"user_action":{"action":"', event_type, '","user_id":', user_id, '}}')
    WHEN 1 THEN concat('{"flow_definition":{"output_dataset":"', event_type, '","input_datasets":["raw","u', user_id, '"]}}')
    ELSE concat('{"flow_progress":{"metrics":{"num_output_rows":', user_id, '},"data_quality":{"dropped_records":',
      event_id % 5, ',"expectations":[{"name":"a","dataset":"', event_type, '","passed_records":', user_id,
      ',"failed_records":1},{"name":"b","dataset":"', event_type, '","passed_records":2,"failed_records":', event_id % 7,
      '}]}}}') END"""


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type END AS action,
      CASE WHEN event_id % 3 = 0 THEN user_id::BIGINT END AS user_id,
      CASE WHEN event_id % 3 = 1 THEN event_type END AS output_dataset,
      CASE WHEN event_id % 3 = 1 THEN 'u' || user_id END AS last_input,
      CASE WHEN event_id % 3 = 2 THEN user_id::BIGINT END AS num_output_rows
    FROM events""")
def event_variant_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of three kinds of events from one VARIANT column: no inference, no schema."""
    events = variant_details(table(spark, sf_dir, "events").selectExpr("event_id", f"{EVENT_DETAILS} AS details"))
    return events.select(
        "event_id",
        detail("$.user_action.action", "string").alias("action"),
        detail("$.user_action.user_id", "bigint").alias("user_id"),
        detail("$.flow_definition.output_dataset", "string").alias("output_dataset"),
        detail("$.flow_definition.input_datasets[1]", "string").alias("last_input"),
        detail("$.flow_progress.metrics.num_output_rows", "bigint").alias("num_output_rows"),
    )


@query("""SELECT event_id, (event_id % 5)::BIGINT AS dropped_records, name, event_type AS dataset,
      CASE name WHEN 'a' THEN user_id ELSE 2 END::BIGINT AS passed_records,
      CASE name WHEN 'a' THEN 1 ELSE event_id % 7 END::BIGINT AS failed_records
    FROM events, (SELECT unnest(['a', 'b']) AS name) WHERE event_id % 3 = 2""")
def event_variant_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule metrics exploded from the same column; the other kinds of events give no rows."""
    events = table(spark, sf_dir, "events").selectExpr("event_id", f"{EVENT_DETAILS} AS details")
    return variant_rule_metrics(variant_details(events).drop("details"))


@query(f"""WITH {BRONZE_SQL}, judged AS (
    SELECT file_name, coalesce({INVOICE_RULES_SQL}, false) AS ok FROM bronze)
    SELECT file_name, count(*) FILTER (NOT ok) AS dropped_records, count(*) FILTER (ok) AS num_output_rows
    FROM judged GROUP BY file_name""")
def batch_dropped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the drop policy takes out, as events of a batch job tell them."""
    metrics = rule_metrics_by(bronze(spark, sf_dir), INVOICE_RULES, "silver", ["file_name"], drops=True)
    events = variant_details(rule_metrics_to_events(metrics, ["file_name"]))
    return events.select(
        "file_name",
        detail("$.flow_progress.data_quality.dropped_records", "bigint").alias("dropped_records"),
        detail("$.flow_progress.metrics.num_output_rows", "bigint").alias("num_output_rows"),
    )
