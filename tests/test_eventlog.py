from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from weirflow.functions import infer_json_schema
from weirflow.operators import (
    append_new_events,
    json_dataset,
    parse_details,
    rule_metric_rows,
    rule_metrics_by,
    rule_metrics_to_events,
)
from weirflow.plans.event_log import run_event_log

DOCUMENTS = [
    {"k": 1, "f": 1.5, "n": None, "s": "a", "o": {"x y": [1, 2], "z": [{"q": 1}]}, "e": []},
    {"k": 2, "mixed": "t", "f": 2.0, "d": 1e300, "big": 123456789012345678901, "b": True},
    {"mixed": 1, "o": {"z": [{"r": "OBJECT<x>"}]}},
]


@pytest.mark.parametrize(
    "texts",
    [
        [json.dumps(d) for d in DOCUMENTS],
        [json.dumps(d) for d in DOCUMENTS] + ["{broken"],
        ['{"OBJECT<a": 1, "b`c": {"d": 2}}'],
        ['{"a": 1}', '{"a": 1.25}', '{"a": 12345678901234567890}'],
        ['{"a": [1, "x"]}', '{"a": [null]}'],
        ['{"a": {"b": 1}}', '{"a": "text"}'],
    ],
)
def test_inferred_schema_is_that_of_the_json_reader(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "details STRING")
    expected = spark.read.json(df.rdd.map(lambda row: row[0])).schema
    assert infer_json_schema(df, "details").simpleString() == expected.simpleString()


def test_schema_of_no_documents(spark):
    df = spark.createDataFrame([(None,), ("",)], "details STRING")
    assert infer_json_schema(df, "details") == T.StructType([])


def test_sampled_schema(spark):
    df = spark.range(1000).selectExpr("""concat('{"k":', id, '}') AS details""")
    assert infer_json_schema(df, "details", sampling_ratio=0.1).simpleString() == "struct<k:bigint>"


EVENTS = [
    (1, json.dumps({"user_action": {"action": "CREATE"}})),
    (2, json.dumps({"flow_definition": {"output_dataset": "silver", "input_datasets": ["bronze"]}})),
    (3, json.dumps({"flow_progress": {"metrics": {"num_output_rows": 10}, "data_quality": {
        "dropped_records": 2, "expectations": [
            {"name": "r1", "dataset": "silver", "passed_records": 9, "failed_records": 1},
            {"name": "r2", "dataset": "silver", "passed_records": 8, "failed_records": 2}]}}})),
    (4, "not json"),
]


def test_events_of_all_kinds(spark, rows):
    log = spark.createDataFrame(EVENTS, "event_id INT, details STRING")
    parsed = parse_details(log)
    assert parsed.select("details_parsed.flow_definition.input_datasets").filter(
        "event_id = 2").first()[0] == ["bronze"]
    assert parsed.filter("event_id = 4").select("details_parsed._corrupt_record").first()[0] == "not json"
    assert rows(rule_metric_rows(parsed).drop("details")) == [
        (3, 2, "r1", "silver", 9, 1),
        (3, 2, "r2", "silver", 8, 2),
    ]


def test_known_schema_needs_no_job(spark, plan):
    log = spark.createDataFrame(EVENTS, "event_id INT, details STRING")
    schema = T.StructType().add("user_action", T.StructType().add("action", "string"))
    assert parse_details(log, schema=schema).select("details_parsed.user_action.action").first()[0] == "CREATE"


def test_json_column_as_a_table(spark, rows):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":2,"b":"x"}',), (None,), (" ",)], "j STRING")
    assert rows(json_dataset(df, "j")) == [(1, None), (2, "x")]


def test_metrics_to_events_and_back(spark, rows):
    df = spark.createDataFrame([("f", 1), ("f", None), ("g", 3)], "file STRING, v INT")
    metrics = rule_metrics_by(df, {"v": "v IS NOT NULL", "big": "v > 2"}, "silver", ["file"])
    parsed = parse_details(rule_metrics_to_events(metrics, ["file"]))
    back = rule_metric_rows(parsed).select(*metrics.columns)
    assert rows(back) == rows(metrics)


def test_events_are_appended_once(spark, rows):
    log = spark.createDataFrame([(1, "a"), (2, "b")], "event_id INT, details STRING")
    new = spark.createDataFrame([(2, "b"), (3, "c")], "event_id INT, details STRING")
    assert rows(append_new_events(new, log)) == [(3, "c")]
    assert rows(append_new_events(new, None)) == [(2, "b"), (3, "c")]


def test_inference_and_parsing_start_no_python_worker(spark, plan, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert "Python" not in plan(parse_details(events, "props"))


def test_event_log_flow_gains_fields_and_runs_again(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    events = spark.createDataFrame(EVENTS[:1], "event_id INT, details STRING")
    events.createOrReplaceTempView("raw_log")
    run_event_log(spark, "raw_log", path, "parsed_log")
    assert spark.table("parsed_log").select("details_parsed.user_action.action").first()[0] == "CREATE"
    events = spark.createDataFrame(EVENTS[:3], "event_id INT, details STRING")
    events.createOrReplaceTempView("raw_log")
    for _ in range(2):
        log = run_event_log(spark, "raw_log", path, "parsed_log")
    assert rows(log.select("event_id", "details_parsed.user_action.action",
                           "details_parsed.flow_progress.metrics.num_output_rows")) == [
        (1, "CREATE", None), (2, None, None), (3, None, 10)]


def test_event_log_flow_without_a_key_appends_every_time(spark, tmp_path):
    spark.createDataFrame(EVENTS, "event_id INT, details STRING").createOrReplaceTempView("raw_log")
    for _ in range(2):
        log = run_event_log(spark, "raw_log", str(tmp_path / "log"), key=None)
    assert log.count() == 8
