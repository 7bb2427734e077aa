"""Incremental tables: exactly once, in steps, side by side."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators import expect_keep, parse_details, rule_metric_rows, union_all
from weirflow.operators.eventlog import DETAILS_SCHEMA
from weirflow.plans import Contract
from weirflow.streaming import (
    CheckedStream,
    LandingSource,
    StreamTables,
    entity_flow_from_config,
    log_events,
    run_entity_flow,
    run_union_flow,
    settle,
)

COLLATERAL = Contract(
    "collateral",
    T.StructType().add("id", "string").add("date", "timestamp").add("currency_code", "string")
    .add("value", "double").add("type", "string"),
    ("id IS NOT NULL", "value >= 0", "length(currency_code) = 3"),
)


@pytest.fixture
def at(spark):
    return F.expr("TIMESTAMP '2024-05-06 07:08:09'")


@pytest.fixture
def tables(spark, tmp_path):
    return StreamTables(spark, str(tmp_path / "store"))


def drop(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def entity(tmp_path, **settings):
    config = {
        "landing_zone": str(tmp_path / "landing"),
        "invalid_format_path": str(tmp_path / "invalid"),
        "file_format": "json",
        "max_files": "1",
    }
    return entity_flow_from_config(COLLATERAL, config, **settings)


def good(i):
    return json.dumps({"id": f"c{i}", "currency_code": "EUR", "value": i})


FIRST = [
    good(1), good(2), json.dumps({"id": "c3", "currency_code": "EURO", "value": -1}),
    json.dumps({"currency_code": "EUR", "value": 1}), '{"id": "cut',
]


@pytest.mark.parametrize("single_pass", [False, True])
def test_entity_flow_in_two_runs(spark, tmp_path, tables, rows, at, single_pass):
    flow = entity(tmp_path, single_pass=single_pass)
    drop(tmp_path / "landing", "one.json", *FIRST)
    first = run_entity_flow(tables, flow, at)
    assert {n: first.tables[n].count() for n in ("bronze", "silver", "quarantine")} == {
        "bronze": 5, "silver": 2, "quarantine": 2}
    assert rows(first.tables["quarantine"].select("id", "_failed_rules")) == [
        ("c3", ["value >= 0", "length(currency_code) = 3"]),
        (None, ["id IS NOT NULL"]),
    ]
    counted = "collateral_checked" if single_pass else "collateral_silver"
    assert rows(first.metrics(spark)) == [
        ("id IS NOT NULL", counted, 3, 1),
        ("length(currency_code) = 3", counted, 3, 1),
        ("value >= 0", counted, 3, 1),
    ]
    name = F.element_at(F.split("InputFileName", "/"), -1)
    assert rows(first.tables["ctl"].select(name, "rows_OK", "rows_KO")) == [("one.json", 2, 1)]
    assert rows(first.tables["reconciliation"].select(name, "rows_OK", "rows_KO")) == [
        ("one.json", 2, 2)]
    aside = spark.read.json(flow.invalid_path).collect()
    assert [(r["record"], r["path"].endswith("one.json")) for r in aside] == [('{"id": "cut', True)]

    again = run_entity_flow(tables, flow, at)
    assert {n: again.tables[n].count() for n in ("bronze", "silver", "quarantine")} == {
        "bronze": 5, "silver": 2, "quarantine": 2}
    assert sum(stream.input_rows for stream in again.streams.values()) == 0
    assert rows(again.metrics(spark).select("passed_records", "failed_records").distinct()) == [(0, 0)]

    drop(tmp_path / "landing", "two.json", good(7))
    drop(tmp_path / "landing", "three.json", json.dumps({"id": "c9", "value": 1}))
    last = run_entity_flow(tables, flow, at)
    assert last.streams["collateral_bronze"].input_rows == 2
    assert len([b for b in last.streams["collateral_bronze"].batches.values() if b["numInputRows"]]) == 2
    assert rows(last.tables["reconciliation"].select(name, "rows_OK", "rows_KO")) == [
        ("one.json", 2, 2), ("three.json", 0, 1), ("two.json", 1, 0)]
    assert rows(last.tables["ctl"].select(name, "rows_OK", "rows_KO")) == [
        ("one.json", 2, 1), ("two.json", 1, None)]
    assert spark.read.json(flow.invalid_path).count() == 1


def test_flow_without_an_invalid_path_quarantines_what_it_cannot_read(tmp_path, tables):
    drop(tmp_path / "landing", "one.json", *FIRST)
    flow = entity_flow_from_config(COLLATERAL, {"landing_zone": str(tmp_path / "landing")})
    done = run_entity_flow(tables, flow)
    assert done.tables["quarantine"].count() == 3
    assert done.tables["quarantine"].filter("_rescue = '{\"id\": \"cut'").count() == 1


def test_flow_needs_a_landing_zone():
    with pytest.raises(ValueError, match="landing_zone"):
        entity_flow_from_config(COLLATERAL, {})


def test_settings_reach_the_source():
    config = {"landing_zone": "/x", "file_format": "csv", "max_files": "3", "max_bytes": "99"}
    source = entity_flow_from_config(COLLATERAL, config, entity_tag="PT").source
    assert (source.landing, source.file_format, source.entity) == ("/x", "csv", "PT")
    assert (source.max_files, source.max_bytes) == (3, 99)


INVOICE = (
    T.StructType().add("InvoiceNo", "integer").add("Description", "string").add("CustomerID", "integer")
)


def invoice_sources(tmp_path, rules):
    return [
        LandingSource(f"bronze_{e.lower()}_invoice", str(tmp_path / e), e, INVOICE, rules=rules)
        for e in ("ES", "PT")
    ]


def test_union_flow(spark, tmp_path, tables, rows, at):
    head = "InvoiceNo,Description,CustomerID"
    drop(tmp_path / "ES", "a.csv", head, "1,x,10", "C2,y,11", "3,Discount,12")
    drop(tmp_path / "PT", "b.csv", head, "4,z,", "5,,13")
    sources = invoice_sources(tmp_path, {"valid_invoice": "Description != 'Discount'"})
    silver_rules = {"Valid InvoiceNo": "InvoiceNo IS NOT NULL", "Valid CustomerID": "CustomerID IS NOT NULL"}
    rechecks = {"rechecked": {"valid_entity": "length(entity) = 2", "one": "InvoiceNo = 1"}}

    def run():
        return run_union_flow(
            tables, sources, "silver_invoice", silver_rules, "invoice_ctl", rechecks, at
        )

    done = run()
    assert rows(done.tables["silver_invoice"].select("InvoiceNo", "Entity")) == [
        (1, "ES"), (3, "ES"), (5, "PT")]
    assert rows(done.metrics(spark)) == [
        ("Valid CustomerID", "silver_invoice", 4, 1),
        ("Valid InvoiceNo", "silver_invoice", 4, 1),
        ("one", "rechecked", 1, 2),
        ("valid_entity", "rechecked", 3, 0),
        ("valid_invoice", "bronze_es_invoice", 2, 1),
        ("valid_invoice", "bronze_pt_invoice", 1, 1),
    ]
    assert rows(done.tables["invoice_ctl"].select("records", "Entity")) == [(1, "PT"), (2, "ES")]
    assert done.tables["bronze_es_invoice"].filter("_rescue IS NOT NULL").count() == 1

    log_events(tables, done)
    # Each source has events of its own, for every table its rows reach.
    assert rows(rule_metric_rows(parse_details(log_events(tables, done), schema=DETAILS_SCHEMA))
                .groupBy("dataset", "name").agg(F.sum("dropped_records"), F.sum("passed_records"))) == [
        ("bronze_es_invoice", "valid_invoice", 0, 2),
        ("bronze_pt_invoice", "valid_invoice", 0, 1),
        ("rechecked", "one", 0, 1),
        ("rechecked", "valid_entity", 0, 3),
        ("silver_invoice", "Valid CustomerID", 2, 4),
        ("silver_invoice", "Valid InvoiceNo", 2, 4),
    ]

    drop(tmp_path / "PT", "c.csv", head, "6,w,14")
    more = run()
    assert log_events(tables, more).count() == 2 * 3 + 3
    assert more.tables["silver_invoice"].count() == 4
    assert more.tables["rechecked"].count() == 4
    assert more.streams["silver_invoice"].input_rows == 1
    assert rows(more.tables["invoice_ctl"].select("records", "Entity")) == [(1, "PT"), (1, "PT"), (2, "ES")]


def test_metrics_add_up_over_many_batches(spark, tmp_path, tables):
    for i in range(12):
        drop(tmp_path / "landing", f"{i:02d}.json", good(i), json.dumps({"id": None}))
    source = LandingSource("t", str(tmp_path / "landing"), "ES", COLLATERAL.schema, "json", max_files=1)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "8")
    try:
        (done,) = settle(tables.append(expect_keep(source.open(spark), {"id": "id IS NOT NULL"}, "t"), "t"))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    counted = CheckedStream(done, {"id": "id IS NOT NULL"}, drops=False)
    assert counted.metric_rows() == [("id", "t", 12, 12)]
    assert len({event[0] for event in counted.events()}) == 12


def test_max_bytes_bounds_a_batch(spark, tmp_path, tables):
    for i in range(4):
        drop(tmp_path / "landing", f"{i}.json", *[good(j) for j in range(50)])
    source = LandingSource("t", str(tmp_path / "landing"), "ES", COLLATERAL.schema, "json", max_bytes=3000)
    (done,) = settle(tables.append(source.open(spark), "t"))
    assert len([b for b in done.batches.values() if b["numInputRows"]]) > 1
    assert tables.read("t").count() == 200


def test_ingestion_time_is_one_per_batch(spark, tmp_path, tables):
    for i in range(2):
        drop(tmp_path / "landing", f"{i}.json", good(1), good(2))
    source = LandingSource("t", str(tmp_path / "landing"), "ES", COLLATERAL.schema, "json", max_files=1)
    settle(tables.append(source.open(spark), "t"))
    times = tables.read("t").groupBy("InputFileName").agg(F.countDistinct("IngestionTime").alias("n"))
    assert [r["n"] for r in times.collect()] == [1, 1]
    assert tables.read("t").select("IngestionTime").distinct().count() == 2


def test_streams_are_united_by_position(spark, tmp_path, tables):
    for name in ("a", "b"):
        drop(tmp_path / name, "x.json", good(1))
    frames = [
        LandingSource(n, str(tmp_path / n), n, COLLATERAL.schema, "json").open(spark) for n in ("a", "b")
    ]
    settle(tables.append(union_all(frames), "u"))
    assert tables.read("u").count() == 2
    with pytest.raises(ValueError):
        union_all([frames[0], frames[1].drop("_rescue")])


def test_a_failing_stream_stops_the_others(spark, tmp_path, tables):
    drop(tmp_path / "landing", "x.json", good(1))
    source = LandingSource("t", str(tmp_path / "landing"), "ES", COLLATERAL.schema, "json")
    fails = source.open(spark).withColumn("bad", F.expr("raise_error('stop here')"))
    with pytest.raises(Exception, match="stop here"):
        settle(tables.append(fails, "fails"), tables.append(source.open(spark), "fine"))
    assert not spark.streams.active
    (done,) = settle(tables.append(source.open(spark), "fine"))
    assert tables.read("fine").count() == 1


def test_empty_landing_folder(spark, tmp_path, tables):
    (tmp_path / "landing").mkdir()
    done = run_entity_flow(tables, entity(tmp_path))
    assert {n: done.tables[n].count() for n in done.tables} == {
        "bronze": 0, "silver": 0, "quarantine": 0, "ctl": 0, "reconciliation": 0}
