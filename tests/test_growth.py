"""Flows that change from run to run: sources, columns, drivers that end, batches that fail."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators import expect_drop, parse_details, rule_metric_rows
from weirflow.operators.eventlog import DETAILS_SCHEMA
from weirflow.plans import Contract
from weirflow.streaming import (
    CountTable,
    LandingSource,
    StreamTables,
    entity_flow_from_config,
    log_events,
    run_entity_flow,
    run_union_flow,
    settle,
)
from weirflow.streaming import counts, flows
from weirflow.streaming.registry import Registry, merged_schema

INVOICE = T.StructType().add("InvoiceNo", "integer").add("Description", "string").add("CustomerID", "integer")
HEAD = "InvoiceNo,Description,CustomerID"
RULES = {"numbered": "InvoiceNo IS NOT NULL"}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


@pytest.fixture
def tables(spark, root):
    return StreamTables(spark, root)


def drop(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def sources(tmp_path, *entities, **settings):
    return [LandingSource(f"bronze_{e.lower()}", str(tmp_path / e), e, INVOICE, rules=RULES, **settings) for e in entities]


def silver(tables, sources, rows, **settings):
    done = run_union_flow(tables, sources, "silver", RULES, "ctl", **settings)
    return done, rows(done.tables["silver"].select("InvoiceNo", "Entity"))


def test_sources_come_go_and_change_places(spark, tmp_path, root, rows):
    for i, e in enumerate(("ES", "PT", "UK")):
        drop(tmp_path / e, "a.csv", HEAD, f"{i},x,1", "C1,y,2")
    _, got = silver(StreamTables(spark, root), sources(tmp_path, "ES", "PT"), rows)
    assert got == [(0, "ES"), (1, "PT")]
    drop(tmp_path / "PT", "b.csv", HEAD, "11,x,1")
    _, got = silver(StreamTables(spark, root), sources(tmp_path, "UK", "PT", "ES"), rows)
    assert got == [(0, "ES"), (1, "PT"), (11, "PT"), (2, "UK")]
    drop(tmp_path / "UK", "c.csv", HEAD, "22,x,1")
    done, got = silver(StreamTables(spark, root), sources(tmp_path, "UK"), rows, rechecks={"again": {"big": "InvoiceNo > 9"}})
    assert got == [(0, "ES"), (1, "PT"), (11, "PT"), (2, "UK"), (22, "UK")]
    assert rows(done.tables["ctl"].groupBy("Entity").agg(F.sum("records"))) == [("ES", 1), ("PT", 2), ("UK", 2)]
    # A table that is new takes in all the rows its source has had.
    assert rows(done.tables["again"].select("InvoiceNo")) == [(2,), (22,)]
    assert rows(done.metrics(spark)) == [("big", "again", 1, 1), ("numbered", "bronze_uk", 1, 0), ("numbered", "silver", 1, 0)]
    assert StreamTables(spark, root).view("silver", "all_of_silver").count() == 5
    assert spark.sql("SELECT max(InvoiceNo) FROM all_of_silver").first()[0] == 22


def test_one_table_cannot_have_two_sources(tmp_path, tables):
    with pytest.raises(ValueError, match="fill one table"):
        run_union_flow(tables, sources(tmp_path, "ES") * 2, "silver", RULES)


def test_sources_of_other_columns_are_united_by_name(spark, tmp_path, tables, rows):
    drop(tmp_path / "ES", "a.csv", HEAD, "1,x,10")
    drop(tmp_path / "PT", "a.csv", "Vat,InvoiceNo,CustomerID", "PT9,2,20")
    other = T.StructType().add("Vat", "string").add("InvoiceNo", "integer").add("CustomerID", "integer")
    pt = LandingSource("bronze_pt", str(tmp_path / "PT"), "PT", other, rules=RULES)
    done = run_union_flow(tables, [*sources(tmp_path, "ES"), pt], "silver", RULES)
    assert rows(done.tables["silver"].select("InvoiceNo", "Description", "CustomerID", "Vat", "Entity")) == [
        (1, "x", 10, None, "ES"), (2, None, 20, "PT9", "PT")]


def test_sources_of_the_same_types_are_united_by_position(spark, tmp_path, tables, rows):
    drop(tmp_path / "ES", "a.csv", HEAD, "1,x,10")
    drop(tmp_path / "PT", "a.csv", "Numero,Texto,Cliente", "2,y,20", "C3,y,20")
    other = T.StructType().add("Numero", "integer").add("Texto", "string").add("Cliente", "integer")
    pt = LandingSource("bronze_pt", str(tmp_path / "PT"), "PT", other, rules={"numbered": "Numero IS NOT NULL"})
    done = run_union_flow(tables, [*sources(tmp_path, "ES"), pt], "silver", RULES)
    assert rows(done.tables["silver"].select("InvoiceNo", "Description", "CustomerID")) == [(1, "x", 10), (2, "y", 20)]
    logged = rule_metric_rows(parse_details(log_events(tables, done), schema=DETAILS_SCHEMA))
    assert rows(logged.groupBy("dataset").agg(F.sum("passed_records"), F.sum("failed_records"))) == [
        ("bronze_es", 1, 0), ("bronze_pt", 1, 1), ("silver", 2, 1)]


def test_columns_come_and_widen(spark, root, rows):
    def land(sql):
        tables = StreamTables(spark, root)
        path = f"{root}/landing"
        spark.sql(sql).write.mode("append").json(path)
        given = spark.readStream.schema(spark.sql(sql).schema).json(path)
        settle(tables.append(given, "t"))
        settle(tables.append(tables.stream("t"), "u"))
        return tables

    land("SELECT 1 AS a, 'x' AS b")
    land("SELECT CAST(5000000000 AS BIGINT) AS a, named_struct('p', 1) AS s")
    tables = land("SELECT CAST(3 AS SMALLINT) AS a, 'y' AS b, named_struct('p', 2, 'q', 'z') AS s")
    want = [(1, "x", None, None), (3, "y", 2, "z"), (5000000000, None, 1, None)]
    for name in ("t", "u"):
        assert rows(tables.read(name).select("a", "b", "s.p", "s.q")) == want
        assert tables.read(name).schema["a"].dataType == T.LongType()
    with pytest.raises(ValueError, match="cannot become"):
        land("SELECT true AS a")


def test_schemas_are_merged_by_name():
    have = T.StructType().add("a", "integer", False).add("B", "string")
    more = T.StructType().add("b", "string").add("c", "float").add("A", "long")
    assert merged_schema(have, more, "t").simpleString() == "struct<a:bigint,B:string,c:float>"
    with pytest.raises(ValueError, match="t.a"):
        merged_schema(have, T.StructType().add("a", "date"), "t")


def test_registry_adds_a_row_only_for_a_change(spark, root):
    path = f"{root}/registry"
    one = T.StructType().add("a", "integer", False)
    registry = Registry(spark, path)
    assert registry.get("t") is None
    for part in ("p", "q", "p"):
        registry.declare("t", one, part)
    assert Registry(spark, path).get("t").parts == ("p", "q")
    assert spark.read.json(path).count() == 2
    assert Registry(spark, path).declare("t", T.StructType().add("z", "string"), "p").schema.fieldNames() == ["a", "z"]
    assert spark.read.json(path).count() == 3
    with pytest.raises(ValueError, match="has parts"):
        registry.declare("t", one)


COLLATERAL = Contract(
    "collateral",
    T.StructType().add("id", "string").add("value", "double"),
    ("id IS NOT NULL", "value >= 0"),
)


def entity(tmp_path, **config):
    return entity_flow_from_config(COLLATERAL, {"landing_zone": str(tmp_path / "landing"), "file_format": "json"} | config)


def good(i):
    return json.dumps({"id": f"c{i}", "value": i})


def sides(rows, done):
    name = F.element_at(F.split("InputFileName", "/"), -1)
    return rows(done.tables["reconciliation"].select(name, "rows_OK", "rows_KO"))


def test_control_tables_count_only_new_rows(spark, tmp_path, root, rows):
    flow = entity(tmp_path, max_files="1")
    drop(tmp_path / "landing", "a.json", *[good(i) for i in range(50)])
    run_entity_flow(StreamTables(spark, root), flow)
    drop(tmp_path / "landing", "b.json", good(1), good(-1), json.dumps({"value": 2}))
    done = run_entity_flow(StreamTables(spark, root), flow)
    assert done.streams["collateral_counts@collateral_checked"].input_rows == 3
    want = [("a.json", 50, 0), ("b.json", 1, 2)]
    assert sides(rows, done) == want
    ctl = want[:1] + want[1:]
    assert rows(done.tables["ctl"].select("rows_OK", "rows_KO")) == [(1, 1), (50, None)]
    assert len(ctl) == 2
    done.counts.compact()
    assert rows(done.counts.sums().select("records", "kept", "ids", "kept_ids")) == [(3, 1, 2, 1), (50, 50, 50, 50)]
    # After that only newer deltas are read; those of whole days before are not even opened.
    assert done.counts._after(counts._marks(done.counts._sums().pointer)).count() == 0
    drop(tmp_path / "landing", "c.json", good(5))
    done = run_entity_flow(StreamTables(spark, root), flow)
    assert sides(rows, done) == [*want, ("c.json", 1, 0)]
    again = run_entity_flow(StreamTables(spark, root), flow)
    assert sides(rows, again) == [*want, ("c.json", 1, 0)]


def test_counts_are_compacted_by_themselves(spark, tmp_path, tables, rows, monkeypatch):
    monkeypatch.setattr(flows, "COMPACT_EVERY", 2)
    for i in range(3):
        drop(tmp_path / "landing", f"{i}.json", good(i))
    done = run_entity_flow(tables, entity(tmp_path, max_files="1"))
    assert done.counts._sums().current() is not None
    assert sides(rows, done) == [(f"{i}.json", 1, 0) for i in range(3)]


def test_a_clock_that_was_set_back_is_refused(spark, tmp_path, tables):
    drop(tmp_path / "landing", "a.json", good(1))
    done = run_entity_flow(tables, entity(tmp_path))
    done.counts.mark_logged(json.dumps({"collateral_checked": 2**62}))
    with pytest.raises(RuntimeError, match="clock"):
        run_entity_flow(tables, entity(tmp_path))


def logged_rows(log):
    return rule_metric_rows(parse_details(log, schema=DETAILS_SCHEMA))


@pytest.mark.parametrize("single_pass", [True, False])
def test_counts_of_a_driver_that_ended_are_logged_by_the_next(spark, tmp_path, root, rows, single_pass):
    flow = entity_flow_from_config(COLLATERAL, {"landing_zone": str(tmp_path / "landing")}, single_pass=single_pass)
    drop(tmp_path / "landing", "a.json", good(1), good(-1))
    run_entity_flow(StreamTables(spark, root), flow)  # all is committed, nothing logged: the driver ends
    drop(tmp_path / "landing", "b.json", good(2), json.dumps({"value": 1}), json.dumps({"value": -1}))
    tables = StreamTables(spark, root)
    log = log_events(tables, run_entity_flow(tables, flow))
    summed = logged_rows(log).groupBy("name").agg(F.sum("passed_records"), F.sum("failed_records"), F.sum("dropped_records"))
    dropped = 0 if single_pass else 3
    assert rows(summed) == [("id IS NOT NULL", 3, 2, dropped), ("value >= 0", 3, 2, dropped)]
    before = rows(log)
    assert rows(log_events(tables, CountTable(tables, "collateral_counts"))) == before
    # An append whose mark was lost is made again and adds nothing.
    tables_again = CountTable(tables, "collateral_counts")
    tables_again.mark_logged("{}")
    assert rows(log_events(tables, tables_again)) == before
    assert len({r[0] for r in before}) == len(before)


def test_a_batch_that_breaks_a_rule_leaves_no_row(spark, tmp_path, tables, rows):
    source = LandingSource("t", str(tmp_path / "in"), "ES", INVOICE, rules={"priced": "CustomerID > 0"}, policy="fail")

    def run():
        settle(tables.append(source.checked(source.open(spark)), "t"))

    drop(tmp_path / "in", "a.csv", HEAD, "1,x,1")
    run()
    drop(tmp_path / "in", "b.csv", HEAD, "2,x,2")
    drop(tmp_path / "in", "c.csv", HEAD, "3,x,3", "4,x,0")
    for _ in range(2):
        with pytest.raises(Exception, match="row breaks: priced"):
            run()
        assert rows(tables.read("t").select("InvoiceNo")) == [(1,)]
    # Mended in place, or by another file.
    drop(tmp_path / "in", "c.csv", HEAD, "3,x,3", "4,x,4")
    (tmp_path / "in" / "b.csv").unlink()
    drop(tmp_path / "in", "d.csv", HEAD, "5,x,5")
    run()
    assert rows(tables.read("t").select("InvoiceNo")) == [(1,), (3,), (4,), (5,)]


def test_the_fail_policy_of_a_flow_keeps_all_its_layers_clean(spark, tmp_path, tables, rows):
    flow = entity(tmp_path, policy="fail")
    assert flow.source.policy == "fail"
    drop(tmp_path / "landing", "a.json", good(1), good(-1))
    with pytest.raises(Exception, match="row breaks: value >= 0"):
        run_entity_flow(tables, flow)
    drop(tmp_path / "landing", "a.json", good(1), good(2))
    done = run_entity_flow(tables, flow)
    assert {n: done.tables[n].count() for n in ("bronze", "silver", "quarantine")} == {"bronze": 2, "silver": 2, "quarantine": 0}
    with pytest.raises(ValueError, match="neither keep nor fail"):
        entity(tmp_path, policy="ignore")


def test_reading_a_table_nobody_filled(tables):
    with pytest.raises(ValueError, match="give its schema"):
        tables.stream("nothing")


def test_replaced_tables_are_read_by_name(spark, tables):
    tables.replace(spark.range(3), "kept")
    tables.replace(expect_drop(spark.range(9), {"small": "id < 5"}), "kept")
    assert tables.read("kept").count() == 5
