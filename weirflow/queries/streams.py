"""The same semantics run as streams over the whole given tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import (
    expect_drop,
    expect_keep,
    label,
    parse_details,
    quarantine,
    rule_metric_rows,
    union_all,
    with_entity,
)
from ..operators.eventlog import DETAILS_SCHEMA
from ..operators.expectations import METRICS_SCHEMA
from ..plans import Contract
from ..scratch import scratch_dir
from ..sources import CompleteTable, publish_stream_table
from ..streaming import (
    CheckedStream,
    CountTable,
    EntityFlow,
    FlowResult,
    LandingSource,
    StreamTables,
    entity_flow_from_config,
    log_events,
    run_entity_flow,
    run_union_flow,
    settle,
)
from .controls import SIDES_SQL, UNION_SOURCES, UNION_SQL
from .expectations import RULE_ROWS_SQL
from .files import EVENT_FILE, EVENT_LINE, INVOICE_FILE, INVOICE_LINES
from .inputs import (
    BRONZE_SQL,
    INVOICE_COLUMNS,
    INVOICE_FAILED_SQL,
    INVOICE_RULES,
    INVOICE_RULES_SQL,
    bronze_stream,
    fresh_tables,
    table,
    table_stream,
)
from .registry import query

COLUMNS_SQL = ", ".join(INVOICE_COLUMNS)


def _bronze(spark: SparkSession, sf_dir: str, label: str) -> tuple[StreamTables, DataFrame]:
    """Fill a bronze table by a stream; give the tables and a stream of bronze."""
    tables = fresh_tables(spark, label)
    rows = bronze_stream(spark, sf_dir)
    settle(tables.append(rows, "bronze"))
    return tables, tables.stream("bronze", rows.schema)


@query(f"WITH {BRONZE_SQL} SELECT {COLUMNS_SQL} FROM bronze WHERE {INVOICE_RULES_SQL}")
def stream_bronze_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, rows = _bronze(spark, sf_dir, "silver")
    settle(tables.append(expect_drop(rows, INVOICE_RULES), "silver"))
    return tables.read("silver").select(*INVOICE_COLUMNS)


@query(f"""WITH {BRONZE_SQL}, failed AS (
    SELECT {COLUMNS_SQL}, {INVOICE_FAILED_SQL} AS failed_rules FROM bronze)
    SELECT * FROM failed WHERE failed_rules != ''""")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and quarantine fed side by side from one bronze table."""
    tables, rows = _bronze(spark, sf_dir, "quarantine")
    settle(
        tables.append(expect_drop(rows, INVOICE_RULES, "silver"), "silver"),
        tables.append(quarantine(rows, INVOICE_RULES), "quarantine"),
    )
    return tables.read("quarantine").select(
        *INVOICE_COLUMNS, F.array_join("_failed_rules", ",").alias("failed_rules")
    )


@query(f"""WITH {SIDES_SQL}
    SELECT entity, true AS passed, count(*) AS records FROM silver GROUP BY entity UNION ALL
    SELECT entity, false, count(*) FROM quarantine GROUP BY entity""")
def stream_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides in one pass, as partitions of one table."""
    tables, rows = _bronze(spark, sf_dir, "single-pass")
    checked = label(rows, INVOICE_RULES).withColumn("passed", F.size("_failed_rules") == 0)
    settle(tables.append(checked, "checked", partition_by=["passed"]))
    checked = tables.read("checked", checked.schema)
    return checked.groupBy("entity", "passed").agg(F.count(F.lit(1)).alias("records"))


@query(f"WITH {BRONZE_SQL} {RULE_ROWS_SQL.format(keys='', group='')}")
def stream_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts observed while the stream runs."""
    tables = fresh_tables(spark, "metrics")
    counted = expect_keep(bronze_stream(spark, sf_dir), INVOICE_RULES, "bronze")
    (done,) = settle(tables.append(counted, "bronze"))
    counted = CheckedStream(done, INVOICE_RULES, drops=False)
    return spark.createDataFrame(counted.metric_rows(), METRICS_SCHEMA)


@query(UNION_SQL)
def stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fresh_tables(spark, "union")
    streams = [
        with_entity(table_stream(spark, sf_dir, name).selectExpr(*columns), entity)
        for name, (entity, *columns) in UNION_SOURCES.items()
    ]
    settle(tables.append(union_all(streams), "silver"))
    return tables.read("silver")


@query("""SELECT CAST(1 AS BIGINT) AS run, count(*) AS input_rows, count(*) AS table_rows
    FROM orders UNION ALL
    SELECT 2, 0, count(*) FROM orders""")
def stream_rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run finds no new files and adds no rows."""
    tables = fresh_tables(spark, "rerun")
    runs = []
    for run in (1, 2):
        (done,) = settle(tables.append(bronze_stream(spark, sf_dir), "bronze"))
        counted = tables.read("bronze").agg(F.count(F.lit(1)).alias("table_rows"))
        runs.append(
            counted.select(
                F.lit(run).cast("bigint").alias("run"),
                F.lit(done.input_rows).cast("bigint").alias("input_rows"),
                "table_rows",
            )
        )
    return union_all(runs)


EVENT_CONTRACT = Contract(
    "event", EVENT_FILE, ("id IS NOT NULL", "kind != 'error'", "length(kind) > 4")
)


def _event_flow(
    spark: SparkSession, sf_dir: str, files: int | None = None, **settings
) -> tuple[StreamTables, EntityFlow]:
    root = scratch_dir(spark, "event-flow")
    lines = table(spark, sf_dir, "events").selectExpr(f"{EVENT_LINE} AS value")
    (lines.repartition(files) if files else lines).write.text(f"{root}/landing")
    config = {
        "landing_zone": f"{root}/landing",
        "invalid_format_path": f"{root}/invalid",
        "file_format": "json",
    }
    return StreamTables(spark, root), entity_flow_from_config(EVENT_CONTRACT, config, **settings)


EVENT_LAYERS_SQL = """
    SELECT layer, count(*) AS records, count(ko) AS named FROM (
      SELECT unnest(CASE
          WHEN event_id % 11 = 0 THEN ['bronze', 'invalid']
          WHEN event_type != 'error' AND length(event_type) > 4 THEN ['bronze', 'silver']
          ELSE ['bronze', 'quarantine'] END) AS layer,
        CASE WHEN event_id % 11 != 0 AND NOT (event_type != 'error' AND length(event_type) > 4)
          THEN 1 END AS ko
      FROM events) GROUP BY layer"""


def _layers(spark: SparkSession, tables: StreamTables, flow: EntityFlow) -> DataFrame:
    done = run_entity_flow(tables, flow)
    invalid = spark.read.schema("path STRING, reason STRING, record STRING").json(flow.invalid_path)
    frames = {name: done.tables[name] for name in ("bronze", "silver", "quarantine")}
    return union_all(
        [
            frame.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("layer"), "records")
            for name, frame in (frames | {"invalid": invalid}).items()
        ]
    )


EVENT_RECORDS_SQL = f"SELECT layer, records FROM ({EVENT_LAYERS_SQL})"


@query(EVENT_RECORDS_SQL)
def stream_entity_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract-driven template, JSON landing to all its layers, by two streams."""
    return _layers(spark, *_event_flow(spark, sf_dir, single_pass=False))


@query(EVENT_RECORDS_SQL)
def stream_entity_flow_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layers(spark, *_event_flow(spark, sf_dir, single_pass=True))


@query(EVENT_RECORDS_SQL)
def stream_limited_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a bound on every hop: a backlog is taken in several batches each time."""
    tables, flow = _event_flow(spark, sf_dir, files=6)
    bounded = replace(flow, source=replace(flow.source, max_files=2))
    return _layers(spark, tables, bounded)


@query(f"""SELECT 'ctl' AS layer, count(*) FILTER (ok AND event_id IS NOT NULL) AS loaded,
      count(*) FILTER (NOT ok) AS rejected
    FROM (SELECT event_id, event_type != 'error' AND length(event_type) > 4 AS ok
      FROM events WHERE event_id % 11 != 0)
    UNION ALL
    SELECT 'reconciliation', count(*) FILTER (ok), count(*) FILTER (NOT ok)
    FROM (SELECT event_type != 'error' AND length(event_type) > 4 AS ok
      FROM events WHERE event_id % 11 != 0)""")
def stream_control_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the control tables of a flow say, summed over its files."""
    done = run_entity_flow(*_event_flow(spark, sf_dir))
    return union_all(
        [
            done.tables[name].agg(F.sum("rows_OK").alias("loaded"), F.sum("rows_KO").alias("rejected"))
            .select(F.lit(name).alias("layer"), "loaded", "rejected")
            for name in ("ctl", "reconciliation")
        ]
    )


@query("""SELECT 'bronze' AS quality, 'All orders as they came.' AS note, count(*) AS records
    FROM orders UNION ALL
    SELECT 'silver', 'Orders that meet every rule.', count(*) FROM (
      SELECT * FROM orders WHERE o_totalprice > 1500)""")
def stream_table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment and properties of published stream tables next to their rows."""
    tables = fresh_tables(spark, "published")
    rows = table_stream(spark, sf_dir, "orders")
    settle(tables.append(rows, "bronze"))
    settle(tables.append(tables.stream("bronze", rows.schema).filter("o_totalprice > 1500"), "silver"))
    told = []
    notes = {"bronze": "All orders as they came.", "silver": "Orders that meet every rule."}
    for name, note in notes.items():
        view = f"weirflow_{name}_{uuid.uuid4().hex}"
        publish_stream_table(spark, view, tables.path(name), note, {"quality": name})
        seen = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
        told.append(
            tables.read(name).agg(F.count(F.lit(1)).alias("records")).select(
                F.lit(seen["quality"]).alias("quality"),
                F.lit(spark.catalog.getTable(view).description).alias("note"),
                "records",
            )
        )
        spark.sql(f"DROP VIEW {view}")
    return union_all(told)


ENTITY_OF_ORDER = {"ES": 0, "PT": 1, "BR": 2, "UK": 3}


FILE_RULES = {"existing_invoice": "InvoiceNo IS NOT NULL", "valid_invoice": "Description != '5-LOW'"}
RECHECK_RULES = {"valid_entity": "length(Entity) = 2", "urgent": "Description = '1-URGENT'"}

LANDED_SQL = """landed AS (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN 'ES' WHEN 1 THEN 'PT' WHEN 2 THEN 'BR' ELSE 'UK' END
      AS entity,
    o_orderkey % 23 != 0 AS existing_invoice, o_orderpriority != '5-LOW' AS valid_invoice,
    o_orderpriority = '1-URGENT' AS urgent
  FROM orders)"""


def _union_flow(spark: SparkSession, sf_dir: str) -> tuple[StreamTables, FlowResult]:
    root = scratch_dir(spark, "union-flow")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey % 4 AS place", *INVOICE_LINES)
    # One write fills all four folders.
    orders.write.partitionBy("place").option("header", True).csv(f"{root}/landing")
    sources = [
        LandingSource(
            f"bronze_{entity.lower()}_invoice",
            f"{root}/landing/place={place}",
            entity,
            INVOICE_FILE,
            rules=FILE_RULES,
        )
        for entity, place in ENTITY_OF_ORDER.items()
    ]
    tables = StreamTables(spark, root)
    return tables, run_union_flow(
        tables,
        sources,
        "silver_invoice",
        FILE_RULES,
        "invoice_ctl",
        rechecks={"rechecked_invoice": RECHECK_RULES},
    )


@query(f"""WITH {LANDED_SQL} SELECT entity AS "Entity", count(*) AS records
    FROM landed WHERE existing_invoice AND valid_invoice GROUP BY 1""")
def stream_union_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four landing folders into one checked table and its control table."""
    _, done = _union_flow(spark, sf_dir)
    return done.tables["invoice_ctl"].groupBy("Entity").agg(F.sum("records").alias("records"))


@query(f"""WITH {LANDED_SQL}, counted AS (
    SELECT 'bronze_' || lower(entity) || '_invoice' AS dataset, 0 AS dropped_records, rule AS name,
      count(*) FILTER (ok) AS passed_records, count(*) FILTER (NOT ok) AS failed_records
    FROM (SELECT entity, unnest(['existing_invoice', 'valid_invoice']) AS rule,
            unnest([existing_invoice, valid_invoice]) AS ok FROM landed) GROUP BY ALL
    UNION ALL
    SELECT 'silver_invoice', (SELECT count(*) FROM landed WHERE NOT (existing_invoice AND valid_invoice)),
      rule, count(*) FILTER (ok), count(*) FILTER (NOT ok)
    FROM (SELECT unnest(['existing_invoice', 'valid_invoice']) AS rule,
            unnest([existing_invoice, valid_invoice]) AS ok FROM landed) GROUP BY ALL
    UNION ALL
    SELECT 'rechecked_invoice', 0, rule, count(*) FILTER (ok), count(*) FILTER (NOT ok)
    FROM (SELECT unnest(['valid_entity', 'urgent']) AS rule, unnest([true, urgent]) AS ok
          FROM landed WHERE existing_invoice AND valid_invoice) GROUP BY ALL)
    SELECT dataset, name, CAST(dropped_records AS BIGINT) AS dropped_records,
      passed_records, failed_records FROM counted""")
def stream_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streams counted, logged as JSON events (twice: the second adds
    nothing), parsed back and summed over batches."""
    tables, done = _union_flow(spark, sf_dir)
    log_events(tables, done)
    parsed = parse_details(log_events(tables, done))
    return (
        rule_metric_rows(parsed)
        .groupBy("dataset", "name")
        .agg(
            *[
                F.sum(c).alias(c)
                for c in ("dropped_records", "passed_records", "failed_records")
            ]
        )
    )


@query(f"""WITH {LANDED_SQL} SELECT entity AS "Entity", count(*) AS silver, count(*) AS controlled
    FROM landed WHERE existing_invoice AND valid_invoice AND entity IN ('ES', 'PT', 'UK') GROUP BY 1""")
def stream_union_grows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources, then three in another order: each row is in the table once.

    Of PT half the rows land before the first run, the others before the second.
    """
    root = scratch_dir(spark, "union-grows")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey % 8 AS place", *INVOICE_LINES)
    tables = StreamTables(spark, root)

    def land(*places: int) -> None:
        # Two of eight places go to one folder, one after the other.
        landed = orders.where(F.col("place").isin(*places)).withColumn("place", F.col("place") % 4)
        landed.write.mode("append").partitionBy("place").option("header", True).csv(f"{root}/landing")

    def run(*entities: str) -> FlowResult:
        sources = [
            LandingSource(
                f"bronze_{e.lower()}_invoice", f"{root}/landing/place={ENTITY_OF_ORDER[e]}", e, INVOICE_FILE, rules=FILE_RULES
            )
            for e in entities
        ]
        return run_union_flow(tables, sources, "silver_invoice", FILE_RULES, "invoice_ctl")

    land(0, 4, 1)
    run("ES", "PT")
    land(5, 3, 7)
    done = run("PT", "ES", "UK")
    silver = done.tables["silver_invoice"].groupBy("Entity").agg(F.count(F.lit(1)).alias("silver"))
    controlled = done.tables["invoice_ctl"].groupBy("Entity").agg(F.sum("records").alias("controlled"))
    return silver.join(controlled, "Entity")


@query("""WITH seen(moment, of_all) AS (VALUES ('first', false), ('after a write that failed', false),
      ('written, not switched', false), ('switched', true))
    SELECT moment, count(*) AS records, sum(o_orderkey)::BIGINT AS keys
    FROM seen, orders WHERE of_all OR o_orderstatus = 'O' GROUP BY moment""")
def complete_table_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers of a complete table see before, while and after it is replaced."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    complete = CompleteTable(spark, scratch_dir(spark, "switch"))
    seen = []

    def look(moment: str) -> None:
        found = complete.read().agg(F.count(F.lit(1)), F.sum("o_orderkey")).first()
        seen.append((moment, *found))

    complete.replace(orders.where("o_orderstatus = 'O'"))
    look("first")
    stops = F.when(F.col("o_orderstatus") == "F", F.raise_error(F.lit("lost half way")).cast("string"))
    try:
        complete.replace(orders.withColumn("o_orderstatus", stops.otherwise(F.col("o_orderstatus"))))
    except Exception as error:
        if "lost half way" not in str(error):
            raise
        look("after a write that failed")
    version = complete.stage(orders)
    look("written, not switched")
    complete.switch(version)
    look("switched")
    return spark.createDataFrame(seen, "moment string, records long, keys long")


# Rows of the landing files that can be read at all, and whether they meet the contract.
EVENT_SIDES_SQL = """readable AS (
    SELECT event_id, event_type, event_type != 'error' AND length(event_type) > 4 AS ok
    FROM events WHERE event_id % 11 != 0)"""


@query(f"""WITH {EVENT_SIDES_SQL}, looked_at AS (
      SELECT *, unnest(['ctl', 'reconciliation', 'compacted', 'counted by the second run']) AS layer FROM readable)
    SELECT layer, count(*) FILTER (ok) AS loaded, count(*) FILTER (NOT ok) AS rejected FROM looked_at
    WHERE layer != 'counted by the second run' OR event_id % 3 = 0 GROUP BY layer""")
def stream_control_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control tables after two runs, of which the second counts only what is new."""
    root = scratch_dir(spark, "control-deltas")
    events = table(spark, sf_dir, "events")
    config = {"landing_zone": f"{root}/landing", "invalid_format_path": f"{root}/invalid"}
    tables, flow = StreamTables(spark, root), entity_flow_from_config(EVENT_CONTRACT, config)
    for third in ("event_id % 3 != 0", "event_id % 3 = 0"):
        events.where(third).selectExpr(f"{EVENT_LINE} AS value").write.mode("append").text(f"{root}/landing")
        done = run_entity_flow(tables, flow)
    sides = [F.sum("rows_OK").alias("loaded"), F.sum("rows_KO").alias("rejected")]
    told = [(name, *done.tables[name].agg(*sides).first()) for name in ("ctl", "reconciliation")]
    # What the second run added to the counts, if that is also all its query says it read.
    kept, rejected = F.sum("kept"), F.sum("records") - F.sum("kept")
    newest = tables.read(done.counts.name).groupBy("batch").agg(kept, rejected).orderBy(F.desc("batch")).first()
    if done.streams[f"{done.counts.name}@{flow.table('checked')}"].input_rows == newest[1] + newest[2]:
        told.append(("counted by the second run", *newest[1:]))
    done.counts.compact()
    told.append(("compacted", *done.counts.sums().agg(kept, rejected).first()))
    return spark.createDataFrame(told, "layer string, loaded long, rejected long")


@query(f"""WITH {EVENT_SIDES_SQL}, verdicts AS (
      SELECT unnest([{", ".join("'" + rule.replace("'", "''") + "'" for rule in EVENT_CONTRACT.constraints)}]) AS name,
        unnest([event_id IS NOT NULL, event_type != 'error', length(event_type) > 4]) AS held
      FROM readable)
    SELECT name, count(*) FILTER (held) AS passed_records, count(*) FILTER (NOT held) AS failed_records,
      (SELECT count(*) FROM readable WHERE NOT ok) AS dropped_records, CAST(2 AS BIGINT) AS batches
    FROM verdicts GROUP BY name""")
def stream_durable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a run whose driver ends before it logs them reach the event log with the next run.

    Rules are judged by two streams, silver and quarantine, each with an event per batch.
    """
    root = scratch_dir(spark, "durable-events")
    events = table(spark, sf_dir, "events")
    config = {"landing_zone": f"{root}/landing", "invalid_format_path": f"{root}/invalid"}
    flow = entity_flow_from_config(EVENT_CONTRACT, config, single_pass=False)
    for half in (0, 1):
        lines = events.where(F.col("event_id") % 2 == half).selectExpr(f"{EVENT_LINE} AS value")
        lines.write.mode("append").text(f"{root}/landing")
        # Each run has objects of its own, as after a restart; the first one logs nothing.
        tables = StreamTables(spark, root)
        done = run_entity_flow(tables, flow)
    log_events(tables, done)
    # Once more, by whoever has the counts: nothing is added.
    logged = rule_metric_rows(parse_details(log_events(tables, CountTable(tables, done.counts.name)), schema=DETAILS_SCHEMA))
    summed = [F.sum(c).alias(c) for c in ("passed_records", "failed_records", "dropped_records")]
    sides = F.count_distinct(F.split_part("event_id", F.lit(":"), F.lit(2)))
    return logged.groupBy("name").agg(*summed, (F.count_distinct("event_id") / sides).cast("long").alias("batches"))


@query("""WITH seen(moment, halves) AS (VALUES ('first', 1), ('after a batch that failed', 1), ('mended', 2))
    SELECT moment, count(*) AS records, CAST(0 AS BIGINT) AS broken
    FROM seen, orders WHERE o_orderkey % 2 < halves GROUP BY moment""")
def stream_fail_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with a row that breaks a rule leaves none; mended, it is taken in whole."""
    root = scratch_dir(spark, "fail-policy")
    tables = StreamTables(spark, root)
    landing = f"{root}/landing"
    orders = table(spark, sf_dir, "orders").selectExpr(*INVOICE_LINES, "o_orderkey % 2 AS half")
    rules = {"priced": "UnitPrice > 0", "described": "Description IS NOT NULL"}
    source = LandingSource("invoice", landing, "ES", INVOICE_FILE, rules=rules, policy="fail")
    seen = []

    def land(half: int, price: str, mode: str) -> None:
        rows = orders.where(F.col("half") == half).withColumn("UnitPrice", F.expr(price)).drop("half")
        rows.write.mode(mode).option("header", True).csv(landing)

    def run(moment: str) -> None:
        try:
            settle(tables.append(source.checked(source.open(spark)), source.table))
        except Exception as error:
            if "row breaks: priced" not in str(error):
                raise
            moment = "after a batch that failed"
        rows = tables.read(source.table)
        seen.append((moment, *rows.agg(F.count(F.lit(1)), F.count_if(~F.expr("UnitPrice > 0"))).first()))

    land(0, "UnitPrice", "append")
    run("first")
    land(1, "CASE WHEN Description = '5-LOW' THEN '-1' ELSE UnitPrice END", "append")
    run("taken in with broken rows")
    land(1, "UnitPrice", "overwrite")
    run("mended")
    return spark.createDataFrame(seen, "moment string, records long, broken long")


@query("""SELECT unnest(['read', 'streamed']) AS side, o_orderkey AS id, o_totalprice AS price,
      CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority FROM orders""")
def stream_schema_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two schemas in one stream table: the second brings a column and a wider type.

    The table is read, and copied by a stream that had already read it by its old
    columns; both show old rows with NULL in the new one.
    """
    root = scratch_dir(spark, "schema-growth")
    tables = StreamTables(spark, root)
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_totalprice AS price", "o_orderpriority AS priority"
    )
    for rows, schema in (
        (orders.where("id % 2 = 0").drop("priority"), T.StructType().add("id", "integer").add("price", "double")),
        (orders.where("id % 2 = 1"), T.StructType().add("priority", "string").add("price", "double").add("id", "long")),
    ):
        rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("append").text(f"{root}/landing")
        source = LandingSource("grown", f"{root}/landing", "ES", schema, "json")
        settle(tables.append(source.open(spark), source.table))
        settle(tables.append(tables.stream("grown"), "copy"))
    return union_all(
        [
            tables.read(name).select(F.lit(side).alias("side"), "id", "price", "priority")
            for name, side in (("grown", "read"), ("copy", "streamed"))
        ]
    )
