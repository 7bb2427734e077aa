"""Flow templates: landing folders to checked tables and control tables.

One template serves many entities and many sources. Tables that do not depend
on each other are filled side by side; a table is read only after its stream
has ended.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.controls import control_of_counts
from ..operators.expectations import (
    FAILED_COLUMN,
    METRICS_SCHEMA,
    expect_drop,
    expect_fail,
    expect_keep,
    label,
    passes,
)
from ..operators.expectations import quarantine as quarantined_rows
from ..operators.transforms import (
    DATE_COLUMN,
    ENTITY_COLUMN,
    FILE_COLUMN,
    RESCUE_COLUMN,
    TIME_COLUMN,
    extended,
    malformed,
    with_provenance,
)
from ..plans.contracts import Contract
from ..plans.rules import Rules
from ..sources.files import read_landing
from ..sources.writers import append_once
from .counts import SCHEMA as COUNTS_SCHEMA
from .counts import CountTable, Judged
from .tables import EVENT_SCHEMA, CheckedStream, StreamResult, StreamTables, settle

PASSED_COLUMN = "_passed"

KEEP, FAIL = "keep", "fail"

#: Deltas of a counting query are summed up after so many of its batches.
COMPACT_EVERY = 64


@dataclass(frozen=True)
class LandingSource:
    """One landing folder, what its rows look like, and the table it fills.

    ``policy`` says what becomes of rows that break one of ``rules``. ``keep`` takes
    them in and counts them; ``fail`` stops the batch, all or nothing: no row of it
    reaches the table, and it is taken again by the next run. Mend the landing
    folder in between: a file that is gone then is passed over, and what was put in
    its place is taken in. (Rows are dropped on the way from this table to the next.)
    """

    table: str
    landing: str
    entity: str
    schema: T.StructType
    file_format: str = "csv"
    max_files: int | None = None
    max_bytes: int | None = None
    rules: Rules = field(default_factory=dict)
    header: bool = True
    options: Mapping[str, str] = field(default_factory=dict)
    policy: str = KEEP

    def __post_init__(self) -> None:
        if self.policy not in (KEEP, FAIL):
            raise ValueError(f"source {self.table!r}: policy {self.policy!r} is neither {KEEP} nor {FAIL}")

    def open(self, spark: SparkSession, at: Column | None = None) -> DataFrame:
        rows = read_landing(
            spark,
            self.landing,
            self.schema,
            self.file_format,
            header=self.header,
            max_files=self.max_files,
            max_bytes=self.max_bytes,
            options=({"ignoreMissingFiles": "true"} if self.policy == FAIL else {}) | dict(self.options),
        )
        return with_provenance(rows, self.entity, at)

    def checked(self, rows: DataFrame) -> DataFrame:
        """The rows as the policy lets them into the table, counted under its name."""
        return expect_keep(expect_fail(rows, self.rules) if self.policy == FAIL else rows, self.rules, self.table)


@dataclass(frozen=True)
class EntityFlow:
    """The contract-driven template: bronze, silver, quarantine, control table.

    With ``single_pass`` silver and quarantine are one table split by a
    partition column, so bronze is read, and each rule evaluated, once; a row is
    then always on just one side. Without it they are two streams, which judge a
    rule that depends on the time of day each for itself.
    """

    contract: Contract
    source: LandingSource
    invalid_path: str | None = None
    failed_column: str = FAILED_COLUMN
    id_column: str = "id"
    single_pass: bool = True

    def table(self, layer: str) -> str:
        return f"{self.contract.entity}_{layer}"


@dataclass
class FlowResult:
    """Frames of the tables a run filled, its streams, and what its rules counted."""

    tables: dict[str, DataFrame]
    streams: dict[str, StreamResult]
    checks: list[CheckedStream]

    counts: CountTable

    def metrics(self, spark: SparkSession) -> DataFrame:
        """Passed and failed rows of this run: one row per table and rule."""
        sums: dict[tuple[str, str], list[int]] = {}
        for check in self.checks:
            for name, dataset, passed, failed in check.metric_rows():
                found = sums.setdefault((name, dataset), [0, 0])
                found[0] += passed
                found[1] += failed
        return spark.createDataFrame([(*key, *found) for key, found in sums.items()], METRICS_SCHEMA)

    def events(self, spark: SparkSession) -> DataFrame:
        """The same per batch, as events for the event log."""
        rows = [row for check in self.checks for row in check.events()]
        return spark.createDataFrame(rows, EVENT_SCHEMA)


def log_events(tables: StreamTables, result: FlowResult | CountTable, name: str = "event_log") -> DataFrame:
    """Append to the event log what its flow has counted since it was last logged.

    The events are made of the stored counts, not of what this process has seen:
    batches of a run that ended before it came to log them are logged now. A log is
    partitioned by day, and only the days of the new events are looked into, so it
    costs the same however long the log is; doing it again adds nothing.
    """
    counts = result.counts if isinstance(result, FlowResult) else result
    found = counts.events()
    if found is not None:
        events, mark = found
        append_once(events, tables.path(name), within="day")
        counts.mark_logged(mark)
    logged = tables.spark.read.schema(f"{EVENT_SCHEMA}, day DATE").parquet(tables.path(name))
    return logged.drop("day")


def entity_flow_from_config(
    contract: Contract, config: Mapping[str, str], entity_tag: str = "ES", **settings
) -> EntityFlow:
    """A flow from string settings, as a job configuration gives them.

    Needs ``landing_zone``; knows ``invalid_format_path`` and what
    :func:`source_settings` does, with ``file_format`` ``json`` if absent.
    """
    if "landing_zone" not in config:
        raise ValueError(f"entity {contract.entity!r}: the configuration has no landing_zone")
    source = LandingSource(
        table=f"{contract.entity}_bronze",
        landing=config["landing_zone"],
        entity=entity_tag,
        schema=contract.schema,
        **({"file_format": "json"} | source_settings(config)),
    )
    return EntityFlow(contract, source, config.get("invalid_format_path"), **settings)


def source_settings(config: Mapping[str, str]) -> dict:
    """Settings of a landing source from strings: ``file_format``, ``policy``, ``header``, ``max_files``,
    ``max_bytes`` (no bound if absent), and reader options as ``option.<name>``."""
    found: dict = {key: int(config[key]) for key in ("max_files", "max_bytes") if key in config}
    for key in ("file_format", "policy"):
        if key in config:
            found[key] = config[key]
    if "header" in config:
        found["header"] = config["header"].strip().lower() == "true"
    options = {key.removeprefix("option."): value for key, value in config.items() if key.startswith("option.")}
    return found | {"options": options} if options else found


def union_sources_from_config(
    config: Mapping[str, str], schema: T.StructType, table: str = "bronze_{entity}", rules: Rules | None = None
) -> list[LandingSource]:
    """Sources of a union flow from string settings: one per ``landing_zone.<ENTITY>``.

    Other settings are those of :func:`source_settings` and hold for all sources.
    """
    zones = {key.partition(".")[2]: path for key, path in config.items() if key.startswith("landing_zone.")}
    if not zones:
        raise ValueError("the configuration has no landing_zone.<ENTITY>")
    return [
        LandingSource(table.format(entity=entity.lower()), path, entity, schema, rules=rules or {}, **source_settings(config))
        for entity, path in zones.items()
    ]


def run_entity_flow(
    tables: StreamTables, flow: EntityFlow, at: Column | None = None
) -> FlowResult:
    """Take in what is new in the landing folder and bring all layers up to date.

    With the policy ``fail`` the contract's rules are checked where files come in,
    so a file that breaks one gets into no layer; quarantine then stays empty.
    """
    rules = flow.contract.rules
    opened = flow.source.open(tables.spark, at)
    counts = CountTable(tables, flow.table("counts"))
    layers = ["checked"] if flow.single_pass else ["silver", "quarantine"]
    labelled = extended(opened.schema, **{flow.failed_column: T.ArrayType(T.StringType())})
    made = {
        "bronze": opened.schema,
        "checked": extended(labelled, **{PASSED_COLUMN: "boolean"}),
        "silver": opened.schema,
        "quarantine": labelled,
    }
    tables.registry.declare_all(
        [(flow.table(layer), made[layer], "") for layer in ("bronze", *layers)]
        + [(counts.name, COUNTS_SCHEMA, flow.table(layer)) for layer in layers]
    )
    bronze = flow.source if flow.source.rules else replace(flow.source, rules=rules)
    landed = bronze.checked(opened) if flow.source.policy != KEEP else opened
    done = settle(tables.append(landed, flow.table("bronze")))
    schema = tables.registry.get(flow.table("bronze")).schema

    def bronze_stream() -> DataFrame:
        return tables.stream(flow.table("bronze"), schema, flow.source.max_bytes, flow.source.max_files)

    def bronze_rows() -> DataFrame:
        rows = bronze_stream()
        return rows.filter(~unreadable) if flow.invalid_path else rows

    unreadable = malformed(flow.contract.schema, flow.source.file_format)
    started = []
    if flow.invalid_path:
        aside = (
            bronze_stream()
            .filter(unreadable)
            .select(
                F.col("InputFileName").alias("path"),
                F.lit("malformed record").alias("reason"),
                F.col(RESCUE_COLUMN).alias("record"),
            )
        )
        started.append(
            tables.append(aside, flow.table("invalid"), path=flow.invalid_path, file_format="json")
        )
    if flow.single_pass:
        checked = label(
            bronze_rows(), rules, flow.failed_column, flow.table("checked")
        ).withColumn(PASSED_COLUMN, F.size(flow.failed_column) == 0)
        started.append(
            tables.append(checked, flow.table("checked"), partition_by=[PASSED_COLUMN])
        )
    else:
        silver = expect_drop(bronze_rows(), rules, flow.table("silver"))
        kept_aside = quarantined_rows(bronze_rows(), rules, flow.failed_column)
        started.append(tables.append(silver, flow.table("silver")))
        started.append(tables.append(kept_aside, flow.table("quarantine")))
    done += settle(*started)
    streams = {stream.name: stream for stream in done}

    dataset = flow.table("checked" if flow.single_pass else "silver")
    broken = {name: ~F.array_contains(flow.failed_column, name) for name in rules}
    if flow.single_pass:
        everything = tables.read(flow.table("checked"))
        silver = everything.filter(F.col(PASSED_COLUMN)).drop(flow.failed_column, PASSED_COLUMN)
        kept_aside = everything.filter(~F.col(PASSED_COLUMN)).drop(PASSED_COLUMN)
        checks = [CheckedStream(streams[dataset], rules, drops=False)]
        counted = {"checked": broken}
    else:
        silver, kept_aside = tables.read(flow.table("silver")), tables.read(flow.table("quarantine"))
        checks = [CheckedStream(streams[dataset], rules, drops=True)]
        counted = {"silver": {name: F.lit(True) for name in rules}, "quarantine": broken}
    counts.check_clock([flow.table(layer) for layer in counted])
    fresh = settle(
        *[
            counts.append(
                tables.stream(flow.table(layer), None, flow.source.max_bytes, flow.source.max_files),
                [Judged(dataset, verdicts, drops=not flow.single_pass)],
                flow.table(layer),
                flow.id_column,
            )
            for layer, verdicts in counted.items()
        ]
    )
    streams |= {stream.name: stream for stream in fresh}
    _compact_now_and_then(counts, streams)
    reconciled = counts.sums().select(
        FILE_COLUMN,
        DATE_COLUMN,
        TIME_COLUMN,
        F.col("kept").alias("rows_OK"),
        (F.col("records") - F.col("kept")).alias("rows_KO"),
        F.col("kept_ids").alias("ids_OK"),
        (F.col("ids") - F.col("kept_ids")).alias("ids_KO"),
    )
    return FlowResult(
        tables={
            "bronze": tables.read(flow.table("bronze")),
            "silver": silver,
            "quarantine": kept_aside,
            "ctl": control_of_counts(reconciled),
            "reconciliation": reconciled,
        },
        streams=streams,
        checks=checks,
        counts=counts,
    )


def _compact_now_and_then(counts: CountTable, streams: Mapping[str, StreamResult]) -> None:
    """Compact the counts when one of their queries has come to another `COMPACT_EVERY` batches."""
    own = [stream for stream in streams.values() if stream.table == counts.name]
    taken = [number for stream in own for number, batch in stream.batches.items() if batch["numInputRows"]]
    if any(number % COMPACT_EVERY == COMPACT_EVERY - 1 for number in taken):
        counts.compact()


def run_union_flow(
    tables: StreamTables,
    sources: Sequence[LandingSource],
    silver_table: str,
    silver_rules: Rules,
    control_table: str | None = None,
    rechecks: Mapping[str, Rules] | None = None,
    at: Column | None = None,
) -> FlowResult:
    """Many landing folders into one checked table.

    Each source fills its bronze table, with its rules applied by its policy;
    silver is the union of all of them without the rows that break a silver rule.
    ``rechecks`` names tables that copy silver and count more rules; with a
    ``control_table`` the result has silver's rows per file under that name.

    Silver and the tables made of it have a part per source, each filled by a query
    of its own. So sources may be added, left out or put in another order from run
    to run; rows of a source that is left out stay. Sources with columns of the
    same types in the same order are united by position, others by name: silver
    has all columns, NULL where a source lacks one.
    """
    spark = tables.spark
    if len({s.table for s in sources}) < len(sources):
        raise ValueError("two sources of a union flow fill one table")
    rechecks = rechecks or {}
    opened = {s.table: s.open(spark, at) for s in sources}
    counts = CountTable(tables, f"{silver_table}_counts")
    tables.registry.declare_all(
        [(s.table, opened[s.table].schema, "") for s in sources] + [(counts.name, COUNTS_SCHEMA, s.table) for s in sources]
    )
    done = settle(*[tables.append(s.checked(opened[s.table]), s.table) for s in sources])

    known = tables.registry.get(silver_table)
    first = known.schema if known else tables.registry.get(sources[0].table).schema

    def bronze(s: LandingSource, also: Mapping[str, Column] | None = None) -> DataFrame:
        rows = tables.stream(s.table, None, s.max_bytes, s.max_files)
        alike = [f.dataType for f in rows.schema.fields] == [f.dataType for f in first.fields]
        names = first.fieldNames() if alike else rows.columns
        return rows.withColumns(also or {}).toDF(*names, *(also or ()))

    tables.registry.declare_all(
        [(name, bronze(s).schema, s.table) for s in sources for name in (silver_table, *rechecks)]
    )

    def verdicts(rules: Rules) -> dict[str, Column]:
        return {name: passes(predicate) for name, predicate in rules.items()}

    def counted(s: LandingSource) -> tuple[DataFrame, list[Judged]]:
        # The source's own rules speak of its own columns, so they are judged before those are renamed.
        landed = {f"_landed{i}": verdict for i, verdict in enumerate(verdicts(s.rules).values())}
        in_silver = passes(" AND ".join(f"({p})" for p in silver_rules.values()) or "true")
        return bronze(s, landed), [
            Judged(s.table, {name: F.col(c) for name, c in zip(s.rules, landed, strict=True)}),
            Judged(silver_table, verdicts(silver_rules), drops=True),
            *[Judged(name, verdicts(rules), among=in_silver) for name, rules in rechecks.items()],
        ]

    # Silver and the counts are made of the same rows of bronze, side by side.
    counts.check_clock([s.table for s in sources])
    done += settle(
        *[tables.append(expect_drop(bronze(s), silver_rules, silver_table), silver_table, part=s.table) for s in sources],
        *[counts.append(*counted(s), s.table) for s in sources],
    )
    done += settle(
        *[
            tables.append(
                expect_keep(tables.stream(silver_table, None, s.max_bytes, s.max_files, part=s.table), rules, name), name, part=s.table
            )
            for name, rules in rechecks.items()
            for s in sources
        ]
    )
    streams = {stream.name: stream for stream in done}
    checks = [CheckedStream(streams[s.table], s.rules, drops=False) for s in sources]
    checks += [CheckedStream(streams[f"{silver_table}@{s.table}"], silver_rules, drops=True) for s in sources]
    checks += [
        CheckedStream(streams[f"{name}@{s.table}"], rules, drops=False) for name, rules in rechecks.items() for s in sources
    ]
    _compact_now_and_then(counts, streams)
    for name in (silver_table, *rechecks):
        streams[name] = _together(name, [streams[f"{name}@{s.table}"] for s in sources])
    filled = {name: tables.read(name) for name in (*opened, silver_table, *rechecks)}
    if control_table:
        filled[control_table] = (
            counts.sums()
            .where((F.col("dataset") == silver_table) & (F.col("kept") > 0))
            .select(F.col(FILE_COLUMN).alias("fileName"), F.col("kept").alias("records"), ENTITY_COLUMN, DATE_COLUMN, TIME_COLUMN)
        )
    return FlowResult(filled, streams, checks, counts)


def _together(name: str, parts: Sequence[StreamResult]) -> StreamResult:
    """What the queries of all parts of a table did, as one result."""
    batches = [batch for part in parts for _, batch in sorted(part.batches.items())]
    return StreamResult(name, ",".join(part.query_id for part in parts), dict(enumerate(batches)))
