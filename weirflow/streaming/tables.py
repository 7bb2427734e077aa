"""Tables that streams append to, and the waiting for those streams."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.expectations import KEPT, TOTAL, metric_tuples
from ..operators.transforms import union_all
from ..plans.rules import Rules
from ..sources.complete import CompleteTable
from .registry import Definition, Registry, as_declared

OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

EVENT_SCHEMA = "event_id STRING, timestamp STRING, flow_name STRING, details STRING"


class StreamTables:
    """Parquet tables under one storage root, each with the checkpoint of its stream.

    Every table is filled by one file-sink query in append mode. The sink's
    commit log and the checkpoint make a re-run, or a run after a lost executor
    or driver, add each input row exactly once.

    A table can also be made of parts, each with a query, commit log and checkpoint
    of its own: one per source. Sources can then come, go and change their order,
    since no query knows of any source but its own. Readers see all parts as one.

    The columns of a table may grow. `Registry` remembers them; writers give rows
    all columns of the table, readers show NULL where older rows lack one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.registry = Registry(spark, f"{self.root}/registry")

    def path(self, name: str, part: str = "") -> str:
        return f"{self.root}/tables/{name}" + (f"/{part}" if part else "")

    def checkpoint(self, name: str, part: str = "") -> str:
        return f"{self.root}/checkpoints/{name}" + (f"/{part}" if part else "")

    def parts(self, name: str) -> tuple[str, ...]:
        """The parts of a table, in the order in which they came."""
        known = self.registry.get(name)
        return known.parts if known else ()

    def append(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        path: str | None = None,
        file_format: str = "parquet",
        part: str = "",
    ) -> StreamingQuery:
        """Start a triggered query: take in what is new, then stop.

        The rows may lack columns of the table or bring new ones. With a ``path``
        the rows go to files outside the tables, as they are.
        """
        if path is None:
            df = as_declared(df, self.registry.declare(name, df.schema, part).schema)
        writer = (
            df.writeStream.format(file_format)
            .queryName(f"{self.root}/{name}{'@' if part else ''}{part}")
            .outputMode("append")
            .option("checkpointLocation", self.checkpoint(name, part))
            .trigger(availableNow=True)
        )
        target = path or self.path(name, part)
        if not partition_by:
            return writer.start(target)
        # A few partition values can each keep a file open; the default is to
        # sort every row by them first. The query takes its settings when it
        # starts, so the caller's are put back at once.
        kept = self.spark.conf.get(OPEN_WRITERS)
        self.spark.conf.set(OPEN_WRITERS, max(int(kept), 8))
        try:
            return writer.partitionBy(*partition_by).start(target)
        finally:
            self.spark.conf.set(OPEN_WRITERS, kept)

    def stream(
        self,
        name: str,
        schema: T.StructType | None = None,
        max_bytes: int | None = None,
        max_files: int | None = None,
        part: str = "",
    ) -> DataFrame:
        """The table, or one part of it, as an incremental source: rows this reader has not read yet.

        Its columns are those the table has now, or those of ``schema``.
        """
        if schema is None:
            schema = self._known(name).schema
        reader = self.spark.readStream.schema(schema)
        if max_bytes is not None:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path(name, part))

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """All rows of the table now, of all its parts, with the columns it has now or those of ``schema``."""
        known = self.registry.get(name)
        if known is None:
            complete = CompleteTable(self.spark, self.path(name))
            if schema is None and complete.current() is not None:
                return complete.read()
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(self.path(name))
        reader = self.spark.read.schema(schema or known.schema)
        return union_all([reader.parquet(self.path(name, part)) for part in known.parts or ("",)])

    def view(self, name: str, view: str) -> DataFrame:
        """`read`, and a view of this session under which SQL finds the same rows."""
        rows = self.read(name)
        rows.createOrReplaceTempView(view)
        return rows

    def replace(self, df: DataFrame, name: str) -> DataFrame:
        """Write a complete table: all of it, in place of what was there (`CompleteTable`)."""
        return CompleteTable(self.spark, self.path(name)).replace(df)

    def _known(self, name: str) -> Definition:
        known = self.registry.get(name)
        if known is None:
            raise ValueError(f"no stream has filled table {name} yet: give its schema")
        return known


@dataclass
class StreamResult:
    """What one triggered query did: its id and the progress of each batch.

    ``name`` is that of the table, followed by ``@`` and the part for a part of one.
    """

    name: str
    query_id: str
    batches: dict[int, dict] = field(default_factory=dict)

    @property
    def table(self) -> str:
        return self.name.partition("@")[0]

    @property
    def input_rows(self) -> int:
        return sum(batch["numInputRows"] for batch in self.batches.values())


@dataclass(frozen=True)
class CheckedStream:
    """A stream whose rules were counted under the name of the table it fills."""

    stream: StreamResult
    rules: Rules
    drops: bool

    def _observed(self) -> list[tuple[int, dict]]:
        name = self.stream.table
        return [
            (number, batch["observedMetrics"][name].asDict())
            for number, batch in sorted(self.stream.batches.items())
            if name in batch["observedMetrics"]
        ]

    def metric_rows(self) -> list[tuple[str, str, int, int]]:
        """Passed and failed counts per rule, summed over the batches of this run."""
        sums = {name: [0, 0] for name in self.rules}
        for _, seen in self._observed():
            for name, _, passed, failed in metric_tuples(seen, self.rules, self.stream.table):
                sums[name][0] += passed
                sums[name][1] += failed
        return [
            (name, self.stream.table, passed, failed) for name, (passed, failed) in sums.items()
        ]

    def events(self) -> list[tuple[str, str, str, str]]:
        """One flow-progress event per batch, as rows of `EVENT_SCHEMA`.

        Query and batch number make the event id, so a batch has one id however
        often it is reported.
        """
        rows = []
        for number, seen in self._observed():
            dropped = seen[TOTAL] - seen[KEPT] if self.drops else 0
            expectations = [
                {"name": name, "dataset": dataset, "passed_records": ok, "failed_records": ko}
                for name, dataset, ok, ko in metric_tuples(seen, self.rules, self.stream.table)
            ]
            details = {
                "flow_progress": {
                    "metrics": {"num_output_rows": seen[TOTAL] - dropped},
                    "data_quality": {"dropped_records": dropped, "expectations": expectations},
                }
            }
            rows.append(
                (
                    f"{self.stream.query_id}:{number}",
                    self.stream.batches[number]["timestamp"],
                    self.stream.name,
                    json.dumps(details),
                )
            )
        return rows


def settle(*queries: StreamingQuery) -> list[StreamResult]:
    """Wait for triggered queries that run side by side.

    Progress is gathered while they run, since a query keeps only its latest
    batches; if some still were missed the counts would be too low, and an error
    is raised. If one fails the others are stopped and its error is raised.
    """
    results = [StreamResult(q.name.rsplit("/", 1)[-1], str(q.id)) for q in queries]
    pending = list(range(len(queries)))
    try:
        while pending:
            for i in list(pending):
                ended = queries[i].awaitTermination(0.2)
                for progress in queries[i].recentProgress:
                    _note(results[i], progress)
                if ended:
                    pending.remove(i)
    except BaseException:
        for i in pending:
            queries[i].stop()
        raise
    for result in results:
        seen = result.batches.keys()
        if seen and len(seen) <= max(seen) - min(seen):
            raise RuntimeError(
                f"progress of batches of {result.name} was missed; raise"
                " spark.sql.streaming.numRecentProgressUpdates or make batches larger"
            )
    return results


def _note(result: StreamResult, progress: dict) -> None:
    # An idle trigger repeats the number of the last batch, with nothing in it.
    known = result.batches.get(progress["batchId"])
    if known is None or not known["observedMetrics"] and not known["numInputRows"]:
        result.batches[progress["batchId"]] = progress
