"""Counts of rows and rules kept up to date by streams of their own, at the cost of the new rows.

What a table holds is counted once, when it is new: a stream over the table's
committed files appends, per task, how many rows each input file gave and how
many of them meet each rule. These deltas are summed when read. They are as
exactly-once as any other stream table, so a lost driver loses no counts: the
next run goes on where the last commit left off.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.transforms import DATE_COLUMN, ENTITY_COLUMN, FILE_COLUMN, TIME_COLUMN
from ..sources.complete import CompleteTable, Pointer
from .tables import StreamTables

KEYS = (FILE_COLUMN, ENTITY_COLUMN, DATE_COLUMN, TIME_COLUMN)
SIDES = ("records", "kept", "ids", "kept_ids")

DELTAS = (
    T.StructType()
    .add("dataset", "string")
    .add("drops", "boolean")
    .add(FILE_COLUMN, "string")
    .add(ENTITY_COLUMN, "string")
    .add(DATE_COLUMN, "date")
    .add(TIME_COLUMN, "timestamp")
    .add("records", "long")
    .add("kept", "long")
    .add("ids", "long")
    .add("kept_ids", "long")
    .add("rules", T.ArrayType(T.StructType().add("name", "string").add("passed_records", "long")))
)

#: The stored deltas: whose they are, and when they were made.
SCHEMA = T.StructType([*DELTAS.fields, *T.StructType().add("source", "string").add("batch", "timestamp").add("day", "date").fields])

#: Groups that a task holds before it brings its partial counts together.
_HELD = 100_000


@dataclass(frozen=True)
class Judged:
    """One way to look at the rows of a stream: as rows of ``dataset``, by verdicts that are never NULL.

    ``drops`` says that the dataset holds only the rows that all verdicts let pass;
    ``among`` (never NULL either), which of the stream's rows are judged at all.
    """

    dataset: str
    verdicts: Mapping[str, Column]
    drops: bool = False
    among: Column | None = None


def count_deltas(rows: DataFrame, judged: Sequence[Judged], id_column: str | None = None) -> DataFrame:
    """Partial counts of each task, a row per input file, ingestion and dataset: `DELTAS`.

    Only the keys and the verdicts, as 0 or 1, leave the generated code.
    """
    names = [list(j.verdicts) for j in judged]
    has_id = F.col(id_column).isNotNull() if id_column else F.lit(True)
    bits = {"_id": has_id}
    for i, j in enumerate(judged):
        bits[f"_n{i}"] = F.lit(True) if j.among is None else j.among
        bits |= {f"_d{i}_{k}": verdict for k, verdict in enumerate(j.verdicts.values())}
    plain = rows.select(*KEYS, *[bit.cast("long").alias(c) for c, bit in bits.items()])
    for i, j in enumerate(judged):
        own = [f"_d{i}_{k}" for k in range(len(j.verdicts))]
        plain = plain.withColumns({c: F.col(c) * F.col(f"_n{i}") for c in own})
        kept = reduce(lambda x, y: x * y, [F.col(c) for c in own], F.col(f"_n{i}"))
        plain = plain.withColumns({f"_kept{i}": kept, f"_ids{i}": F.col(f"_n{i}") * F.col("_id"), f"_kept_ids{i}": kept * F.col("_id")})
    plain = plain.drop("_id")
    counters = [c for c in plain.columns if c not in KEYS]
    datasets = [(j.dataset, j.drops) for j in judged]

    def summed(tables: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(tables).group_by(list(KEYS), use_threads=False).aggregate([(c, "sum") for c in counters])
        return found.rename_columns([c.removesuffix("_sum") for c in found.column_names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(summed([pa.Table.from_batches([batch])]))
                size += held[-1].num_rows
                if size > _HELD:
                    held = [summed(held)]
                    size = held[0].num_rows
        for group in summed(held).to_pylist() if held else []:
            for i, (dataset, drops) in enumerate(datasets):
                told = [{"name": name, "passed_records": group[f"_d{i}_{k}"]} for k, name in enumerate(names[i])]
                counts = tuple(group[f"_{c}{i}"] for c in ("n", "kept", "ids", "kept_ids"))
                if not counts[0]:
                    continue
                yield _row((dataset, drops, *(group[k] for k in KEYS), *counts, told))

    return plain.mapInArrow(run, DELTAS)


_ARROW = pa.schema(
    [
        ("dataset", pa.string()),
        ("drops", pa.bool_()),
        (FILE_COLUMN, pa.string()),
        (ENTITY_COLUMN, pa.string()),
        (DATE_COLUMN, pa.date32()),
        (TIME_COLUMN, pa.timestamp("us", "UTC")),
        *((c, pa.int64()) for c in SIDES),
        ("rules", pa.list_(pa.struct([("name", pa.string()), ("passed_records", pa.int64())]))),
    ]
)


def _row(values: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _ARROW, strict=True)], schema=_ARROW)


@dataclass(frozen=True)
class CountTable:
    """The deltas of a flow: a stream table with a part per counted stream.

    ``batch`` is the moment of the micro-batch that made a delta. It is the same
    when a batch is replayed and rises within a part, so it names the batch; and
    what has been logged or compacted can be told by one moment per part.
    """

    tables: StreamTables
    name: str

    def append(
        self, rows: DataFrame, judged: Sequence[Judged], part: str, id_column: str | None = None
    ) -> StreamingQuery:
        """Count the new rows of a stream, as a part of this table."""
        deltas = (
            count_deltas(rows, judged, id_column)
            .withColumn("source", F.lit(part))
            .withColumn("batch", F.current_timestamp())
            .withColumn("day", F.to_date("batch"))
        )
        return self.tables.append(deltas, self.name, partition_by=["day"], part=part)

    def check_clock(self, parts: Iterable[str]) -> None:
        """Refuse to count while the clock stands before a batch that was logged or compacted."""
        for marks in (_marks(self._sums().pointer), _marks(self._logged())):
            late = [part for part in parts if marks.get(part, 0) >= time.time() * 1e6]
            if late:
                raise RuntimeError(f"the clock stands before the last counts of {', '.join(late)} that were taken in")

    def sums(self) -> DataFrame:
        """Per dataset, file and ingestion: ``records``, ``kept``, ``ids`` and ``kept_ids``."""
        compacted = self._sums()
        now = compacted.current()
        rows = self._after(json.loads(now[1]) if now else {}).select("dataset", *KEYS, *SIDES)
        if now is not None:
            rows = rows.unionByName(compacted.read())
        return rows.groupBy("dataset", *KEYS).agg(*[F.sum(c).alias(c) for c in SIDES])

    def compact(self) -> None:
        """Sum up all deltas there are, so that `sums` has only newer ones to read.

        The deltas stay where they are; whole days of them are no longer opened.
        Not to be called while a stream fills the table.
        """
        marks = {r["source"]: r["mark"] for r in self._last_batches().collect()}
        self._sums().replace(self.sums(), json.dumps(marks))

    def events(self) -> tuple[DataFrame, str] | None:
        """A flow-progress event per batch not yet marked as logged, and the mark that says so.

        None if there is none. Rows are (event_id, timestamp, flow_name, details, day). Part and moment of
        a batch make its id, so it has one id whoever reports it and how often.
        """
        marks = _marks(self._logged())
        deltas = self._after(marks)
        last = {r["source"]: r["mark"] for r in self._last_batches(deltas).collect()}
        if not last:
            return None
        keys = ["dataset", "drops", "source", "batch", "day"]
        each = (
            deltas.select(*keys, "records", "kept", F.posexplode_outer("rules").alias("at", "rule"))
            .select(*keys, "records", "kept", "at", "rule.name", "rule.passed_records")
            .groupBy(*keys, "at", "name")
            .agg(*[F.sum(c).alias(c) for c in ("records", "kept", "passed_records")])
        )
        failed = (F.col("records") - F.col("passed_records")).alias("failed_records")
        rule = F.struct("at", "name", "dataset", "passed_records", failed)
        whole = each.groupBy(*keys).agg(
            F.max("records").alias("records"),
            F.max("kept").alias("kept"),
            F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), rule))).alias("rules"),
        )
        dropped = F.when(F.col("drops"), F.col("records") - F.col("kept")).otherwise(F.lit(0).cast("long"))
        expectations = F.transform(
            "rules", lambda r: F.struct(*[r[c].alias(c) for c in ("name", "dataset", "passed_records", "failed_records")])
        )
        progress = F.struct(
            F.struct((F.col("records") - dropped).alias("num_output_rows")).alias("metrics"),
            F.struct(dropped.alias("dropped_records"), expectations.alias("expectations")).alias("data_quality"),
        )
        moment = F.unix_micros("batch").cast("string")
        told = whole.select(
            F.concat_ws(":", "dataset", "source", moment).alias("event_id"),
            F.date_format("batch", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
            F.col("dataset").alias("flow_name"),
            F.to_json(F.struct(progress.alias("flow_progress"))).alias("details"),
            "day",
        )
        return told, json.dumps(marks | last)

    def mark_logged(self, mark: str) -> None:
        """Note that the events `events` gave are stored; those of later batches come next."""
        now = self._logged().current()
        self._logged().set(now[0] + 1 if now else 0, mark)

    def _sums(self) -> CompleteTable:
        return CompleteTable(self.tables.spark, self.tables.path(f"{self.name}_compacted"))

    def _logged(self) -> Pointer:
        return Pointer(self.tables.spark, self.tables.path(f"{self.name}_logged"))

    def _last_batches(self, deltas: DataFrame | None = None) -> DataFrame:
        rows = self.tables.read(self.name) if deltas is None else deltas
        return rows.groupBy("source").agg(F.max(F.unix_micros("batch")).alias("mark"))

    def _after(self, marks: Mapping[str, int]) -> DataFrame:
        """Deltas of batches behind the marks of their parts; whole days before all marks are not read."""
        rows = self.tables.read(self.name)
        if not marks:
            return rows
        known = F.create_map(*[F.lit(x) for pair in marks.items() for x in pair])
        rows = rows.where(F.unix_micros("batch") > F.coalesce(known[F.col("source")], F.lit(0)))
        if set(self.tables.parts(self.name)) <= marks.keys():
            rows = rows.where(F.col("day") >= F.to_date(F.timestamp_micros(F.lit(min(marks.values())))))
        return rows


def _marks(pointer: Pointer) -> dict[str, int]:
    """The last batch of each part that was taken in, in microseconds."""
    now = pointer.current()
    return json.loads(now[1]) if now else {}
