"""Rule sets: ordered maps from rule name to a SQL predicate."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

Rules = Mapping[str, str]

RULE_FILE_SCHEMA = "name STRING, constraint STRING, tag STRING"

def publish_rules(spark: SparkSession, entries: Iterable[tuple[str, str, str]], path: str) -> None:
    """Write ``(name, constraint, tag)`` entries as one CSV file with a header."""
    entries = list(entries)
    (
        spark.createDataFrame(entries, RULE_FILE_SCHEMA)
        .coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def rules_from_csv(spark: SparkSession, path: str, tag: str) -> dict[str, str]:
    """The rules of one tag, in order of file name and line; a later one of the same name wins.

    Rules come to the driver because they become parts of a plan. A tag without
    any rule is an error: nothing would be checked.
    """
    rows = (
        spark.read.option("header", True)
        .csv(path)
        .filter(F.col("tag") == tag)
        .select(
            "name",
            "constraint",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        .collect()
    )
    rules: dict[str, str] = {}
    # Within one part of one file the row numbers follow the lines.
    for row in sorted(rows, key=lambda r: (r["file"], r["block"], r["row"])):
        if row["name"] in rules:
            log.warning("%s: rule %r of tag %r is given twice; the later one holds",
                        path, row["name"], tag)
        rules[row["name"]] = row["constraint"]
    if not rules:
        raise KeyError(f"{path}: no rule under tag {tag!r}")
    return rules


def rules_from_control_table(
    spark: SparkSession,
    table: str,
    name: str,
    name_column: str = "TableName",
    rules_column: str = "Expectations",
) -> dict[str, str]:
    """The rules a control table holds for ``name`` as a JSON object name -> SQL.

    Two rows for one name are an error: either could be meant.
    """
    found = (
        spark.table(table)
        .filter(F.col(name_column) == name)
        .select(F.from_json(rules_column, "map<string,string>").alias("rules"))
        .take(2)
    )
    if not found:
        raise KeyError(f"{table} has no row for {name!r}")
    if len(found) > 1:
        raise ValueError(f"{table} has several rows for {name!r}")
    row = found[0]
    if row["rules"] is None:
        raise ValueError(f"{table}: the rules of {name!r} are no JSON object")
    return dict(row["rules"])


def rules_from_constraints(constraints: Iterable[str]) -> dict[str, str]:
    """Rules that carry their own text as name."""
    return {constraint: constraint for constraint in constraints}


def validate_rules(df: DataFrame, rules: Rules) -> None:
    """Check, without running anything, that each rule is a predicate over ``df``."""
    for name, predicate in rules.items():
        try:
            checked = df.select(F.expr(predicate).alias("rule")).schema["rule"].dataType
        except Exception as error:
            raise ValueError(f"rule {name!r} ({predicate}) does not fit the data: {error}") from error
        if not isinstance(checked, T.BooleanType):
            raise ValueError(f"rule {name!r} ({predicate}) is {checked.simpleString()}, not boolean")
