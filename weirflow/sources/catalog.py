"""Catalog objects: databases, tables over a path, control tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .complete import CompleteTable


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def register_external(
    spark: SparkSession, table: str, location: str, file_format: str = "parquet"
) -> None:
    """Make the files under ``location`` readable as a table."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {file_format} LOCATION {_text(location)}")


def publish_stream_table(
    spark: SparkSession,
    name: str,
    path: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Make a table filled by a stream readable by name.

    It is a view on the path, not a table over it: reading the path honours the
    log of the stream's commits, so files of a failed attempt are not counted.
    """
    note = f" COMMENT {_text(comment)}" if comment else ""
    more = f" TBLPROPERTIES ({_properties(properties)})" if properties else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{note}{more} AS SELECT * FROM parquet.`{path}`")


def save_table(
    df: DataFrame,
    table: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Replace a complete table of the catalog by ``df``, with its comment and properties.

    The rows go to a new version in the folder of the database (`CompleteTable`);
    then one statement points the name at it. So the name can be read at any time
    and shows all old rows or all new ones, under the columns and the comment that
    belong to them, also after a write that failed half way. The name is a view:
    such a table is only ever replaced, never written into.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    where = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    rows = CompleteTable(spark, f"{where.rstrip('/')}/{name.strip('`')}.complete")
    version = rows.stage(df)
    # The pointer first: what the name shows is then never the folder to be written next.
    rows.switch(version)
    publish_stream_table(spark, table, rows.folder(version), comment, properties)


def create_control_table(spark: SparkSession, table: str) -> None:
    """The table that maps a target table to its rules as a JSON object."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (TableName STRING, Expectations STRING) USING parquet"
    )


def replace_control_rows(spark: SparkSession, table: str, rules: Mapping[str, str]) -> None:
    """Replace all rows of the control table by one per target, in one statement."""
    rows = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in rules.items())
    given = f"VALUES {rows}" if rows else "SELECT '', '' WHERE false"
    spark.sql(f"INSERT OVERWRITE TABLE {table} {given}")
