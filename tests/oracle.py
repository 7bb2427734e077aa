"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def spark_rows(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect())


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in found.fetchall())
    return [names[i] for i in order], rows


def difference(df, connection, sql: str) -> str | None:
    """What differs, in words; None if nothing does."""
    columns, ours = spark_rows(df)
    theirs_columns, theirs = sql_rows(connection, sql)
    if columns != theirs_columns:
        return f"columns {columns} against {theirs_columns}"
    if ours != theirs:
        return (
            f"{ours.total()} rows against {theirs.total()};"
            f" only ours {list((ours - theirs).items())[:3]},"
            f" only theirs {list((theirs - ours).items())[:3]}"
        )
    return None
