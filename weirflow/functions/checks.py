"""Column checks that rule text may call by name.

The shipped checks are SQL functions: Spark inlines their body, so a rule that
calls them stays inside whole-stage codegen and never starts a Python worker.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Significant digits the precision check looks at (fixed value).
MAX_DIGITS = 14

# What counts as a number: no `d`/`f` suffix, no hex, no `inf` or `nan`, all of
# which a plain cast would let through.
NUMBER = r"^\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$"

_LENGTH_SQL = "coalesce(length({s}) = {n}, false)"


def _precision_sql(value: str, precision: str, scale: str, guard: str = "true") -> str:
    """SQL for "the double `value` has exactly this precision and this scale".

    Both together fix how many digits the whole part must have, so the size of
    the last digit looked at is a constant. The fraction, counted in units of
    that digit (rounded half up), must then be a multiple of the last wanted
    decimal place and of no earlier one.
    """
    whole = f"({precision} - {scale})"
    size = f"abs({value})"
    units = (
        f"CAST(floor(pow(10D, {MAX_DIGITS} - {whole}) * ({size} - floor({size})) + 0.5D) AS BIGINT)"
    )
    place = f"CAST(pow(10D, greatest({MAX_DIGITS} - {precision}, 0)) AS BIGINT)"
    return (
        f"coalesce({whole} BETWEEN 1 AND {MAX_DIGITS - 1}"
        f" AND {scale} >= 0 AND {precision} <= {MAX_DIGITS}"
        f" AND {size} < pow(10D, {whole})"
        f" AND ({whole} = 1 OR {size} >= pow(10D, {whole} - 1))"
        f" AND {units} % {place} = 0"
        f" AND ({scale} = 0 OR {units} % (10 * {place}) != 0)"
        f" AND {guard}, false)"
    )


def _text_precision_sql(text: str, precision: str, scale: str) -> str:
    plain = f"replace({text}, ',', '')"
    return _precision_sql(
        f"try_cast({plain} AS DOUBLE)", precision, scale, f"{plain} RLIKE '{NUMBER}'"
    )


def has_length(column: Column | str, length: int) -> Column:
    """True when the text has exactly ``length`` characters; NULL gives false."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.length(column) == F.lit(length), F.lit(False))


def has_precision_and_scale(
    column: str, precision: int, scale: int, numeric: bool = False
) -> Column:
    """True when the number has exactly that many digits in all and after the point.

    Trailing zeros after the point do not count; thousands commas are ignored.
    NULL, text that is no number and whole parts of 14 digits or more give false.
    Set ``numeric`` for a column that already holds numbers: no text is parsed then.
    """
    kind, check = ("DOUBLE", _precision_sql) if numeric else ("STRING", _text_precision_sql)
    name = column.replace("`", "``")
    return F.expr(check(f"CAST(`{name}` AS {kind})", str(precision), str(scale)))


def register_sql_check(spark: SparkSession, name: str, parameters: str, body: str) -> None:
    """Register a check written in SQL, e.g. ``("is_even", "n BIGINT", "n % 2 = 0")``."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS BOOLEAN RETURN {body}"
    )


def register_python_check(spark: SparkSession, name: str, check: Callable[..., bool]) -> None:
    """Register a check only Python can express; rows travel in Arrow batches."""
    spark.udf.register(name, F.udf(check, "boolean", useArrow=True))


def register_vector_check(
    spark: SparkSession, name: str, check: Callable[..., pd.Series]
) -> None:
    """Register a Python check on whole columns: pandas series in, a series of booleans out."""
    spark.udf.register(name, F.pandas_udf(check, "boolean"))


def register_checks(spark: SparkSession) -> None:
    """Make the shipped checks callable from rule text. The names are fixed values."""
    register_sql_check(
        spark, "is_valid_col", "s STRING, n INT", _LENGTH_SQL.format(s="s", n="n")
    )
    register_sql_check(
        spark,
        "is_valid_precision_and_scale",
        "x STRING, p INT, s INT",
        _text_precision_sql("x", "p", "s"),
    )
