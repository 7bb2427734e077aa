from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from weirflow.functions import (
    has_length,
    has_precision_and_scale,
    register_checks,
    register_python_check,
    register_sql_check,
)


@pytest.mark.parametrize("text, ok", [("ES", True), ("ESP", False), (None, False), ("ñé", True), ("", False)])
def test_length(spark, text, ok):
    register_checks(spark)
    df = spark.createDataFrame([(text,)], "s STRING")
    found = df.select(has_length("s", 2), F.expr("is_valid_col(s, 2)")).first()
    assert tuple(found) == (ok, ok)


@pytest.mark.parametrize(
    "text, precision, scale, ok",
    [
        ("1234", 4, 0, True),
        ("123", 4, 0, False),
        ("12.34", 4, 2, True),
        ("1,234", 4, 0, True),
        ("-12.340", 4, 2, True),
        ("0", 1, 0, True),
        ("0.5", 2, 1, True),
        (".5", 2, 1, True),
        ("5.", 1, 0, True),
        ("1e3", 4, 0, True),
        ("0.05", 3, 2, True),
        ("9.99999999999999", 1, 0, True),
        ("9.99999999999999999", 2, 0, True),
        ("12.3", 4, 1, False),
        ("12.3", 3, 0, False),
        ("1234567890123", 13, 0, True),
        ("12345678901234", 14, 0, False),
        ("123456789012345", 15, 0, False),
        ("1e20", 21, 0, False),
        ("1.5d", 2, 1, False),
        ("0x10", 2, 0, False),
        ("inf", 1, 0, False),
        ("nan", 1, 0, False),
        ("abc", 4, 0, False),
        ("", 4, 0, False),
        (None, 4, 0, False),
        ("1", 0, 0, False),
        ("1", 1, -1, False),
    ],
)
def test_precision_cases(spark, text, precision, scale, ok):
    register_checks(spark)
    df = spark.createDataFrame([(text,)], "x STRING")
    found = df.select(
        has_precision_and_scale("x", precision, scale),
        F.expr(f"is_valid_precision_and_scale(x, {precision}, {scale})"),
    ).first()
    assert tuple(found) == (ok, ok)


def digits(text: str) -> tuple[int, int]:
    """Precision and scale counted in exact decimal arithmetic."""
    size = abs(Decimal(text))
    whole = len(str(int(size)))
    rounded = size.quantize(Decimal(1).scaleb(whole - 14), ROUND_HALF_UP)
    scale = max(-(rounded - int(rounded)).normalize().as_tuple().exponent, 0)
    return whole + scale, scale


def test_precision_of_random_numbers_against_brute_force(spark):
    draw = random.Random(3)
    texts = []
    for _ in range(4000):
        whole = draw.randrange(10 ** draw.randrange(0, 8))
        places = draw.randrange(0, 6)
        texts.append(f"{draw.choice(['', '-'])}{whole}.{draw.randrange(10**places):0{places}d}" if places
                     else str(whole))
    df = spark.createDataFrame([(t, float(t)) for t in texts], "t STRING, d DOUBLE")
    pairs = [(1, 0), (4, 0), (4, 2), (5, 3), (7, 2), (9, 4), (6, 5)]
    found = df.select(
        "t",
        *[has_precision_and_scale("t", p, s).alias(f"t{p}_{s}") for p, s in pairs],
        *[has_precision_and_scale("d", p, s, numeric=True).alias(f"d{p}_{s}") for p, s in pairs],
    ).collect()
    seen = {pair: 0 for pair in pairs}
    for row in found:
        for p, s in pairs:
            expected = digits(row["t"]) == (p, s)
            seen[p, s] += expected
            assert row[f"t{p}_{s}"] == expected, (row["t"], p, s)
            assert row[f"d{p}_{s}"] == expected, (row["t"], p, s)
    assert all(seen.values())


def test_numeric_arguments(spark):
    register_checks(spark)
    df = spark.sql("SELECT 1234 AS i, 12.50D AS d, CAST(12.50 AS DECIMAL(10,2)) AS e")
    found = df.selectExpr(
        "is_valid_precision_and_scale(i, 4, 0)",
        "is_valid_precision_and_scale(d, 3, 1)",
        "is_valid_precision_and_scale(e, 3, 1)",
    ).first()
    assert tuple(found) == (True, True, True)


def test_column_with_a_strange_name(spark):
    df = spark.createDataFrame([("1.5",)], "`a ``b.c` STRING")
    assert df.select(has_precision_and_scale("a `b.c", 2, 1)).first()[0] is True


def test_checks_of_users(spark):
    register_sql_check(spark, "is_even", "n BIGINT", "n % 2 = 0")
    register_python_check(spark, "is_palindrome", lambda s: s is not None and s == s[::-1])
    df = spark.createDataFrame([(2, "abba"), (3, "ab"), (4, None)], "n INT, s STRING")
    found = df.selectExpr("is_even(n) AS e", "is_palindrome(s) AS p").collect()
    assert [tuple(r) for r in found] == [(True, True), (False, False), (True, False)]


def test_shipped_checks_start_no_python_worker(spark, plan):
    register_checks(spark)
    df = spark.range(5).selectExpr("CAST(id AS STRING) AS x")
    text = plan(df.filter("is_valid_precision_and_scale(x, 1, 0) AND is_valid_col(x, 1)"))
    assert "Python" not in text
    assert "*(1) Filter" in text
