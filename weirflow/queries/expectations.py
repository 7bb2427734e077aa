"""Expectation policies and check functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    has_length,
    has_precision_and_scale,
    register_checks,
    register_vector_check,
)
from ..operators import (
    alerts,
    expect_drop,
    expect_fail,
    expect_keep,
    quarantine,
    rule_metrics,
    rule_metrics_by,
)
from .inputs import (
    BRONZE_SQL,
    INVOICE_COLUMNS,
    INVOICE_FAILED_SQL,
    INVOICE_RULES,
    INVOICE_RULES_SQL,
    bronze,
    table,
)
from .registry import query

COLUMNS_SQL = ", ".join(INVOICE_COLUMNS)

RULE_ROWS_SQL = """
    SELECT {keys}'existing_customer' AS name, CAST('bronze' AS VARCHAR) AS dataset,
      count(*) FILTER (customer_id IS NOT NULL) AS passed_records,
      count(*) FILTER (customer_id IS NULL) AS failed_records
    FROM bronze {group}
    UNION ALL
    SELECT {keys}'valid_invoice', 'bronze', count(*) FILTER (description != '5-LOW'),
      count(*) FILTER (NOT coalesce(description != '5-LOW', false))
    FROM bronze {group}
    UNION ALL
    SELECT {keys}'worthwhile', 'bronze', count(*) FILTER (price > 1500),
      count(*) FILTER (NOT coalesce(price > 1500, false))
    FROM bronze {group}"""


@query(f"WITH {BRONZE_SQL} SELECT {COLUMNS_SQL} FROM bronze WHERE {INVOICE_RULES_SQL}")
def expect_drop_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect_drop(bronze(spark, sf_dir), INVOICE_RULES).select(*INVOICE_COLUMNS)


@query(f"WITH {BRONZE_SQL} SELECT {COLUMNS_SQL} FROM bronze WHERE {INVOICE_RULES_SQL}")
def expect_drop_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with the violations counted in the same pass."""
    counted = Observation("expect_drop_observed")
    return expect_drop(bronze(spark, sf_dir), INVOICE_RULES, counted).select(*INVOICE_COLUMNS)


@query(f"WITH {BRONZE_SQL} SELECT {COLUMNS_SQL} FROM bronze")
def expect_keep_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = Observation("expect_keep_rows")
    return expect_keep(bronze(spark, sf_dir), INVOICE_RULES, counted).select(*INVOICE_COLUMNS)


@query(f"WITH {BRONZE_SQL} {RULE_ROWS_SQL.format(keys='', group='')}")
def expect_keep_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_metrics(bronze(spark, sf_dir), INVOICE_RULES, "bronze")


@query(f"""WITH {BRONZE_SQL}, metrics AS (
    {RULE_ROWS_SQL.format(keys='entity, ', group='GROUP BY entity')})
    SELECT * FROM metrics WHERE failed_records > 0""")
def rule_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(rule_metrics_by(bronze(spark, sf_dir), INVOICE_RULES, "bronze", ["entity"]))


@query(f"WITH {BRONZE_SQL} SELECT {COLUMNS_SQL} FROM bronze")
def expect_fail_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fail policy over rows that all meet the rules."""
    rules = {"has_invoice": "invoice_no IS NOT NULL", "has_entity": "length(entity) = 2"}
    return expect_fail(bronze(spark, sf_dir), rules).select(*INVOICE_COLUMNS)


@query(f"""WITH {BRONZE_SQL}, failed AS (
    SELECT {COLUMNS_SQL}, {INVOICE_FAILED_SQL} AS failed_rules FROM bronze)
    SELECT * FROM failed WHERE failed_rules != ''""")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(bronze(spark, sf_dir), INVOICE_RULES).select(
        *INVOICE_COLUMNS, F.array_join("_failed_rules", ",").alias("failed_rules")
    )


@query(f"""WITH {BRONZE_SQL}, metrics AS (
    {RULE_ROWS_SQL.format(keys='entity, ', group='GROUP BY entity')})
    SELECT entity, name, failed_records FROM metrics""")
def quarantine_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed rows per entity and rule, counted without exploding any row."""
    return rule_metrics_by(bronze(spark, sf_dir), INVOICE_RULES, "bronze", ["entity"]).select(
        "entity", "name", "failed_records"
    )


@query("""SELECT o_orderkey AS invoice_no, length(o_orderstatus) = 1 AS status_ok,
      coalesce(length(CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END) = 5, false)
        AS priority_ok
    FROM orders""")
def check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS invoice_no",
        "o_orderstatus",
        "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END AS priority",
    )
    return orders.select(
        "invoice_no",
        has_length("o_orderstatus", 1).alias("status_ok"),
        has_length("priority", 5).alias("priority_ok"),
    )


@query(f"""WITH {BRONZE_SQL}
    SELECT {COLUMNS_SQL} FROM bronze
    WHERE coalesce(length(entity) = 2, false) AND coalesce(length(description) = 5, false)""")
def check_in_rule_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks called by name from rule text, whatever the case of the column name."""
    register_checks(spark)
    rules = {
        "valid_entity": "is_valid_col(ENTITY, 2)",
        "short_description": "is_valid_col(description, 5)",
    }
    counted = Observation("check_in_rule_text")
    return expect_drop(bronze(spark, sf_dir), rules, counted).select(*INVOICE_COLUMNS)


# Precision and scale from the digits of the shortest text of the number.
PRECISION_SQL = """WITH priced AS (
    SELECT {key} AS id, CAST({price} AS VARCHAR) AS price FROM {table}),
  digits AS (
    SELECT id, length(split_part(price, '.', 1)) AS whole,
      length(rtrim(split_part(price, '.', 2), '0')) AS scale FROM priced)
  SELECT id, whole + scale = 4 AND scale = 1 AS p4_s1, whole + scale = 3 AND scale = 0 AS p3_s0,
    whole + scale = 5 AND scale = 2 AS p5_s2 FROM digits"""


@query(PRECISION_SQL.format(key="p_partkey", price="p_retailprice", table="part"))
def check_precision_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        *[
            has_precision_and_scale("p_retailprice", p, s, numeric=True).alias(f"p{p}_s{s}")
            for p, s in ((4, 1), (3, 0), (5, 2))
        ],
    )


@query(PRECISION_SQL.format(
    key="l_orderkey * 10 + l_linenumber", price="l_extendedprice", table="lineitem"))
def check_precision_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check by name, on prices written as text."""
    register_checks(spark)
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id", "CAST(l_extendedprice AS STRING) AS price"
    ).select(
        "id",
        *[
            F.expr(f"is_valid_precision_and_scale(price, {p}, {s})").alias(f"p{p}_s{s}")
            for p, s in ((4, 1), (3, 0), (5, 2))
        ],
    )


@query("""SELECT c_custkey, c_name FROM customer
    WHERE list_sum(list_transform(
      regexp_extract_all(c_name, '[0-9]'), lambda d: CAST(d AS INTEGER))) % 2 = 0""")
def user_check_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own Python check on whole columns, called from rule text."""

    def even_digit_sum(text: pd.Series) -> pd.Series:
        digits = sum(text.str.count(str(d)) * d for d in range(10))
        return (digits % 2 == 0) & text.notna()

    register_vector_check(spark, "even_digit_sum", even_digit_sum)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return expect_drop(customers, {"check_digit": "even_digit_sum(c_name)"})
