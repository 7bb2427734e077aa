"""Bronze views of the given tables, in Spark and in SQL.

The tables hold no NULLs, so the views plant some by key, the same way on both
sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..scratch import scratch_dir
from ..streaming.tables import StreamTables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A pattern in place of the plain path lets the table be one file or a folder.
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def fresh_tables(spark: SparkSession, label: str) -> StreamTables:
    return StreamTables(spark, scratch_dir(spark, label))


# Invoices as they come out of ingestion. A file holds the orders of one month
# and is ingested once; those of January arrive in two ingestions.
BRONZE = [
    "o_orderkey AS invoice_no",
    "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS customer_id",
    "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END AS description",
    "o_totalprice AS price",
    "CASE o_orderkey % 4 WHEN 0 THEN 'ES' WHEN 1 THEN 'PT' WHEN 2 THEN 'BR' ELSE 'UK' END AS entity",
    "concat('landing-', year(o_orderdate), '-', month(o_orderdate), '.csv') AS file_name",
    "trunc(o_orderdate, 'MM') AS ingest_date",
    "CASE WHEN month(o_orderdate) = 1 AND o_orderkey % 2 = 1 THEN '18:00' ELSE '06:00' END"
    " AS ingest_time",
]

BRONZE_SQL = """bronze AS (
  SELECT o_orderkey AS invoice_no,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS customer_id,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END AS description,
    o_totalprice AS price,
    CASE o_orderkey % 4 WHEN 0 THEN 'ES' WHEN 1 THEN 'PT' WHEN 2 THEN 'BR' ELSE 'UK' END AS entity,
    concat('landing-', year(o_orderdate), '-', month(o_orderdate), '.csv') AS file_name,
    strftime(o_orderdate, '%Y-%m-01') AS ingest_date,
    CASE WHEN month(o_orderdate) = 1 AND o_orderkey % 2 = 1 THEN '18:00' ELSE '06:00' END
      AS ingest_time
  FROM orders)"""

INVOICE_RULES = {
    "existing_customer": "customer_id IS NOT NULL",
    "valid_invoice": "description != '5-LOW'",
    "worthwhile": "price > 1500",
}

INVOICE_RULES_SQL = "customer_id IS NOT NULL AND description != '5-LOW' AND price > 1500"

# The same rules as names of what failed, in rule order.
INVOICE_FAILED_SQL = """concat_ws(',',
      CASE WHEN customer_id IS NULL THEN 'existing_customer' END,
      CASE WHEN NOT coalesce(description != '5-LOW', false) THEN 'valid_invoice' END,
      CASE WHEN NOT coalesce(price > 1500, false) THEN 'worthwhile' END)"""

INVOICE_COLUMNS = ["invoice_no", "customer_id", "description", "price", "entity"]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*BRONZE)


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_stream(spark, sf_dir, "orders").selectExpr(*BRONZE)
