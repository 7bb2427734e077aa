"""Unions of sources and control tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    control_of_counts,
    expect_drop,
    file_counts,
    file_reconciliation,
    label,
    loaded_vs_rejected,
    quarantine,
    reconciliation_of_labelled,
    union_all,
    with_entity,
)
from ..scratch import scratch_dir
from ..sources import create_database, save_table, write_complete
from .inputs import BRONZE_SQL, INVOICE_RULES, INVOICE_RULES_SQL, bronze, table
from .registry import query

INGESTION = ("ingest_date", "ingest_time")

SIDES_SQL = f"""{BRONZE_SQL},
  silver AS (SELECT * FROM bronze WHERE {INVOICE_RULES_SQL}),
  quarantine AS (SELECT * FROM bronze WHERE NOT coalesce({INVOICE_RULES_SQL}, false))"""

UNION_SOURCES = {
    "customer": ("CU", "c_custkey AS id", "c_name AS name", "c_acctbal AS amount"),
    "supplier": ("SU", "s_suppkey AS id", "s_name AS name", "s_acctbal AS amount"),
    "part": ("PA", "p_partkey AS id", "p_name AS name", "p_retailprice AS amount"),
    "orders": ("OR", "o_orderkey AS id", "o_orderpriority AS name", "o_totalprice AS amount"),
}

UNION_SQL = " UNION ALL ".join(
    f"SELECT {', '.join(columns)}, '{entity}' AS \"Entity\" FROM {name}"
    for name, (entity, *columns) in UNION_SOURCES.items()
)


def text_of(*columns: str) -> list:
    return [F.col(c).cast("string").alias(c) for c in columns]


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = bronze(spark, sf_dir)
    return expect_drop(rows, INVOICE_RULES), quarantine(rows, INVOICE_RULES)


@query(UNION_SQL, name="union_entities")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        [
            with_entity(table(spark, sf_dir, name).selectExpr(*columns), entity)
            for name, (entity, *columns) in UNION_SOURCES.items()
        ]
    )


# Names of the control table's columns are fixed values.
FILE_COUNTS = """SELECT file_name AS fileName, count(*) AS records, entity, ingest_date, ingest_time
    FROM {source} GROUP BY ALL"""
FILE_COUNTS_SQL = f"WITH {BRONZE_SQL} {FILE_COUNTS.format(source='bronze')}"


@query(FILE_COUNTS_SQL, name="file_counts")
def counts_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = file_counts(bronze(spark, sf_dir), "file_name", ("entity", *INGESTION))
    return counted.select("fileName", "records", "entity", *text_of(*INGESTION))


@query(FILE_COUNTS_SQL)
def complete_control_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts as a complete table of the catalog, written by a SQL select."""
    database = f"weirflow_{uuid.uuid4().hex}"
    create_database(spark, database, scratch_dir(spark, "complete"))
    view = f"silver_{uuid.uuid4().hex}"
    bronze(spark, sf_dir).createOrReplaceTempView(view)
    counted = spark.sql(FILE_COUNTS.format(source=view))
    save_table(counted, f"{database}.invoice_ctl", "Control table.", {"quality": "ctl"})
    spark.catalog.dropTempView(view)
    return spark.table(f"{database}.invoice_ctl").select(
        "fileName", "records", "entity", *text_of(*INGESTION)
    )


# Every ingestion with loaded rows, once for each ingestion of its file with rejected
# ones, or once without a count where the file has none.
LOADED_VS_REJECTED_SQL = f"""WITH {BRONZE_SQL},
  judged AS (SELECT *, coalesce({INVOICE_RULES_SQL}, false) AS ok FROM bronze),
  sides AS (
    SELECT ok, file_name, ingest_date, ingest_time, count(customer_id) AS n FROM judged GROUP BY ALL),
  rejections AS (SELECT file_name, list(n) AS all_n FROM sides WHERE NOT ok GROUP BY file_name)
  SELECT file_name, ingest_date, ingest_time, n AS "rows_OK",
    unnest(coalesce((SELECT all_n FROM rejections r WHERE r.file_name = sides.file_name), [NULL]))
      AS "rows_KO"
  FROM sides WHERE ok"""

RECONCILIATION_SQL = f"""WITH {BRONZE_SQL},
  judged AS (SELECT *, coalesce({INVOICE_RULES_SQL}, false) AS ok FROM bronze)
  SELECT file_name, ingest_date, ingest_time,
    count(*) FILTER (ok) AS "rows_OK", count(*) FILTER (NOT ok) AS "rows_KO"
  FROM judged GROUP BY ALL"""


@query(LOADED_VS_REJECTED_SQL, name="loaded_vs_rejected")
def loaded_and_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, kept_aside = sides(spark, sf_dir)
    counts = loaded_vs_rejected(silver, kept_aside, "customer_id", "file_name", INGESTION)
    return counts.select("file_name", *text_of(*INGESTION), "rows_OK", "rows_KO")


@query(RECONCILIATION_SQL, name="file_reconciliation")
def reconciled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, kept_aside = sides(spark, sf_dir)
    counts = file_reconciliation(silver, kept_aside, "file_name", INGESTION)
    return counts.select("file_name", *text_of(*INGESTION), "rows_OK", "rows_KO")


def counted_in_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = label(bronze(spark, sf_dir), INVOICE_RULES)
    return reconciliation_of_labelled(
        labelled, file_column="file_name", by=INGESTION, id_column="customer_id"
    )


@query(RECONCILIATION_SQL)
def single_pass_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one reading of the rows."""
    return counted_in_one_pass(spark, sf_dir).select(
        "file_name", *text_of(*INGESTION), "rows_OK", "rows_KO"
    )


@query(LOADED_VS_REJECTED_SQL)
def single_pass_control_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one reading of the rows: the counts are stored, then joined."""
    stored = write_complete(counted_in_one_pass(spark, sf_dir), scratch_dir(spark, "counts"))
    counts = control_of_counts(stored, "file_name", INGESTION)
    return counts.select("file_name", *text_of(*INGESTION), "rows_OK", "rows_KO")
