"""Landing files: seeding, provenance, rescue of what does not fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import malformed, with_provenance
from ..scratch import scratch_dir
from ..sources import append_json, read_json, read_landing, register_external, write_landing
from .inputs import table
from .registry import query

INVOICE_FILE = (
    T.StructType().add("InvoiceNo", "integer").add("Description", "string").add("UnitPrice", "double")
)

# Every 23rd id is of the kind that does not fit the declared type.
INVOICE_LINES = [
    "CASE WHEN o_orderkey % 23 = 0 THEN concat('C', o_orderkey) ELSE CAST(o_orderkey AS STRING) END"
    " AS InvoiceNo",
    "o_orderpriority AS Description",
    "CAST(o_totalprice AS STRING) AS UnitPrice",
]


@query("""SELECT CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderkey AS INTEGER) END
        AS "InvoiceNo", o_orderpriority AS "Description", o_totalprice AS "UnitPrice",
      CASE WHEN o_orderkey % 23 = 0 THEN
        'C' || o_orderkey || ',' || o_orderpriority || ',' || CAST(o_totalprice AS VARCHAR) END
        AS _rescue
    FROM orders""")
def csv_roundtrip_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv-landing")
    write_landing(table(spark, sf_dir, "orders").selectExpr(*INVOICE_LINES), path)
    rows = read_landing(spark, path, INVOICE_FILE, "csv", streaming=False)
    return rows.select("InvoiceNo", "Description", "UnitPrice", "_rescue")


@query("""SELECT count(*) AS rows_read, count(*) FILTER (o_orderkey % 23 = 0) AS rows_rescued
    FROM orders""")
def csv_rescue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the rescue column is used, yet it is right: see the reader."""
    path = scratch_dir(spark, "csv-landing")
    write_landing(table(spark, sf_dir, "orders").selectExpr(*INVOICE_LINES), path)
    return read_landing(spark, path, INVOICE_FILE, "csv", streaming=False).agg(
        F.count(F.lit(1)).alias("rows_read"), F.count("_rescue").alias("rows_rescued")
    )


EVENT_FILE = T.StructType().add("id", "long").add("kind", "string").add("value", "double")

# A clean object, one with keys the schema lacks, one with a value of the wrong
# type, and one cut short; the same expression in Spark and in DuckDB.
EVENT_LINE = """CASE
    WHEN event_id % 11 = 0 THEN concat('{"id":', event_id, ',"kind":"', event_type, '"')
    WHEN event_id % 7 = 0 THEN concat('{"id":', event_id, ',"kind":"', event_type, '","value":"high"}')
    WHEN event_id % 5 = 0 THEN
      concat('{"id":', event_id, ',"kind":"', event_type, '","user":', user_id, '}')
    ELSE concat('{"id":', event_id, ',"kind":"', event_type, '"}') END"""


def event_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json-landing")
    table(spark, sf_dir, "events").selectExpr(f"{EVENT_LINE} AS value").write.text(path)
    return read_landing(spark, path, EVENT_FILE, "json", streaming=False)


@query(f"""SELECT CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id END AS id,
      CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS kind,
      CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN {EVENT_LINE}
        WHEN event_id % 5 = 0 THEN concat('{{"user":"', user_id, '"}}') END AS _rescue
    FROM events""")
def json_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_landing(spark, sf_dir).select("id", "kind", "_rescue")


@query("""SELECT event_id % 11 = 0 AS bad, count(*) AS records FROM events GROUP BY 1""", name="bad_records_split")
def bad_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that could not be read at all against the rest."""
    rows = event_landing(spark, sf_dir)
    return rows.groupBy(malformed(EVENT_FILE, "json").alias("bad")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query("""SELECT CAST(10 AS BIGINT) AS files, count(*) AS records FROM orders""")
def landing_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeding operator: all rows, spread over ten files."""
    path = scratch_dir(spark, "seed")
    write_landing(table(spark, sf_dir, "orders"), path, files=10)
    seeded = spark.read.option("header", True).csv(path)
    return seeded.select(F.col("_metadata.file_path").alias("file")).agg(
        F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("records")
    )


@query("""SELECT CAST(100 AS BIGINT) AS records FROM (SELECT count(*) AS n FROM orders) WHERE n >= 100""")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIMIT as an operator of its own: a hundred orders, whichever."""
    return table(spark, sf_dir, "orders").limit(100).agg(F.count(F.lit(1)).alias("records"))


ENTITY_FILE = (
    T.StructType().add("InvoiceNo", "integer").add("Entity", "string").add("Description", "string")
    .add("UnitPrice", "double").add("InputFileName", "string")
)


@query("""SELECT o_orderkey AS "InvoiceNo", o_orderpriority AS "Description",
      o_totalprice AS "UnitPrice", 'PT' AS "Entity" FROM orders""")
def csv_provenance_in_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that hold a provenance field among others: it is read over and overwritten."""
    path = scratch_dir(spark, "csv-entity")
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS InvoiceNo", "'XX' AS Entity", "o_orderpriority AS Description",
        "o_totalprice AS UnitPrice",
    )
    write_landing(rows, path)
    read = with_provenance(read_landing(spark, path, ENTITY_FILE, "csv", streaming=False), "PT")
    return read.select("InvoiceNo", "Description", "UnitPrice", "Entity")


NESTED_FILE = T.StructType().add("id", "long").add(
    "user", T.StructType().add("id", "long").add("tags", T.ArrayType(T.StructType().add("t", "string")))
)

# Every 5th event has a key too many in a struct, every 7th one in an array of structs.
NESTED_LINE = """concat('{"id":', event_id, ',"user":', CASE
    WHEN event_id % 5 = 0 THEN concat('{"id":', user_id, ',"kind":"', event_type, '"}')
    WHEN event_id % 7 = 0 THEN concat('{"id":', user_id, ',"tags":[{"t":"a"},{"t":"b","w":1}]}')
    ELSE concat('{"id":', user_id, ',"tags":[{"t":"a"}]}') END, '}')"""


@query("""SELECT event_id AS id, user_id AS user,
      event_id % 5 = 0 OR event_id % 7 = 0 AS rescued,
      event_id % 5 = 0 OR event_id % 7 = 0 AS whole
    FROM events""")
def json_nested_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys the schema lacks inside structs and arrays: the field is rescued whole."""
    path = scratch_dir(spark, "json-nested")
    table(spark, sf_dir, "events").selectExpr(f"{NESTED_LINE} AS value").write.text(path)
    rows = read_landing(spark, path, NESTED_FILE, "json", streaming=False)
    told = F.get_json_object("_rescue", "$.user")
    lost = F.get_json_object(told, "$.kind").isNotNull() | F.contains(told, F.lit('"w":1'))
    return rows.select(
        "id",
        F.col("user.id").alias("user"),
        F.col("_rescue").isNotNull().alias("rescued"),
        F.coalesce(lost, F.lit(False)).alias("whole"),
    )


@query("""SELECT o_orderkey, true AS named, 'ES' AS "Entity", '2024-05-06' AS "IngestionDate",
      '2024-05-06 07:08:09' AS "IngestionTime" FROM orders""")
def provenance_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/orders.parquet"
    schema = spark.read.parquet(path).select("o_orderkey").schema
    rows = read_landing(spark, path, schema, "parquet", streaming=False)
    marked = with_provenance(rows, "ES", F.expr("TIMESTAMP_NTZ '2024-05-06 07:08:09'"))
    return marked.select(
        "o_orderkey",
        F.contains("InputFileName", F.lit("orders.parquet")).alias("named"),
        "Entity",
        F.col("IngestionDate").cast("string").alias("IngestionDate"),
        F.col("IngestionTime").cast("string").alias("IngestionTime"),
    )


@query("""SELECT s_suppkey AS id, s_name AS name, s_acctbal AS value FROM supplier UNION ALL
    SELECT c_custkey, c_name, c_acctbal FROM customer""")
def json_append_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    shape = T.StructType().add("id", "long").add("name", "string").add("value", "double")
    for name, prefix in (("supplier", "s_suppkey"), ("customer", "c_custkey")):
        letter = prefix[0]
        append_json(
            table(spark, sf_dir, name).selectExpr(
                f"{prefix} AS id", f"{letter}_name AS name", f"{letter}_acctbal AS value"
            ),
            path,
        )
    return read_json(spark, path, shape)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS records FROM lineitem GROUP BY ALL""")
def external_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table registered over files where they lie."""
    name = "weirflow_" + scratch_dir(spark, "t").rsplit("-", 1)[1]
    register_external(spark, name, f"{sf_dir}/lineitem.parquet")
    return (
        spark.table(name)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("records"))
    )
