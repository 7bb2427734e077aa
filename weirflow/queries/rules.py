"""Where rules come from: a CSV file, a control table, an entity contract."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import expect_drop, label, union_all
from ..plans import (
    Contract,
    load_contract,
    publish_rules,
    rules_from_control_table,
    rules_from_csv,
    save_contract,
)
from ..scratch import scratch_dir
from ..sources import create_control_table, create_database, replace_control_rows
from .inputs import BRONZE_SQL, INVOICE_COLUMNS, INVOICE_RULES, INVOICE_RULES_SQL, bronze, table
from .registry import query

COLUMNS_SQL = ", ".join(INVOICE_COLUMNS)


@query(f"WITH {BRONZE_SQL} SELECT {COLUMNS_SQL} FROM bronze WHERE {INVOICE_RULES_SQL}", name="rules_from_csv")
def rules_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules in two files of one folder: what the second says again holds."""
    path = scratch_dir(spark, "rules")
    entries = [(name, rule, "invoice_silver") for name, rule in INVOICE_RULES.items()]
    first = [("never", "false", "other"), ("worthwhile", "false", "invoice_silver"), entries[0]]
    publish_rules(spark, first, f"{path}/part=1")
    publish_rules(spark, entries[1:], f"{path}/part=2")
    rules = rules_from_csv(spark, path, "invoice_silver")
    return expect_drop(bronze(spark, sf_dir), rules).select(*INVOICE_COLUMNS)


@query(f"WITH {BRONZE_SQL} SELECT {COLUMNS_SQL} FROM bronze WHERE {INVOICE_RULES_SQL}", name="rules_from_control_table")
def rules_by_control_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = f"weirflow_{uuid.uuid4().hex}"
    create_database(spark, database, scratch_dir(spark, "control"))
    create_control_table(spark, f"{database}.sources")
    replace_control_rows(
        spark,
        f"{database}.sources",
        {"bronze_invoice": json.dumps(INVOICE_RULES), "other": '{"never": "false"}'},
    )
    rules = rules_from_control_table(spark, f"{database}.sources", "bronze_invoice")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return expect_drop(bronze(spark, sf_dir), rules).select(*INVOICE_COLUMNS)


def _contract(entity: str, fields: dict[str, str], *constraints: str) -> Contract:
    schema = T.StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return Contract(entity, schema, constraints)


CONTRACTS = (
    _contract(
        "customer",
        {"c_custkey": "long", "c_acctbal": "double", "c_mktsegment": "string"},
        "c_acctbal >= 0",
        "length(c_mktsegment) = 9",
    ),
    _contract(
        "orders",
        {"o_orderkey": "long", "o_totalprice": "double", "o_orderstatus": "string"},
        "o_totalprice >= 20000",
        "o_orderstatus IN ('O', 'F')",
    ),
    _contract(
        "lineitem",
        {"l_orderkey": "long", "l_quantity": "double", "l_discount": "double"},
        "l_quantity > 2",
        "l_discount < 0.1",
    ),
)


@query("""
    SELECT 'customer' AS entity,
      count(*) FILTER (c_acctbal >= 0 AND length(c_mktsegment) = 9) AS loaded,
      count(*) FILTER (NOT (c_acctbal >= 0 AND length(c_mktsegment) = 9)) AS rejected
    FROM customer UNION ALL
    SELECT 'orders', count(*) FILTER (o_totalprice >= 20000 AND o_orderstatus IN ('O', 'F')),
      count(*) FILTER (NOT (o_totalprice >= 20000 AND o_orderstatus IN ('O', 'F')))
    FROM orders UNION ALL
    SELECT 'lineitem', count(*) FILTER (l_quantity > 2 AND l_discount < 0.1),
      count(*) FILTER (NOT (l_quantity > 2 AND l_discount < 0.1))
    FROM lineitem""", name="contract_flow")
def contracts_of_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One template, three entities: each loads its contract and is checked in one pass."""
    directory = scratch_dir(spark, "contracts")

    def checked(contract: Contract) -> DataFrame:
        save_contract(spark, contract, directory)
        loaded = load_contract(spark, directory, contract.entity)
        rows = table(spark, sf_dir, loaded.entity).select(*loaded.schema.fieldNames())
        return (
            label(rows, loaded.rules)
            .agg(
                F.count_if(F.size("_failed_rules") == 0).alias("loaded"),
                F.count_if(F.size("_failed_rules") > 0).alias("rejected"),
            )
            .select(F.lit(loaded.entity).alias("entity"), "loaded", "rejected")
        )

    return union_all([checked(contract) for contract in CONTRACTS])
