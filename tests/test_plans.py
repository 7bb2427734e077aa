"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver

QUERIES = driver.queries()


def exchanges(text: str) -> int:
    return len(re.findall(r"\bExchange\b", text))


def test_drop_reaches_the_scan(spark, sf_dir, plan):
    text = plan(QUERIES["expect_drop_silver"](spark, sf_dir))
    assert "GreaterThan(o_totalprice,1500.0)" in text
    assert "o_orderdate" not in text and "o_orderstatus" not in text
    assert exchanges(text) == 0


@pytest.mark.parametrize(
    "name",
    [
        "expect_drop_silver", "expect_drop_observed", "expect_keep_rows", "expect_fail_ok",
        "quarantine_rows", "check_length", "check_in_rule_text", "check_precision_scale",
        "check_precision_text", "union_entities", "typed_dates", "market_projection",
    ],
)
def test_row_level_work_neither_shuffles_nor_leaves_the_jvm(spark, sf_dir, plan, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert exchanges(text) == 0
    assert "Python" not in text


@pytest.mark.parametrize(
    "name", ["quarantine_rows", "expect_fail_ok", "check_precision_text", "market_projection"]
)
def test_row_level_work_is_one_piece_of_generated_code(spark, sf_dir, plan, name):
    operators = [line for line in plan(QUERIES[name](spark, sf_dir)).splitlines()
                 if re.match(r"^[ +\-:]*(\*\(\d+\) )?(Project|Filter)", line)]
    assert operators and all("*(1)" in line for line in operators)


@pytest.mark.parametrize(
    "name, count",
    [("expect_keep_metrics", 1), ("quarantine_by_rule", 1), ("file_counts", 1),
     ("file_reconciliation", 1), ("single_pass_reconciliation", 1), ("stream_single_pass", 1)],
)
def test_counts_are_summed_before_the_only_shuffle(spark, sf_dir, plan, name, count):
    text = plan(QUERIES[name](spark, sf_dir))
    assert exchanges(text) == count
    assert text.index("partial_count") > text.index("Exchange")


def test_rows_are_counted_before_they_are_joined(spark, sf_dir, plan):
    text = plan(QUERIES["loaded_vs_rejected"](spark, sf_dir))
    assert text.index("Join") < text.index("HashAggregate")
    assert text.count("partial_count") == 2


def test_user_checks_travel_in_arrow_batches(spark, sf_dir, plan):
    text = plan(QUERIES["user_check_udf"](spark, sf_dir))
    assert "ArrowEvalPython" in text and "BatchEvalPython" not in text


def test_split_table_is_pruned_by_side(spark, sf_dir, tmp_path, plan):
    from weirflow.operators import label
    from weirflow.queries.inputs import INVOICE_RULES, bronze_stream
    from weirflow.streaming import StreamTables, settle

    tables = StreamTables(spark, str(tmp_path))
    checked = label(bronze_stream(spark, sf_dir), INVOICE_RULES).selectExpr(
        "*", "size(_failed_rules) = 0 AS passed")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    settle(tables.append(checked, "checked", partition_by=["passed"]))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    text = plan(tables.read("checked", checked.schema).filter("passed").select("price"))
    assert re.search(r"PartitionFilters: \[[^\]]*passed", text)
