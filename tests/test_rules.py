from __future__ import annotations

import json
import logging

import pytest
from pyspark.sql import types as T

from weirflow.plans import (
    Contract,
    load_contract,
    publish_rules,
    rules_from_constraints,
    rules_from_control_table,
    rules_from_csv,
    save_contract,
    validate_rules,
)
from weirflow.sources import create_control_table, create_database, replace_control_rows

RULE_TEXT = """
name,constraint,tag
has_key,"key IS NOT NULL",raw
short_note,"note != 'a, b'",raw
in_time,"date_format(seen,'yyyy-MM') > '2001-02'",clean
has_key,"key > 0",raw
"""


@pytest.fixture
def rule_file(tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text(RULE_TEXT)
    return str(path)


def test_rules_by_tag_keep_file_order_and_the_later_name_wins(spark, rule_file, caplog):
    with caplog.at_level(logging.WARNING):
        rules = rules_from_csv(spark, rule_file, "raw")
    assert list(rules.items()) == [
        ("has_key", "key > 0"),
        ("short_note", "note != 'a, b'"),
    ]
    assert "given twice" in caplog.text


def test_commas_in_a_quoted_rule(spark, rule_file):
    assert rules_from_csv(spark, rule_file, "clean") == {
        "in_time": "date_format(seen,'yyyy-MM') > '2001-02'"
    }


def test_unknown_tag_is_an_error(spark, rule_file):
    with pytest.raises(KeyError, match="none"):
        rules_from_csv(spark, rule_file, "none")


def test_rules_of_several_files_stand_by_file_and_line(spark, tmp_path):
    for name, rules in (("b.csv", ["z,1 > 0,t", "x,2 > 0,t"]), ("a.csv", ["x,0 > 0,t", "y,3 > 0,t"])):
        (tmp_path / name).write_text("\n".join(["name,constraint,tag", *rules]) + "\n")
    assert list(rules_from_csv(spark, str(tmp_path), "t").items()) == [
        ("x", "2 > 0"), ("y", "3 > 0"), ("z", "1 > 0")]


def test_published_rules_read_back(spark, tmp_path):
    entries = [
        ("a", "x != 'it''s, \"so\"'", "t"),
        ("b", "NOT(x IS NULL AND y IS NULL)", "t"),
        ("c", "x RLIKE '^[a-z]+$'", "u"),
    ]
    publish_rules(spark, entries, str(tmp_path / "r"))
    assert list(rules_from_csv(spark, str(tmp_path / "r"), "t").items()) == [
        (name, rule) for name, rule, tag in entries if tag == "t"
    ]


@pytest.fixture
def control_table(spark, tmp_path):
    create_database(spark, "rules_test", str(tmp_path / "db"))
    create_control_table(spark, "rules_test.sources")
    yield "rules_test.sources"
    spark.sql("DROP DATABASE rules_test CASCADE")


def test_rules_of_a_control_table(spark, control_table):
    rules = {"Valid InvoiceNo": "InvoiceNo IS NOT NULL", "Not 'x'": "Description != 'x'"}
    replace_control_rows(spark, control_table, {"bronze_invoice": json.dumps(rules), "bad": "{"})
    assert rules_from_control_table(spark, control_table, "bronze_invoice") == rules
    with pytest.raises(KeyError):
        rules_from_control_table(spark, control_table, "absent")
    with pytest.raises(ValueError):
        rules_from_control_table(spark, control_table, "bad")


def test_two_control_rows_for_one_name_are_refused(spark, control_table):
    replace_control_rows(spark, control_table, {"a": "{}"})
    spark.sql(f"INSERT INTO {control_table} VALUES ('a', '{{\"r\": \"true\"}}')")
    with pytest.raises(ValueError, match="several rows"):
        rules_from_control_table(spark, control_table, "a")


def test_control_rows_are_replaced(spark, control_table):
    replace_control_rows(spark, control_table, {"a": "{}", "b": "{}"})
    replace_control_rows(spark, control_table, {"c": "{}"})
    assert [r["TableName"] for r in spark.table(control_table).collect()] == ["c"]
    replace_control_rows(spark, control_table, {})
    assert spark.table(control_table).count() == 0


def test_rules_named_by_their_text():
    assert rules_from_constraints(["a > 1", "b > 2"]) == {"a > 1": "a > 1", "b > 2": "b > 2"}


def test_rules_are_checked_against_the_data(spark):
    df = spark.createDataFrame([], "a INT, b STRING")
    validate_rules(df, {"ok": "a > 1 AND B IS NOT NULL"})
    with pytest.raises(ValueError, match="'gone'"):
        validate_rules(df, {"ok": "a > 1", "gone": "c > 1"})
    with pytest.raises(ValueError, match="not boolean"):
        validate_rules(df, {"number": "a + 1"})


def test_contract_round_trip(spark, tmp_path):
    schema = T.StructType().add("id", "string").add("date", "timestamp").add("value", "double")
    contract = Contract("collateral", schema, ("id IS NOT NULL", "value >= 0"))
    save_contract(spark, contract, str(tmp_path))
    assert load_contract(spark, str(tmp_path), "collateral") == contract
    assert contract.rules == {"id IS NOT NULL": "id IS NOT NULL", "value >= 0": "value >= 0"}


def test_contract_file_written_by_hand(spark, tmp_path):
    schema = T.StructType().add("id", "string")
    (tmp_path / "agreement.json").write_text(
        json.dumps(
            {"entity": "agreement", "schema": schema.jsonValue(), "constraints": ["id IS NOT NULL"]},
            indent=4,
        )
    )
    assert load_contract(spark, str(tmp_path), "agreement").schema == schema


@pytest.mark.parametrize(
    "contract, message",
    [
        (Contract("e", T.StructType().add("a", "integer").add("A", "integer"), ()), "more than once"),
        (Contract("e", T.StructType().add("a", "integer"), ("b > 1",)), "does not fit"),
    ],
)
def test_bad_contracts(spark, contract, message):
    with pytest.raises(ValueError, match=message):
        contract.validate(spark)


def test_contract_without_constraints_key():
    with pytest.raises(ValueError, match="constraints"):
        Contract.from_json('{"entity": "e", "schema": {"type": "struct", "fields": []}}')
