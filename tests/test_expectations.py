from __future__ import annotations

import pytest
from pyspark.sql import Observation

from weirflow.functions import register_checks
from weirflow.operators import (
    alerts,
    expect_drop,
    expect_fail,
    expect_keep,
    label,
    quarantine,
    rule_metrics,
    rule_metrics_by,
)
from weirflow.operators.expectations import metric_tuples

RULES = {"existing_invoice": "InvoiceNo IS NOT NULL", "valid_invoice": "Description != 'Discount'"}


@pytest.fixture
def invoices(spark):
    return spark.createDataFrame(
        [(1, "a"), (2, None), (None, "b"), (None, "Discount"), (3, "Discount"), (None, None)],
        "InvoiceNo INT, Description STRING",
    )


def test_drop_keeps_only_rows_that_meet_all(invoices, rows):
    assert rows(expect_drop(invoices, RULES)) == [(1, "a")]


def test_null_under_a_rule_fails_it_and_both_names_come_in_rule_order(invoices, rows):
    assert rows(quarantine(invoices, RULES)) == [
        (2, None, ["valid_invoice"]),
        (3, "Discount", ["valid_invoice"]),
        (None, "Discount", ["existing_invoice", "valid_invoice"]),
        (None, "b", ["existing_invoice"]),
        (None, None, ["existing_invoice", "valid_invoice"]),
    ]


def test_the_failed_column_can_be_named(invoices):
    assert quarantine(invoices, RULES, "_broken").columns[-1] == "_broken"


def test_silver_and_quarantine_add_up(invoices):
    kept, aside = expect_drop(invoices, RULES).count(), quarantine(invoices, RULES).count()
    assert kept + aside == invoices.count()


def test_label_serves_both_sides(invoices, rows):
    labelled = label(invoices, RULES)
    assert rows(labelled.filter("size(_failed_rules) = 0").drop("_failed_rules")) == rows(
        expect_drop(invoices, RULES)
    )
    assert rows(labelled.filter("size(_failed_rules) > 0")) == rows(quarantine(invoices, RULES))


METRICS = [("existing_invoice", "bronze", 3, 3), ("valid_invoice", "bronze", 2, 4)]


def test_metrics_count_null_as_failed(invoices, rows):
    assert rows(rule_metrics(invoices, RULES, "bronze")) == METRICS
    for row in rule_metrics(invoices, RULES, "bronze").collect():
        assert row["passed_records"] + row["failed_records"] == 6


@pytest.mark.parametrize("policy, kept", [(expect_keep, 6), (expect_drop, 1), (label, 6)])
def test_observed_counts_see_all_rows(invoices, policy, kept):
    observation = Observation(policy.__name__)
    if policy is label:
        df = label(invoices, RULES, observation=observation)
    else:
        df = policy(invoices, RULES, observation)
    assert len(df.collect()) == kept
    seen = observation.get
    assert metric_tuples(seen, RULES, "bronze") == METRICS
    assert (seen["total_records"], seen["kept_records"]) == (6, 1)


def test_keep_and_drop_leave_the_columns_alone(invoices):
    assert expect_keep(invoices, RULES, Observation("k")).columns == invoices.columns
    assert expect_drop(invoices, RULES, Observation("d")).columns == invoices.columns


def test_metrics_per_group_and_alerts(spark, rows):
    df = spark.createDataFrame([("x", 1), ("x", None), ("y", 2)], "g STRING, v INT")
    metrics = rule_metrics_by(df, {"v": "v IS NOT NULL"}, "t", ["g"])
    assert rows(metrics) == [("x", "v", "t", 1, 1), ("y", "v", "t", 1, 0)]
    assert rows(alerts(metrics)) == [("x", "v", "t", 1, 1)]
    assert rows(alerts(metrics, tolerated=1)) == []


def test_metrics_of_no_rows_and_of_no_rules(spark, invoices, rows):
    assert rows(rule_metrics(invoices.limit(0), {"r": "InvoiceNo > 0"}, "t")) == [("r", "t", 0, 0)]
    assert rows(rule_metrics(invoices, {}, "t")) == []


def test_no_rules_keep_everything(invoices):
    assert expect_drop(invoices, {}).count() == 6
    assert quarantine(invoices, {}).count() == 0
    assert label(invoices, {}).filter("size(_failed_rules) = 0").count() == 6


def test_fail_policy(invoices):
    assert len(expect_fail(invoices.limit(1), RULES).collect()) == 1
    with pytest.raises(Exception, match="row breaks: .*_invoice"):
        expect_fail(invoices, RULES).collect()


def test_fail_policy_stops_at_null(spark):
    df = spark.createDataFrame([(None,)], "a INT")
    with pytest.raises(Exception, match="row breaks: positive"):
        expect_fail(df, {"positive": "a > 0"}).collect()


def test_rules_may_call_checks(spark, rows):
    register_checks(spark)
    df = spark.createDataFrame([("ES", "1234"), ("ESP", "1234"), ("ES", "12.5")], "Entity STRING, p STRING")
    rules = {"e": "is_valid_col(entity, 2)", "d": "is_valid_precision_and_scale(p, 4, 0)"}
    assert rows(expect_drop(df, rules)) == [("ES", "1234")]
    assert rows(expect_drop(df, rules, Observation("c"))) == [("ES", "1234")]
    assert rows(quarantine(df, rules)) == [("ES", "12.5", ["d"]), ("ESP", "1234", ["e"])]
    assert rows(rule_metrics(df, rules, "t")) == [("d", "t", 2, 1), ("e", "t", 2, 1)]


def test_random_rows_against_brute_force(spark, rows):
    import random

    draw = random.Random(7)
    data = [
        (i, draw.choice([None, 0, 1, 5]), draw.choice([None, "x", "yy", "zzz"])) for i in range(500)
    ]
    df = spark.createDataFrame(data, "i INT, a INT, b STRING")
    rules = {"big": "a > 0", "short": "length(b) < 3", "pair": "a = length(b) OR b = 'x'"}

    def truth(a, b):
        either = None if b is None else (b == "x") or (None if a is None else a == len(b))
        return {
            "big": a is not None and a > 0,
            "short": b is not None and len(b) < 3,
            "pair": bool(either),
        }

    verdicts = {i: [n for n, ok in truth(a, b).items() if not ok] for i, a, b in data}
    assert {r["i"] for r in expect_drop(df, rules).collect()} == {
        i for i, failed in verdicts.items() if not failed
    }
    assert {r["i"]: r["_failed_rules"] for r in quarantine(df, rules).collect()} == {
        i: failed for i, failed in verdicts.items() if failed
    }
