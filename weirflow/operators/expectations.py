"""Row-level expectations: keep and count, drop, fail, quarantine.

Everywhere a rule holds only where it is TRUE: FALSE and NULL both fail it. So
the rows `expect_drop` keeps and the rows `quarantine` keeps add up to the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.rules import Rules

FAILED_COLUMN = "_failed_rules"
TOTAL = "total_records"
KEPT = "kept_records"

METRICS_SCHEMA = "name STRING, dataset STRING, passed_records BIGINT, failed_records BIGINT"


def passes(predicate: str) -> Column:
    """The verdict on one rule as a boolean that is never NULL."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def rules_hold(rules: Rules) -> Column:
    """TRUE where every rule holds.

    The bare conjunction: a filter on it drops NULL by itself, and only the bare
    form is pushed into the scan.
    """
    return reduce(Column.__and__, [F.expr(p) for p in rules.values()], F.lit(True))


def failed_rules(rules: Rules) -> Column:
    """Names of the rules a row breaks, in rule order."""
    return _names({name: passes(predicate) for name, predicate in rules.items()})


def expect_drop(
    df: DataFrame, rules: Rules, observation: Observation | str | None = None
) -> DataFrame:
    """Keep the rows that meet every rule.

    With an ``observation`` the counts per rule are taken in the same pass, over
    all rows. Counting has to see the rows that are dropped, so it keeps the
    filter out of the scan; leave it out where only the result matters.
    """
    if observation is None:
        return df.filter(rules_hold(rules))
    return _observed(df, rules, observation, drop=True)


def expect_keep(df: DataFrame, rules: Rules, observation: Observation | str) -> DataFrame:
    """Pass all rows on and count, per rule, those that meet it."""
    return _observed(df, rules, observation, drop=False)


def expect_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Pass all rows on; stop the job at the first row that breaks a rule.

    The check sees every row that is read: a filter applied later is not moved
    below it. A LIMIT still reads, and so checks, only as many rows as it needs.
    """
    broken = F.array_join(failed_rules(rules), ", ")
    held = F.when(_all_hold(rules), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("row breaks: "), broken)).cast("boolean")
    )
    # Rows are counted behind the check, which keeps later filters above it.
    return df.filter(held).observe(f"checked_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))


def quarantine(df: DataFrame, rules: Rules, column: str = FAILED_COLUMN) -> DataFrame:
    """The rows that break a rule, with the names of the rules they break.

    Rows are filtered on one short-circuit predicate first, so the names are
    worked out only for the rows that stay.
    """
    return label(df.filter(~_all_hold(rules)), rules, column)


def label(
    df: DataFrame,
    rules: Rules,
    column: str = FAILED_COLUMN,
    observation: Observation | str | None = None,
) -> DataFrame:
    """All rows with the names of the rules they break (an empty array if none).

    One pass that serves both sides: `size(column) = 0` is the drop result, the
    rest is the quarantine. With an ``observation`` the counts per rule are
    taken from the same verdicts.
    """
    judged, verdicts = _judged(df, rules)
    if observation is not None:
        judged = _counted(judged, verdicts, observation)
    clean = reduce(Column.__and__, verdicts.values(), F.lit(True))
    names = F.when(clean, _no_names()).otherwise(_names(verdicts))
    return judged.withColumn(column, names).drop(*_columns(rules))


def rule_metrics(df: DataFrame, rules: Rules, dataset: str) -> DataFrame:
    """One row per rule: name, dataset, passed_records, failed_records."""
    return rule_metrics_by(df, rules, dataset, ())


def rule_metrics_by(
    df: DataFrame, rules: Rules, dataset: str, keys: Sequence[str], drops: bool = False
) -> DataFrame:
    """`rule_metrics` per group of ``keys``.

    With ``drops`` each row also says how many rows of its group break some rule,
    as ``dropped_records``: those that the drop policy takes out.

    All rules are counted in one aggregate over the input, summed map-side; the
    wide result is turned into a row per rule only afterwards.
    """
    counts = [F.count_if(F.expr(p)).alias(f"_p{i}") for i, p in enumerate(rules.values())]
    if drops:
        counts.append(F.count_if(~_all_hold(rules)).alias("dropped_records"))
    also = ["dropped_records"] if drops else []
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *counts)
    per_rule = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit(dataset).alias("dataset"),
                F.col(f"_p{i}").alias("passed_records"),
                (F.col("_n") - F.col(f"_p{i}")).alias("failed_records"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return counted.select(*keys, *also, F.inline(per_rule.cast(f"array<struct<{METRICS_SCHEMA}>>")))


def alerts(metrics: DataFrame, tolerated: int = 0) -> DataFrame:
    """The metric rows with more failures than ``tolerated``."""
    return metrics.filter(F.col("failed_records") > F.lit(tolerated))


def _no_names() -> Column:
    return F.array().cast("array<string>")


def _names(verdicts: dict[str, Column]) -> Column:
    # `array_except` takes out the NULLs that rules which hold leave: unlike a
    # lambda it stays inside generated code (and rule names never repeat).
    if not verdicts:
        return _no_names()
    names = F.array(*[F.when(~verdict, F.lit(name)) for name, verdict in verdicts.items()])
    return F.array_except(names, F.array(F.lit(None).cast("string")))


def _all_hold(rules: Rules) -> Column:
    return F.coalesce(rules_hold(rules), F.lit(False))


def _columns(rules: Rules) -> list[str]:
    return [f"_verdict{i}" for i in range(len(rules))]


def _judged(df: DataFrame, rules: Rules) -> tuple[DataFrame, dict[str, Column]]:
    """The rows with a boolean column per rule, and those columns by rule name.

    Each rule is evaluated once for all that is made of its verdict. Rules that
    call SQL functions may be counted that way; the counters themselves may not
    call any.
    """
    columns = _columns(rules)
    if columns:
        df = df.withColumns({c: passes(p) for c, p in zip(columns, rules.values())})
    return df, {name: F.col(column) for name, column in zip(rules, columns)}


def _counted(
    judged: DataFrame, verdicts: dict[str, Column], observation: Observation | str
) -> DataFrame:
    held = reduce(Column.__and__, verdicts.values(), F.lit(True))
    return judged.observe(
        observation,
        F.count(F.lit(1)).alias(TOTAL),
        F.count_if(held).alias(KEPT),
        *[F.count_if(v).alias(_metric(i)) for i, v in enumerate(verdicts.values())],
    )


def _observed(
    df: DataFrame, rules: Rules, observation: Observation | str, drop: bool
) -> DataFrame:
    judged, verdicts = _judged(df, rules)
    counted = _counted(judged, verdicts, observation)
    if drop:
        counted = counted.filter(reduce(Column.__and__, verdicts.values(), F.lit(True)))
    return counted.drop(*_columns(rules))


def _metric(position: int) -> str:
    return f"passed_{position}"


def metric_tuples(
    observed: dict[str, int], rules: Rules, dataset: str
) -> list[tuple[str, str, int, int]]:
    """The counters of one observation as rows of `METRICS_SCHEMA`."""
    total = observed[TOTAL]
    return [
        (name, dataset, observed[_metric(i)], total - observed[_metric(i)])
        for i, name in enumerate(rules)
    ]
