"""Registered queries of the subpackage: those with SQL give its rows, all give one row per input row."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as driver
from weirflow.llm.queries import LLM_ORACLES, LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, name):
    duck = oracle.connect(sf_dir)
    assert oracle.difference(LLM_QUERIES[name](spark, sf_dir), duck, LLM_ORACLES[name]) is None


def test_all_operators_are_registered():
    names = driver.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
