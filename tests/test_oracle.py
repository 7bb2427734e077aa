"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as driver
from weirflow.queries import ORACLES as SQL
from weirflow.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = oracle.connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert name in SQL
    assert oracle.difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_all_are_registered():
    assert QUERIES.items() <= driver.queries().items()
    assert SQL.items() <= driver.oracle_sql().items()
