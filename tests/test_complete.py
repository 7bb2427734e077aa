"""Complete tables: readers see all of one version, whatever becomes of the next."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from weirflow.sources import CompleteTable, create_database, read_complete, save_table, write_complete


def failing(spark, n):
    return spark.range(0, n, 1, 4).withColumn("id", F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))


def test_versions_take_turns(spark, tmp_path):
    table = CompleteTable(spark, str(tmp_path / "t"), kept=3)
    assert table.current() is None
    with pytest.raises(ValueError, match="no version"):
        table.read()
    for n in range(8):
        assert table.replace(spark.range(n), f"mark {n}").count() == n
        assert table.current() == (n, f"mark {n}")
        assert table.read().count() == n
    assert len(list((tmp_path / "t" / "versions").iterdir())) == 3
    assert len(list((tmp_path / "t" / "pointer").iterdir())) == 2


def test_failed_and_unfinished_writes_change_nothing(spark, tmp_path):
    table = CompleteTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(5))
    planned = table.read()
    with pytest.raises(Exception, match="lost"):
        table.replace(failing(spark, 100))
    assert table.read().count() == 5
    table.stage(spark.range(7))  # and the driver is gone
    again = CompleteTable(spark, str(tmp_path / "t"))
    assert again.read().count() == 5
    again.replace(spark.range(9))
    assert again.read().count() == 9
    assert planned.count() == 5  # a query planned before still finds its version


def test_a_pointer_that_was_lost_half_way_is_passed_over(spark, tmp_path):
    table = CompleteTable(spark, str(tmp_path / "t"))
    for n in (1, 2, 3):
        table.replace(spark.range(n))
    shutil.rmtree(tmp_path / "t" / "pointer" / "slot=1")  # that of version 1, being written anew for 3
    assert table.read().count() == 3


def test_two_writers_are_noticed(spark, tmp_path):
    one, two = (CompleteTable(spark, str(tmp_path / "t")) for _ in range(2))
    staged = one.stage(spark.range(1))
    two.replace(spark.range(2))
    with pytest.raises(ValueError, match="another writer"):
        one.switch(staged)
    with pytest.raises(ValueError, match="two at least"):
        CompleteTable(spark, str(tmp_path / "t"), kept=1)


def test_schema_may_change_with_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    write_complete(spark.range(3), path)
    assert write_complete(spark.sql("SELECT 'x' AS name, 1.5D AS price"), path).columns == ["name", "price"]
    assert [tuple(r) for r in read_complete(spark, path).collect()] == [("x", 1.5)]


def test_catalog_name_shows_old_rows_until_the_switch(spark, tmp_path):
    create_database(spark, "complete_test", str(tmp_path / "db"))
    try:
        save_table(spark.range(3), "complete_test.t", "first")
        with pytest.raises(Exception, match="lost"):
            save_table(failing(spark, 50), "complete_test.t", "second")
        assert spark.table("complete_test.t").count() == 3
        assert spark.catalog.getTable("complete_test.t").description == "first"
        save_table(spark.sql("SELECT 1 AS a, 2 AS b"), "complete_test.t", "third", {"quality": "ctl"})
        assert [tuple(r) for r in spark.table("complete_test.t").collect()] == [(1, 2)]
        for n in range(6):
            save_table(spark.range(n), "complete_test.t")
            assert spark.table("complete_test.t").count() == n
    finally:
        spark.sql("DROP DATABASE complete_test CASCADE")
