from __future__ import annotations

import pytest

from weirflow.operators import (
    control_of_counts,
    expect_drop,
    file_counts,
    file_reconciliation,
    label,
    loaded_vs_rejected,
    quarantine,
    reconciliation_of_labelled,
    union_all,
    where_sql,
    with_entity,
)

KEYS = "InputFileName STRING, IngestionDate STRING, IngestionTime STRING"


def test_union_goes_by_position(spark, rows):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS y, 4 AS x")
    assert rows(union_all([a, b, a])) == [(1, 2), (1, 2), (3, 4)]
    assert union_all([a, b]).columns == ["x", "y"]


def test_union_refuses_what_does_not_line_up(spark):
    a = spark.sql("SELECT 1 AS x, 'a' AS y")
    with pytest.raises(ValueError, match="frame 2"):
        union_all([a, spark.sql("SELECT 'a' AS y, 1 AS x")])
    with pytest.raises(ValueError, match="frame 3"):
        union_all([a, a, spark.sql("SELECT 1 AS x")])
    with pytest.raises(ValueError):
        union_all([])


def test_filter_and_entity(spark, rows):
    df = spark.createDataFrame([("Y", 1), ("N", 2), (None, 3)], "Organic STRING, i INT")
    assert rows(with_entity(where_sql(df, "Organic = 'Y'"), "ES")) == [("Y", 1, "ES")]


def test_file_counts(spark, rows):
    df = spark.createDataFrame(
        [("f", "ES", "d", "t", 1), ("f", "ES", "d", "t", None), ("g", "ES", "d", "t", 1)],
        "InputFileName STRING, Entity STRING, IngestionDate STRING, IngestionTime STRING, id INT",
    )
    counted = file_counts(df)
    assert counted.columns == ["fileName", "records", "Entity", "IngestionDate", "IngestionTime"]
    assert rows(counted) == [("f", 2, "ES", "d", "t"), ("g", 1, "ES", "d", "t")]


@pytest.fixture
def layers(spark):
    silver = [("both", "d", "1", 1), ("both", "d", "1", 2), ("both", "d", "2", 3),
              ("clean", "d", "1", 4)]
    rejected = [("both", "d", "1", 5), ("both", "d", "2", None), ("only", "d", "1", 6)]
    return (
        spark.createDataFrame(silver, KEYS + ", id INT"),
        spark.createDataFrame(rejected, KEYS + ", id INT"),
    )


def test_loaded_vs_rejected_keeps_the_definition(layers, rows):
    # Two ingestions of one file on both sides give 2 x 2 rows; a clean file has
    # NULL; a file with rejects only is missing; a NULL id is not counted.
    assert rows(loaded_vs_rejected(*layers)) == [
        ("both", "d", "1", 2, 0),
        ("both", "d", "1", 2, 1),
        ("both", "d", "2", 1, 0),
        ("both", "d", "2", 1, 1),
        ("clean", "d", "1", 1, None),
    ]


def test_reconciliation_shows_every_file_once_per_ingestion(layers, rows):
    assert rows(file_reconciliation(*layers)) == [
        ("both", "d", "1", 2, 1),
        ("both", "d", "2", 1, 1),
        ("clean", "d", "1", 1, 0),
        ("only", "d", "1", 0, 1),
    ]


def test_control_table_of_stored_counts_is_the_same(spark, layers, tmp_path, rows):
    file_reconciliation(*layers, id_column="id").write.parquet(str(tmp_path / "counts"))
    counts = spark.read.parquet(str(tmp_path / "counts"))
    assert rows(control_of_counts(counts)) == rows(loaded_vs_rejected(*layers))
    assert rows(counts.drop("ids_OK", "ids_KO")) == rows(file_reconciliation(*layers))


def test_counts_of_labelled_rows(spark, rows):
    df = spark.createDataFrame(
        [("f", "d", "t", 1), ("f", "d", "t", -1), ("f", "d", "t", None), ("g", "d", "t", None)],
        KEYS + ", id INT",
    )
    rules = {"positive": "id > 0"}
    expected = file_reconciliation(expect_drop(df, rules), quarantine(df, rules), id_column="id")
    found = reconciliation_of_labelled(label(df, rules), id_column="id")
    assert rows(found) == rows(expected) == [("f", "d", "t", 1, 2, 1, 1), ("g", "d", "t", 0, 1, 0, 0)]


def test_one_file_with_most_rows_is_counted_before_it_is_shuffled(spark, plan):
    df = spark.range(1000).selectExpr(
        "'hot' AS InputFileName", "'ES' AS Entity", "'d' AS IngestionDate", "'t' AS IngestionTime"
    )
    text = plan(file_counts(df))
    assert text.count("Exchange") == 1
    assert text.index("partial_count") > text.index("Exchange")
