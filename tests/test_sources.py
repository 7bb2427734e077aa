"""Golden cases of the file sources and sinks."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators import malformed, strip_provenance, with_provenance
from weirflow.sources import (
    append_json,
    append_merge,
    create_database,
    publish_stream_table,
    read_csv_strings,
    read_json,
    read_landing,
    read_merged,
    register_external,
    read_complete,
    save_table,
    write_complete,
    write_landing,
)

INVOICE = T.StructType(
    [
        T.StructField("InvoiceNo", T.IntegerType()),
        T.StructField("Description", T.StringType()),
        T.StructField("InvoiceDate", T.DateType()),
        T.StructField("UnitPrice", T.DecimalType()),
    ]
)
HEADER = "InvoiceNo,Description,InvoiceDate,UnitPrice\n"


def landing(tmp_path, text, name="a.csv"):
    (tmp_path / "landing").mkdir(exist_ok=True)
    (tmp_path / "landing" / name).write_text(text)
    return str(tmp_path / "landing")


def test_csv_rescue(spark, tmp_path):
    path = landing(
        tmp_path,
        HEADER
        + "1,a,2020-01-01,2.55\nC536379,Discount,2020-01-02,27.50\n3,c,bad,1\n"
        + '4,d,2020-01-01,1,extra\n5,"e,f",2020-01-01,1\n6,g\n',
    )
    df = read_landing(spark, path, INVOICE, "csv", streaming=False)
    day = datetime.date(2020, 1, 1)
    assert {r["_rescue"] or r["InvoiceNo"]: tuple(r)[:4] for r in df.collect()} == {
        1: (1, "a", day, Decimal(3)),
        "C536379,Discount,2020-01-02,27.50": (None, "Discount", datetime.date(2020, 1, 2), Decimal(28)),
        "3,c,bad,1": (3, "c", None, Decimal(1)),
        "4,d,2020-01-01,1,extra": (4, "d", day, Decimal(1)),
        5: (5, "e,f", day, Decimal(1)),
        "6,g": (6, "g", None, None),
    }


@pytest.mark.parametrize(
    "use, expected",
    [
        (lambda df: df.select("_rescue"), 3),
        (lambda df: df.select("InvoiceNo", "_rescue"), 3),
        (lambda df: df.filter("_rescue IS NOT NULL").select("Description").withColumn("_rescue", F.lit(1)), 3),
        (lambda df: df.filter("InvoiceNo > 1").select("_rescue"), 2),
    ],
)
def test_csv_rescue_does_not_depend_on_the_columns_used(spark, tmp_path, use, expected):
    path = landing(
        tmp_path, HEADER + "1,a,2020-01-01,2\nC2,b,2020-01-01,2\n3,c,bad,1\n4,d,2020-01-01,1,extra\n"
    )
    df = read_landing(spark, path, INVOICE, "csv", streaming=False)
    assert use(df).filter("_rescue IS NOT NULL").count() == expected
    assert df.filter("_rescue IS NULL").select("Description").count() == 1


EVENT = T.StructType().add("id", "integer").add("d", "string")


def test_json_rescue(spark, tmp_path):
    path = landing(
        tmp_path,
        '{"id":1,"d":"a"}\n{"id":2,"d":"a","extra":9,"more":{"x":[1]}}\n{"id":"oops"\n\n'
        '{"id":"x","d":"b"}\n{"id":5}\n{"extra":1}\nplain text\n',
        "a.json",
    )
    df = read_landing(spark, path, EVENT, "json", streaming=False)
    found = {(r["id"], r["d"], r["_rescue"]) for r in df.collect()}
    assert found == {
        (1, "a", None),
        (2, "a", '{"extra":"9","more":"{\\"x\\":[1]}"}'),
        (None, None, '{"id":"oops"'),
        (None, "b", '{"id":"x","d":"b"}'),
        (5, None, None),
        (None, None, '{"extra":"1"}'),
        (None, None, "plain text"),
    }
    bad = df.filter(malformed(EVENT, "json")).select("_rescue").collect()
    assert {r[0] for r in bad} == {'{"id":"oops"', "plain text"}
    assert df.select("_rescue").filter("_rescue IS NOT NULL").count() == 5


def test_malformed_csv_is_where_nothing_was_read(spark, tmp_path):
    schema = T.StructType().add("a", "integer").add("b", "integer")
    path = landing(tmp_path, "a,b\n1,2\nx,y\n3,z\n,\n")
    df = read_landing(spark, path, schema, "csv", streaming=False)
    assert [r["_rescue"] for r in df.filter(malformed(schema, "csv")).collect()] == ["x,y"]
    assert df.count() == 4


@pytest.mark.parametrize("file_format, text", [("csv", "a.b,c`d\n1,x\nq,y\n"),
                                               ("json", '{"a.b":1,"c`d":"x"}\n{"a.b":"q","c`d":"y"}\n')])
def test_column_names_of_any_kind(spark, tmp_path, file_format, text):
    schema = T.StructType().add("a.b", "integer").add("c`d", "string")
    df = read_landing(spark, landing(tmp_path, text, f"a.{file_format}"), schema, file_format, streaming=False)
    assert [(r["a.b"], r["c`d"], r["_rescue"] is None) for r in df.orderBy("`c``d`").collect()] == [
        (1, "x", True), (None, "y", False)]
    assert df.filter(malformed(schema, file_format)).count() == 0


def test_json_options_reach_the_parser(spark, tmp_path):
    schema = T.StructType().add("day", "date")
    path = landing(tmp_path, '{"day":"06/05/2024"}\n', "a.json")
    df = read_landing(spark, path, schema, "json", streaming=False, options={"dateFormat": "dd/MM/yyyy"})
    assert df.first()["day"] == datetime.date(2024, 5, 6)
    with pytest.raises(ValueError, match="one object per line"):
        read_landing(spark, path, schema, "json", options={"multiLine": "true"})


def test_provenance_is_added_not_read(spark, tmp_path):
    declared = T.StructType(
        [*INVOICE.fields, T.StructField("InputFileName", T.StringType(), False),
         T.StructField("entity", T.StringType()), T.StructField("IngestionDate", T.DateType()),
         T.StructField("IngestionTime", T.TimestampType())]
    )
    assert strip_provenance(declared) == INVOICE
    path = landing(tmp_path, HEADER + "1,a,2020-01-01,2\n")
    at = F.lit(datetime.datetime(2024, 5, 6, 7, 8, 9))
    row = with_provenance(read_landing(spark, path, declared, "csv", streaming=False), "ES", at).first()
    assert row["InputFileName"].endswith("/landing/a.csv")
    assert (row["Entity"], row["IngestionDate"]) == ("ES", datetime.date(2024, 5, 6))
    assert row["IngestionTime"] == datetime.datetime(2024, 5, 6, 7, 8, 9)


def test_other_formats_have_nothing_to_rescue(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    schema = T.StructType().add("id", "long")
    df = read_landing(spark, str(tmp_path / "p"), schema, "parquet", streaming=False)
    assert df.columns == ["id", "_rescue", "InputFileName"]
    assert df.filter("_rescue IS NULL").count() == 3


def test_options_reach_the_reader(spark, tmp_path):
    path = landing(tmp_path, "1;a;2020-01-01;2\n")
    df = read_landing(spark, path, INVOICE, "csv", streaming=False, header=False, options={"sep": ";"})
    assert df.first()["Description"] == "a"


@pytest.mark.parametrize("files", [1, 7])
def test_landing_files(spark, tmp_path, files):
    path = str(tmp_path / "out")
    write_landing(spark.range(100), path, files=files)
    back = read_csv_strings(spark, path)
    assert back.dtypes == [("id", "string")]
    assert back.count() == 100
    assert len(list((tmp_path / "out").glob("*.csv"))) == files


def test_landing_files_bounded_by_rows_need_no_shuffle(spark, tmp_path):
    write_landing(spark.range(0, 100, 1, 1), str(tmp_path / "out"), rows_per_file=30)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 4
    assert read_csv_strings(spark, str(tmp_path / "out")).count() == 100


def test_json_append(spark, tmp_path):
    path = str(tmp_path / "j")
    append_json(spark.range(2), path)
    append_json(spark.range(2, 3), path)
    assert sorted(r[0] for r in read_json(spark, path, T.StructType().add("id", "long")).collect()) == [0, 1, 2]


def test_complete_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "c")
    write_complete(spark.range(5), path)
    write_complete(spark.range(2), path)
    assert read_complete(spark, path).count() == 2


def test_append_with_new_column(spark, tmp_path, rows):
    path = str(tmp_path / "m")
    append_merge(spark.sql("SELECT 1 AS a"), path)
    append_merge(spark.sql("SELECT 2 AS a, 'x' AS b"), path)
    assert rows(read_merged(spark, path).select("a", "b")) == [(1, None), (2, "x")]


@pytest.fixture
def database(spark, tmp_path):
    create_database(spark, "sources_test", str(tmp_path / "db"))
    create_database(spark, "sources_test")
    yield "sources_test"
    spark.sql("DROP DATABASE sources_test CASCADE")


def test_catalog_table_has_comment_and_properties(spark, database):
    save_table(spark.range(3), f"{database}.t", "It's a table", {"quality": "ctl"})
    save_table(spark.range(2), f"{database}.t", "It's a table", {"quality": "ctl"})
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {database}.t").collect()}
    assert described["Comment"] == "It's a table"
    assert "quality=ctl" in described["Table Properties"]
    assert spark.table(f"{database}.t").count() == 2


def test_table_over_files(spark, database, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "files"))
    for _ in range(2):
        register_external(spark, f"{database}.e", str(tmp_path / "files"))
    assert spark.table(f"{database}.e").count() == 3


def test_published_stream_table_leaves_out_uncommitted_files(spark, database, tmp_path):
    source, path = tmp_path / "src", str(tmp_path / "stream")
    spark.range(3).write.parquet(str(source))
    query = (
        spark.readStream.schema("id BIGINT").parquet(str(source)).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    spark.range(9).write.parquet(str(tmp_path / "left"))
    for i, left in enumerate((tmp_path / "left").glob("*.parquet")):
        (tmp_path / "stream" / f"left-{i}.parquet").write_bytes(left.read_bytes())
    publish_stream_table(spark, f"{database}.s", path, "a stream's table")
    assert spark.table(f"{database}.s").count() == 3
