"""Inputs on which rows, values or errors were once lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators import expect_fail
from weirflow.sources import append_merge, append_once, read_landing, read_merged
from weirflow.streaming import source_settings, union_sources_from_config

AB = T.StructType().add("a", "string").add("b", "string")


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_csv_in_another_order_is_refused(spark, tmp_path):
    path = write(tmp_path / "x", "one.csv", "b,a", "2,1")
    with pytest.raises(Exception, match="(?i)header"):
        read_landing(spark, path, AB, "csv", streaming=False).collect()
    forced = read_landing(spark, path, AB, "csv", streaming=False, options={"enforceSchema": "true"})
    assert [(r.a, r.b) for r in forced.collect()] == [("2", "1")]


def test_csv_with_a_provenance_field_in_the_middle(spark, tmp_path):
    schema = T.StructType().add("id", "integer").add("entity", "string").add("name", "string").add("InputFileName", "string")
    path = write(tmp_path / "x", "one.csv", "id,entity,name", "1,XX,bob", "C,XX,eve")
    rows = read_landing(spark, path, schema, "csv", streaming=False)
    assert rows.columns == ["id", "name", "_rescue", "InputFileName"]
    assert sorted((str(r.id), r.name, r["_rescue"]) for r in rows.collect()) == [("1", "bob", None), ("None", "eve", "C,XX,eve")]


def test_json_keys_unknown_at_any_depth(spark, tmp_path):
    inner = T.StructType().add("x", "long")
    schema = (
        T.StructType().add("id", "long").add("o", inner).add("l", T.ArrayType(inner))
        .add("m", T.MapType(T.StringType(), inner))
    )
    path = write(
        tmp_path / "x", "one.json",
        '{"id":1,"o":{"x":1},"l":[{"x":1}],"m":{"k":{"x":1}}}',
        '{"id":2,"o":{"x":1,"lost":7}}',
        '{"id":3,"l":[{"x":1},{"lost":7}]}',
        '{"id":4,"m":{"k":{"x":1,"lost":7}}}',
        '{"id":5,"o":null,"l":[],"m":{}}',
        '{"id":6,"lost":7}',
    )
    rows = {r.id: r["_rescue"] for r in read_landing(spark, path, schema, "json", streaming=False).collect()}
    assert rows[1] is None and rows[5] is None
    assert all("lost" in rows[i] and '7' in rows[i] for i in (2, 3, 4, 6))


def test_fail_policy_sees_rows_that_are_filtered_later(spark):
    rows = expect_fail(spark.range(100), {"big": "id >= 10"})
    with pytest.raises(Exception, match="row breaks: big"):
        rows.filter("id > 50").collect()
    assert expect_fail(spark.range(100), {"all": "id >= 0"}).filter("id > 50").count() == 49


def test_append_keeps_the_types_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    append_merge(spark.createDataFrame([(1, "x")], "k long, s string"), path)
    append_merge(spark.createDataFrame([(2, 3, 4)], "k int, s int, more int"), path)
    with pytest.raises(ValueError, match="column k"):
        append_merge(spark.createDataFrame([("y",)], "k string"), path)
    assert sorted(tuple(r) for r in read_merged(spark, path).select("k", "s", "more").collect()) == [(1, "x", None), (2, "3", 4)]


def test_append_keeps_the_types_inside_structs(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, (None,))], "id long, d struct<k:string>")
    append_merge(one, path)
    append_merge(spark.createDataFrame([(2, (5, 6)), (3, None)], "id long, d struct<k:long,n:long>"), path)
    found = {r.id: r.d for r in read_merged(spark, path).collect()}
    assert found[2].k == "5" and found[2].n == 6 and found[3] is None


def test_append_once_is_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "event_id long, v string")
    append_once(rows, path)
    append_once(rows, path)
    assert sorted(r.event_id for r in read_merged(spark, path).collect()) == [1, 2]
    with pytest.raises(Exception, match="event_id is NULL"):
        append_once(spark.createDataFrame([(None, "a")], "event_id long, v string"), path)


def test_sources_from_string_settings():
    config = {"landing_zone.ES": "/es", "landing_zone.PT": "/pt", "header": "false", "max_files": "2", "option.sep": ";"}
    sources = union_sources_from_config(config, AB)
    assert [(s.table, s.landing, s.entity) for s in sources] == [("bronze_es", "/es", "ES"), ("bronze_pt", "/pt", "PT")]
    assert all((s.header, s.max_files, s.options) == (False, 2, {"sep": ";"}) for s in sources)
    with pytest.raises(ValueError, match="landing_zone"):
        union_sources_from_config({}, AB)
    assert source_settings({}) == {}


def test_reader_options_reach_the_files(spark, tmp_path):
    path = write(tmp_path / "x", "one.csv", "a;b", "1;2")
    (source,) = union_sources_from_config({"landing_zone.ES": path, "option.sep": ";"}, AB)
    rows = read_landing(spark, source.landing, AB, "csv", streaming=False, header=source.header, options=source.options)
    assert rows.select(F.struct("a", "b")).first()[0] == ("1", "2")
