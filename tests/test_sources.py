import datetime
import os
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from strata.session import scratch_path
from strata.sources import (
    conform, create_df, create_empty_df, parse_as, read_or_empty, read_xml, register_view,
    write_table, write_with_count,
)

XML = '<page><title>A</title><revision><text bytes="3">x</text></revision></page>'


def test_create_df_row_forms(spark):
    fields = [("port", IntegerType(), True), StructField("harbour", StringType(), True)]
    df = create_df(spark, [(11, "Lerwick"), Row(12, None), [None, "Wick"]], fields)
    assert [tuple(r) for r in df.collect()] == [(11, "Lerwick"), (12, None), (None, "Wick")]
    one = create_df(spark, [5, 6], [("x", IntegerType())])
    assert [r["x"] for r in one.collect()] == [5, 6]


@pytest.mark.parametrize(("value", "dtype"), [
    (1.9, "int"), ("1", "int"), (True, "int"), (2**31, "int"), (300, "tinyint"), (1, "string"),
    (datetime.datetime(2020, 1, 1), "date"), (Decimal("1.234"), "decimal(5,2)"), (10**4, "decimal(5,2)"),
    (1.5, "decimal(5,2)"), ([1, "x"], "array<int>"), ({"a": 1.5}, "map<string,int>"), (1, "boolean")])
def test_create_df_refuses_other_types(spark, value, dtype):
    with pytest.raises(TypeError, match="column 'a'"):
        create_df(spark, [(value,)], f"a {dtype}")


def test_create_df_takes_fitting_values(spark):
    row = (5, 2.5, 3, Decimal("1.20"), "x", True, datetime.date(2020, 1, 2), [1, None], {"k": 2})
    df = create_df(spark, [row], "a tinyint, b double, c double, d decimal(5,2), e string, "
                                 "f boolean, g date, h array<int>, i map<string,int>")
    assert tuple(df.first()) == row


def test_nulls_where_none_may_be(spark):
    strict = StructType([StructField("a", LongType(), False), StructField("b", StringType())])
    with pytest.raises(ValueError, match="NULL in column 'a'"):
        create_df(spark, [(None, "x")], strict)
    df = spark.createDataFrame([("1", None), (None, "x")], "a string, b string")
    for bound in (parse_as(df, strict), parse_as(df, strict, strict=False),
                  conform(df.select(F.col("a").cast("int").alias("a"), "b"), strict)):
        with pytest.raises(Exception, match="NULL in column 'a'"):
            bound.collect()
    assert [tuple(r) for r in parse_as(df.where("a IS NOT NULL"), strict).collect()] == [(1, None)]


def test_create_empty_df(spark):
    df = create_empty_df(spark, [("a", LongType(), False)])
    assert df.count() == 0 and df.schema[0].name == "a"


def test_conform_reorders_and_casts(spark):
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    out = conform(df, schema)
    assert out.schema == schema and tuple(out.first()) == (1, "x")
    with pytest.raises(ValueError):
        conform(df.select("a"), schema)


@pytest.mark.parametrize(("source", "target"), [
    ("double", "int"), ("bigint", "int"), ("string", "int"), ("decimal(20,2)", "decimal(10,2)"),
    ("double", "bigint"), ("timestamp", "date"), ("bigint", "decimal(10,0)"),
    ("array<double>", "array<int>")])
def test_conform_refuses_casts_that_lose(spark, source, target):
    df = spark.range(1).selectExpr(f"cast(NULL AS {source}) AS a")
    with pytest.raises(TypeError, match="parse_as"):
        conform(df, f"a {target}")
    if "array" not in source:
        assert parse_as(df, f"a {target}").schema["a"].dataType.simpleString() == target


@pytest.mark.parametrize(("source", "target"), [
    ("int", "bigint"), ("bigint", "double"), ("int", "string"), ("date", "timestamp"),
    ("int", "decimal(12,2)"), ("decimal(8,2)", "decimal(10,2)"), ("array<int>", "array<bigint>"),
    ("struct<x:int>", "struct<x:bigint>"), ("map<string,int>", "map<string,bigint>")])
def test_conform_widens(spark, source, target):
    df = spark.range(1).selectExpr(f"cast(NULL AS {source}) AS a")
    assert conform(df, f"a {target}").schema["a"].dataType.simpleString() == target


def test_parse_as_keeps_or_refuses_bad_values(spark):
    df = spark.createDataFrame([("1.9",), ("x",)], "a string")
    assert [r["a"] for r in parse_as(df, "a double", strict=False).collect()] == [1.9, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_as(df, "a double").collect()


def test_xml_nested_value(spark, tmp_path):
    path = tmp_path / "pages.xml"
    path.write_text(XML)
    df = read_xml(spark, str(path), row_tag="page")
    assert df.schema.simpleString() == (
        "struct<revision:struct<text:struct<_VALUE:string,_bytes:bigint>>,title:string>")
    assert df.select("title", "revision.text._VALUE").first() == ("A", "x")


def test_read_or_empty_only_forgives_missing_path(spark, tmp_path):
    schema = StructType([StructField("a", LongType())])
    assert read_or_empty(spark, str(tmp_path / "missing"), schema).count() == 0
    bad = tmp_path / "bad.parquet"
    bad.write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(bad), schema).collect()


def test_writers_and_view(spark):
    df = spark.range(5)
    path = scratch_path(spark, "test-writers")
    assert write_with_count(df, path, mode="errorifexists") == 5
    with pytest.raises(Exception):
        write_table(df, path, mode="errorifexists")
    write_table(df, path, mode="overwrite")
    view = register_view(spark, "strata_test_view", "parquet", path)
    assert view.count() == 5
    assert spark.sql("SELECT count(*) FROM strata_test_view WHERE id > 2").first()[0] == 2


def test_scratch_is_under_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir()
    assert base and scratch_path(spark, "x").startswith(base)
    assert not os.path.exists(scratch_path(spark, "y").replace("file:", ""))


def test_literal_tables_keep_schema_and_need_no_python(spark, capsys):
    fields = [("a", LongType(), True), ("b", StringType(), False)]
    df = create_df(spark, [(None, "x"), (2, "y")], fields)
    assert df.schema == StructType([StructField("a", LongType(), True),
                                    StructField("b", StringType(), False)])
    assert [tuple(r) for r in df.collect()] == [(None, "x"), (2, "y")]
    empty = create_empty_df(spark, fields)
    assert empty.schema == df.schema and empty.count() == 0
    capsys.readouterr()
    df.union(empty).explain()
    plan = capsys.readouterr().out
    assert "ExistingRDD" not in plan and "PythonRDD" not in plan


def test_avro_without_module_fails_clearly(spark, tmp_path):
    from strata.sources import read_avro

    with pytest.raises(RuntimeError, match="spark-avro"):
        read_avro(spark, str(tmp_path / "x.avro"))


def test_jdbc_partitioned_read_needs_all_bounds(spark):
    from strata.sources import read_jdbc

    # Validated before any connection is opened (no database is started).
    with pytest.raises(ValueError, match="lower_bound"):
        read_jdbc(spark, "jdbc:none://nowhere", "t", {"user": "u"}, column="id",
                  num_partitions=4)
