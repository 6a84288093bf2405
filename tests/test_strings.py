import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import java_split, jvm_trim, parse_double, round_to_float, split_quoted


def jvm_split_model(s: str, sep: str = " ") -> list[str]:
    """Python model of java.lang.String.split(regex) with limit 0."""
    if s == "":
        return [""]
    parts = re.split(re.escape(sep), s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _apply(spark, values, column_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    rows = df.select("i", column_fn(F.col("s")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def test_java_split_golden(spark):
    cases = {"": [""], " ": [], " a": ["", "a"], "a ": ["a"], " a  b ": ["", "a", "", "b"]}
    got = _apply(spark, list(cases), java_split)
    assert got == list(cases.values())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=8), min_size=1, max_size=20))
def test_java_split_matches_model(spark, values):
    assert _apply(spark, values, java_split) == [jvm_split_model(v) for v in values]


def test_jvm_trim(spark):
    assert _apply(spark, ["\t x\n ", "\x01a b\x02", "  ", "q"], jvm_trim) == ["x", "a b", "", "q"]


def test_split_quoted(spark):
    assert _apply(spark, ['1,"A, B",x|y'], split_quoted) == [["1", '"A, B"', "x|y"]]


def test_parse_double_bad_is_null(spark):
    assert _apply(spark, ["4.0", " 2.5 ", "bad", ""], parse_double) == [4.0, 2.5, None, None]


def test_round_to_float(spark):
    df = spark.createDataFrame([(0.123456,)], "x double")
    value = df.select(round_to_float(F.col("x"), 4).alias("f")).first()["f"]
    assert abs(value - 0.12349999696) < 1e-10
    assert df.select(round_to_float(F.col("x"), 4)).schema[0].dataType.simpleString() == "float"


ODD = "a ,\n\r\u0085\u2028\t\"\x01\x02|"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ODD, max_size=12), min_size=1, max_size=20))
def test_splits_and_trim_follow_the_jvm_on_odd_characters(spark, values):
    def quoted(s):
        parts, out = re.split(',(?=(?:[^"]*"[^"]*")*[^"]*\\Z)', s), []
        while parts and parts[-1] == "":
            parts.pop()
        return parts or ([""] if s == "" else out)

    assert _apply(spark, values, java_split) == [jvm_split_model(v) for v in values]
    assert _apply(spark, values, split_quoted) == [quoted(v) for v in values]
    blanks = "".join(map(chr, range(33)))
    assert _apply(spark, values, jvm_trim) == [v.strip(blanks) for v in values]


def test_long_runs_are_linear(spark):
    n = 1_000_000
    df = spark.range(1).select(
        F.repeat(F.lit(" "), n).alias("spaces"), F.repeat(F.lit("\n"), n).alias("breaks"),
        F.concat(F.repeat(F.lit("x "), n // 2), F.lit("x")).alias("words"),
        F.concat(F.repeat(F.lit('"a,b",'), n // 6), F.lit("z")).alias("fields"))
    row = df.select(F.size(java_split("spaces")).alias("a"), F.size(java_split("breaks", "\n")).alias("b"),
                    F.size(java_split("words")).alias("c"), F.size(split_quoted("fields")).alias("d"),
                    F.length(jvm_trim("spaces")).alias("e")).first()
    assert tuple(row) == (0, 0, n // 2 + 1, n // 6 + 1, 0)
