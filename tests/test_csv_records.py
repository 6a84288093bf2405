"""Records with line breaks inside quotes, read in chunks, against Spark's own
one-task reader."""

import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources.csv_records import csv_records, read_csv_records

PLAIN = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@pytest.fixture
def small_chunks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    bits = ["a", "é", " ", ",", '"', "\n", "\n\n", "x" * 30, "tail\n", "\r\n", "'"]
    return [(str(i), *["".join(rng.choice(bits) for _ in range(rng.randrange(0, 12)))
                       for _ in range(2)]) for i in range(n)]


def written(path, rows, newline="\n", header=("id", "first text", "b")):
    def field(v):
        return '"' + v.replace('"', '""') + '"' if v else ""
    lines = [",".join(header), *[",".join(map(field, r)) for r in rows]]
    path.write_bytes((newline.join(lines) + newline).encode())


@pytest.mark.parametrize("seed", range(6))
def test_equals_the_one_task_reader(spark, tmp_path, small_chunks, seed):
    rows = random_rows(seed)
    written(tmp_path / "a.csv", rows[:35])
    written(tmp_path / "b.csv", rows[35:])
    whole = spark.read.option("header", True).options(multiLine=True, **PLAIN).csv(str(tmp_path))
    got = read_csv_records(spark, str(tmp_path))
    assert got.columns == ["id", "first text", "b"] == whole.columns
    want = sorted((i, a or None, b or None) for i, a, b in rows)
    assert sorted(map(tuple, got.collect())) == want
    assert csv_records(spark, str(tmp_path)).count() == len(rows) + 2  # with headers


def test_one_file_in_many_tasks(spark, tmp_path, small_chunks):
    written(tmp_path / "a.csv", random_rows(9, 200))
    lines = spark.read.text(str(tmp_path / "a.csv"))
    assert lines.rdd.getNumPartitions() > 20
    got = read_csv_records(spark, str(tmp_path / "a.csv"))
    assert got.count() == 200
    assert "multiLine=true" not in got._jdf.queryExecution().executedPlan().toString()


def test_one_record_over_many_chunks(spark, tmp_path, small_chunks):
    long = "line\n" * 400 + "end"
    written(tmp_path / "a.csv", [("1", "x", "y"), ("2", long, ""), ("3", long, long), ("4", "", "z")])
    assert sorted(map(tuple, read_csv_records(spark, str(tmp_path)).collect())) == [
        ("1", "x", "y"), ("2", long, None), ("3", long, long), ("4", None, "z")]


def test_line_ends_blank_lines_and_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,t\r\n1,"a\r\nb"\r\n\r\n2,c\r\n  \r\n3,"d"')
    got = read_csv_records(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [("1", "a\r\nb"), ("2", "c"), ("3", "d")]
    schema = StructType([StructField("n", StringType()), StructField("text", StringType())])
    assert read_csv_records(spark, str(tmp_path), schema).columns == ["n", "text"]


def test_only_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,t\n")
    got = read_csv_records(spark, str(tmp_path))
    assert got.columns == ["id", "t"] and got.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_kept_in_columns(spark, tmp_path, small_chunks, seed):
    """With a store, files are read and parsed once: the rows are the same, and what reads
    them again reads columns, without Python."""
    written(tmp_path / "a.csv", random_rows(seed))
    written(tmp_path / "b.csv", random_rows(seed + 20, 20))
    files = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    got = read_csv_records(spark, files, store=str(tmp_path / "kept"))
    want = read_csv_records(spark, files)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Scan text" not in plan and "from_csv" not in plan


def test_kept_long_records_and_odd_lines(spark, tmp_path, small_chunks):
    long = "line\n" * 400 + "end"
    rows = [("1", "x", "y"), ("2", long, ""), ("3", long, long), ("4", "", "z")]
    written(tmp_path / "a.csv", rows)
    got = read_csv_records(spark, str(tmp_path / "a.csv"), store=str(tmp_path / "kept"))
    assert sorted(map(tuple, got.collect())) == [(i, a or None, b or None) for i, a, b in rows]
    (tmp_path / "odd.csv").write_bytes(b'id,t\r\n1,"a\r\nb"\r\n\r\n2,c\r\n  \r\n3,"d"')
    odd = read_csv_records(spark, str(tmp_path / "odd.csv"), store=str(tmp_path / "kept-odd"))
    assert sorted(map(tuple, odd.collect())) == [("1", "a\r\nb"), ("2", "c"), ("3", "d")]


def test_kept_without_breaks_needs_no_python(spark, tmp_path, small_chunks):
    rows = [(str(i), 'a "b", c' * (i % 3), " é " if i % 5 else "") for i in range(60)]
    written(tmp_path / "a.csv", rows[:30])
    written(tmp_path / "b.csv", rows[30:])
    (tmp_path / "blank.csv").write_text('id,first text,b\n"x",,\n\n  \n"",y,""\n1\n1,2,3,4\n')
    (tmp_path / "head.csv").write_text("id,first text,b\n")
    files = [str(tmp_path / f"{n}.csv") for n in ("a", "b", "blank", "head")]
    got = read_csv_records(spark, files, store=str(tmp_path / "kept"))
    assert not (tmp_path / "kept" / "pieces").exists()
    want = sorted(map(tuple, read_csv_records(spark, files).collect()), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) == 64
