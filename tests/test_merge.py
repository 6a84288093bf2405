import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.operators.merge import merge_upsert

BASE_SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()),
                          StructField("n", LongType())])
DELTA_SCHEMA = "id string, name string, n string"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_golden(spark):
    base = spark.createDataFrame([(1, "x", 10), (2, "y", None)], BASE_SCHEMA)
    delta = spark.createDataFrame([("2", None, "7"), ("3", "z", "9")], DELTA_SCHEMA)
    out = merge_upsert(base, delta, "id")
    assert out.schema == BASE_SCHEMA
    assert _rows(out) == [(1, "x", 10), (2, "y", 7), (3, "z", 9)]


def test_merge_empty_delta_is_identity(spark):
    base = spark.createDataFrame([(1, "x", 10), (2, "y", None)], BASE_SCHEMA)
    delta = spark.createDataFrame([], DELTA_SCHEMA)
    assert _rows(merge_upsert(base, delta, "id")) == _rows(base)


def test_merge_is_idempotent_and_keys_are_union(spark):
    base = spark.createDataFrame([(i, f"b{i}", i) for i in range(20)], BASE_SCHEMA)
    delta = spark.createDataFrame([(str(i), None if i % 2 else f"d{i}", str(i * 100))
                                   for i in range(15, 30)], DELTA_SCHEMA)
    once = merge_upsert(base, delta, "id")
    twice = merge_upsert(once, delta, "id")
    assert _rows(once) == _rows(twice)
    assert sorted(r["id"] for r in once.collect()) == list(range(30))
    # A NULL in the delta never clears a value.
    row17 = [r for r in once.collect() if r["id"] == 17][0]
    assert row17["name"] == "b17" and row17["n"] == 1700


def test_merge_two_keys_and_dedupe(spark):
    base = spark.createDataFrame([(1, 2020, 5), (1, 2021, 6)], "a long, y int, c long")
    delta = spark.createDataFrame([("1", "2021", "60", "1"), ("1", "2021", "61", "2"),
                                   ("2", "2020", "1", "1")], "a string, y string, c string, v string")
    base_v = base.selectExpr("a", "y", "c", "cast(0 as string) as v")
    out = merge_upsert(base_v, delta, ["a", "y"], dedupe_by="v")
    assert _rows(out.select("a", "y", "c")) == [(1, 2020, 5), (1, 2021, 61), (2, 2020, 1)]


def test_merge_strict_cast_raises_and_lenient_nulls(spark):
    base = spark.createDataFrame([(1, "x", 10)], BASE_SCHEMA)
    delta = spark.createDataFrame([("1", None, "bad")], DELTA_SCHEMA)
    with pytest.raises(Exception):
        merge_upsert(base, delta, "id").collect()
    out = merge_upsert(base, delta, "id", strict=False)
    assert _rows(out) == [(1, "x", 10)]


def merge_model(base, delta):
    """Python model: update-wins per column, NULL never clears, keys united."""
    out = {k: list(v) for k, v in base.items()}
    for k, v in delta.items():
        if k in out:
            out[k] = [d if d is not None else b for d, b in zip(v, out[k])]
        else:
            out[k] = list(v)
    return sorted((k, *v) for k, v in out.items())


ROWS = st.dictionaries(st.integers(0, 30), st.tuples(st.one_of(st.none(), st.sampled_from("xyz")),
                                                    st.one_of(st.none(), st.integers(0, 99))),
                       max_size=12)


@settings(max_examples=15, deadline=None)
@given(ROWS, ROWS)
def test_merge_matches_model(spark, base_rows, delta_rows):
    base = spark.createDataFrame([(k, *v) for k, v in base_rows.items()], BASE_SCHEMA)
    delta = spark.createDataFrame(
        [(str(k), v[0], None if v[1] is None else str(v[1])) for k, v in delta_rows.items()],
        DELTA_SCHEMA)
    want = merge_model(base_rows, delta_rows)
    assert _rows(merge_upsert(base, delta, "id")) == want


def test_latest_per_key_hot_key(spark):
    from strata.operators.merge import latest_per_key

    df = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k",
                                         "id AS v")
    out = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], "v").collect()}
    assert out[0] == 2997 and len(out) == 2001


def test_merge_parses_array_column_and_reports_duplicates(spark):
    from pyspark.sql import functions as F

    from strata.operators.merge import duplicate_keys

    base = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id long, alts array<string>")
    delta = spark.createDataFrame([("2", '["c"]'), ("3", None), ("3", '["d"]')],
                                  "id string, alts string")
    with pytest.raises(ValueError, match="2 rows of one key"):
        merge_upsert(base, delta, "id", parse={"alts": lambda c: F.from_json(c, "array<string>")})
    out = merge_upsert(base, delta, "id", dedupe_by="alts",
                       parse={"alts": lambda c: F.from_json(c, "array<string>")})
    assert out.schema == base.schema
    rows = sorted(((r["id"], r["alts"]) for r in out.collect()), key=str)
    assert rows == sorted([(1, ["a", "b"]), (2, ["c"]), (3, ["d"])], key=str)
    assert [tuple(r) for r in duplicate_keys(delta, "id").collect()] == [("3", 2)]


def test_merge_null_keys_ties_and_unknown_order(spark):
    from strata.operators.merge import latest_per_key

    base = spark.createDataFrame([(1, "x", 10), (None, "n", 1)], BASE_SCHEMA)
    delta = spark.createDataFrame([(None, "m", "2"), ("1", "y", None)], DELTA_SCHEMA)
    assert sorted(map(str, map(tuple, merge_upsert(base, delta, "id").collect()))) == sorted(
        map(str, [(1, "y", 10), (None, "n", 1), (None, "m", 2)]))
    late = spark.createDataFrame([("1", "a", "5", "2"), ("1", "b", "6", None), ("1", "c", "7", "2")],
                                 DELTA_SCHEMA + ", seen string")
    out = merge_upsert(base.where("id = 1"), late, "id", dedupe_by="seen")
    assert _rows(out) == [(1, "c", 7)]
    rows = spark.createDataFrame([(1, None, "a"), (1, None, "b")], "k int, o int, v string")
    assert [tuple(r) for r in latest_per_key(rows, ["k"], "o").collect()] == [(1, None, "b")]
