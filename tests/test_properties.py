"""Hypothesis properties: skew-safe left join, quote-aware split, panel with a
hot venue."""

import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import split_quoted
from strata.operators.joins import left_join_hot_right
from strata.operators.panel import entity_period_counts

KEYS = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=15),
       st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=15))
def test_left_join_hot_right_equals_left_join(spark, left_rows, right_rows):
    # One hot right key on top of the random rows.
    right_rows = right_rows + [(0, 99)] * 20
    left = spark.createDataFrame(left_rows, "k int, x int")
    right = spark.createDataFrame(right_rows, "rk int, y int")
    got = sorted(map(tuple, left_join_hot_right(left, right, "k", "rk").collect()), key=str)
    want = sorted(map(tuple, left.join(right, left.k == right.rk, "left").collect()), key=str)
    assert got == want


def quoted_split_model(line: str) -> list[str]:
    parts = re.split(r',(?=(?:[^"]*"[^"]*")*[^"]*$)', line)
    if line == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet='a,"', max_size=10), min_size=1, max_size=12))
def test_split_quoted_matches_model(spark, lines):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, s string")
    got = [r["f"] for r in df.select("i", split_quoted(F.col("s")).alias("f")).orderBy("i")
           .collect()]
    assert got == [quoted_split_model(v) for v in lines]


def test_panel_with_hot_venue_matches_model(spark):
    host = [(0, w) for w in range(600)] + [(v, v * 10 + j) for v in range(1, 6) for j in range(3)]
    works = [(w, 2000 + w % 3) for w in range(0, 700)]
    venues = spark.createDataFrame([(v,) for v in range(7)], "venue_id long")
    h = spark.createDataFrame(host, "venue_id long, work_id long")
    w = spark.createDataFrame(works, "work_id long, publication_year int")
    got = {(r[0], r[1]): r[2] for r in
           entity_period_counts(venues, h, w, [2000, 2001, 2002]).collect()}
    year = dict(works)
    want = defaultdict(set)
    for v, wk in host:
        if wk in year:
            want[(v, year[wk])].add(wk)
    hosting = {v for v, _ in host}
    expected = {(v, y): len(want[(v, y)]) for v in hosting for y in (2000, 2001, 2002)}
    assert got == expected
