from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators.text import word_count, word_count_filtered, word_totals
from tests.test_strings import jvm_split_model

LINES = st.lists(st.text(alphabet="ab ,.\t", max_size=12), min_size=1, max_size=15)


@settings(max_examples=25, deadline=None)
@given(LINES)
def test_word_count_matches_model(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = {r["word"]: r["n"] for r in word_count(df, sort=False).collect()}
    want = Counter(w for line in lines for w in jvm_split_model(line))
    assert got == dict(want)
    totals = word_totals(word_count(df, sort=False)).first()
    assert totals["distinct_words"] == len(want)
    assert (totals["total_words"] or 0) == sum(want.values())


def test_word_count_filtered_rules(spark):
    df = spark.createDataFrame([("The cat,\tthe DOG. cat",), ("  ",)], "value string")
    got = {r["word"]: r["n"] for r in
           word_count_filtered(df, separators=(" ", ",", "."), stop_words=(" THE ",)).collect()}
    assert got == {"cat": 2, "dog": 1}


def test_word_count_sorted_most_frequent_first(spark):
    df = spark.createDataFrame([("b a b c b a",)], "value string")
    assert [tuple(r) for r in word_count(df).collect()] == [("b", 3), ("a", 2), ("c", 1)]


def test_lines_of_keeps_empty_lines(spark):
    from strata.operators.text import lines_of

    def lines(text):
        return [r[0] for r in lines_of(spark.createDataFrame([(text,)], "t string"), "t").collect()]
    assert lines("a\n\n") == ["a", ""]
    assert lines("\n") == [""]
    assert lines("a\r\n\nb") == ["a", "", "b"]
    assert lines("") == [] and lines(None) == []
