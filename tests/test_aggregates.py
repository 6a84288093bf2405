import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import count_by, mean_by, ratio_by, top_n
from strata.operators.catalog import weekday_counts


def _ratings(spark):
    return spark.createDataFrame([(7, "4.0"), (7, "2.0"), (7, "bad"), (8, "5")],
                                 "item long, rating string")


@pytest.mark.parametrize("method", ["fold", "join", "pandas"])
def test_mean_skips_bad_numbers(spark, method):
    out = {r["item"]: r["mean"] for r in mean_by(_ratings(spark), "item", "rating",
                                                 method=method).collect()}
    assert out == {7: 3.0, 8: 5.0}


@pytest.mark.parametrize("method", ["fold", "join", "pandas"])
def test_mean_join_form_counts_bad_rows(spark, method):
    out = {r["item"]: r["mean"] for r in mean_by(_ratings(spark), "item", "rating",
                                                 method=method, bad="count").collect()}
    assert out == {7: 2.0, 8: 5.0}


def test_mean_forms_agree_on_clean_data(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("k"),
                                     (F.col("id") % 11).cast("double").alias("v"))
    forms = [sorted(tuple(r) for r in mean_by(df, "k", "v", method=m).collect())
             for m in ("fold", "join", "pandas")]
    assert forms[0] == forms[1]
    assert [(k, round(v, 9)) for k, v in forms[0]] == [(k, round(v, 9)) for k, v in forms[2]]


def test_count_by_and_top_n(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (2, 1.0)], "k long, v double")
    assert sorted(tuple(r) for r in count_by(df, "k").collect()) == [(1, 2), (2, 1)]
    assert sorted(tuple(r) for r in count_by(df, "k", column="v").collect()) == [(1, 1), (2, 1)]
    top = top_n(count_by(df, "k"), [F.col("n").desc()], 1, tiebreak=["k"]).collect()
    assert [tuple(r) for r in top] == [(1, 2)]


def test_ratio_by_zero_sum_is_null(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 2)], "g string, id long")
    out = {r["g"]: (r["count"], r["procent"], r["share"])
           for r in ratio_by(df, "g", "id", share_name="share").collect()}
    assert out["a"][0] == 2 and out["a"][1] is None
    assert out["b"] == (1, 0.5, pytest.approx(1 / 3))


def test_weekday_base0_drops_day_zero(spark):
    orders = spark.createDataFrame([(d, i) for i, d in enumerate([0, 1, 2, 3, 4, 5, 6, 6])],
                                   "dow int, id long")
    out = {r["day_name"]: r["order_count"] for r in
           weekday_counts(spark, orders, "dow", "id").collect()}
    assert "Saturday" not in out          # id 7 has no rows
    assert sum(out.values()) == 7         # day 0 drops at the inner join
    assert out["Friday"] == 2             # day 6 reads as id 6 = Friday


def test_mean_forms_drop_keys_of_bad_numbers_only(spark):
    from strata.operators.aggregates import mean_by, ratio_by

    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("b", "x"), ("b", None)], "k string, v string")
    for bad, mean in (("count", 0.5), ("skip", 1.0)):
        for method in ("fold", "join", "pandas"):
            out = mean_by(df, "k", "v", name="m", method=method, bad=bad)
            assert [tuple(r) for r in out.collect()] == [("a", mean)]
    ids = spark.createDataFrame([(1, 6 * 10**18), (1, 6 * 10**18)], "k int, v long")
    row = ratio_by(ids, "k", "v", share_name="share").first()
    assert row["count"] == 2 and row["share"] == 1.0 and row["procent"] == 2 / 12e18
