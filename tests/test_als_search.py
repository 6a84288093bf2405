"""ALS by normal equations and the exact inner-product search, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import als
from strata.operators.search import max_inner_products

USERS, ITEMS, RANK, REG = 23, 17, 3, 0.05


def rating_rows(seed=4, n=300):
    rng = np.random.default_rng(seed)
    # One item holds a third of all ratings.
    return [(int(rng.integers(USERS)), 0 if i % 3 == 0 else int(rng.integers(ITEMS)),
             float(rng.integers(1, 11)) / 2) for i in range(n)]


def numpy_als(rows, start, iterations):
    x, y = np.zeros((USERS, RANK)), start.copy()
    for _ in range(iterations):
        for own, other, k in ((x, y, 0), (y, x, 1)):
            for i in range(len(own)):
                mine = [r for r in rows if r[k] == i]
                if mine:
                    a = np.array([other[r[1 - k]] for r in mine])
                    own[i] = np.linalg.solve(a.T @ a + REG * len(mine) * np.eye(RANK),
                                             a.T @ np.array([r[2] for r in mine]))
    return x, y


@pytest.mark.parametrize(("per_salt", "buckets"), [(100_000, 1), (10, 3)])
def test_als_equals_numpy_with_a_hot_item(spark, per_salt, buckets):
    rows = rating_rows()
    start = np.random.default_rng(1).random((ITEMS, RANK))
    df = spark.createDataFrame([*rows, (1, None, 3.0), (None, 2, 3.0), (1, 2, None)],
                               "user_id int, item_id int, rating double")
    first = spark.createDataFrame([(i, start[i].tolist()) for i in range(ITEMS)],
                                  "id int, features array<double>")
    got = als.fit_als(df, rank=RANK, iterations=3, reg=REG, start=first, per_salt=per_salt,
                      buckets=buckets)
    x, y = numpy_als(rows, start, 3)
    for found, want, seen in ((got.users, x, {r[0] for r in rows}), (got.items, y, {r[1] for r in rows})):
        found = {r["id"]: r["features"] for r in found.collect()}
        assert found.keys() == seen
        assert all(np.allclose(found[i], want[i], rtol=1e-8, atol=1e-9) for i in seen)


def test_residuals_of_a_half_step_and_sql(spark):
    rows = rating_rows(8)
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    got = als.fit_als(df, rank=2, iterations=2, reg=REG)
    # The items were solved last, from the users.
    left = als.residuals(df, got.items, got.users, "item_id", "user_id", "rating", 2, REG)
    assert left.agg(F.max("residual")).first()[0] < 1e-9
    df.createOrReplaceTempView("als_r")
    got.users.createOrReplaceTempView("als_x")
    got.items.createOrReplaceTempView("als_y")
    worst = spark.sql(f"""
        SELECT max(greatest(abs(s11 * y.features[0] + s12 * y.features[1] - t1),
                            abs(s12 * y.features[0] + s22 * y.features[1] - t2)))
        FROM (SELECT item_id, sum(features[0] * features[0]) + {REG} * count(*) AS s11,
                     sum(features[0] * features[1]) AS s12,
                     sum(features[1] * features[1]) + {REG} * count(*) AS s22,
                     sum(rating * features[0]) AS t1, sum(rating * features[1]) AS t2
              FROM als_r JOIN als_x ON id = user_id GROUP BY item_id) JOIN als_y y ON id = item_id""")
    assert worst.first()[0] < 1e-9


def test_hashed_start_and_cold_starts(spark):
    df = spark.createDataFrame(rating_rows(), "user_id int, item_id int, rating double")
    a = als.fit_als(df, rank=4, iterations=1, seed=5, buckets=2)
    b = als.fit_als(df.repartition(5), rank=4, iterations=1, seed=5, per_salt=7)
    for one, two in ((a.users, b.users), (a.items, b.items)):
        one, two = ({r["id"]: r["features"] for r in f.collect()} for f in (one, two))
        assert all(np.allclose(one[i], two[i], rtol=1e-7, atol=1e-8) for i in one)
    pairs = spark.createDataFrame([(0, 0), (0, 999), (999, 0)], "user_id int, item_id int")
    assert als.predict(a, pairs).count() == 1
    kept = als.predict(a, pairs, cold_start="null")
    assert kept.count() == 3 and kept.where("prediction IS NULL").count() == 2
    with pytest.raises(ValueError):
        als.predict(a, pairs, cold_start="nan")


def test_no_task_holds_a_hot_item(spark):
    rows = spark.range(3000).selectExpr("cast(id AS int) AS user", "0 AS item", "1.0D AS rating")
    salts = als._salts(rows, "item", 100)
    assert [tuple(r) for r in salts.collect()] == [(0, 30)]


def test_half_steps_move_sums_not_ratings(spark, tmp_path):
    """The ratings stay where they were placed: a half step shuffles the factors, by
    cell, and sums that were added up before."""
    rows = spark.range(4000).selectExpr("id % 40 AS user", "id % 30 AS item", "id % 7 + 0.5D AS rating",
                                        "id % 4 AS cell")
    placed = rows.localCheckpoint()
    fixed = als.hashed_start(spark.range(30), 2, 1)
    needed = placed.select("cell", "item").distinct()
    plan = als._half_step(placed, fixed, needed, "item", "user", 2, REG, 4)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and "hashpartitioning(id" in text and "salt" not in text


# --- search

def vectors(spark, values, first=0):
    return spark.createDataFrame([(first + i, [float(c) for c in v]) for i, v in enumerate(values)],
                                 "id long, features array<double>")


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_search_equals_all_pairs_and_prunes(spark, block):
    rng = np.random.default_rng(block)
    base = rng.normal(size=(300, 5)) * rng.lognormal(0, 1.5, size=(300, 1))
    asked = rng.normal(size=(60, 5))
    asked[7] = 0  # all products are 0: the smallest ids
    found = max_inner_products(vectors(spark, asked), vectors(spark, base, 1000), 4, block=block)
    got = {(r["query"], r["rank"]): (r["base"], r["score"]) for r in found.matches.collect()}
    products = asked @ base.T
    for q in range(60):
        order = sorted(range(300), key=lambda i: (-products[q, i], i))[:4]
        assert [got[q, k + 1][0] for k in range(4)] == [1000 + i for i in order]
        assert np.allclose([got[q, k + 1][1] for k in range(4)], products[q, order], atol=1e-12)
    assert len(got) == 240
    if block == 7:
        assert found.pruned_share() > 0.3


def test_search_ties_few_vectors_and_nulls(spark):
    base = vectors(spark, [[1, 0], [1, 0], [2, 0]])
    asked = vectors(spark, [[1, 1]]).union(spark.createDataFrame([(9, None)], "id long, features array<double>"))
    for block in (1, 2, 100):
        rows = sorted(map(tuple, max_inner_products(asked, base, 2, block=block).matches.collect()))
        assert rows == [(0, 1, 2, 2.0), (0, 2, 0, 1.0)]
    assert max_inner_products(asked, base, 5).matches.count() == 3
    assert max_inner_products(asked, base.where("id > 9"), 2).matches.count() == 0
    assert max_inner_products(asked.where("id > 9"), base, 2).matches.count() == 0


def test_search_with_one_long_vector_for_all(spark):
    """A vector that all queries want is one row of one block."""
    rng = np.random.default_rng(2)
    base = np.vstack([[100.0] * 4, rng.random((80, 4))])
    asked = rng.random((500, 4))
    found = max_inner_products(vectors(spark, asked), vectors(spark, base), 1, block=10)
    assert {r["base"] for r in found.matches.collect()} == {0}
    assert found.pruned_share() > 0.8


def test_search_keeps_k_of_a_block_of_copies(spark):
    """Equal vectors tie at the edge: a pair of blocks gives k rows a query, those
    with the smallest ids, in whatever order the block holds them."""
    from strata.operators import search

    asked = [(i, [1.0, 0.0]) for i in range(600)]
    base = [(i, [1.0, 2.0]) for i in reversed(range(50))] + [(99, [3.0, 0.0])]
    block = "array<struct<id: long, v: array<double>>>"
    pairs = spark.createDataFrame([(asked, base)], f"q {block}, b {block}")
    rows = search._products(pairs, 3, "bigint", "bigint").collect()
    assert len(rows) == 3 * 600
    assert {(r["base"], r["score"]) for r in rows} == {(99, 3.0), (0, 1.0), (1, 1.0)}
