"""Recommendations with ALS and their evaluation.

MLlib's ALS is itself a distributed Spark job (blocked factors, shuffles per
iteration). What this module adds is determinism and checks: a hash split
that does not move with partitioning, seeds as arguments, 32-bit id checks,
RMSE as a DataFrame, and top-k in either direction.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.search import max_inner_products

INT_MAX = 2**31 - 1


def hash_split(df: DataFrame, cols: list[str], train_percent: int = 80,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train/test split by a hash of ``cols``: the same rows land on the same
    side whatever the partitioning, unlike ``randomSplit``."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(100))
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def int_ids(df: DataFrame, cols: list[str]) -> DataFrame:
    """ALS needs 32-bit ids; the ANSI cast raises on an id out of range."""
    return df.select(*[F.col(c).cast("int").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def fit_recommender(train: DataFrame, user: str, item: str, rating: str, max_iter: int = 5,
                    reg_param: float = 0.01, rank: int = 10, seed: int = 42,
                    cold_start: str = "drop") -> ALSModel:
    """Explicit-feedback ALS with the reference's settings by default."""
    als = ALS(maxIter=max_iter, regParam=reg_param, rank=rank, seed=seed, userCol=user,
              itemCol=item, ratingCol=rating, coldStartStrategy=cold_start)
    return als.fit(int_ids(train, [user, item]))


def rmse(model: ALSModel, test: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """One row: root-mean-square error on ``test``; with cold-start drop,
    rows of unseen users or items are left out (A13)."""
    return rmse_of(model.transform(int_ids(test, [user, item])), rating)


def rmse_of(predicted: DataFrame, rating: str, prediction: str = "prediction") -> DataFrame:
    """One row: error of any predictions (M4, A13), and how many rows have one."""
    return predicted.agg(
        F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(rating), 2))).alias("rmse"),
        F.count(prediction).alias("n_scored"))


def modulo_split(df: DataFrame, col: str, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Train/test split any engine can compute (M1): every ``folds``-th number
    of ``col`` is for the test."""
    test = F.pmod(F.col(col), F.lit(folds)) == 0
    return df.where(~test), df.where(test)


def item_mean_predictions(train: DataFrame, test: DataFrame, item: str, rating: str
                          ) -> DataFrame:
    """A deterministic predictor: the item's mean rating; rows of unseen items
    drop out, as cold starts do (M3)."""
    means = train.groupBy(item).agg(F.avg(rating).alias("prediction"))
    return test.join(means, item, "inner")


def top_k_users(scores: DataFrame, items: DataFrame, item: str, user: str, score: str, k: int
                ) -> DataFrame:
    """Top ``k`` users per eligible item of a score table (M6), ties by user;
    ``max_by``-like partial work: Spark limits each partition's groups before
    the shuffle."""
    rank = Window.partitionBy(item).orderBy(F.col(score).desc(), F.col(user))
    return (scores.join(items.select(item), item, "left_semi")
            .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k))


def eligible_items(ratings: DataFrame, item: str, rating: str, min_count: int) -> DataFrame:
    """Items with more than ``min_count`` ratings (M5)."""
    return (ratings.groupBy(item).agg(F.count(rating).alias("_n"))
            .where(F.col("_n") > min_count).select(item))


def top_users_by_factors(users: DataFrame, items: DataFrame, wanted: DataFrame, k: int, item: str,
                         user: str) -> DataFrame:
    """``(item, rank, user, score)``: the ``k`` users with the largest inner product of
    factors (id, features) for every item of ``wanted``; items without factors drop
    out. The exact search skips what its norm bounds rule out (M6)."""
    asked = items.join(wanted.select(F.col(item).alias("id")), "id", "left_semi")
    found = max_inner_products(asked, users, k)
    return found.matches.select(F.col("query").alias(item), "rank", F.col("base").alias(user), "score")


def recommend_users_for_items(model: ALSModel, items: DataFrame, k: int, item: str) -> DataFrame:
    """Top ``k`` users per item of ``items``: ``(item, recommendations)`` (M6), with
    MLlib's factors and our search instead of MLlib's scoring of all pairs."""
    wanted = int_ids(items.select(item), [item])
    top = top_users_by_factors(model.userFactors, model.itemFactors, wanted, k, item, "user_id")
    best = F.sort_array(F.collect_list(F.struct("rank", "user_id", F.col("score").cast("float")
                                                .alias("rating"))))
    return top.groupBy(item).agg(best.alias("_best")).select(item, F.transform(
        "_best", lambda r: F.struct(r["user_id"].alias("user_id"), r["rating"].alias("rating")))
        .alias("recommendations"))


def recommend_items_for_users(model: ALSModel, users: DataFrame, k: int, user: str) -> DataFrame:
    """Top ``k`` items per user of ``users`` (the other direction, Q18)."""
    return model.recommendForUserSubset(int_ids(users.select(user), [user]), k)


def titled(recs: DataFrame, titles: DataFrame, item: str, title: str = "title") -> DataFrame:
    """Titles on the recommendations (M7)."""
    t = int_ids(titles.select(item, title), [item])
    return recs.join(t, item, "inner").select(item, title, "recommendations")
