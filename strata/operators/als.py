"""Alternating least squares by normal equations (M2, M3), safe with hot users and items.

With the factors of one side fixed, those of the other solve a small linear system
each: ``(sum of y y' + reg * n * I) x = sum of rating * y`` over its n ratings (the
weighted regularisation of MLlib's explicit ALS). The sums are Spark aggregates:

* The ratings are placed once, in a grid of cells: users and items are dealt to stripes
  by a hash, and a rating lies in the cell of its user's and its item's stripe, about
  ``CELL`` ratings a cell. A user or item with more than ``per_salt`` ratings adds
  depths to its cells, by a hash of the other side, so that no task holds its ratings.
* A half step sends every fixed factor to the cells of its stripe that need it, adds up
  the outer products of each solved id within its cells, sends these sums (not the
  ratings) to the id, and solves all systems of an Arrow batch at once. What moves is a
  row per id and cell, at most one per rating and the fewer the fuller the cells.

The factors of every half step are stored in the run's scratch folder, and the ones
before them removed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import workers_can_import
from strata.sources.scratch import RunScratch

PER_SALT = 100_000
CELL = 1_000_000  # ratings of a cell, about


@contextmanager
def _one_key(spark: SparkSession) -> Iterator[None]:
    """Joins on (cell, id) take a placement by cell as it is."""
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@dataclass
class Factors:
    users: DataFrame  # id, features
    items: DataFrame  # id, features
    rank: int
    path: str         # the folder that holds both


def hashed_start(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """(id, features): a start between 0 and 1 that depends on the id only, whatever
    the partitioning, scaled to length 1."""
    draws = F.transform(F.sequence(F.lit(1), F.lit(rank)), lambda j: (
        F.pmod(F.xxhash64(F.lit(seed), F.col("id"), j), F.lit(1 << 20)) + 1) / F.lit(1 << 20))
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, c: s + c * c))
    return ids.select("id", draws.alias("features")).select(
        "id", F.transform("features", lambda c: c / length).alias("features"))


def _sums(rank: int) -> list[Column]:
    """The lower triangle of ``sum y y'``, then ``sum rating * y``, then the count."""
    y = [F.col("y")[i] for i in range(rank)]
    outer = [F.sum(y[i] * y[j]) for i in range(rank) for j in range(i + 1)]
    return [*outer, *[F.sum(F.col("rating") * c) for c in y], F.count(F.lit(1)).cast("double")]


def normal_equations(seen: DataFrame, rank: int) -> DataFrame:
    """(id, s): the sums of every id's system, from rows (id, rating, y); added up
    where the rows are, before they move."""
    names = [f"s{i}" for i in range(rank * (rank + 1) // 2 + rank + 1)]
    whole = seen.groupBy("id").agg(*[s.alias(n) for s, n in zip(_sums(rank), names, strict=True)])
    return whole.select("id", F.array(*names).alias("s"))


def solve(equations: DataFrame, rank: int, reg: float) -> DataFrame:
    """(id, features): the solution of every id's system."""
    workers_can_import(equations.sparkSession)
    lower = np.tril_indices(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            s = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            a = np.zeros((len(s), rank, rank))
            a[:, lower[0], lower[1]] = s[:, :len(lower[0])]
            a[:, lower[1], lower[0]] = s[:, :len(lower[0])]
            a += reg * s[:, -1, None, None] * np.eye(rank)
            x = np.linalg.solve(a, s[:, len(lower[0]):-1, None])[:, :, 0]
            cuts = pa.array(np.arange(0, x.size + 1, rank, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(cuts, pa.array(x.ravel()))],
                names=["id", "features"])

    id_type = equations.schema["id"].dataType.simpleString()
    return equations.mapInArrow(run, f"id {id_type}, features array<double>")


def _salts(ratings: DataFrame, side: str, per_salt: int) -> DataFrame:
    """(side, salts) of the ids with more than ``per_salt`` ratings: fewer than
    ratings / per_salt rows."""
    return (ratings.groupBy(side).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > per_salt)
            .select(side, F.ceil(F.col("_n") / per_salt).cast("int").alias(f"{side}_salts")))


def _half_step(placed: DataFrame, fixed: DataFrame, needed: DataFrame, by: str, to: str, rank: int,
               reg: float, cells: int) -> DataFrame:
    """Factors of the side ``to`` from the ratings placed in cells; ``needed`` tells in
    which cells the ids of the side ``by`` have ratings."""
    copies = (needed.join(fixed.select(F.col("id").alias(by), F.col("features").alias("y")), by)
              .repartition(cells, "cell"))
    # Both sides lie by cell: the ids of a cell meet where its ratings are.
    seen = placed.join(copies.hint("shuffle_hash"), ["cell", by]).select(
        F.col(to).alias("id"), "rating", "y")
    return solve(normal_equations(seen, rank), rank, reg)


def fit_als(ratings: DataFrame, user: str = "user_id", item: str = "item_id",
            rating: str = "rating", rank: int = 10, iterations: int = 5, reg: float = 0.01,
            seed: int = 42, start: DataFrame | None = None, per_salt: int = PER_SALT,
            buckets: int | None = None) -> Factors:
    """Explicit-feedback ALS: ``iterations`` times the users' factors from the
    items', then the items' from the users'. ``start`` (id, features) may give the
    items' first factors. Ids of any type; rows with a NULL are left out; several
    ratings of a pair count each."""
    if iterations < 1:
        raise ValueError("at least one iteration")
    spark = ratings.sparkSession
    with RunScratch(spark, "als") as run:
        rows = ratings.select(F.col(user).alias("user"), F.col(item).alias("item"),
                              F.col(rating).cast("double").alias("rating")).dropna()
        rows = run.store(rows, "ratings")
        cells = buckets or max(1, -(-rows.count() // CELL))
        stripes = max(1, math.isqrt(cells))
        # Fewer hot ids than rows / per_salt: small enough for every task.
        salts = {side: F.broadcast(run.store(_salts(rows, side, per_salt), f"{side}-salts"))
                 for side in ("user", "item")}
        cell = [F.pmod(F.xxhash64(side), F.lit(stripes if side == "user" else -(-cells // stripes)))
                for side in ("user", "item")]
        for side, other in (("user", "item"), ("item", "user")):
            rows = rows.join(salts[side], side, "left")
            cell.append(F.pmod(F.xxhash64(F.lit(1), other), F.coalesce(f"{side}_salts", F.lit(1))))
        rows = rows.select("user", "item", "rating", F.xxhash64(*cell).alias("cell"))
        with _one_key(spark):
            placed = run.place(rows, "by-cell", cells, ["cell"])
            run.drop("ratings")
            needed = {side: run.store(placed.select("cell", side).distinct(), f"{side}-cells")
                      for side in ("user", "item")}
            if start is None:
                start = hashed_start(needed["item"].select(F.col("item").alias("id")).distinct(),
                                     rank, seed)
            items = start.select("id", "features")
            for i in range(iterations):
                users = run.store(_half_step(placed, items, needed["item"], "item", "user",
                                             rank, reg, cells), f"users-{i}")
                run.drop(f"users-{i - 1}")
                items = run.store(_half_step(placed, users, needed["user"], "user", "item",
                                             rank, reg, cells), f"items-{i}")
                run.drop(f"items-{i - 1}")
        run.keep(f"users-{iterations - 1}")
        run.keep(f"items-{iterations - 1}")
        return Factors(users, items, rank, run.root)


def predict(factors: Factors, pairs: DataFrame, user: str = "user_id", item: str = "item_id",
            cold_start: str = "drop") -> DataFrame:
    """``pairs`` with ``prediction``. A pair with an unseen side has none: ``drop``
    leaves it out (M3), ``null`` keeps it."""
    if cold_start not in ("drop", "null"):
        raise ValueError("cold_start must be 'drop' or 'null'")
    how = "inner" if cold_start == "drop" else "left"
    x = factors.users.select(F.col("id").alias(user), F.col("features").alias("_x"))
    y = factors.items.select(F.col("id").alias(item), F.col("features").alias("_y"))
    dot = F.aggregate(F.zip_with("_x", "_y", lambda a, b: a * b), F.lit(0.0), lambda s, c: s + c)
    return (pairs.join(x, user, how).join(y, item, how)
            .withColumn("prediction", dot).drop("_x", "_y"))


def residuals(ratings: DataFrame, solved: DataFrame, fixed: DataFrame, to: str, by: str,
              rating: str, rank: int, reg: float) -> DataFrame:
    """(id, residual): the largest entry of ``A x - b`` of every solved id's system,
    to check a half step."""
    seen = (ratings.select(F.col(to).alias("id"), F.col(by).alias("_by"),
                           F.col(rating).cast("double").alias("rating"))
            .join(fixed.select(F.col("id").alias("_by"), F.col("features").alias("y")), "_by"))
    joined = normal_equations(seen, rank).join(solved, "id")
    size = rank * (rank + 1) // 2

    def entry(i: int) -> Column:
        cell = [F.col("s")[max(i, j) * (max(i, j) + 1) // 2 + min(i, j)] for j in range(rank)]
        ax = sum((cell[j] * F.col("features")[j] for j in range(rank)), F.lit(0.0))
        return F.abs(ax + reg * F.col("s")[size + rank] * F.col("features")[i] - F.col("s")[size + i])

    return joined.select("id", F.greatest(F.lit(0.0), *[entry(i) for i in range(rank)])
                         .alias("residual"))
