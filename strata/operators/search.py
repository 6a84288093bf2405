"""Exact maximum inner products (M6): the best ``k`` base vectors of every query vector.

Base vectors are sorted by length, longest first, and cut into blocks; query vectors
into blocks as well. All work is on pairs of blocks, one row each, so a hot vector,
query or block is one row among many:

1. every query block meets the first base block, which holds the longest vectors, and
   gets a first ``k``-th best product per query;
2. a base block can only matter to a query if ``|q| * (its longest vector)`` reaches
   that product (Cauchy-Schwarz). Lengths fall from block to block, so a query's
   blocks are the first few: queries are sorted by how far they reach and cut
   into blocks again, which meet only the base blocks within reach;
3. the candidates of a query from its blocks are cut to ``k`` in each task, then in all.

The bound only ever skips blocks without a better vector: results equal those of all
pairs. ``pruned_share`` tells how many block pairs were skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import workers_can_import
from strata.sources.scratch import RunScratch

BLOCK = 2048  # vectors of a block
PAIRS = 64    # pairs of a block that one task meets
SLICE = 256   # queries of a block that a task scores at a time
BATCH = 4     # pairs of blocks that a Python worker holds at a time
SLACK = 1e-9  # relative and absolute


@dataclass
class Search:
    matches: DataFrame       # query id, rank, base id, score
    pairs: DataFrame         # query_block, base_block: the pairs that met in step 2
    query_blocks: int
    base_blocks: int

    def pruned_share(self) -> float:
        """Share of the block pairs that the bound skipped."""
        every = self.query_blocks * self.base_blocks
        return 1 - self.pairs.count() / every if every else 0.0


def _numbered(run: RunScratch, df: DataFrame, order: list[Column], size: int, name: str
              ) -> DataFrame:
    """``df`` with ``block``: every ``size`` rows in ``order``. Rows are sorted by range
    over all tasks and numbered within the ranges; a range's first number is the
    sum of the counts before it (one row per range), so no task sees all rows."""
    spread = run.store(df.orderBy(*order).withColumn("_part", F.spark_partition_id())
                       .withColumn("_at", F.monotonically_increasing_id()), name)
    counts = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0))
                           .alias("_before"))
    return (spread.join(starts, "_part")  # a range's rows are numbered without gaps
            .withColumn("block", ((F.col("_at") - F.col("_from") + F.col("_before")) / size)
                        .cast("long")).drop("_part", "_at", "_from", "_before"))


def _blocks(run: RunScratch, vectors: DataFrame, name: str) -> DataFrame:
    """One row per block: its vectors with ids, their longest length, least reach."""
    return run.store(vectors.groupBy("block").agg(
        F.max("length").alias("longest"), F.min("reach").alias("least"),
        F.collect_list(F.struct("id", "v")).alias("of")), name)


def _attached(pairs: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """``pairs`` with the block of ``key``. The first base block is in nearly all
    pairs: a block's pairs are salted, ``PAIRS`` a salt, and the block copied per salt."""
    often = (pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
             .select(key, F.ceil(F.col("_n") / PAIRS).cast("int").alias("_salts")))
    other = "query_block" if key == "base_block" else "base_block"
    salted = pairs.join(often, key).withColumn("_salt", F.pmod(F.xxhash64(other), F.col("_salts"))
                                               .cast("int")).drop("_salts")
    copies = blocks.join(often, key).withColumn("_salt", F.explode(F.sequence(
        F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def _unit(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    return (vectors.where(F.col(vector_col).isNotNull())
            .select(F.col(id_col).alias("id"), v.alias("v"))
            .withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)))
            .withColumn("reach", F.lit(0.0)))


def _products(pairs: DataFrame, k: int, id_type: str, base_type: str) -> DataFrame:
    """The best ``k`` of each pair of blocks (``q``, ``b``) per query."""
    workers_can_import(pairs.sparkSession)

    def parts(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        rows = column.values
        flat = rows.field("v").flatten().to_numpy(zero_copy_only=False)
        return rows.field("id"), flat.reshape(len(rows), -1) if len(rows) else np.zeros((0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queries, x = parts(batch.column(0)[i])
                base, y = parts(batch.column(1)[i])
                if x.shape[1] != y.shape[1]:
                    raise ValueError("the vectors differ in length")
                m = min(k, len(base))
                ids = base.take(pc.array_sort_indices(base))
                y = y[pc.array_sort_indices(base).to_numpy()]
                rows, cols, scores = [], [], []
                for at in range(0, len(x), SLICE):
                    score = x[at:at + SLICE] @ y.T
                    edge = np.partition(score, -m, axis=1)[:, -m, None]
                    above, ties = score > edge, score == edge
                    # of ties at the edge the smallest ids, as many as there is room for
                    room = m - above.sum(1, keepdims=True)
                    row, col = np.nonzero(above | (ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= room)))
                    rows.append(row + at)
                    cols.append(col)
                    scores.append(score[row, col])
                row, col = np.concatenate(rows), np.concatenate(cols)
                yield pa.RecordBatch.from_arrays(
                    [queries.take(pa.array(row)), ids.take(pa.array(col)),
                     pa.array(np.concatenate(scores))], names=["query", "base", "score"])

    return pairs.select("q", "b").mapInArrow(
        run, f"query {id_type}, base {base_type}, score double")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """A row is a pair of blocks: few go to a Python worker at a time, however many
    pairs a task meets."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every query, ties by id; Spark limits each task's groups first."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("base"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def max_inner_products(queries: DataFrame, base: DataFrame, k: int, id_col: str = "id",
                       vector_col: str = "features", base_id: str | None = None,
                       base_vector: str | None = None, block: int = BLOCK) -> Search:
    """The ``k`` base vectors with the largest inner product with every query
    vector: ``matches(query, rank, base, score)``, ties by base id. Ids are unique on
    either side; null vectors are left out, and fewer than ``k`` base vectors give
    fewer matches."""
    base_id, base_vector = base_id or id_col, base_vector or vector_col
    types = (queries.schema[id_col].dataType.simpleString(),
             base.schema[base_id].dataType.simpleString())
    longest_first = [F.col("length").desc(), F.col("id")]
    spark = queries.sparkSession
    with RunScratch(spark, "search") as run:
        b = _blocks(run, _numbered(run, _unit(base, base_id, base_vector), longest_first, block,
                                   "base"), "base-blocks")
        b = b.select(F.col("block").alias("base_block"), "longest", F.col("of").alias("b"))
        asked = _numbered(run, _unit(queries, id_col, vector_col), longest_first, block, "queries")
        # 1. the longest base vectors (one block): a first k-th best product per query
        first = F.broadcast(b.where(F.col("base_block") == 0))
        start = _blocks(run, asked, "query-blocks").select(
            F.lit(0).cast("long").alias("base_block"), F.col("of").alias("q"))
        with _small_batches(spark):
            seen = run.store(_best(_products(start.join(first, "base_block"), k, *types), k)
                             .select("query", "score", "rank"), "seen")
        known = (seen.groupBy("query").agg(F.min("score").alias("edge"), F.max("rank").alias("n"))
                 .where(F.col("n") >= k).select(F.col("query").alias("id"), "edge"))
        # 2. how short a base vector may be to matter still: edge / |q|
        reach = F.when(F.col("length") > 0, F.col("edge") / F.col("length"))
        asked = (asked.drop("block", "reach").join(known, "id", "left")
                 .withColumn("reach", F.coalesce(reach, F.lit(float("-inf")))).drop("edge"))
        q = _blocks(run, _numbered(run, asked, [F.col("reach").desc(), F.col("id")], block,
                                   "reach"), "reach-blocks")
        q = q.select(F.col("block").alias("query_block"), "least", F.col("of").alias("q"))
        # Lengths carry rounding: a block a hair below the bound still meets. The
        # bounds are one number per base block, a scalar subquery.
        bounds = b.select(F.sort_array(F.collect_list(F.struct("base_block", "longest")))).scalar()
        near = F.transform(F.filter("_tops", lambda t: (
            t["longest"] * (1 + SLACK) + SLACK >= F.col("least"))), lambda t: t["base_block"])
        pairs = run.store(q.select("query_block", "least", bounds.alias("_tops"))
                          .select("query_block", F.explode(near).alias("base_block")), "pairs")
        # 3. only the pairs within reach carry vectors
        met = _attached(pairs, q.select("query_block", "q"), "query_block")
        met = _attached(met, b.select("base_block", "b"), "base_block")
        with _small_batches(spark):
            matches = run.store(_best(_products(met, k, *types), k)
                                .select("query", "rank", "base", "score"), "matches")
        run.keep("pairs")
        run.keep("matches")
        return Search(matches, pairs, q.count(), b.count())
