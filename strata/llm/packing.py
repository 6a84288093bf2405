"""Best-fit packing by a grouping genetic algorithm.

Documents become token pieces; a piece that fills a sequence is one by itself.
All other pieces are dealt by hash into cells of about ``CELL_PIECES`` pieces.
Every cell is worked on by ``ISLANDS`` islands: each starts from best-fit
solutions in different orders and breeds by grouping crossover, which injects
whole well-filled bins of one parent into the other, removes the bins that now
hold duplicates and best-fits their displaced pieces. Between rounds every
island sends its elite to the next one; a cell's best solution is its result.

What fills its bins well is final. The other bins, a few of each cell, are opened
again: their pieces are dealt anew into fewer cells, and so on until one cell is left,
which searches longest. So cells cost no sequences: at the end one bin or so is open,
as in a single packing of all pieces. Where lengths leave most bins open however they
are dealt (few small pieces), a cell's solution is as good as any larger one's, and stays.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import workers_can_import

from .common import map_batches, slices, stored, utf8
from .token_counts import compiled, texts_of

SEQUENCE = 2048
#: Id that ends every document.
SEPARATOR = 0
CELL_PIECES = 4096
ISLANDS, ROUNDS, POPULATION, CHILDREN = 2, 2, 3, 3
#: Children of the last cell, where the lower bound is still open.
LAST_CHILDREN = 40
#: Bins as full as this are final and the pieces of all others are dealt again: the
#: strictest share that leaves at most ``AGAIN`` of the pieces dealt, if any does.
FINAL, AGAIN = (1.0, 0.9995, 0.999, 0.99), 0.5
#: Islands per task, and tasks at most (then each works on more islands).
TASK_CELLS, MAX_TASKS = 4, 50_000
#: Bins that crossover may inject are at least this full.
WELL_FILLED = 0.97


def token_pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's token ids and the separator, cut where they exceed
    ``sequence``: ``id_col``, piece, start, length, ids_crc32. All pieces of a
    cut document but the first have ``sequence`` tokens."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = compiled(tokenizer_path)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            out: list[tuple[int, int, int, int, int]] = []
            for a, b in slices(offsets):
                ids, bounds = table.encode(texts_of(data, offsets[a:b + 1]))
                for row, (x, y) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), a):
                    own = np.append(ids[x:y], np.uint32(SEPARATOR)).astype("<u4")
                    first = len(own) % sequence or sequence
                    cuts = [0, *range(first, len(own) + 1, sequence)]
                    out.extend((row, k, p, q - p, zlib.crc32(own[p:q]))
                               for k, (p, q) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)))
            cols = np.array(out, dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[:, 0])),
                 pa.array(cols[:, 1].astype(np.int32)), *(pa.array(cols[:, i]) for i in (2, 3, 4))],
                names=schema.names)

    return map_batches(docs.select(id_col, text_col), run, schema)


# --- the genetic algorithm on one cell --------------------------------------

def best_fit(sizes: np.ndarray, order: np.ndarray, assigned: np.ndarray, free: list[int],
             capacity: int) -> None:
    """Put the pieces of ``order`` each into the fullest bin with room, opening
    bins where none has; updates ``assigned`` and ``free``."""
    rooms = sorted((f, b) for b, f in enumerate(free) if f)
    for i in order:
        size = int(sizes[i])
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        assigned[i] = b
        free[b] = room - size
        if free[b]:
            insort(rooms, (free[b], b))


def fitness(sizes: np.ndarray, assigned: np.ndarray, capacity: int) -> float:
    """Fewer bins first; of as many, uneven fill is better."""
    fill = np.bincount(assigned, sizes) / capacity
    return -len(fill) + float((fill ** 2).sum()) / (len(fill) + 1)


def crossover(sizes: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int,
              rng: np.random.Generator) -> np.ndarray:
    """A child: random well-filled bins of ``giver``, the bins of ``taker`` that
    share no piece with them, and the displaced pieces by best fit."""
    fill = np.bincount(giver, sizes) / capacity
    well = fill >= WELL_FILLED
    inject = well & (rng.random(len(fill)) < 0.5)
    given = inject[giver]
    hit = np.zeros(int(taker.max()) + 1, dtype=bool)
    hit[taker[given]] = True
    stays = ~given & ~hit[taker]
    child = np.full(len(sizes), -1, dtype=np.int64)
    renumber = np.cumsum(inject) - 1
    child[given] = renumber[giver[given]]
    kept = np.cumsum(~hit) - 1 + int(inject.sum())
    child[stays] = kept[taker[stays]]
    placed = child >= 0
    bins = int(inject.sum()) + int((~hit).sum())
    free = (capacity - np.bincount(child[placed], sizes[placed], bins)).astype(int).tolist()
    loose = np.flatnonzero(~placed)
    # Pieces keep their descending order but for a little noise, so that children differ.
    noise = sizes[loose] * (1 + 0.02 * rng.standard_normal(len(loose)))
    best_fit(sizes, loose[np.argsort(-noise, kind="stable")], child, free, capacity)
    return np.unique(child, return_inverse=True)[1]


def evolve(sizes: np.ndarray, elites: list[np.ndarray], capacity: int, seed: int,
           children: int = CHILDREN) -> list[np.ndarray]:
    """One island's round: from the elites (own and migrated) and fresh best-fit
    solutions to its best solutions, best first."""
    rng = np.random.default_rng(seed)
    pool = list(elites)
    while len(pool) < POPULATION:
        spread = 0.0 if not pool and seed % ISLANDS == 0 else 0.1
        noise = sizes * (1 + spread * rng.standard_normal(len(sizes)))
        fresh, free = np.full(len(sizes), -1, dtype=np.int64), []
        best_fit(sizes, np.argsort(-noise, kind="stable"), fresh, free, capacity)
        pool.append(fresh)
    pool = sorted(pool, key=lambda s: -fitness(sizes, s, capacity))
    lower = -(-int(sizes.sum()) // capacity)
    for _ in range(children):
        if int(pool[0].max()) + 1 <= lower:
            break
        a, b = rng.choice(len(pool), 2, replace=False) if len(pool) > 1 else (0, 0)
        pool.append(crossover(sizes, pool[a], pool[b], capacity, rng))
        pool = sorted(pool, key=lambda s: -fitness(sizes, s, capacity))[:POPULATION]
    return pool


def _island_round(capacity: int, number: int, children: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            best, score = [], []
            for cell, island, sizes, elites in zip(
                    frame["cell"], frame["island"], frame["sizes"], frame["elites"], strict=True):
                sizes = np.asarray(sizes, dtype=np.int64)
                seed = (int(cell) * ROUNDS + number) * ISLANDS + int(island)
                pool = evolve(sizes, [np.asarray(e, dtype=np.int64) for e in elites],
                              capacity, seed, children)
                best.append(pool[0].tolist())
                score.append(fitness(sizes, pool[0], capacity))
            yield frame[["cell", "island", "sizes"]].assign(best=best, score=score)
    return run


def _pack_cells(part: DataFrame, columns: list[str], cells: int, sequence: int, deal: int
                ) -> DataFrame:
    """``part`` dealt into ``cells`` and packed there: ``columns``, sequence_id, offset,
    and fill, the tokens of the whole sequence."""
    workers_can_import(part.sparkSession)
    item = F.struct(F.col("length").alias("length"), *[c for c in columns if c != "length"])
    by_cell = (part.withColumn("cell", F.pmod(F.xxhash64(F.lit(deal), *columns,
                                                         F.monotonically_increasing_id()),
                                              F.lit(cells)))
               .groupBy("cell").agg(F.sort_array(F.collect_list(item), False).alias("items")))
    by_cell = stored(by_cell, "packing-cells")
    islands = by_cell.select(
        "cell", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        F.col("items.length").alias("sizes"),
        F.array().cast("array<array<bigint>>").alias("elites"))
    state = "cell long, island int, sizes array<bigint>, best array<bigint>, score double"
    for number in range(ROUNDS):
        if number:  # migration: own elite and that of the island before
            met = islands.groupBy("cell").agg(
                F.first("sizes").alias("sizes"),
                F.map_from_entries(F.collect_list(F.struct("island", "best"))).alias("by_island"))
            islands = met.select(
                "cell", F.explode(F.map_keys("by_island")).alias("island"), "sizes", "by_island")
            islands = islands.select(
                "cell", "island", "sizes",
                F.array(F.col("by_island")[F.col("island")],
                        F.col("by_island")[F.pmod(F.col("island") + ISLANDS - 1, F.lit(ISLANDS))])
                .alias("elites"))
        # An explicit count, as AQE would put these small rows of long work into one task.
        islands = (islands.repartition(max(1, min(cells * ISLANDS // TASK_CELLS, MAX_TASKS)),
                                       "cell", "island")
                   .mapInPandas(_island_round(sequence, number,
                                              CHILDREN if cells > 1 else LAST_CHILDREN), state))
    winner = islands.groupBy("cell").agg(
        F.max_by("best", F.struct("score", "island")).alias("best"))
    joined = by_cell.join(winner, "cell")
    placed = joined.select(
        "cell", F.posexplode(F.arrays_zip("items", F.col("best").alias("bin")))
        .alias("place", "z")).select("cell", "place", "z.items.*", F.col("z.bin").alias("bin"))
    sequence_id = (F.shiftleft(F.lit(deal).cast("long"), 58)
                   + F.shiftleft(F.col("cell").cast("long"), 20) + F.col("bin"))
    of_bin = W.partitionBy("cell", "bin")
    before = of_bin.orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return placed.select(*columns, sequence_id.alias("sequence_id"),
                         F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
                         F.sum("length").over(of_bin).alias("fill"))


def pack(pieces: DataFrame, sequence: int = SEQUENCE, cell_pieces: int = CELL_PIECES,
         id_col: str = "doc_id") -> DataFrame:
    """``pieces`` (stored) with sequence_id and offset: every sequence holds at
    most ``sequence`` tokens and its offsets are gapless from 0."""
    columns = pieces.columns
    done = pieces.filter(F.col("length") >= sequence).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    part = pieces.filter(F.col("length") < sequence)
    count, deal = part.count(), 0
    while count:
        cells = max(1, round(count / cell_pieces))
        placed = stored(_pack_cells(part, columns, cells, sequence, deal), "packing-placed")
        left = placed.agg(*[F.count_if(F.col("fill") < share * sequence) for share in FINAL]).first()
        known = [(share, n) for share, n in zip(FINAL, left, strict=True) if n <= AGAIN * count]
        if cells == 1 or not known:
            return done.unionByName(placed.drop("fill"))
        final, count = F.col("fill") >= known[0][0] * sequence, known[0][1]
        done = done.unionByName(placed.filter(final).drop("fill"))
        part, deal = placed.filter(~final).select(*columns), deal + 1
    return done


def pack_documents(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document row: ``id_col``, piece, start, length,
    ids_crc32, sequence_id, offset.

    Null text counts as empty: one piece that holds the separator. Repeated rows
    and null ids are packed like any other row; ties between solutions fall to
    the island with the larger number. Other columns are ignored; an empty table
    gives an empty result.
    """
    pieces = stored(token_pieces(docs, tokenizer_path, sequence, id_col, text_col),
                    "packing-pieces")
    return pack(pieces, sequence, id_col=id_col)
