"""Benchmark decontamination with suffix arrays of the training texts.

The documents are cut into shards of bounded size. Each task builds the word
suffix array of its shard and binary-searches every suffix of the benchmark
items in it, narrowing a range of the array word by word; the documents are
never shuffled. Benchmark items are sent to the tasks in blocks of bounded
size, so a benchmark of any size passes through in several rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, slices, text_of, utf8, word_bytes, words

WINDOW = 13
#: Bytes of benchmark text that are sent to the tasks at once.
BLOCK_BYTES = 8 << 20
ALNUM = word_bytes("alnum")
#: Slots of the table that tells which word pairs can begin a match.
PAIR_SLOTS = 1 << 22


class Block:
    """The windows (item suffixes cut to the window) of some benchmark items."""

    def __init__(self, ids: list, texts: pa.Array, window: int) -> None:
        data, offsets = utf8(texts)
        self.words, bounds = words(data, offsets, ALNUM)
        self.ids, self.window = ids, window
        starts, lengths, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], \
            [np.zeros(0, np.int64)]
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if b > a:
                n = max(1, b - a - window + 1)
                starts.append(np.arange(a, a + n))
                lengths.append(np.full(n, min(window, b - a)))
                items.append(np.full(n, i))
        self.starts, self.lengths = np.concatenate(starts), np.concatenate(lengths)
        self.items = np.concatenate(items)
        self.pairs = np.zeros(PAIR_SLOTS, dtype=bool)
        single = self.lengths == 1
        self.singles = np.unique(self.words[self.starts[single]])
        at = self.starts[~single]
        self.pairs[_pair(self.words[at], self.words[at + 1])] = True


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * np.uint64(3) + b) >> np.uint64(20)).astype(np.int64) & (PAIR_SLOTS - 1)


def suffix_array(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` sorted by the ``depth`` words from there on (``text`` is padded
    by ``depth`` words). Only suffixes still tied are sorted further."""
    order = starts[np.argsort(text[starts], kind="stable")]
    first = text[order]
    fresh = np.ones(len(order), dtype=bool)  # where a run of equal suffixes begins
    fresh[1:] = first[1:] != first[:-1]
    for d in range(1, depth):
        run = np.cumsum(fresh)
        tied = np.flatnonzero(~fresh | np.append(~fresh[1:], False))
        if not len(tied):
            break
        key = text[order[tied] + d]
        perm = np.lexsort((key, run[tied]))
        order[tied] = order[tied][perm]
        key, group = key[perm], run[tied]
        fresh[tied[1:]] |= (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    return order


def search(text: np.ndarray, array: np.ndarray, query: np.ndarray, starts: np.ndarray,
           lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every query suffix the range of ``array`` whose suffixes begin with
    its ``lengths`` words: binary search inside the range of the words before."""
    lo = np.zeros(len(starts), dtype=np.int64)
    hi = np.full(len(starts), len(array), dtype=np.int64)
    live = np.flatnonzero(lengths > 0)
    for d in range(int(lengths.max(initial=0))):
        live = live[(lo[live] < hi[live]) & (lengths[live] > d)]
        if not len(live):
            break
        want = query[starts[live] + d]
        bounds = []
        for right in (False, True):
            a, b = lo[live].copy(), hi[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                seen = text[array[np.minimum(mid, len(array) - 1)] + d]
                below = open_ & ((seen <= want) if right else (seen < want))
                a = np.where(below, mid + 1, a)
                b = np.where(open_ & ~below, mid, b)
            bounds.append(a)
        lo[live], hi[live] = bounds
    return lo, np.maximum(lo, hi)


def shard_matches(data: np.ndarray, offsets: np.ndarray, block: Block
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the shard's documents: word bounds, and per occurrence of a window the
    document word, the item word and the window's number."""
    text, bounds = words(data, offsets, ALNUM)
    none = np.zeros(0, np.int64)
    if not len(text) or not len(block.starts):
        return bounds, none, none, none
    pad = np.concatenate([text, np.zeros(block.window, np.uint64)])
    able = block.pairs[_pair(pad[:-1], pad[1:])][:len(text)]
    if len(block.singles):
        able |= np.isin(text, block.singles)
    array = suffix_array(pad, np.flatnonzero(able), block.window)
    if not len(array):
        return bounds, none, none, none
    lo, hi = search(pad, array, block.words, block.starts, block.lengths)
    n = hi - lo
    window = np.repeat(np.arange(len(n)), n)
    at = array[np.repeat(hi - np.cumsum(n), n) + np.arange(int(n.sum()))] if n.sum() else none
    # A window that runs past its document's end, or into the padding, is none.
    end = bounds[np.searchsorted(bounds, at, side="right")] if len(at) else none
    whole = at + block.lengths[window] <= end
    at, window = at[whole], window[whole]
    return bounds, at, block.starts[window], window


MATCH = "struct<item_id:{0},length:int,doc_word:int,item_word:int>"


def _matches(docs: DataFrame, block: Block, text_col: str, id_type: T.DataType) -> DataFrame:
    """``docs`` with this block's matches appended to ``_matches``."""
    schema = T.StructType(docs.schema.fields)
    names = schema.names
    at_text, at_old = names.index(text_col), names.index("_matches")
    bc = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = bc.value
        item_first = np.full(len(block.ids), np.iinfo(np.int64).max)
        np.minimum.at(item_first, block.items, block.starts)
        for batch in batches:
            data, offsets = utf8(batch.column(at_text))
            n_words, found = [], [[] for _ in range(batch.num_rows)]
            for a, b in slices(offsets):
                bounds, at, src, window = shard_matches(data, offsets[a:b + 1], block)
                n_words.append(np.diff(bounds))
                if not len(at):
                    continue
                item = block.items[window]
                # Windows in step on one diagonal make one longest match.
                order = np.lexsort((at, at - src, item))
                at, src, item = at[order], src[order], item[order]
                length = block.lengths[window[order]]
                doc = np.searchsorted(bounds, at, side="right") - 1
                new = np.ones(len(at), dtype=bool)
                new[1:] = (item[1:] != item[:-1]) | (at[1:] - src[1:] != at[:-1] - src[:-1]) | \
                    (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
                heads = np.flatnonzero(new)
                tails = np.append(heads[1:], len(at)) - 1
                for h, t in zip(heads, tails, strict=True):
                    found[a + doc[h]].append({
                        "item_id": block.ids[item[h]],
                        "length": int(at[t] - at[h] + length[t]),
                        "doc_word": int(at[h] - bounds[doc[h]]),
                        "item_word": int(src[h] - item_first[item[h]])})
            old = batch.column(at_old)
            if any(found):
                merged = [[*(o or ()), *f] for o, f in zip(old.to_pylist(), found, strict=True)]
                old = pa.array(merged, old.type)
            columns = [old if i == at_old else batch.column(i) for i in range(len(names))]
            columns[names.index("n_words")] = pa.array(
                np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(docs, run, schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    text_col: str = "text", item_col: str = "item_id",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (row by row, all columns but any of these names) with n_words and
    matches: every longest verbatim match of ``window`` words or more with a benchmark
    item (or of the whole item, if that is shorter) as (item_id, length, doc_word, item_word),
    positions in words from 0.

    Null text has no words and no matches. Equal items match each by itself;
    repeated rows are matched each. An empty benchmark leaves matches empty.
    """
    id_type = benchmark.schema[item_col].dataType
    items = benchmark.select(F.col(item_col).alias("id"), text_of("text").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    rows = docs.withColumn("n_words", F.lit(0).cast("long")).withColumn(
        "_matches", F.array().cast(f"array<{MATCH.format(id_type.simpleString())}>"))
    block_of = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for k in range(blocks):
        part = items.filter(block_of == k).toArrow()  # about ``block_bytes``
        block = Block(part.column("id").to_pylist(), part.column("text").combine_chunks(), window)
        rows = _matches(rows, block, text_col, id_type)
    return rows.withColumnRenamed("_matches", "matches")


def _covered(matches) -> object:
    """Words inside any match: the union of the matches' word ranges."""
    ranges = F.array_sort(F.transform(matches, lambda m: F.struct(
        m["doc_word"].alias("a"), (m["doc_word"] + m["length"]).alias("b"))))
    return F.aggregate(
        ranges, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(r["b"] - F.greatest(r["a"], acc["end"]), F.lit(0)))
            .cast("long").alias("n"),
            F.greatest(acc["end"], r["b"]).alias("end")))["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` (row by row, all columns) with n_words, n_hit (words inside a
    match), n_items, items_sha256 (the matching item ids sorted as text,
    comma-joined), contaminated (a twentieth of the words or more are hit).

    Edge cases as in ``longest_matches``; equal item ids count once, a null item
    id counts as the empty text. A document without words is never contaminated.
    """
    rows = longest_matches(docs, benchmark, window, text_col, item_col)
    ids = F.array_sort(F.array_distinct(F.transform(
        "matches", lambda m: F.coalesce(m["item_id"].cast("string"), F.lit("")))))
    rows = rows.withColumn("n_hit", _covered(F.col("matches"))).withColumn("_ids", ids)
    return rows.withColumn("n_items", F.size("_ids").cast("long")).withColumn(
        "items_sha256", F.sha2(F.array_join("_ids", ","), 256)).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    ).drop("_ids", "matches")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows; all columns as they were, whatever
    their names. Null and empty texts have no words and stay; repeated rows go or stay
    together; an empty benchmark drops nothing, an empty table stays empty."""
    marked = contamination(docs.withColumnsRenamed({c: f"_doc_{c}" for c in docs.columns}),
                           benchmark, window, f"_doc_{text_col}")
    return marked.filter(~F.col("contaminated")).select(
        *[F.col(f"_doc_{c}").alias(c) for c in docs.columns])
