"""Hierarchical weighted hash tree: every row descends region, rack and shard
by weighted hash draws.

At each node every child draws ``-ln(u) / weight`` from the row's key and the
child's own name; the smallest draw wins. A child's draw depends on nothing but
the key, its name and its weight, so a change of weight moves rows only into or
out of the subtree that changed. Built-in SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored, text_of

#: Rows that follow each other in the input and are numbered together, as a power of two.
BLOCK_BITS = 17


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a shard has a number and no children."""

    name: str
    weight: float = 1.0
    children: tuple[Node, ...] = field(default=())
    shard: int | None = None

    def total(self) -> float:
        return sum(c.total() for c in self.children) if self.children else self.weight


def tree(shards: int, regions: int = 2, racks: int = 3, added: int = 0) -> Node:
    """``shards`` equal shards dealt over regions and racks. Each of ``added``
    further shards is a region of its own, so that the draws inside the other
    regions stay as they are and rows move only into the new shard."""
    groups: dict[tuple[int, int], list[Node]] = {}
    for s in range(shards):
        key = (s * regions // shards, s % racks)
        groups.setdefault(key, []).append(Node(f"s{s}", 1.0, (), s))
    tops = []
    for r in sorted({k[0] for k in groups}):
        tops.append(Node(f"r{r}", children=tuple(
            Node(f"r{r}k{k}", children=tuple(groups[(r, k)]))
            for k in range(racks) if (r, k) in groups)))
    for s in range(shards, shards + added):
        tops.append(Node(f"r+{s}", children=(
            Node(f"k+{s}", children=(Node(f"s{s}", 1.0, (), s),)),)))
    return Node("root", children=tuple(tops))


def _draw(key: Column, child: Node) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11).cast("double")
    u = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.ln(u) / F.lit(child.total())


def shard_of(key: Column, node: Node) -> Column:
    """The shard that ``key`` (a 64-bit column) descends to."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(key, node.children[0])
    draws = [F.struct(_draw(key, c).alias("d"), F.lit(i).alias("i"))
             for i, c in enumerate(node.children)]
    best = F.least(*draws)["i"]
    if all(not c.children for c in node.children):
        return F.element_at(F.array(*[F.lit(c.shard) for c in node.children]), best + 1)
    out = None
    for i, c in enumerate(node.children):
        out = (F if out is None else out).when(best == i, shard_of(key, c))
    return out


def assign_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document row: ``id_col``, size, text_crc32, law (``key``),
    shard, slot (0, 1, ... within the shard), grown_shard (with one more shard).

    Null text has no bytes; a null id is a key of its own. Rows that repeat an
    id share a shard and get slots of their own. Other columns are ignored; an
    empty table gives an empty result. Slots follow the rows' places in the stored
    input: each block of 2**``BLOCK_BITS`` rows numbers its own, from the sum of the
    shard's counts in the blocks before it, so no task numbers a whole shard, even
    where one id or text holds a third of all rows.
    """
    text = text_of(text_col)
    key = F.xxhash64(F.lit("shard"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    rows = docs.select(
        F.col(id_col), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("_key"))
    rows = stored(rows.select(
        id_col, "size", "text_crc32",
        shard_of(F.col("_key"), tree(shards)).alias("shard"),
        shard_of(F.col("_key"), tree(shards, added=1)).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_at")), "sharding-rows")
    rows = rows.withColumn("_block", F.shiftright("_at", BLOCK_BITS))
    counts = rows.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    before = W.partitionBy("shard").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "_block",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = W.partitionBy("shard", "_block").orderBy("_at")
    return (rows.withColumn("_row", F.row_number().over(within))
            .join(starts, ["shard", "_block"])
            .select(id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_start") + F.col("_row") - 1).alias("slot"), "grown_shard"))
