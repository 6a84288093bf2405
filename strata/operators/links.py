"""Link extraction, graphs from edge tables and PageRank (B10, E6, E13, E14,
F6, U3, G1, G2, A12).

PageRank is a DataFrame loop with the GraphX static-PageRank rule: every
vertex starts at 1.0; each round ``rank = reset + (1 - reset) * sum(rank(u) /
outdeg(u))`` over in-edges (a duplicate edge counts twice, a vertex without
out-edges passes nothing on); at the end ranks are scaled to sum to |V|.

Plan: the weighted edges are placed once, partitioned on (source, salt),
where hot sources get several salts; each round joins them with the source
ranks partitioned the same way (no edge shuffle) and sums partially per
target; vertices without in-edges, fixed at ``reset``, are added by a union. Every
round's ranks are stored in the run's folder of the shared scratch area, which cuts
the lineage, so a lost executor recomputes at most one round; a round's end removes
the ranks before it, and the run's end everything but the last ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.strings import java_split, literal_regex
from strata.sources.scratch import RunScratch

# The reference's wiki-link pattern and the link prefixes it skips.
WIKI_LINK = r"\[\[([^\]]+)\]\]"
WIKI_SKIP = ("[[Site:", "[[Image:", "[[Category:")


def _head(c: Column, separator: str | None) -> Column:
    if separator is None:
        return c
    return F.try_element_at(java_split(c, literal_regex(separator)), F.lit(1))


def extract_links(pages: DataFrame, src_col: str, text_col: str, pattern: str = WIKI_LINK,
                  skip_prefixes: Sequence[str] = WIKI_SKIP, raw: bool = False,
                  separator: str | None = "|", src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges ``(src, dst)`` from every match of ``pattern`` in the text.

    Matches whose whole text starts with one of ``skip_prefixes`` are
    dropped. The target is the part before the first ``separator``: of the
    whole match when ``raw=True`` (the reference's form, brackets kept:
    ``[[B|b]]`` -> ``[[B``), else of the pattern's first group (``B``);
    ``separator=None`` keeps it whole. A NULL text gives no edges.
    """
    text = F.col(text_col)
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    if raw:
        pairs = F.transform(whole, lambda m: F.struct(m.alias("m"), m.alias("g")))
    else:  # the texts are searched once; the group comes from each short match
        pairs = F.transform(whole, lambda m: F.struct(
            m.alias("m"), F.regexp_extract(m, pattern, 1).alias("g")))

    def keep(x):
        cond = F.lit(True)
        for prefix in skip_prefixes:
            cond = cond & ~x["m"].startswith(prefix)
        return cond

    targets = F.transform(F.filter(pairs, keep),
                          lambda x: _head(x["m"] if raw else x["g"], separator))
    return (pages.select(F.col(src_col).alias(src), F.explode(targets).alias(dst))
            .where(F.col(dst).isNotNull()))


def graph_vertices(edges: DataFrame, src: str = "src", dst: str = "dst",
                   name: str = "id") -> DataFrame:
    """Distinct vertices of an edge table (GraphFrame.fromEdges)."""
    return (edges.select(F.col(src).alias(name))
            .union(edges.select(F.col(dst).alias(name))).distinct())


EDGES_PER_PARTITION = 1_000_000


def next_ranks(ranks: DataFrame, weighted: DataFrame, salted: DataFrame, no_in_edges: DataFrame,
               reset: float, n: int) -> DataFrame:
    """One round: the ranks go to the placed edges, the sums to their targets."""
    sent = (ranks.withColumnRenamed("id", "src").join(salted, "src", "left")
            .select("src", "rank", F.explode(F.sequence(
                F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("salt"))
            .repartition(n, "src", "salt"))
    # Stream the placed edges and hash the (small) rank side per partition.
    sums = (weighted.join(sent.hint("shuffle_hash"), ["src", "salt"])
            .groupBy("dst").agg(F.sum(F.col("w") * F.col("rank")).alias("_in")))
    return (sums.select(F.col("dst").alias("id"),
                        (F.lit(reset) + F.lit(1.0 - reset) * F.col("_in")).alias("rank"))
            .unionByName(no_in_edges.select("id", F.lit(reset).alias("rank"))))


def pagerank(edges: DataFrame, iterations: int = 5, reset: float = 0.15, src: str = "src",
             dst: str = "dst", name: str = "pagerank", partitions: int | None = None,
             edges_per_partition: int = EDGES_PER_PARTITION) -> DataFrame:
    """Static PageRank of ``iterations`` rounds; ``(id, pagerank)``.

    Edges are placed once: duplicates merge into one weighted edge, and the
    weighted edges are written as a table bucketed on ``(src, salt)``.
    A source with more edges than an average partition holds gets several
    salts (its edges spread by a hash of the target), so no task holds a hot
    source's whole edge list. Each round moves only vertex-sized data in two
    shuffles: the ranks of sources (one copy per salt) are partitioned the
    same way as the edges, so the edge side of the join never shuffles again,
    and the contributions are partially summed per target before theirs.
    """
    spark = edges.sparkSession
    with RunScratch(spark, "pagerank") as run:
        e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
        # One pass over the edge table: duplicates merge into (src, dst, mult);
        # degrees, vertices and weights all derive from it.
        pairs = run.store(e.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_mult")), "pairs")
        out_degree = pairs.groupBy("src").agg(F.sum("_mult").alias("_deg"))
        # Partitions for the loop: about ``edges_per_partition`` edges each.
        total = pairs.agg(F.sum("_mult")).first()[0] or 0
        n = partitions or max(1, -(-total // edges_per_partition))
        # Salts per source: enough that no salt holds more than an average partition.
        per_partition = max(1.0, total / n)
        sources = run.store(out_degree.select(
            "src", "_deg", F.least(F.lit(n), F.ceil(F.col("_deg") / F.lit(per_partition)))
            .cast("int").alias("_salts")), "sources")
        # The edges go to a table bucketed on (src, salt): written once (a reliable
        # lineage cut), and the per-round join never moves an edge.
        weighted = run.place(
            pairs.join(sources, "src")
            .select("src", "dst", (F.col("_mult") / F.col("_deg")).alias("w"),
                    F.pmod(F.xxhash64("dst"), F.col("_salts")).cast("int").alias("salt")),
            "edges", n, ["src", "salt"])
        # Vertices without in-edges rank exactly ``reset`` in every round; all
        # others get a sum row. So a round needs no join with the vertex table.
        vertices = run.store(graph_vertices(pairs, "src", "dst", "id"), "vertices")
        no_in_edges = run.store(vertices.join(
            pairs.select(F.col("dst").alias("id")).distinct(), "id", "left_anti"), "no-in-edges")
        run.drop("pairs")
        # Fewer than n sources have more edges than an average partition; only
        # these have several salts, so their table is small whatever the graph.
        salted = F.broadcast(sources.where(F.col("_salts") > 1).select("src", "_salts"))
        ranks = vertices.select("id", F.lit(1.0).alias("rank"))
        for i in range(iterations):
            ranks = run.store(next_ranks(ranks, weighted, salted, no_in_edges, reset, n), f"round-{i}")
            run.drop(f"round-{i - 1}")
        if not iterations:
            ranks = run.store(ranks, "round--1")
        run.keep(f"round-{iterations - 1}")
        total = ranks.select(F.sum("rank")).scalar()
        count = ranks.select(F.count(F.lit(1)).cast("double")).scalar()
        return ranks.select("id", (F.col("rank") * count / total).alias(name))
