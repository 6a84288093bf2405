"""Exact duplicates by skew-safe combining.

Rows are combined three times, each time comparing the digest *and* the whole
normalised text: inside each map task (partial aggregation), within salted
digest groups, then over the salt winners. A text with any number of copies
leaves one row per map task and one per salt, so no task sees all its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, text_of

#: Salts per digest: a text's map-task winners meet in this many groups.
SALTS = 16


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 salts: int = SALTS, digest=_digest) -> DataFrame:
    """One row per document row: ``id_col``, keep_id (largest id of equal texts),
    group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Null text counts as
    empty. A null id is smaller than any other; a group of null ids only has
    keep_id null and keeps its rows. Repeated rows (same id and text) are all
    counted and all kept. Other columns are ignored; an empty table gives an
    empty result. ``digest`` may be weak: groups are formed on whole texts.
    """
    norm = ascii_lower(text_of(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), norm.alias("_text"))
    rows = rows.withColumn("_digest", digest(F.col("_text")))
    salted = (rows.groupBy("_digest", "_text", (F.spark_partition_id() % salts).alias("_salt"))
              .agg(F.max("_id").alias("_keep"), F.count("*").alias("_n")))
    winners = (salted.groupBy("_digest", "_text")
               .agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n")))
    # From here two independent hashes stand for the text; were two texts ever
    # to share both, the job stops instead of mixing them up.
    check = F.xxhash64("_text")
    groups = (winners.select("_digest", check.alias("_check"), "_keep", "_n")
              .groupBy("_digest", "_check")
              .agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n"),
                   F.count("*").alias("_texts"))
              .withColumn("_n", F.when(F.col("_texts") > 1,
                                       F.raise_error("two texts share both hashes").cast("long"))
                          .otherwise(F.col("_n"))).drop("_texts"))
    # A thin inner join; AQE splits a partition that one text's copies fill.
    members = rows.select("_id", "_digest", check.alias("_check"),
                          F.sha2("_text", 256).alias("text_sha256"))
    return (members.join(groups, ["_digest", "_check"])
            .select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
                    F.col("_n").alias("group_size"),
                    F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that lose to an equal text: all columns stay,
    of equal texts the rows with the largest id stay, of rows that repeat id
    and text one stays."""
    norm = ascii_lower(text_of(text_col))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    names = ["__dedup_key", "__dedup_digest"]
    keys = docs.withColumns(dict(zip(names, (key, _digest(norm)), strict=True)))
    best = (exact_groups(docs, id_col, text_col).filter("kept")
            .select(key.alias(names[0]), F.col("text_sha256").alias(names[1])))
    # One shuffle by the key serves the join and the repeated rows.
    return keys.join(best, names, "left_semi").dropDuplicates(names).drop(*names)
