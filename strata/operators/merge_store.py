"""A stored base that merges rewrite in part.

The base is a table partitioned by ``_part`` (a hash of the key) and bucketed on the
key inside each partition. A merge

* reads only the partitions that the delta's keys fall into,
* joins them without moving them: the buckets carry the base's partitioning, so the plan
  has an exchange on the delta's side only,
* writes back only these partitions (dynamic overwrite: staged, then moved into place).

So its cost grows with the delta and the partitions it touches, not with the base.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.merge import cast_to, duplicate_keys, latest_per_key
from strata.sources.scratch import RunScratch

PART = "_part"


def _part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(parts)).cast("int")


def create_store(base: DataFrame, table: str, path: str, keys: Sequence[str] | str, parts: int = 64,
                 buckets: int = 16) -> None:
    """Store ``base`` as the table ``table`` in the folder ``path``. A partition should
    hold some hundred megabytes, so that a small delta touches little."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if PART in base.columns:
        raise ValueError(f"the base has a column {PART!r}")
    (base.withColumn(PART, _part(keys, parts)).repartition(buckets, *keys)
     .write.partitionBy(PART).bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
     .saveAsTable(table))


def read_store(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(PART)


def merged_parts(spark: SparkSession, table: str, delta: DataFrame, keys: Sequence[str], parts: int,
                 touched: Sequence[int]) -> DataFrame:
    """The touched partitions after the merge, with ``_part``: rows of the base take the
    delta's non-NULL values, rows of unknown or NULL keys are added."""
    base = spark.table(table).where(F.col(PART).isin(list(touched))).drop(PART)
    values = [c for c in base.columns if c not in keys]
    fresh = delta.select(*keys, *[F.col(f"`{c}`").alias(f"_d_{c}") for c in values])
    joined = base.join(fresh, list(keys), "full_outer").select(*[
        F.col(c) if c in keys else F.coalesce(F.col(f"`_d_{c}`"), F.col(f"`{c}`")).alias(c)
        for c in base.columns])
    return joined.withColumn(PART, _part(keys, parts))


def merge_into_store(spark: SparkSession, table: str, delta: DataFrame, keys: Sequence[str] | str,
                     parts: int = 64, strict: bool = True, dedupe_by: str | None = None) -> list[int]:
    """Merge ``delta`` into the stored base (``parts`` as it was created) and return the
    partitions rewritten. A key that the delta has twice raises unless ``dedupe_by``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    with RunScratch(spark, "merge-store") as run:
        if dedupe_by is not None:
            delta = latest_per_key(delta, keys, dedupe_by)
        delta = run.store(cast_to(delta, read_store(spark, table), strict=strict), "delta")
        keyed = delta.dropna(subset=keys)
        twice = duplicate_keys(keyed, keys).limit(1).collect()
        if twice:
            raise ValueError(f"the delta has {twice[0]['copies']} rows of one key "
                             f"({', '.join(map(str, twice[0][:-1]))}); pass dedupe_by")
        # At most ``parts`` numbers.
        touched = sorted(r[0] for r in delta.select(_part(keys, parts)).distinct().collect())
        if touched:
            setting = "spark.sql.sources.partitionOverwriteMode"
            before = spark.conf.get(setting)
            spark.conf.set(setting, "dynamic")
            try:
                merged_parts(spark, table, delta, keys, parts, touched) \
                    .write.mode("overwrite").insertInto(table)
            finally:
                spark.conf.set(setting, before)
        return touched
