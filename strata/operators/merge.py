"""Merging an update file into a base table.

One plan at every size: base rows take the delta's non-NULL values (left join),
delta rows with keys that the base lacks are added (anti join). Rows with a NULL
key match nothing and pass around the joins. There are no hints: AQE broadcasts
a small delta by itself and splits a skewed partition of the base. The cast
delta is checkpointed, as three branches read it. A key that occurs twice in the
delta would multiply rows, so it raises unless ``dedupe_by`` says which row holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField, StructType

from strata.session import checkpoint_dir
from strata.sources.frames import parse_as

def cast_to(delta: DataFrame, base: DataFrame, strict: bool = True) -> DataFrame:
    """The delta with the base's column order and types (Q14). ``strict``
    raises on a bad value; ``strict=False`` turns it into NULL. A NULL of the delta
    means "no news", so it may stand in any column."""
    schema = StructType([StructField(f.name, f.dataType) for f in base.schema])
    return parse_as(delta, schema, strict=strict)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_col``, NULL being the
    smallest; of equals the one with the greatest other columns. ``max_by``
    aggregates partially before the shuffle, so a hot key stays cheap."""
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    ties = [F.col(f"`{f.name}`") for f in df.schema
            if f.name in others and not isinstance(f.dataType, MapType)]
    order = F.struct(F.col(order_col).isNotNull().alias("known"), F.col(order_col).alias("order"),
                     F.struct(*ties).alias("ties"))
    return (df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
            .select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in others]))


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Keys that occur more than once, with their count (Q16: a duplicated key
    multiplies rows in the merge). A partial aggregate, cheap at any skew."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def merge_upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str] | str,
                 columns: Sequence[str] | None = None, strict: bool = True,
                 dedupe_by: str | None = None,
                 parse: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Merge ``delta`` into ``base`` (see the module notes). ``parse`` maps a
    column to a function turning the delta's text into the base type where
    a cast cannot (an array written as JSON, say ``F.from_json``). ``dedupe_by``
    may be a column that only the delta has."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = list(columns) if columns is not None else [c for c in base.columns if c not in keys]
    base = base.select(*keys, *columns)
    if dedupe_by is not None:
        delta = latest_per_key(delta, keys, dedupe_by)
    if parse:
        delta = delta.select(*[parse[c](F.col(c)).alias(c) if c in parse else F.col(c)
                               for c in delta.columns])
    checkpoint_dir(base.sparkSession)
    delta = cast_to(delta, base, strict=strict).checkpoint()
    keyed = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    known = delta.where(keyed)
    twice = duplicate_keys(known, keys).limit(1).collect()
    if twice:
        raise ValueError(f"the delta has {twice[0]['copies']} rows of one key "
                         f"({', '.join(map(str, twice[0][:-1]))}); pass dedupe_by")
    fresh = known.select(*keys, *[F.col(f"`{c}`").alias(f"_d_{c}") for c in columns])
    updated = base.where(keyed).join(fresh, keys, "left").select(
        *keys, *[F.coalesce(F.col(f"`_d_{c}`"), F.col(f"`{c}`")).alias(c) for c in columns])
    added = known.join(base.where(keyed).select(*keys), keys, "left_anti").select(*keys, *columns)
    return (updated.unionByName(added).unionByName(base.where(~keyed))
            .unionByName(delta.where(~keyed).select(*keys, *columns)))
