"""Join helpers for skewed keys.

AQE splits a skewed partition of an inner join on either side, but for a
left outer join only on the left side. ``left_join_hot_right`` keeps a left
outer join balanced when one key of the *right* side is hot (say, one work
citing a third of everything): the matched rows come from an inner join
(splittable on both sides), and the unmatched left rows from an anti join
against the right side's distinct keys, which a partial aggregate keeps
small whatever the skew. The result equals ``left.join(right, cond, "left")``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_hot_right(left: DataFrame, right: DataFrame, left_key: str,
                        right_key: str) -> DataFrame:
    """``left ⟕ right`` on ``left_key = right_key`` (column names must not clash)."""
    matched = left.join(right, F.col(left_key) == F.col(right_key), "inner")
    keys = right.select(F.col(right_key).alias("_rk")).distinct()
    unmatched = left.join(keys, F.col(left_key) == F.col("_rk"), "left_anti")
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in right.schema.fields]
    return matched.unionByName(unmatched.select(*left.columns, *nulls))
