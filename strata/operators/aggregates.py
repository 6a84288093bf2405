"""Keyed aggregates (A1-A10, U5) and top-n.

Every aggregate here is a ``groupBy().agg()``: Spark plans a partial
aggregate before the shuffle (the map-side combine of ``reduceByKey`` /
``combineByKey``), so a key holding a third of all rows still ships one
partial row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strata.functions.strings import parse_double
from strata.session import workers_can_import


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_by(df: DataFrame, keys, name: str = "n", column: str | None = None) -> DataFrame:
    """Rows per key (A2), or non-NULL values of ``column`` per key."""
    counted = F.count(F.lit(1)) if column is None else F.count(F.col(column))
    return df.groupBy(*_cols(keys)).agg(counted.alias(name))


def sum_by(df: DataFrame, keys, value: str, name: str = "total") -> DataFrame:
    """Sum per key (A1)."""
    return df.groupBy(*_cols(keys)).agg(F.sum(value).alias(name))


def _numeric(df: DataFrame, value: str) -> Column:
    """The value as double; strings are parsed and bad numbers become NULL."""
    dtype = df.schema[value].dataType.simpleString()
    return parse_double(F.col(value)) if dtype == "string" else F.col(value).cast("double")


def mean_by(df: DataFrame, key: str, value: str, method: str = "fold",
            bad: str = "skip", name: str = "mean") -> DataFrame:
    """Mean of ``value`` per ``key``.

    ``method="fold"``: one aggregate of (sum, n), the reference's combineByKey;
    ``method="join"``: sum per key and count per key joined and divided, the
    reference's first approach (both aggregates come out hash-partitioned on
    the key, so a sort-merge join of them needs no further shuffle; small
    counts are broadcast instead);
    ``method="pandas"``: a user fold in pandas per partition (create / merge
    value) and a Spark aggregate of the partials (merge combiners).

    ``bad="skip"`` averages valid numbers only; ``bad="count"`` divides by every
    row of the key, as the join form of the reference does on bad input.
    """
    if bad not in ("skip", "count"):
        raise ValueError("bad must be 'skip' or 'count'")
    v = _numeric(df, value)
    rows = df.select(F.col(key), v.alias("_v"))
    count_expr = F.count(F.lit(1)) if bad == "count" else F.count("_v")
    if method == "fold":
        return (rows.groupBy(key).agg(F.sum("_v").alias("_s"), count_expr.alias("_n"))
                .where(F.col("_s").isNotNull())  # a key of bad numbers only has no mean
                .select(key, (F.col("_s") / F.col("_n")).alias(name)))
    if method == "join":
        sums = rows.where(F.col("_v").isNotNull()).groupBy(key).agg(F.sum("_v").alias("_s"))
        counts = rows.groupBy(key).agg(count_expr.alias("_n")).where(F.col("_n") > 0)
        return sums.join(counts, key, "inner").select(key, (F.col("_s") / F.col("_n")).alias(name))
    if method == "pandas":
        return _pandas_fold_mean(rows, key, name, count_all=(bad == "count"))
    raise ValueError(f"unknown method {method!r}")


def _pandas_fold_mean(rows: DataFrame, key: str, name: str, count_all: bool) -> DataFrame:
    workers_can_import(rows.sparkSession)
    key_type = rows.schema[key].dataType.simpleString()

    def partials(batches):
        # Fold each Arrow batch of the partition into (sum, n) per key.
        for pdf in batches:
            valid = pdf["_v"].notna()
            n = pdf.groupby(key, dropna=False).size() if count_all else \
                valid.groupby(pdf[key], dropna=False).sum()
            s = pdf["_v"].where(valid, 0.0).groupby(pdf[key], dropna=False).sum()
            good = valid.groupby(pdf[key], dropna=False).sum()
            out = pd.DataFrame({key: s.index, "_s": s.values, "_n": n.reindex(s.index).values,
                                "_good": good.reindex(s.index).values})
            yield out.astype({"_n": "int64", "_good": "int64"})

    schema = f"`{key}` {key_type}, _s double, _n long, _good long"
    return (rows.mapInPandas(partials, schema)
            .groupBy(key).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"),
                              F.sum("_good").alias("_good"))
            .where(F.col("_good") > 0)  # a key of bad numbers only has no mean
            .select(key, (F.col("_s") / F.col("_n")).alias(name)))


def ratio_by(df: DataFrame, key: str, value: str, count_name: str = "count",
             ratio_name: str = "procent", share_name: str | None = None) -> DataFrame:
    """Per key: ``count(value)``, ``count(value) / sum(value)`` as the reference
    computes its "procent" (A10), and optionally the true share of all counted
    rows. ``try_divide`` gives NULL on a zero sum instead of failing; whole
    numbers are summed as decimals, as ids of 64 bits overflow a long sum."""
    whole = isinstance(df.schema[value].dataType, IntegralType)
    total_of = F.sum(F.col(value).cast("decimal(38,0)") if whole else F.col(value)).cast("double")
    out = df.groupBy(key).agg(F.count(value).alias(count_name), total_of.alias("_sum"))
    out = out.withColumn(ratio_name, F.try_divide(F.col(count_name).cast("double"), F.col("_sum")))
    if share_name:
        # The total sums the per-key counts: a scalar subquery over the same aggregate.
        total = out.agg(F.sum(count_name)).scalar()
        out = out.withColumn(share_name, F.try_divide(F.col(count_name).cast("double"), total))
    return out.drop("_sum")


def top_n(df: DataFrame, order: Sequence[Column], n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows by ``order`` with a tie-break so the result is
    determinate; planned as TakeOrderedAndProject (a per-partition top-n)."""
    return df.orderBy(*order, *[F.col(c).asc() for c in tiebreak]).limit(n)


def rank_values(df: DataFrame, array_col: str, name: str = "value", count_name: str = "n",
                descending: bool = True) -> DataFrame:
    """Count each element of an array column over all rows (A3 + O5)."""
    counted = (df.select(F.explode(F.col(array_col)).alias(name))
               .groupBy(name).agg(F.count(F.lit(1)).alias(count_name)))
    order = F.col(count_name).desc() if descending else F.col(count_name).asc()
    return counted.orderBy(order, F.col(name))
