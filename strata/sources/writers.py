"""Sinks and actions (K1, K2, K6, K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, **options) -> None:
    """Write ``df``. ``overwrite`` replaces the target (K1); ``errorifexists``
    fails when it exists (K2). Spark's commit protocol makes a retried task or
    a lost executor safe: only committed task output becomes visible."""
    writer = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_with_count(df: DataFrame, path: str, fmt: str = "parquet",
                     mode: str = "overwrite", **options) -> int:
    """Write and count in one pass: the row count rides on the write as an
    observed metric instead of a second job over the data."""
    observation = Observation("strata_write")
    observed = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    write_table(observed, path, fmt=fmt, mode=mode, **options)
    return int(observation.get["rows"])


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns) as the reference prints it."""
    return df.count(), len(df.columns)
