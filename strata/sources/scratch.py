"""Scratch data owned by a run (G2): everything a job stores on its way lies in one
folder of the shared scratch area, parts go as soon as later ones replace them, and
the run's end leaves what it keeps, the result."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_path


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder of any file system Spark reads; False if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``, sorted; none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(place))


class RunScratch:
    """The stored parts of one run. As a context manager it removes on leaving
    whatever ``keep`` was not called for, also after an error."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, scratch_path(spark, name)
        self._tables: dict[str, str] = {}
        self._kept: set[str] = set()

    def __enter__(self) -> RunScratch:
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.close(keep=() if kind else self._kept)

    def path(self, part: str) -> str:
        return f"{self.root}/{part}"

    def store(self, df: DataFrame, part: str, **options) -> DataFrame:
        """``df`` written once (with ``options`` of the writer) and read again: cuts the
        lineage, survives executors."""
        df.write.options(**options).parquet(self.path(part))
        return self.spark.read.schema(df.schema).parquet(self.path(part))

    def place(self, df: DataFrame, part: str, buckets: int, keys: Sequence[str]) -> DataFrame:
        """``df`` as a table bucketed on ``keys``: its scan carries the partitioning,
        so a join on the keys moves the other side only."""
        setting = "spark.sql.sources.bucketing.maxBuckets"
        before = self.spark.conf.get(setting)
        table = f"strata_{uuid.uuid4().hex}"
        try:
            if buckets > int(before):
                self.spark.conf.set(setting, str(buckets))
            (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
             .option("path", self.path(part)).saveAsTable(table))
        finally:
            self.spark.conf.set(setting, before)
        self._tables[part] = table
        return self.spark.table(table)

    def keep(self, part: str) -> None:
        """Leave ``part`` behind at the run's end: the result lies there."""
        self._kept.add(part)

    def drop(self, part: str) -> None:
        """Remove a part that nothing reads any more."""
        table = self._tables.pop(part, None)
        if table:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_path(self.spark, self.path(part))

    def close(self, keep: Iterable[str] = ()) -> None:
        keep = set(keep)
        for part in set(self._tables) - keep:
            self.drop(part)
        for name in list_names(self.spark, self.root):
            if name not in keep:
                self.drop(name)
        if not keep:
            delete_path(self.spark, self.root)
