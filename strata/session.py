"""Session helpers: a tuned builder for tests/bench and the shared scratch area.

Scratch data (round-trip copies, PageRank checkpoints) lives under the folder
the cluster names in ``spark.checkpoint.dir``. That folder is read from the
session; only when it is unset (local tests) do we create one of our own.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench: AQE on, UI off, UTC, Arrow on."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set one only where the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # Local runs only: a cluster names a shared folder in spark.checkpoint.dir,
        # and a machine-local folder would be invisible to the other executors.
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can "
                               "reach (HDFS, S3, ...) before running strata jobs")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared scratch area for one run of ``name``."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-scratch/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a write go as it ends; else they stay until the driver
    happens to collect its garbage, and the files of all steps of a job add up on disk.
    For writes: a DataFrame that is handed on should be made outside."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def fingerprint(spark: SparkSession, path: str) -> str:
    """What tells one state of a stored table from another: its files' names, sizes
    and times, from a listing of the folder (or of the one file)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    listed = sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in files)
    return hashlib.sha256(repr(listed).encode()).hexdigest()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def workers_can_import(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package: add its
    parent folder to their PYTHONPATH (workers do not see the driver's
    ``sys.path``). On a cluster, ship the package with ``--py-files`` or
    install it on the executors."""
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parts = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *parts])
