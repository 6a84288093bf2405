"""Tables that are replaced without ever being half there (K1).

A plain overwrite deletes the old files before the new ones are complete: a job killed
half-way leaves neither. Here every write goes to a folder of its own, and a small
numbered manifest, written last and moved into place, makes it the table. Readers
follow the newest manifest, so they see the old table until the new one is whole, and
a failed write changes nothing. Two writers of one number: the second one fails.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.sources.scratch import delete_path, list_names
from strata.sources.writers import write_with_count


@dataclass
class Version:
    number: int
    folder: str
    rows: int


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _write_once(spark: SparkSession, path: str, text: str) -> None:
    """A new file with ``text``, there as a whole or not at all; an existing one raises."""
    target, files = _files(spark, path)
    draft, _ = _files(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise FileExistsError(f"another writer has made {path}")


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All published versions, oldest first."""
    found = []
    for name in list_names(spark, f"{path}/_manifests"):
        if not name.endswith(".json") or name.startswith((".", "_")):
            continue
        _, files = _files(spark, path)
        stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_manifests/{name}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        found.append(Version(**json.loads(text)))
    return sorted(found, key=lambda v: v.number)


def publish(df: DataFrame, path: str, fmt: str = "parquet", **options) -> Version:
    """Replace the table in ``path`` with ``df``, which may read that table. The row
    count rides on the write."""
    spark = df.sparkSession
    before = versions(spark, path)
    number = before[-1].number + 1 if before else 1
    folder = f"{path}/_versions/{number:010d}-{uuid.uuid4().hex}"
    rows = write_with_count(df, folder, fmt=fmt, mode="errorifexists", **options)
    version = Version(number, folder.rsplit("/", 1)[1], rows)
    _write_once(spark, f"{path}/_manifests/{number:010d}.json", json.dumps(version.__dict__))
    return version


def read_published(spark: SparkSession, path: str, number: int | None = None,
                   fmt: str = "parquet") -> DataFrame:
    """The newest version of the table in ``path``, or version ``number``."""
    found = [v for v in versions(spark, path) if number is None or v.number == number]
    if not found:
        raise FileNotFoundError(f"no published table in {path}"
                                + (f" has number {number}" if number is not None else ""))
    return spark.read.format(fmt).load(f"{path}/_versions/{found[-1].folder}")


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than: float = 86400.0) -> list[str]:
    """Remove all but the newest ``keep`` versions, and what failed writes left if it
    is older than ``older_than`` seconds (a younger one may still be written).
    Returns the names of the folders removed."""
    if keep < 1:
        raise ValueError("keep at least one version")
    known = versions(spark, path)
    removed = []
    for v in known[:-keep]:  # the manifest first: a version without one is no table
        delete_path(spark, f"{path}/_manifests/{v.number:010d}.json")
        delete_path(spark, f"{path}/_versions/{v.folder}")
        removed.append(v.folder)
    held = {v.folder for v in known}
    for name in list_names(spark, f"{path}/_versions"):
        place, files = _files(spark, f"{path}/_versions/{name}")
        if name not in held and files.exists(place) and \
                time.time() - files.getFileStatus(place).getModificationTime() / 1000 >= older_than:
            delete_path(spark, f"{path}/_versions/{name}")
            removed.append(name)
    return sorted(removed)
