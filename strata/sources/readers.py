"""Readers for every source format the reference programs use.

All readers return lazy DataFrames: Catalyst pushes filters and column pruning
into the scan (Parquet, ORC, CSV, JSON and JDBC support pushdown). Schema
inference is an extra pass over the data, so it runs only when no ``schema`` is
given and the caller asks for it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.session import exists
from strata.sources.frames import create_empty_df


def _apply_schema(reader, schema):
    if schema is None:
        return reader
    return reader.schema(schema)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return _apply_schema(spark.read, schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             header: bool = True, infer: bool = False, sep: str = ",",
             quote: str = '"', **options) -> DataFrame:
    """CSV with a header. ``infer=False`` keeps every column a string (S2);
    ``infer=True`` runs Spark's inference pass (S3); ``schema`` skips both."""
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("quote", quote).options(**options))
    if schema is None and infer:
        reader = reader.option("inferSchema", True)
    return _apply_schema(reader, schema).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | None = None,
              **options) -> DataFrame:
    """JSON lines. Without a schema Spark infers one: fields sorted by name,
    integers as bigint."""
    return _apply_schema(spark.read.options(**options), schema).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str,
             schema: StructType | None = None, **options) -> DataFrame:
    """XML rows by tag (built into Spark 4). Element text next to attributes
    arrives as ``_VALUE`` with ``_attr`` siblings."""
    reader = spark.read.format("xml").option("rowTag", row_tag).options(**options)
    return _apply_schema(reader, schema).load(path)


def read_text(spark: SparkSession, path: str, whole_text: bool = False) -> DataFrame:
    """Plain text, one ``value`` row per line."""
    return spark.read.text(path, wholetext=whole_text)


def read_avro(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Avro through the ``avro`` data source. The source ships as a separate
    Spark module; without it this raises a clear error instead of guessing."""
    try:
        return _apply_schema(spark.read.format("avro"), schema).load(path)
    except AnalysisException as exc:
        if "avro" in str(exc).lower():
            raise RuntimeError(
                "The Avro data source is not on the classpath; add the "
                "spark-avro package to the session to read Avro files") from exc
        raise


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int | None = None) -> DataFrame:
    """A database table over JDBC. Credentials come in ``properties``, never
    from constants. Give ``column/lower_bound/upper_bound/num_partitions`` to
    read with many parallel connections instead of one."""
    props = dict(properties or {})
    if fetch_size:
        props["fetchsize"] = str(fetch_size)
    if column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound "
                             "and num_partitions")
        return spark.read.jdbc(url, table, column=column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


_READERS = {
    "parquet": read_parquet,
    "csv": read_csv,
    "json": read_json,
    "avro": read_avro,
}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None, **options) -> DataFrame:
    """One entry point for file sources (S1-S5, S8, S9); no hard-coded prefix."""
    fmt = fmt.lower()
    if fmt in _READERS:
        return _READERS[fmt](spark, path, schema=schema, **options)
    if fmt == "xml":
        return read_xml(spark, path, schema=schema, **options)
    if fmt == "text":
        return read_text(spark, path, **options)
    return _apply_schema(spark.read.format(fmt).options(**options), schema).load(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType,
                  fmt: str = "parquet", **options) -> DataFrame:
    """Read ``path``; if it does not exist, an empty table of ``schema``.
    Only a missing path is forgiven, every other error is raised."""
    # A plain path is looked up first: Spark logs every failed analysis with its stack.
    if not any(c in path for c in "*?[{") and not exists(spark, path):
        return create_empty_df(spark, schema)
    try:
        return read_table(spark, path, fmt=fmt, schema=schema, **options)
    except AnalysisException as exc:
        if getattr(exc, "getCondition", lambda: None)() == "PATH_NOT_FOUND" \
                or "PATH_NOT_FOUND" in str(exc):
            return create_empty_df(spark, schema)
        raise


def register_view(spark: SparkSession, name: str, fmt: str, path: str,
                  options: dict | None = None) -> DataFrame:
    """A file-backed temporary view created in SQL (S6), replacing any view of
    the same name, and returned as a DataFrame."""
    if not name.replace("_", "").isalnum():
        raise ValueError(f"bad view name {name!r}")
    opts = {"path": path, **(options or {})}
    rendered = ", ".join(f"{k} '{str(v)}'" for k, v in opts.items())
    for value in opts.values():
        if "'" in str(value):
            raise ValueError("option values may not contain quotes")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING {fmt} OPTIONS ({rendered})")
    return spark.table(name)
