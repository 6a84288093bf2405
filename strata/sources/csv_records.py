"""CSV whose fields may hold line breaks, read by many tasks per file.

Spark's ``multiLine`` reads a file in one task, as a chunk does not know whether it
starts inside quotes. Here the lines are read in chunks (the splits of Spark's text
reader), and

1. every chunk counts its quotes; the parities, added up over the chunks before it
   in the file (a window over one row per chunk), say whether it starts inside quotes;
2. with that, every task joins its lines to records on its own: a record ends with
   the line after which the number of quotes is even. The lines at a chunk's edges that
   belong to a record of several chunks come out as fragments;
3. the fragments of a record (few: two per chunk at most) are put together;
4. the records are parsed by Spark's ``from_csv``.

Files that a job reads more than once are kept in columns (``store``), from one pass of
steps 2 to 4; where no line has an odd number of quotes, Spark's own reader makes it.

A quote inside a quoted field must be doubled (``escape='"'``), so that parity holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import workers_can_import

WHOLE, HEAD, TAIL, MIDDLE = range(4)
_RECORDS = "file long, start long, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, file, start): every line in file order within its chunk."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))


def _parity(lines: DataFrame, quote: str) -> DataFrame:
    """(file, start, odd, broken): a chunk's quotes modulo 2; whether one of its lines
    alone is no record, for an odd number of quotes, or holds another line end."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return lines.groupBy("file", "start").agg(
        (F.sum(quotes) % 2).alias("odd"),
        F.max((quotes % 2 == 1) | F.contains("value", F.lit("\r"))).alias("broken"))


def _chunks(parity: DataFrame) -> DataFrame:
    """(file, start, open, ends_open): whether a chunk starts and ends inside quotes."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = parity.withColumn("open", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    return opened.select("file", "start", "open",
                         (F.col("open") != (F.col("odd") == 1)).alias("ends_open"))


class _Chunk:
    """The records of one chunk, from its lines batch by batch."""

    def __init__(self, file: int, start: int, opened: bool) -> None:
        self.file, self.start = file, start
        self.odd, self.head = int(opened), opened
        self.first = start == 0 and not opened  # the file's first record is still to come
        self.pending: list[str] = []

    def add(self, lines: pa.Array, quote: str) -> Iterator[pa.RecordBatch]:
        n = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False)
        odd = (self.odd + np.cumsum(n)) % 2
        ends = np.flatnonzero(odd == 0)
        self.odd = int(odd[-1])
        if not len(ends):
            self.pending += lines.to_pylist()
            return
        if self.pending:  # the record that earlier batches began
            joined = "\n".join([*self.pending, *lines.slice(0, ends[0] + 1).to_pylist()])
            yield self._out(pa.array([joined], pa.string()))
            begin, ends = int(ends[0]) + 1, ends[1:]
        else:
            begin = 0
        if len(ends):
            body = lines.slice(begin, int(ends[-1]) + 1 - begin)
            cuts = np.concatenate([[0], ends + 1 - begin]).astype(np.int32)
            yield self._out(pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), body), "\n"))
            begin = int(ends[-1]) + 1
        self.pending = lines.slice(begin).to_pylist()

    def _out(self, records: pa.Array) -> pa.RecordBatch:
        kind, first = np.zeros(len(records), np.int32), np.zeros(len(records), bool)
        if self.head:
            kind[0], self.head = HEAD, False
        first[0], self.first = self.first, False
        return self._batch(kind, first, records)

    def _batch(self, kind: np.ndarray, first: np.ndarray, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, self.file)), pa.array(np.full(n, self.start)), pa.array(kind),
             pa.array(first), records],
            names=["file", "start", "kind", "first", "record"])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.pending:
            kind = MIDDLE if self.head else TAIL
            yield self._batch(np.array([kind], np.int32), np.array([self.first]),
                              pa.array(["\n".join(self.pending)], pa.string()))


def _pieces(lines: DataFrame, parity: DataFrame, quote: str
            ) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The chunks, and a step that joins the lines of some of them to records."""
    # One row of three numbers per chunk of many megabytes: small whatever the input.
    chunks = F.broadcast(_chunks(parity))
    workers_can_import(lines.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = None
        for batch in batches:
            file, start, opened = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            lines = batch.column(0).cast(pa.string())
            new = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(file)], strict=True):
                if a == b:
                    continue
                if chunk is None or (chunk.file, chunk.start) != (file[a], start[a]):
                    if chunk is not None:
                        yield from chunk.end()
                    chunk = _Chunk(int(file[a]), int(start[a]), bool(opened[a]))
                yield from chunk.add(lines.slice(a, b - a), quote)
        if chunk is not None:
            yield from chunk.end()

    def joined(of: DataFrame) -> DataFrame:
        return lines.join(of, ["file", "start"]).select("value", "file", "start", "open") \
            .mapInArrow(run, _RECORDS)

    return chunks, joined


def _stitched(edges: DataFrame) -> DataFrame:
    """(first, record): a record's fragments put together: the tail that opens it, whole
    chunks inside, the head that ends it."""
    order = Window.partitionBy("file").orderBy("start", "kind")
    opened = F.sum((F.col("kind") == TAIL).cast("long")).over(order)
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "record")))
    return (edges.withColumn("number", opened).groupBy("file", "number")
            .agg(F.max("first").alias("first"), parts.alias("parts"))
            .select("first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
                    .alias("record")))


def _cleaned(records: DataFrame, header: bool) -> DataFrame:
    """Without blank records and, if ``header``, a file's first."""
    if header:
        records = records.where(~F.col("first"))
    # The last "\r" of a record is its line break's; others lie inside quotes.
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).where(
        F.trim("record") != "")


def csv_records(spark: SparkSession, path: str | list[str], quote: str = '"', header: bool = False
                ) -> DataFrame:
    """``record``: every record of the CSV files as one string, its line breaks
    kept, without a file's first record if ``header``. Blank records are left out."""
    lines = _lines(spark, path)
    chunks, joined = _pieces(lines, _parity(lines, quote), quote)
    whole = joined(chunks).where(F.col("kind") == WHOLE).select("first", "record")
    edges = joined(chunks.where(F.col("open") | F.col("ends_open"))).where(F.col("kind") != WHOLE)
    return _cleaned(whole.unionByName(_stitched(edges)), header).select("record")


def read_csv_records(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                     sep: str = ",", quote: str = '"', store: str | None = None, **options
                     ) -> DataFrame:
    """``read_csv`` with a header for files whose quoted fields hold line breaks (and
    quotes doubled), split over tasks. Without ``schema`` all columns are strings, named
    by the header. With ``store`` (a new folder) the records are joined and parsed once
    and kept there in columns: for files that a job reads more than once."""
    if schema is None:
        names = spark.read.option("header", True).option("sep", sep).option("quote", quote).option(
            "escape", quote).csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    given = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true",
             **{k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}}
    # from_csv takes the schema as text; positions stand in for names of any form.
    plain = ", ".join(f"_c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema.fields))
    parsed = F.from_csv("record", plain, given).alias("r")
    if store is None:
        rows = csv_records(spark, path, quote, header=True).select(parsed).select("r.*")
    else:
        rows = _stored(spark, path, quote, plain, given, store)
    return rows.select(*[F.col(f"_c{i}").alias(f.name) for i, f in enumerate(schema.fields)])


def _stored(spark: SparkSession, path: str | list[str], quote: str, plain: str,
            given: dict[str, str], store: str) -> DataFrame:
    """The parsed records. Where every line is a record of its own, Spark's reader splits
    the files rightly. Else one pass of the files through Python writes whole records in
    columns and, beside them, the fragments, which follow put together."""
    lines = _lines(spark, path)
    _parity(lines, quote).write.parquet(f"{store}/chunks")
    parity = spark.read.parquet(f"{store}/chunks")
    if parity.where("broken").isEmpty():
        reader = spark.read.schema(plain).options(**{**given, "multiLine": "false"})
        reader.options(header=True, lineSep="\n").csv(path).write.parquet(
            f"{store}/lines", compression="zstd")
        return spark.read.schema(plain).parquet(f"{store}/lines")
    chunks, joined = _pieces(lines, parity, quote)
    whole, bare = F.col("kind") == WHOLE, F.regexp_replace("record", "\r$", "")
    parsed = F.from_csv("record", plain, given).alias("r")
    (joined(chunks).where(~whole | ~(F.col("first") | (F.trim(bare) == "")))
     .withColumn("fragment", F.when(~whole, F.col("record")))
     .withColumn("record", F.when(whole, bare))
     .select("file", "start", "kind", "first", "fragment", parsed)
     .select("file", "start", "kind", "first", "fragment", "r.*")
     .write.parquet(f"{store}/pieces", compression="zstd"))
    kept = spark.read.parquet(f"{store}/pieces")
    edges = kept.where(~whole).select("file", "start", "kind", "first",
                                      F.col("fragment").alias("record"))
    (_cleaned(_stitched(edges), header=True).select(F.lit(WHOLE).alias("kind"), parsed)
     .select("kind", "r.*").write.parquet(f"{store}/stitched", compression="zstd"))
    return spark.read.schema(kept.schema).parquet(f"{store}/pieces", f"{store}/stitched").where(whole)
