"""Word counts over text.

Texts are exploded into tokens inside one stage and counted with a partial
aggregate before the shuffle, so a very common word (or one huge text) costs
one partial row per map task, not one row per occurrence. ``spread_texts`` cuts a
text too long for one task into pieces that many tasks count.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.strings import char_class, java_split, jvm_trim, literal_regex
from strata.session import workers_can_import

PIECE_BYTES = 4 << 20


def lines_of(df: DataFrame, text_col: str, name: str = "value") -> DataFrame:
    """One row per line of each text, as a text-file reader would give them
    (the line break is dropped; a final break adds no line, any other empty
    line is one)."""
    pieces = F.transform(F.array(F.split(F.col(text_col), r"\r?\n|\r", -1)), lambda found: F.when(
        F.element_at(found, -1) == "", F.slice(found, F.lit(1), F.size(found) - 1))
        .otherwise(found))[0]
    return df.select(F.explode(pieces).alias(name))


def spread_texts(df: DataFrame, text_col: str, separators: Iterable[str] = (" ", "\n"),
                 piece_bytes: int = PIECE_BYTES, name: str = "value") -> DataFrame:
    """``df``'s texts as rows of about ``piece_bytes`` each, dealt over the tasks (S9,
    B9). A longer text is cut at separators that stand alone between other characters
    (the separator goes), so that counting the pieces' lines and words gives what
    the whole text's would: no piece starts or ends with an empty word or line. A text
    without such a place stays whole; a NULL text has no row."""
    if not 0 < piece_bytes:
        raise ValueError("piece_bytes must be positive")
    marks = "".join(separators)
    if not marks or not marks.isascii():
        raise ValueError("separators are ASCII characters")
    every = re.escape(marks + "\r\n").encode()
    cut = re.compile(rb"(?<![" + every + rb"])[" + re.escape(marks).encode() + rb"](?![" + every + rb"])")
    workers_can_import(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_buffer().to_pybytes()
                at = 0
                while len(data) - at > piece_bytes:
                    found = cut.search(data, at + piece_bytes)
                    if found is None or found.end() == len(data):
                        break
                    yield _text_row(name, data[at:found.start()])
                    at = found.end()
                yield _text_row(name, data[at:])

    texts = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias(name))
    long = texts.where(F.octet_length(name) > piece_bytes)
    pieces = long.mapInArrow(run, f"{name} string")
    # Pieces leave the task that cut them; short texts stay where they are.
    return texts.where(F.octet_length(name) <= piece_bytes).unionByName(
        pieces.repartition(_shuffle_partitions(df)))


def _text_row(name: str, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary()).cast(pa.string())], names=[name])


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def word_count(lines: DataFrame, col: str = "value", name: str = "word",
               count_name: str = "n", sort: bool = True) -> DataFrame:
    """The reference's basic count: split each line on one space with JVM
    rules (empty tokens between double spaces count too), count, most
    frequent first."""
    counted = (lines.select(F.explode(java_split(F.col(col), literal_regex(" "))).alias(name))
               .groupBy(name).agg(F.count(F.lit(1)).alias(count_name)))
    return counted.orderBy(F.col(count_name).desc(), F.col(name)) if sort else counted


def word_count_filtered(lines: DataFrame, col: str = "value", separators: Iterable[str] = (" ",),
                        stop_words: Iterable[str] = ("the",), name: str = "word",
                        count_name: str = "n") -> DataFrame:
    """Split on any of ``separators``, trim with JVM rules, lower-case, drop
    stop words (trimmed and lower-cased too) and empty tokens, count."""
    stops = sorted({w.strip().lower() for w in stop_words})
    token = F.lower(jvm_trim(F.col("_t")))
    # Empty tokens go anyway, so the JVM's rule on trailing ones needs no work.
    tokens = (lines.select(F.explode(F.split(F.col(col), char_class(list(separators)))).alias("_t"))
              .select(token.alias(name)))
    kept = tokens.where((F.col(name) != "") & ~F.col(name).isin(stops))
    return kept.groupBy(name).agg(F.count(F.lit(1)).alias(count_name))


def word_totals(counts: DataFrame, count_name: str = "n") -> DataFrame:
    """One row: distinct words (what the reference prints as "Total words")
    and the true number of tokens."""
    return counts.agg(F.count(F.lit(1)).alias("distinct_words"),
                      F.sum(count_name).cast("bigint").alias("total_words"))
