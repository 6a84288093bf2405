"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, workers_can_import

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Text bytes that one vectorised step works on; longer texts get a step of their own.
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given table ``name``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def sample_limit(rows: int, wanted: int) -> int | None:
    """A 64-bit hash below this (as a signed number) has a share of about ``wanted``
    of ``rows``; None takes all. Exact at any number of rows."""
    return None if rows <= wanted else (wanted << 64) // rows - (1 << 63)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read again: cuts the
    lineage, survives lost executors and keeps Python stages from running twice."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]],
                                             Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` where local workers can import this package
    and every task gives its free memory back: workers live on, and would keep
    the largest slice's memory beside the JVM's."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    workers_can_import(df.sparkSession)
    return df.mapInArrow(task, schema)


def quiet_tokenizers() -> None:
    """Spark runs a task per core: the tokenizer library gets no threads of its
    own, whose buffers would stay with the worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


# --- vectorised words -------------------------------------------------------

def word_bytes(pattern: str) -> np.ndarray:
    """Which of the 256 byte values belong to a word. ``alnum``: digits, letters
    and every byte of a non-ASCII character; ``space``: all but ASCII white space."""
    b = np.arange(256)
    if pattern == "alnum":
        return ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x61) & (b <= 0x7A)) | \
            ((b >= 0x41) & (b <= 0x5A)) | (b >= 0x80)
    if pattern == "space":
        return ~((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))
    raise ValueError(f"unknown word pattern {pattern!r}")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    size = 1 << max(SLICE_BYTES.bit_length(), (n + 1).bit_length())
    return (_powers if size <= 4 * SLICE_BYTES else _powers.__wrapped__)(base, size)[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of ``values`` (random numbers for symbols),
    the same for equal spans wherever they stand."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(_INVERSE, len(values) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _symbols() -> np.ndarray:
    lower = np.arange(256)
    lower[0x41:0x5B] += 32
    return mix(lower.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))


SYMBOLS = _symbols()  # one random number per byte, A-Z as a-z


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow text column (null as empty) and the rows' offsets."""
    col = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    return np.frombuffer(data or b"", dtype=np.uint8), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or one longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_spans(data: np.ndarray, bounds: np.ndarray, member: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``; none crosses a row's ``bounds``."""
    inside = member[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    return (np.flatnonzero(inside & (~before | edge[:-1])),
            np.flatnonzero(inside & (~after | edge[1:])) + 1)


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the rows in ``data`` (``offsets``: row bounds) and
    the rows' bounds in the list of words. A-Z count as a-z."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    data, bounds = data[lo:hi], offsets - lo
    starts, ends = word_spans(data, bounds, member)
    hashes = span_hashes(SYMBOLS[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(starts, bounds)
