"""A general keyed fold (U5, A5): the reference's ``combineByKey`` with any state.

``create`` makes a state from a key's first row, ``merge`` takes in a further row,
``combine`` joins two states, ``finish`` makes the result. States are Python objects:

1. every task folds its rows in memory and writes its states (pickled) whenever it
   holds ``held`` keys: a partial aggregate before any shuffle;
2. the states of a key meet in two steps, first by (key, salt of the task), then by
   key, so a key that every task has seen is combined as a tree, not in one task.
   Rows arrive sorted by key and are combined as they stream past, so a task holds
   one state at a time.

Order is not defined: ``combine`` must be associative and commutative. Sums, means and
extremes are cheaper as Spark aggregates (``aggregates``); this is for states that Spark
has no aggregate for.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.cloudpickle import dumps
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.session import workers_can_import

HELD_KEYS = 50_000
SALTS = 16
_NAN = float("nan")  # one object, so that NaN keys are one key


def _rows(batch: pa.RecordBatch, columns: range) -> Iterator[tuple]:
    lists = [[_NAN if isinstance(v, float) and v != v else v for v in batch.column(c).to_pylist()]
             for c in columns]
    return zip(*lists, strict=True)


def fold_by(df: DataFrame, keys: str | list[str], values: list[str], create: Callable,
            merge: Callable, combine: Callable, result_type: str, finish: Callable = lambda s: s,
            name: str = "value", held: int = HELD_KEYS, salts: int = SALTS) -> DataFrame:
    """``keys`` and ``name`` (of ``result_type``), one row per key: ``create(*values)``,
    ``merge(state, *values)``, ``combine(state, state)``, ``finish(state)``. A NULL key
    is a key, as in ``groupBy``; NULL values reach the functions as None."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    n = len(keys)
    fields = [T.StructField(f"_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    state = T.StructType([*fields, T.StructField("_salt", T.IntegerType()),
                          T.StructField("_state", T.BinaryType())])
    out = T.StructType([*fields, T.StructField("_out", T._parse_datatype_string(result_type))])
    types = [to_arrow_type(f.dataType) for f in fields]
    workers_can_import(df.sparkSession)

    def record(found: dict | list, salt: int) -> pa.RecordBatch:
        rows = list(found.items()) if isinstance(found, dict) else found
        columns = [pa.array([k[i] for k, _ in rows], types[i]) for i in range(n)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([salt] * len(rows), pa.int32()),
             pa.array([dumps(s) for _, s in rows], pa.binary())], names=state.names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, object] = {}
        salt = TaskContext.get().partitionId() % salts
        for batch in batches:
            for key, row in zip(_rows(batch, range(n)), _rows(batch, range(n, batch.num_columns)),
                                strict=True):
                states[key] = merge(states[key], *row) if key in states else create(*row)
                if len(states) >= held:
                    yield record(states, salt)
                    states = {}
        if states:
            yield record(states, salt)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(key, state) of each run of equal keys."""
        key, total = None, None
        for batch in batches:
            for k, (data,) in zip(_rows(batch, range(n)), _rows(batch, range(n + 1, n + 2)), strict=True):
                one = pickle.loads(data)
                if key is not None and k == key:
                    total = combine(total, one)
                    continue
                if key is not None:
                    yield key, total
                key, total = k, one
        if key is not None:
            yield key, total

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in joined(batches):
            rows.append(row)
            if len(rows) >= 1000:
                yield record(rows, 0)
                rows = []
        if rows:
            yield record(rows, 0)

    result = to_arrow_type(out["_out"].dataType)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([k[i] for k, _ in rows], types[i]) for i in range(n)]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([finish(s) for _, s in rows], result)], names=out.names)

        rows: list[tuple] = []
        for row in joined(batches):
            rows.append(row)
            if len(rows) >= 1000:
                yield made(rows)
                rows = []
        if rows:
            yield made(rows)

    key_names = [f.name for f in fields]
    folded = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                       *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)]).mapInArrow(fold, state)
    salted = (folded.repartition(*key_names, "_salt").sortWithinPartitions("_salt", *key_names)
              .mapInArrow(partial, state))
    whole = salted.repartition(*key_names).sortWithinPartitions(*key_names).mapInArrow(last, out)
    return whole.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)],
                        F.col("_out").alias(name))
