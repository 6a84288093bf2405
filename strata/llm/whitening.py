"""Whitening of embeddings by an incremental eigendecomposition.

Every partition keeps a *spectrum*: the number of its vectors, their mean, and the
eigenvalues and eigenvectors of their scatter matrix. A block of vectors is centred
and reduced by a QR factorisation to at most one row per dimension with the same
scatter; each of these rows, and the shift between the two means, is a rank-one
update of the spectrum. An update solves the secular equation of the diagonal plus
the rank-one matrix, after deflation of the components that the update leaves as
they are. Spectra are merged pairwise by the same updates (one per eigenvector of the
other spectrum, one for the means), in rounds of Spark tasks until one is left.

The merged eigenvectors are a basis that is nearly right. A Rayleigh-Ritz step makes
it right to double precision: one more pass takes the exactly centred covariance in
that basis (partial sums per task), and its small eigenproblem turns the basis.

What reaches the driver is of the size of a few d x d matrices, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, stored

COMPONENTS = 8
#: Numbers that a block of vectors holds before it is reduced.
BLOCK_NUMBERS = 1 << 21
#: Spectra that one task merges in a round.
FAN_IN = 16
SCALE, SHIFT = 1024, 100_000  # x = floor(SCALE * c) + SHIFT
_EPS = np.finfo(np.float64).eps


# --- the rank-one update ------------------------------------------------------

def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """(origin, offset) of the eigenvalues of ``diag(d) + rho z z'``: the nearest
    pole's index and the distance from it. ``d`` ascends strictly, no ``z`` is
    zero, ``rho`` > 0. Rational steps, kept inside a shrinking bracket."""
    n = len(d)
    high = np.append(d[1:], d[-1] + rho * float(z @ z))
    gap = high - d
    z2 = z * z
    # The sign at the middle tells which pole is nearer.
    middle = d + gap / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        at_middle = 1 / rho + (z2 / (d[None, :] - middle[:, None])).sum(1)
    right = (at_middle < 0) & (np.arange(n) < n - 1)
    origin = np.where(right, np.arange(n) + 1, np.arange(n))
    poles = d[None, :] - d[origin][:, None]  # poles as seen from the origin
    low = np.where(right, -gap / 2, 0.0)
    top = np.where(right, 0.0, np.where(at_middle < 0, gap, gap / 2))
    low = np.where(~right & (at_middle < 0), gap / 2, low)  # the last root only
    x = (low + top) / 2
    left_pole = np.where(right, -gap, 0.0)
    right_pole = np.where(right, 0.0, gap)
    upto = np.arange(n)[None, :] <= np.arange(n)[:, None]
    with np.errstate(all="ignore"):
        for _ in range(80):
            away = poles - x[:, None]
            term = z2[None, :] / away
            slope = term / away
            f = 1 / rho + term.sum(1)
            done = np.abs(f) <= 4 * n * _EPS * (1 / rho + np.abs(term).sum(1))
            done |= (top - low) <= 2 * _EPS * np.maximum(np.abs(low), np.abs(top))
            if done.all():
                break
            low = np.where(f < 0, x, low)
            top = np.where(f < 0, top, x)
            a_left, a_right = left_pole - x, right_pole - x
            psi = np.where(upto, slope, 0).sum(1)
            phi = slope.sum(1) - psi
            c = f - a_left * psi - a_right * phi
            a = (a_left + a_right) * f - a_left * a_right * (psi + phi)
            b = a_left * a_right * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
            bad = ~np.isfinite(new) | (new <= low) | (new >= top)
            x = np.where(done, x, np.where(bad, (low + top) / 2, new))
    return origin, x


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``q diag(d) q' + v v'``."""
    z = q.T @ v
    rho = float(z @ z)
    if rho == 0.0:
        return d, q
    z = z / np.sqrt(rho)
    d, q = d.copy(), q.copy()
    tolerance = 8 * _EPS * max(float(np.abs(d).max()), rho)
    # Deflation: components that the update hardly touches stay as they are, and of
    # two equal eigenvalues one rotates out of the update's way.
    live = rho * np.abs(z) > tolerance
    last = -1
    for i in np.flatnonzero(live):
        if last >= 0 and d[i] - d[last] <= tolerance:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            z[i], z[last] = r, 0.0
            q[:, [last, i]] = np.column_stack([c * q[:, last] - s * q[:, i],
                                               s * q[:, last] + c * q[:, i]])
            live[last] = False
        last = i
    index = np.flatnonzero(live)
    if len(index):
        dl, zl = d[index], z[index]
        origin, offset = secular_roots(dl, zl, rho)
        # Distances root - pole, exact near the pole; then the z that has exactly
        # these roots, so that the eigenvectors are orthogonal.
        poles = dl[None, :] - dl[origin][:, None]
        away = offset[:, None] - poles  # [root, pole]
        differ = dl[None, :] - dl[:, None]
        np.fill_diagonal(differ, 1.0)
        with np.errstate(divide="ignore"):
            logs = np.log(np.abs(away)).sum(0) - np.log(np.abs(differ)).sum(0)
        zhat = np.sign(zl) * np.exp(0.5 * logs)
        with np.errstate(divide="ignore", invalid="ignore"):
            w = zhat[:, None] / away.T
        exact = ~np.isfinite(w).all(0)  # a root on its pole
        for j in np.flatnonzero(exact):
            w[:, j] = 0.0
            w[origin[j], j] = 1.0
        w /= np.linalg.norm(w, axis=0)
        q[:, index] = q[:, index] @ w
        d[index] = dl[origin] + offset
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """Count, mean and eigendecomposition of the scatter of some vectors."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> None:
        self.n, self.mean, self.values, self.vectors = n, mean, values, vectors

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, n: int, mean: np.ndarray, rows: np.ndarray) -> None:
        """Take in ``n`` vectors around ``mean`` whose scatter is ``rows' rows``."""
        if not n:
            return
        shift = mean - self.mean
        total = self.n + n
        for row in [*rows, shift * np.sqrt(self.n / total * n)]:
            self.values, self.vectors = rank_one(self.values, self.vectors, row)
        self.values = np.maximum(self.values, 0.0)
        self.mean, self.n = self.mean + shift * (n / total), total

    def add_block(self, x: np.ndarray) -> None:
        mean = x.mean(0)
        rows = x - mean
        if len(rows) > rows.shape[1]:
            rows = np.linalg.qr(rows, mode="r")
        self.add(len(x), mean, rows)

    def merge(self, other: Spectrum) -> None:
        self.add(other.n, other.mean, (other.vectors * np.sqrt(other.values)).T)


# --- the vectors --------------------------------------------------------------

def _usable(vector: str) -> Column:
    """Whether a vector exists, has entries and all of them are finite numbers."""
    v = F.col(vector)
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False))),
        F.lit(False))


def whole_numbers(vectors: DataFrame, vector_col: str) -> DataFrame:
    """The usable rows, with ``_x``: the entries as whole numbers."""
    return vectors.where(_usable(vector_col)).withColumn("_x", F.transform(
        vector_col, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT)))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * dim:
        raise ValueError("the vectors differ in length")
    return flat.reshape(-1, dim)


_SPECTRUM = "n long, sums array<long>, mean array<double>, values array<double>, vectors array<double>"
_SUMS = "n long, sums array<double>"


def _record(schema: str, n: int, *arrays: np.ndarray) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([n], pa.int64()), *[pa.array([a.ravel()]) for a in arrays]], names=names)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield (batch.column(0)[i].as_py(), *[c[i].values.to_numpy(zero_copy_only=False)
                                                 for c in batch.columns[1:]])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    """The whole-number vectors, in blocks of about ``BLOCK_NUMBERS`` numbers."""
    held, size, rows = [], 0, max(1, BLOCK_NUMBERS // dim)
    for batch in batches:
        column = batch.column(0)
        for at in range(0, len(column), rows):
            held.append(_matrix(column.slice(at, rows), dim))
            size += len(held[-1])
            if size >= rows:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _in_rounds(partials: DataFrame, merge, schema: str, name: str) -> tuple:
    """The one record that ``merge`` (records of a task to one record) leaves
    after rounds in which a task takes about ``FAN_IN`` records."""
    partials = stored(partials, name)
    count = partials.count()
    while count > 1:
        def task(batches):
            merged = merge(_records(batches))
            if merged is not None:
                yield _record(schema, *merged)

        groups = -(-count // FAN_IN)
        partials = stored(map_batches(partials.repartition(groups), task, schema), name)
        count = partials.count()
    row = partials.first()
    return (row[0], *[np.array(a) for a in row[1:]])


def _spectrum(x: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, exact sums per dimension, eigenvectors) of all vectors."""
    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, sums = Spectrum.empty(dim), np.zeros(dim, np.int64)
        for block in _blocks(batches, dim):
            spectrum.add_block(block.astype(np.float64))
            sums = _exact_sum([sums, block.sum(0)], np.abs(block.sum(0, dtype=np.float64)))
        if spectrum.n:
            yield _record(_SPECTRUM, spectrum.n, sums, spectrum.mean, spectrum.values,
                          spectrum.vectors)

    def merge(records: Iterator[tuple]) -> tuple | None:
        total, sums = Spectrum.empty(dim), np.zeros(dim, np.int64)
        for n, part, mean, values, vectors in records:
            total.merge(Spectrum(n, mean, values, vectors.reshape(dim, dim)))
            sums = _exact_sum([sums, part], np.abs(part.astype(np.float64)))
        return (total.n, sums, total.mean, total.values, total.vectors) if total.n else None

    n, sums, _, _, vectors = _in_rounds(map_batches(x.select("_x"), partition, _SPECTRUM), merge,
                                        _SPECTRUM, "whitening-spectra")
    return n, sums.astype(np.int64), vectors.reshape(dim, dim)


def _exact_sum(parts: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    if (np.abs(parts[0].astype(np.float64)) + size > 2.0 ** 62).any():
        raise OverflowError("the sum of a dimension does not fit 64 bits")
    return reduce(np.add, parts)


def _products(x: DataFrame, mean: np.ndarray, basis: np.ndarray) -> tuple[int, np.ndarray]:
    """(n, sum of y and sum of y y') for the vectors ``y = basis' (x - mean)``, the
    two as the rows of one matrix."""
    dim, k = basis.shape

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((k + 1, k))
        for block in _blocks(batches, dim):
            y = (block - mean) @ basis
            total += np.vstack([y.sum(0), y.T @ y])
            n += len(y)
        if n:
            yield _record(_SUMS, n, total)

    def merge(records: Iterator[tuple]) -> tuple | None:
        held = list(records)  # FAN_IN or so
        return (sum(n for n, _ in held), reduce(np.add, [s for _, s in held])) if held else None

    n, total = _in_rounds(map_batches(x.select("_x"), partition, _SUMS), merge, _SUMS,
                          "whitening-products")
    return n, total.reshape(k + 1, k)


def principal_components(x: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(n, exact sums, eigenvalues falling, eigenvectors as columns) of the
    covariance (divisor n) of the whole-number vectors ``_x``."""
    n, sums, rough = _spectrum(x, dim)
    mean = sums / n
    basis = np.linalg.qr(rough)[0]
    total = _products(x, mean, basis)[1]
    inner = (total[1:] + total[1:].T) / (2 * n) - np.outer(total[0], total[0]) / n ** 2
    values, turn = np.linalg.eigh(inner)  # Rayleigh-Ritz in the basis of the spectra
    vectors = basis @ turn[:, ::-1]
    return n, sums, np.maximum(values[::-1], 0.0), vectors


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component (the first ``components``, or as many
    as there are dimensions): ``id_col``, component (from 1), n, deviation
    (decimal: sum over dimensions of (n x - S)^2), whitened, explained,
    identity_error.

    A vector that is null, empty, or holds null or non-finite entries is dropped, and
    takes no part in the fit. Vectors of different lengths raise, as do entries whose
    x does not fit 64 bits. Null or repeated ids and repeated vectors are rows like
    any other. A component without variance (one vector, equal vectors, dependent
    dimensions) has a null ``whitened`` and does not count for ``identity_error``,
    which is null if none counts; ``explained`` is null without any variance. Other
    columns are ignored, whatever their names; no usable vector gives no row.
    """
    x = whole_numbers(vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v")),
                      "_v").select("_id", "_x")
    schema = T.StructType([
        vectors.schema[id_col], T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])
    first = x.select(F.size("_x")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums, values, basis = principal_components(x, first[0])
    k = min(components, first[0])
    mean, whole = sums / n, float(values.sum())
    spread = values[:k] > first[0] * _EPS * values[0]
    with np.errstate(divide="ignore"):
        axes = basis[:, :k] * np.where(spread, 1 / np.sqrt(values[:k]), 0.0)
    explained = values[:k] / whole if whole > 0 else np.full(k, np.nan)
    error = np.nan
    if spread.any():
        total = _products(x, mean, axes[:, spread])[1] / n
        error = float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(spread.sum())).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _matrix(batch.column(1), len(mean))
            rows = len(block)
            y = (block - mean) @ axes
            y[:, ~spread] = np.nan
            number = np.tile(np.arange(1, k + 1, dtype=np.int32), rows)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(number),
                pa.array(np.full(rows * k, n, np.int64)),
                _deviations(block, n, sums).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(y.ravel(), from_pandas=True),
                pa.array(np.tile(explained, rows), from_pandas=True),
                pa.array(np.full(rows * k, error), from_pandas=True)], names=schema.names)

    return map_batches(x, run, schema)


def _deviations(block: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact at any size."""
    largest = max(n * int(np.abs(block).max(initial=0)), int(np.abs(sums).max()))
    if 2 * largest < 1 << 62 and block.shape[1] * (2 * largest) ** 2 < 1 << 62:
        return pa.array(((n * block - sums) ** 2).sum(1)).cast(pa.decimal128(38, 0))
    if 2 * largest < 1 << 62:
        y = n * block - sums
        if block.shape[1] * int(np.abs(y).max(initial=0)) ** 2 < 1 << 62:
            return pa.array((y ** 2).sum(1)).cast(pa.decimal128(38, 0))
    y = n * block.astype(object) - sums.astype(object)
    return pa.array([int(v) for v in (y * y).sum(1)], pa.decimal128(38, 0))
