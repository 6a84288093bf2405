"""Toxicity by a counterfactually regularised classifier.

A sparse logistic model over the words of a text, their beginnings and repeated
beginnings is fitted on a bounded sample of labelled documents, over all features that
are frequent and telling enough. Its counterfactuals: a labelled text that names a group
is also taken with the name swapped for others of its kind, and every labelled text
that names none is taken twice more, with the names of two groups of one kind put
in and the label kept. The fit learns from the latter, and adds a penalty on the
squared change of the score between the members of a pair, so that a neutral mention
of a group raises no alarm by the company it kept in the sample. Every whole text is
then scored where it lies, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (SYMBOLS, map_batches, mix, sample_limit, slices, span_hashes, stored,
                     text_of, utf8, word_bytes, word_spans, words)

#: Bound of the labelled sample (documents).
MAX_LABELLED = 20_000
#: Bytes of the word beginnings that are features beside the whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
FOLDS = 5
MIN_DOCS, MIN_STRENGTH = 4, 1.5
SPARSITY, RIDGE, FAIRNESS = 4e-4, 1e-4, 1.0
#: Weight of a text with a name put in, beside the text itself.
INSERTED = 0.5
ITERATIONS = 150
ALNUM = word_bytes("alnum")

#: Names of groups; within a line any may stand for any other.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "refugees", "natives"),
    ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
)


def _features(data: np.ndarray, offsets: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, word, feature) of every word and word beginning, and the rows."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    data, bounds = data[lo:hi], offsets - lo
    starts, ends = word_spans(data, bounds, ALNUM)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none.astype(np.int64), none, none, len(bounds) - 1
    row = np.searchsorted(bounds, starts, side="right") - 1
    # One call hashes the words and their beginnings alike.
    keep = [np.flatnonzero(ends - starts > k) for k in BEGINNINGS]
    first = np.concatenate([starts, *(starts[i] for i in keep)])
    last = np.concatenate([ends, *(starts[i] + k for i, k in zip(keep, BEGINNINGS, strict=True))])
    feature = span_hashes(SYMBOLS[data], first, last)
    word = np.concatenate([feature[:len(starts)], *(feature[i] for i in keep)])
    feature[len(starts):] = mix(feature[len(starts):] + np.uint64(1))
    return np.concatenate([row, *(row[i] for i in keep)]), word, feature, len(bounds) - 1


def _distinct(row: np.ndarray, word: np.ndarray, feature: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, whether two different words have it), each pair once."""
    order = np.lexsort((word, feature, row))
    row, word, feature = row[order], word[order], feature[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])
    other = np.zeros(len(row), dtype=bool)
    other[1:] = ~new[1:] & (word[1:] != word[:-1])
    return row[new], feature[new], np.logical_or.reduceat(other, np.flatnonzero(new)) \
        if len(row) else other


@dataclass(frozen=True)
class Model:
    """Features (sorted), their weights, the weights of having each twice, the bias."""

    features: np.ndarray
    weights: np.ndarray
    twice: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, word, feature, n = _features(data, offsets)
        z = np.full(n, self.bias)
        if len(row) and len(self.features):
            at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            hit = self.features[at] == feature
            row, at, two = _distinct(row[hit], word[hit], at[hit])
            z += np.bincount(row, self.weights[at] + self.twice[at] * two, n)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _hashes(terms: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array(terms, pa.string()))
    return words(data, offsets, ALNUM)[0]


def _sample(docs: DataFrame, labelled: DataFrame, text_col: str) -> DataFrame:
    """(order, toxic, once, twice): the features of each sampled document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            once, twice = [], []
            for a, b in slices(offsets):
                row, word, feature, n = _features(data, offsets[a:b + 1])
                row, feature, two = _distinct(row, word, feature)
                feature = feature.view(np.int64)
                cuts = np.searchsorted(row, np.arange(n + 1))
                for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                    once.append(feature[x:y])
                    twice.append(feature[x:y][two[x:y]])
            lists = [pa.array(v, pa.list_(pa.int64())) for v in (once, twice)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *lists],
                                             names=["order", "toxic", "once", "twice"])

    rows = docs.join(F.broadcast(labelled), "_id").select(  # at most MAX_LABELLED rows or so
        text_of(text_col).alias("text"), "order", "toxic")
    return map_batches(rows, run, "order long, toxic int, once array<long>, twice array<long>")


def _chosen(sample: DataFrame, docs: int, positives: int) -> DataFrame:
    """(feature, two) of all that occur in ``MIN_DOCS`` documents and tell the labels
    apart by ``MIN_STRENGTH``, and of the identity terms."""
    share = positives / docs
    strength = (F.abs(F.col("t") - F.col("c") * share)
                / F.sqrt(F.col("c") * (share * (1 - share))))
    found = (_exploded(sample).groupBy("feature", "two")
             .agg(F.count("*").alias("c"), F.sum("toxic").alias("t"))
             .filter(F.col("c") >= MIN_DOCS).withColumn("strength", strength)
             .filter(F.col("strength") > MIN_STRENGTH))
    terms = _hashes([t for line in IDENTITY_TERMS for t in line]).view(np.int64).tolist()
    named = sample.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(t) for t in terms])).alias("feature"), F.lit(False).alias("two"))
    return found.select("feature", "two").union(named).distinct()


def _exploded(sample: DataFrame) -> DataFrame:
    one = sample.select("order", "toxic", F.explode("once").alias("feature"),
                        F.lit(False).alias("two"))
    return one.union(sample.select("order", "toxic", F.explode("twice").alias("feature"),
                                   F.lit(True).alias("two")))


class _Rows:
    """A sparse matrix by rows; without values all are 1."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray | None, shape) -> None:
        self.row, self.col, self.value, self.shape = row, col, value, shape

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self._times(w[self.col]), self.shape[0])

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self._times(v[self.row]), self.shape[1])

    def _times(self, of: np.ndarray) -> np.ndarray:
        return of if self.value is None else of * self.value


def _term_features(feature: np.ndarray, two: np.ndarray) -> list[list[tuple[int, ...]]]:
    """Per line of ``IDENTITY_TERMS`` the terms' features: the places of the whole
    word, then of its beginnings, as far as the model has them."""
    place = {int(h): i for i, h in enumerate(feature) if not two[i]}
    lines = []
    for line in IDENTITY_TERMS:
        own = []
        for term in line:
            hashes = _features(*utf8(pa.array([term], pa.string())))[2].tolist()  # whole word first
            if hashes[0] in place:
                own.append(tuple(place[h] for h in hashes if h in place))
        lines.append(own)
    return lines


def _swaps(x: _Rows, lines: list[list[tuple[int, ...]]]) -> _Rows:
    """One row per labelled text and swap of a group's name for another of its
    line: -1 for the features (the word and its beginnings) that go, +1 for
    those that come."""
    of_term = {t[0]: frozenset(t) for line in lines for t in line}
    peers: dict[int, list[int]] = {}
    for line in lines:
        for t in line:
            peers.setdefault(t[0], []).extend(o[0] for o in line if o is not t)
    named = np.isin(x.col, np.array(sorted(peers), np.int64))
    mentions = np.isin(x.row, np.unique(x.row[named]))
    held: dict[int, set[int]] = {}
    for r, c in zip(x.row[mentions].tolist(), x.col[mentions].tolist(), strict=True):
        held.setdefault(r, set()).add(c)
    row, col, value, n = [], [], [], 0
    for _, own in sorted(held.items()):
        for i in sorted(own & peers.keys()):
            for j in peers[i]:
                gone = of_term[i] - of_term[j]
                come = of_term[j] - of_term[i] - own
                row += [n] * (len(gone) + len(come))
                col += [*sorted(gone), *sorted(come)]
                value += [-1.0] * len(gone) + [1.0] * len(come)
                n += 1
    return _Rows(np.array(row, np.int64), np.array(col, np.int64), np.array(value, np.float64),
                 (n, x.shape[1]))


class _Inserted:
    """The texts that name no group, each with the names of two groups of one line
    put in: the text's own score and the score of the name, kept apart, as every text
    takes one of few names."""

    def __init__(self, x: _Rows, lines: list[list[tuple[int, ...]]]) -> None:
        pairs = [(a, b) for line in lines for a in line for b in line if a[0] < b[0]]
        terms = sorted({t for pair in pairs for t in pair})
        number = {t: i for i, t in enumerate(terms)}
        named = np.zeros(x.shape[0], bool)
        named[x.row[np.isin(x.col, np.array([t[0] for t in terms], np.int64))]] = True
        self.texts = np.flatnonzero(~named) if pairs else np.zeros(0, np.int64)
        # Dealt in turn within each label, so that no name goes with one label.
        self.pairs = np.array([(number[a], number[b]) for a, b in pairs], np.int64).reshape(-1, 2)
        self.turn = np.arange(len(self.texts)) % max(1, len(pairs))
        self.terms = _Rows(np.repeat(np.arange(len(terms)), [len(t) for t in terms]),
                           np.array([i for t in terms for i in t], np.int64),
                           np.ones(sum(map(len, terms))), (len(terms), x.shape[1]))

    def deal(self, labels: np.ndarray) -> None:
        self.turn[np.argsort(labels[self.texts], kind="stable")] = \
            np.arange(len(self.texts)) % max(1, len(self.pairs))

    def errors(self, z: np.ndarray, w: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(per text, per feature): the gradient of the loss of all texts with a name."""
        per_text, per_term = np.zeros(len(z)), np.zeros(self.terms.shape[0])
        scores = self.terms.dot(w)
        for side in (0, 1):
            name = self.pairs[self.turn, side]
            e = 1 / (1 + np.exp(-(z[self.texts] + scores[name]))) - y[self.texts]
            per_text[self.texts] += INSERTED * e
            per_term += INSERTED * np.bincount(name, e, len(per_term))
        return per_text, self.terms.back(per_term)

    def curvature(self, z: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``errors`` of the quadratic bound: the scores themselves for errors."""
        per_text, per_term = np.zeros(len(z)), np.zeros(self.terms.shape[0])
        scores = self.terms.dot(v)
        for side in (0, 1):
            name = self.pairs[self.turn, side]
            e = z[self.texts] + scores[name]
            per_text[self.texts] += INSERTED * e
            per_term += INSERTED * np.bincount(name, e, len(per_term))
        return per_text, self.terms.back(per_term)

    def swaps(self) -> _Rows:
        """The change between the two members of every pair, one row per text."""
        where = [np.flatnonzero(self.terms.row == t) for t in range(self.terms.shape[0])]
        row, col, value = [], [], []
        for n, k in enumerate(self.turn.tolist()):
            for side, sign in ((0, -1.0), (1, 1.0)):
                own = self.terms.col[where[self.pairs[k, side]]].tolist()
                row += [n] * len(own)
                col += own
                value += [sign] * len(own)
        return _Rows(np.array(row, np.int64), np.array(col, np.int64), np.array(value, np.float64),
                     (len(self.turn), self.terms.shape[1]))


def _both(a: _Rows, b: _Rows) -> _Rows:
    return _Rows(np.concatenate([a.row, b.row + a.shape[0]]), np.concatenate([a.col, b.col]),
                 np.concatenate([a.value, b.value]), (a.shape[0] + b.shape[0], a.shape[1]))


def fit(row: np.ndarray, col: np.ndarray, labels: np.ndarray, feature: np.ndarray,
        two: np.ndarray, fairness: float = FAIRNESS) -> Model:
    """The model for documents ``row`` that have the features ``col`` (numbers
    into ``feature`` and ``two``); both labels occur. ``fairness`` 0 fits without
    counterfactuals."""
    x = _Rows(row, col, None, (len(labels), len(feature)))
    lines = _term_features(feature, two) if fairness else []
    inserted = _Inserted(x, lines)
    inserted.deal(labels)
    swap = _both(_swaps(x, lines), inserted.swaps())
    identity = np.isin(feature, _hashes([t for line in IDENTITY_TERMS for t in line])) & ~two
    w, b = _descend(x, labels, swap, inserted, fairness, SPARSITY)
    live = (w != 0) | identity
    # What has no weight by now takes no part in the rest.
    held = live[x.col]
    x = _Rows(row[held], col[held], None, x.shape)
    w, b = _descend(x, labels, swap, inserted, fairness, 0.0, w, b, live)
    used = np.unique(feature[live])
    return Model(used, _weights(used, feature[live & ~two], w[live & ~two]),
                 _weights(used, feature[live & two], w[live & two]), float(b))


def _weights(features: np.ndarray, vocabulary: np.ndarray, w: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.zeros(len(features))
    order = np.argsort(vocabulary)
    vocabulary, w = vocabulary[order], w[order]
    at = np.minimum(np.searchsorted(vocabulary, features), len(vocabulary) - 1)
    return np.where(vocabulary[at] == features, w[at], 0.0)


def _descend(x: _Rows, y: np.ndarray, swap: _Rows, inserted: _Inserted, fairness: float,
             sparsity: float, w: np.ndarray | None = None, b: float | None = None,
             live: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on mean logistic loss (of the texts, and by
    ``INSERTED`` with the names put in) + ridge + fairness * mean squared score change
    over the swaps + sparsity * |w|."""
    n = len(y)
    if w is None:
        w, b = np.zeros(x.shape[1]), float(np.log(y.mean() / (1 - y.mean())))
    m = max(1, swap.shape[0])
    # The curvature bound, by power iteration.
    v, big = np.ones(x.shape[1] + 1), 1.0
    for _ in range(12):
        z = x.dot(v[:-1]) + v[-1]
        more, names = inserted.curvature(z, v[:-1])
        u = np.append(x.back(z + more) + names, (z + more).sum()) / (4 * n)
        u[:-1] += 2 * fairness * swap.back(swap.dot(v[:-1])) / m
        big = max(float(np.linalg.norm(u)), 1e-9)
        v = u / big
    step = 1 / (1.1 * big + RIDGE)
    yw, yb, t = w.copy(), b, 1.0
    for _ in range(ITERATIONS if live is None else 3 * ITERATIONS):
        z = x.dot(yw) + yb
        e = 1 / (1 + np.exp(-z)) - y
        more, names = inserted.errors(z, yw, y)
        e += more
        g = (x.back(e) + names) / n + RIDGE * yw
        g += 2 * fairness * swap.back(swap.dot(yw)) / m
        new = yw - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * sparsity, 0)
        if live is not None:
            new = np.where(live, new, 0)
        nb = yb - step * e.sum() / n
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        yw, yb = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = new, nb, t2
    return w, b


def held_out(id_col: Column) -> Column:
    """Whether a document is outside the part that labels are learnt from."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_labelled: int = MAX_LABELLED, fairness: float = FAIRNESS) -> Model:
    """A model from the labelled documents that are not held out, of these an
    id-hash sample of about ``max_labelled``. Rows without id or label teach
    nothing; of several labels of one id the largest holds, and rows of one id
    teach as one text. Without both labels the model has no features and says
    the label there is, or 0. A sample that misses every one of many labels raises."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()
                           & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("_id")).agg((F.max("toxic") > 0).cast("int")
                                                      .alias("toxic")))
    total = known.count()
    limit = sample_limit(total, max_labelled)
    known = known.withColumn("order", F.xxhash64("_id"))
    if limit is not None:
        known = known.filter(F.col("order") < limit)
        if known.isEmpty():
            raise ValueError(f"no label in a sample of {max_labelled} of {total}")
    sample = stored(_sample(docs.select(F.col(id_col).alias("_id"), text_col),
                            known, text_col), "toxicity-sample")
    seen = sample.select("order", "toxic").distinct().orderBy("order").toArrow()
    labels_seen = seen.column("toxic").to_numpy().astype(np.float64)
    positives = int(labels_seen.sum())
    if not 0 < positives < len(labels_seen):
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 3.0 if positives else -3.0)
    # What the sample's texts hold of them: bounded with the sample.
    chosen = stored(_chosen(sample, len(labels_seen), positives), "toxicity-features")
    kinds = chosen.orderBy("feature", "two").toArrow()
    feature = kinds.column("feature").to_numpy()
    two = kinds.column("two").to_numpy()
    numbered = chosen.sparkSession.createDataFrame(kinds.append_column(
        "col", pa.array(np.arange(len(feature), dtype=np.int32))))
    has = (_exploded(sample).join(F.broadcast(numbered), ["feature", "two"])
           .select("order", "col").distinct().toArrow())
    # In order of (document, feature), in place: these are the fit's largest arrays.
    place = np.searchsorted(seen.column("order").to_numpy(), has.column("order").to_numpy())
    place *= len(feature)
    place += has.column("col").to_numpy()
    del has
    place.sort()
    row = place // len(feature)
    place -= row * len(feature)
    return fit(row, place, labels_seen, feature.view(np.uint64), two, fairness)


def score_rows(docs: DataFrame, model: Model, text_col: str = "text",
               score_col: str = "score") -> DataFrame:
    """``docs`` row by row, all columns, with ``score_col`` (0 to 1)."""
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    at = docs.columns.index(text_col)
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            scores = [bc.value.scores(data, offsets[a:b + 1]) for a, b in slices(offsets)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate([np.zeros(0), *scores]))],
                names=schema.names)

    return map_batches(docs, run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per document row: ``id_col``, held_out, score, predicted (1 from
    a score of 0.5).

    Null and empty texts get the model's bias as score. Repeated rows are scored
    each; a null id counts as the empty text for held_out. Without labels of
    both kinds all scores are alike. Other columns are ignored; an empty table
    gives an empty result.
    """
    model = train(docs, labels, id_col, text_col, max_labelled)
    scored = score_rows(docs.select(id_col, text_col), model, text_col, "score")
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more; all columns as they were. Null and
    empty texts get the model's bias as score; repeated rows go or stay together; null
    ids teach nothing and are scored like any other; without labels of both kinds all
    rows are scored alike; an empty table stays empty."""
    model = train(docs, labels, id_col, text_col)
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return score_rows(docs, model, text_col, name).filter(F.col(name) < 0.5).drop(name)
