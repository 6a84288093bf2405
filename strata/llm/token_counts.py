"""Token counts by a compiled finite-state tokenizer.

The byte-level vocabulary splits a text into pretokens (letters, digits, other
signs, white space, English contractions) and encodes each by itself. The
splitter is compiled into a deterministic transducer over symbol classes; its
boundary transitions emit the token count of the pretoken they end. Texts are
cut into chunks of equal length, each chunk is run from *every* state at once,
the chunks' state maps compose through a parallel prefix scan, and a second run
from the now known states emits the boundaries. Counts per pretoken come from
the tokenizer library, once per distinct pretoken, into a compiled table.
"""

from __future__ import annotations

import functools
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import (SLICE_BYTES, map_batches, mix, quiet_tokenizers, slices, span_hashes,
                     utf8)

# Symbol classes.
LETTER, NUMBER, OTHER, SPACE, GAP, LAST_SPACE, LAST_GAP, SHORT, LONG, END = range(10)
# States: what the pretoken being read is.
IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_GAP, JOINING, LEFT_1, LEFT_2, FRESH = range(8)
STATES, CLASSES = 8, 10
CHUNK = 64
#: Distinct pretokens kept compiled in one Python worker; then the table starts anew.
MAX_COMPILED = 1_000_000
#: New pretokens that the library encodes in one call: bounds its result objects.
ENCODE_AT_ONCE = 4096

#: The characters that \s matches.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def _transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a pretoken starts here" per (state, class).

    LAST_SPACE / LAST_GAP are white space right before a non-white character
    (the one-character look-ahead is folded into the class): a plain space then
    joins the next pretoken, any other white space stands alone. SHORT / LONG
    are apostrophes that open a contraction of one or two letters; they count
    only where a pretoken can start. END separates texts.
    """
    step = np.zeros((STATES, CLASSES), dtype=np.uint8)
    cut = np.ones((STATES, CLASSES), dtype=bool)
    for s in range(STATES):
        for c, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHER)):
            step[s, c] = run
            cut[s, c] = s not in (run, JOINING)
        # White space joins a white-space run, but the last one before a word leaves it.
        for c in (SPACE, GAP):
            step[s, c], cut[s, c] = IN_GAP, s != IN_GAP
        step[s, LAST_SPACE] = JOINING
        step[s, LAST_GAP] = FRESH
        for c, left in ((SHORT, LEFT_1), (LONG, LEFT_2)):
            if s in (IN_OTHER, JOINING):
                step[s, c], cut[s, c] = IN_OTHER, False
            else:
                step[s, c] = left
        step[s, END] = FRESH
    for c in range(CLASSES - 1):
        step[LEFT_2, c], cut[LEFT_2, c] = LEFT_1, False
        step[LEFT_1, c], cut[LEFT_1, c] = FRESH, False
    return step, cut


@functools.cache
def _classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LN":
            out[cp] = LETTER if kind == "L" else NUMBER
    out[WHITE] = GAP
    out[0x20] = SPACE
    return out


def symbols(cps: np.ndarray) -> np.ndarray:
    """Class of every code point, look-ahead folded in; the code point 0x110000
    (one past the last) separates texts."""
    end = cps == 0x110000
    cls = _classes()[np.where(end, 0, cps)]
    cls[end] = END
    white = (cls == SPACE) | (cls == GAP)
    before_word = np.zeros(len(cls), dtype=bool)
    before_word[:-1] = white[:-1] & ~white[1:] & ~end[1:]
    cls[before_word & (cls == SPACE)] = LAST_SPACE
    cls[before_word & (cls == GAP)] = LAST_GAP
    at = np.flatnonzero(cps == ord("'"))
    if len(at):
        pad = np.append(cps, [0x110000, 0x110000])
        one, two = pad[at + 1], pad[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(at), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        cls[at[short]] = SHORT
        cls[at[long]] = LONG
    return cls


def pretoken_starts(cps: np.ndarray) -> np.ndarray:
    """Whether a pretoken starts at each code point, by the chunked transducer."""
    step, cut = _transducer()
    n = len(cps)
    k = -(-n // CHUNK)
    cls = np.full(k * CHUNK, END, dtype=np.uint8)
    cls[:n] = symbols(cps)
    cls = np.ascontiguousarray(cls.reshape(k, CHUNK).T)
    flat, marks = step.ravel(), cut.ravel()
    # Each chunk from every state: its state map.
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (k, STATES)).copy()
    for i in range(CHUNK):
        maps = flat[maps * np.uint8(CLASSES) + cls[i][:, None]]
    # Inclusive prefix composition of the maps (Hillis-Steele).
    d = 1
    while d < k:
        later = np.take_along_axis(maps[d:], maps[:-d], axis=1)
        maps = np.concatenate([maps[:d], later])
        d *= 2
    state = np.full(k, FRESH, dtype=np.uint8)
    state[1:] = maps[:-1, FRESH]
    out = np.empty((CHUNK, k), dtype=bool)
    for i in range(CHUNK):
        at = state * np.uint8(CLASSES) + cls[i]
        out[i] = marks[at]
        state = flat[at]
    return out.T.reshape(-1)[:n]


class HashTable:
    """Open addressing from nonzero 64-bit hashes to their numbers 0, 1, ..."""

    def __init__(self, bits: int = 18) -> None:
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.numbers = np.zeros(1 << bits, dtype=np.int32)
        self.size = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of every hash, or -1."""
        mask = np.int64(len(self.keys) - 1)
        at = hashes.view(np.int64) & mask
        seen = self.keys[at]
        out = np.where(seen == hashes, self.numbers[at], -1)
        left = np.flatnonzero((seen != hashes) & (seen != 0))
        at = at[left]
        while len(left):
            at = (at + 1) & mask
            seen = self.keys[at]
            match = seen == hashes[left]
            out[left[match]] = self.numbers[at[match]]
            go = ~match & (seen != 0)
            left, at = left[go], at[go]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct hashes that are not in the table yet."""
        old = None
        bits = len(self.keys).bit_length() - 1
        while 2 * (self.size + len(hashes)) > (1 << bits):
            bits += 1
        if (1 << bits) > len(self.keys):
            used = np.flatnonzero(self.keys)
            old = self.keys[used], self.numbers[used]
            self.keys = np.zeros(1 << bits, dtype=np.uint64)
            self.numbers = np.zeros(1 << bits, dtype=np.int32)
            self._place(*old)
        self._place(hashes, np.arange(self.size, self.size + len(hashes), dtype=np.int32))
        self.size += len(hashes)

    def _place(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = np.int64(len(self.keys) - 1)
        at = hashes.view(np.int64) & mask
        while len(hashes):
            free = np.flatnonzero(self.keys[at] == 0)
            self.keys[at[free]] = hashes[free]  # of several for one slot the last stays
            self.numbers[at[free]] = numbers[free]
            go = self.keys[at] != hashes
            hashes, numbers, at = hashes[go], numbers[go], (at[go] + 1) & mask


class CompiledCounts:
    """Pretoken hash -> token count (and ids), filled from the tokenizer library."""

    def __init__(self, path: str) -> None:
        quiet_tokenizers()
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.tok.encode_special_tokens = True  # they are cut out before
        self._empty()
        self.values = mix(np.arange(0x110001, dtype=np.uint64) + np.uint64(0x3C6EF372FE94F82B))

    def _empty(self) -> None:
        self.table, self.counts = HashTable(), np.zeros(0, np.int64)
        self.begin, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def lookup(self, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The table's place of every pretoken."""
        h = span_hashes(self.values[cps], starts, ends) | np.uint64(1 << 63)
        if self.table.size > MAX_COMPILED:
            self._empty()
        known = self.table.find(h)
        missing = np.flatnonzero(known < 0)
        if len(missing):
            new, first = np.unique(h[missing], return_index=True)
            where = missing[first]
            spans = [cps[a:b].tobytes().decode("utf-32-le")
                     for a, b in zip(starts[where], ends[where], strict=True)]
            ids = [e.ids for k in range(0, len(spans), ENCODE_AT_ONCE)
                   for e in self.tok.encode_batch_fast(spans[k:k + ENCODE_AT_ONCE],
                                                       add_special_tokens=False)]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(counts) - counts])
            self.ids = np.concatenate(
                [self.ids, np.fromiter(itertools.chain.from_iterable(ids), np.uint32)])
            self.counts = np.concatenate([self.counts, counts])
            self.table.add(new)
            known[missing] = self.table.find(h[missing])
        return known

    def pretokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, table place) of every pretoken in order; a special string is
        the place -1 - its number."""
        parts, owner = texts, np.arange(len(texts))
        marks = np.zeros(0, np.int64)  # part numbers that a special string follows
        kinds = np.zeros(0, np.int64)
        for number, special in enumerate(self.special):
            if any(special in t for t in parts):
                cut = [t.split(special) for t in parts]
                sizes = np.fromiter(map(len, cut), np.int64, len(cut))
                last = np.cumsum(sizes) - 1
                inner = np.ones(int(sizes.sum()), dtype=bool)
                inner[last] = False
                new = np.flatnonzero(inner)
                marks = np.concatenate([last[marks], new])
                kinds = np.concatenate([kinds, np.full(len(new), number)])
                owner = np.repeat(owner, sizes)
                parts = [p for c in cut for p in c]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        begins = np.cumsum(lengths + 1) - lengths - 1
        cps = np.full(int((lengths + 1).sum()), 0x110000, dtype=np.uint32)
        inside = np.ones(len(cps), dtype=bool)
        inside[begins + lengths] = False
        cps[inside] = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)
        starts = np.flatnonzero(pretoken_starts(cps))
        ends = np.append(starts[1:], len(cps))
        real = inside[starts]
        starts, ends = starts[real], ends[real]
        places = self.lookup(cps, starts, ends) if len(starts) else np.zeros(0, np.int64)
        part = np.searchsorted(begins, starts, side="right") - 1
        if len(marks):
            order = np.argsort(np.concatenate([2 * part, 2 * marks + 1]), kind="stable")
            places = np.concatenate([places, -1 - kinds])[order]
            part = np.concatenate([part, marks])[order]
        return owner[part], places

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; special strings are one token each."""
        row, places = self.pretokens(texts)
        if not len(places):
            return np.zeros(len(texts), np.int64)
        counts = np.where(places < 0, 1, self.counts[places])
        return np.bincount(row, counts, len(texts)).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and each text's bounds in them."""
        row, places = self.pretokens(texts)
        if not len(places):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        special = places < 0
        counts = np.where(special, 1, self.counts[places])
        ends = np.cumsum(counts)
        take = np.repeat(self.begin[places] - (ends - counts), counts) + np.arange(ends[-1])
        at = ends[special] - 1
        take[at] = 0
        ids = self.ids[take] if len(self.ids) else np.zeros(len(take), np.uint32)
        ids[at] = [self.tok.token_to_id(self.special[-1 - p]) for p in places[special]]
        per_text = np.bincount(row, counts, len(texts)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


def texts_of(data: np.ndarray, bounds: np.ndarray) -> list[str]:
    return [data[a:b].tobytes().decode("utf-8", "replace")
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@functools.lru_cache(maxsize=2)
def compiled(path: str) -> CompiledCounts:
    """One table per tokenizer file and Python worker."""
    return CompiledCounts(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``id_col``, n_bytes (UTF-8), n_tokens,
    over_limit (more than ``limit`` tokens).

    Null text counts as empty (0 bytes, 0 tokens). Repeated rows and null ids
    are kept as they are; other columns are ignored; an empty table gives an
    empty result. Works row by row without a shuffle: a task holds one Arrow
    batch, and vectors of one slice of it.
    """
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = compiled(tokenizer_path)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            counts = [np.zeros(0, np.int64)]
            for a, b in slices(offsets, SLICE_BYTES):
                counts.append(table.count(texts_of(data, offsets[a:b + 1])))
            n = np.concatenate(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                names=schema.names)

    return map_batches(docs.select(id_col, text_col), run, schema)
