"""Phrase collocations from stripes.

A *stripe* is a prefix (no word, one, two or three words) with a counter of the words
that follow it. Tasks count stripes in memory, several slices of text at a time, and
write them as (lang, prefix, words, counts): the prefix once, its words beside it. All
stripes of a prefix meet by a shuffle of stripes and are added word by word. A stripe
is dealt by its prefix and, where many words follow few prefixes (none, or one
word), by a piece of the next word's hash, so no prefix is one task's alone. A row of
the shuffle holds a task's stripes of one deal.

Everything is read from the merged stripes: an entry is a phrase's frequency (its
extension of the prefix), the entries of the empty prefix are the words and their total
is n, an entry of a shorter stripe is the total of a longer prefix, and the largest
entries of the stripes of a phrase, and of the phrases that it ends, subsume it.

Two passes before keep the stripes small. The first adds up the occurrences of words
and of pairs of words in 2**27 hashed counters, whose bits (reached ``min_count`` or
not, 16 MB at every size of the input) go to all tasks; the second those of three and
four words whose pairs passed. A frequent phrase holds only frequent words and shorter
phrases, so what the bits rule out can't be a candidate or a part of one. What shares a
counter with something frequent is counted for nothing; where a larger input fills
the counters more is, but nothing is lost. Within a task words are told apart by
64-bit hashes; between tasks by their texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import (SYMBOLS, ascii_lower, map_batches, mix, slices, span_hashes, stored, text_of,
                     utf8, word_spans)

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
CHUNK_BITS, CHUNKS = 16, 1 << 11  # counters of a chunk (as a power of two), chunks
#: Hashed occurrences that a task holds before it writes them.
HELD_HASHES = 1 << 21
#: Entries of stripes that a task holds before it writes them, and deals of stripes.
HELD_ENTRIES, DEALS = 1 << 20, 1 << 12
SALTS = 16  # of the words that are parts of phrases
SEGMENTS = {0: 256, 1: 16}  # pieces of the stripes of no word and of one word

_bytes = np.arange(256)
_WORD = ~np.isin(_bytes, list(b" \t.,;:!?\n\v\f\r"))
_BREAK = np.isin(_bytes, list(b".,;:!?\n\v\f\r"))
_LOWER = _bytes.astype(np.uint8)
_LOWER[0x41:0x5B] += 32
_PAIR = np.uint64(0x9FB21C651E98DF25)


class _Words:
    """The words of some rows: hashes, and which pairs of neighbours share a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray) -> None:
        lo, hi = int(offsets[0]), int(offsets[-1])
        self.data, bounds = data[lo:hi], offsets - lo
        self.starts, self.ends = word_spans(self.data, bounds, _WORD)
        self.hash = (span_hashes(SYMBOLS[self.data], self.starts, self.ends)
                     if len(self.starts) else np.zeros(0, np.uint64))
        row = np.repeat(np.arange(len(bounds) - 1),
                        np.diff(np.searchsorted(self.starts, bounds)))
        self.row_lang = lang  # a number per language, the same in all tasks
        self.lang = lang[row]
        breaks = np.concatenate([[0], np.cumsum(_BREAK[self.data])])
        self.joined = ((breaks[self.starts[1:]] == breaks[self.ends[:-1]])
                       & (row[1:] == row[:-1])) if len(row) else np.zeros(0, bool)
        self.own = mix(self.hash ^ self.lang)  # a word of a language

    def phrases(self, rule: Callable[[int, np.ndarray], np.ndarray] | None = None
                ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For 1 to ``MAX_WORDS`` words: (m, hash, good), one per place of a phrase's
        first word; good are the phrases within a piece whose parts ``rule`` (m,
        hashes) lets pass, and which it lets pass themselves."""
        key, good = self.own, np.ones(len(self.own), bool)
        for m in range(1, MAX_WORDS + 1):
            if m > 1:  # the phrase of m - 1 words at i, that at i + 1, and one more word
                good = good[:-1] & good[1:] & (self.joined[:len(key) - 1] if m == 2 else True)
                key = mix(key[:-1] * _PAIR + self.own[m - 1:])
            if not good.any():
                return
            if rule is not None:
                good = good.copy()
                good[good] = rule(m, key[good])
            yield m, key, good

    def strings(self, place: np.ndarray) -> list[str]:
        """The words at ``place``, A-Z in lower case."""
        return [_LOWER[self.data[a:b]].tobytes().decode()
                for a, b in zip(self.starts[place].tolist(), self.ends[place].tolist(), strict=True)]


def _words_of(batch: pa.RecordBatch) -> Iterator[tuple[_Words, pa.Array]]:
    """The words of a batch (text, lang) slice by slice, with the rows' languages."""
    data, offsets = utf8(batch.column(0))
    langs = pc.fill_null(batch.column(1).cast(pa.large_string()), "und")
    coded = langs.dictionary_encode()
    names, at = utf8(coded.dictionary)
    numbers = span_hashes(mix(names.astype(np.uint64) + np.uint64(1)), at[:-1], at[1:])
    row = coded.indices.to_numpy()
    for a, b in slices(offsets):
        yield _Words(data, offsets[a:b + 1], numbers[row[a:b]]), langs.slice(a, b - a)


def _rule(bits: list[np.ndarray]) -> Callable[[int, np.ndarray], np.ndarray]:
    """Whether the counters of phrases reached their number: ``bits`` of one and two
    words, and of three and four; without bits all pass."""
    def passes(m: int, hashes: np.ndarray) -> np.ndarray:
        if (m > 2) >= len(bits):
            return np.ones(len(hashes), bool)
        place = _place(hashes)
        byte = bits[m > 2][place >> np.uint32(3)]
        return (byte >> (7 - (place & np.uint32(7))).astype(np.uint8) & 1).astype(bool)

    return passes


def _counters(texts: DataFrame, min_count: int, known: list) -> bytes:
    """The bits of the hashed counters that reach ``min_count``: of one and two words
    without ``known`` bits (broadcast), else of three and four."""
    sizes = (3, 4) if known else (1, 2)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        rule = _rule([np.frombuffer(b.value, np.uint8) for b in known])
        for batch in batches:
            for words, _ in _words_of(batch):
                for m, key, good in words.phrases(rule):
                    if m in sizes:
                        held.append(_place(key[good]))
                        size += len(held[-1])
                    if m == sizes[-1]:
                        break
                if size >= HELD_HASHES:
                    yield _packed(held)
                    held, size = [], 0
        if size:
            yield _packed(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, total = -1, np.zeros(1 << CHUNK_BITS, np.int64)

        def bits() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()),
                 pa.array([np.packbits(total >= min_count).tobytes()], pa.binary())],
                names=["chunk", "bits"])

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py() != chunk:
                    if chunk >= 0:
                        yield bits()
                    chunk = batch.column(0)[i].as_py()
                    total[:] = 0
                at = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint16)
                total[at] += np.frombuffer(batch.column(2)[i].as_buffer(), np.uint32)
        if chunk >= 0:
            yield bits()

    counted = map_batches(texts, count, "chunk int, at binary, n binary")
    merged = map_batches(counted.repartition("chunk").sortWithinPartitions("chunk"), add,
                         "chunk int, bits binary")
    size = (1 << CHUNK_BITS) // 8
    out = bytearray(CHUNKS * size)
    for row in merged.toLocalIterator():  # at most CHUNKS rows of ``size`` bytes
        out[row["chunk"] * size:(row["chunk"] + 1) * size] = row["bits"]
    return bytes(out)


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CHUNK_BITS - (CHUNKS.bit_length() - 1))).astype(np.uint32)


def _packed(places: list[np.ndarray]) -> pa.RecordBatch:
    """One row per chunk: the counters hit (16 bits each) and how often."""
    place, n = np.unique(np.concatenate(places), return_counts=True)
    at = (place & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint16)
    n = n.astype(np.uint32)
    chunk = place >> np.uint32(CHUNK_BITS)
    cuts = np.flatnonzero(np.diff(chunk, prepend=-1))
    bounds = np.append(cuts, len(place)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk[cuts].astype(np.int32)),
         *[pa.LargeBinaryArray.from_buffers(
             pa.large_binary(), len(cuts),
             [None, pa.py_buffer(bounds * a.itemsize), pa.py_buffer(a)]).cast(pa.binary())
           for a in (at, n)]], names=["chunk", "at", "n"])


class _Held:
    """A task's stripes in memory: per number of words m, the distinct phrases (as
    their words' hashes and a language) with their counts, and the words' strings."""

    def __init__(self, rule: Callable[[int, np.ndarray], np.ndarray]) -> None:
        self.rule = rule
        self.clear()

    def clear(self) -> None:
        self.parts: dict[int, list[tuple]] = {m: [] for m in range(1, MAX_WORDS + 1)}
        self.size = self.combined = 0
        self.strings: dict[int, str] = {}
        self.names: dict[int, str] = {}
        self.others: dict[int, int] = {}  # per language: occurrences of words ruled out

    def add(self, words: _Words, langs: pa.Array) -> None:
        single = np.zeros(len(words.own), bool)
        for m, key, good in words.phrases(self.rule):
            if m == 1:
                single = good
            place = np.flatnonzero(good)
            if not len(place):
                break
            columns = np.column_stack([words.hash[place + j] for j in range(m)])
            part = _combined([(key[place], words.lang[place], columns,
                               np.ones(len(place), np.int64))])
            self.parts[m].append(part)
            self.size += len(part[0])
        heard, n = np.unique(words.lang[~single], return_counts=True)
        for lang, count in zip(heard.tolist(), n.tolist(), strict=True):
            self.others[lang] = self.others.get(lang, 0) + count
        for lang, name in zip(words.row_lang.tolist(), langs.to_pylist(), strict=True):
            self.names[lang] = name
        seen, at = np.unique(words.hash[single], return_index=True)
        new = [i for i, h in enumerate(seen.tolist()) if h not in self.strings]
        if new:
            place = np.flatnonzero(single)[at[new]]
            self.strings.update(zip(seen[new].tolist(), words.strings(place), strict=True))

    def full(self) -> bool:
        """Whether the held phrases, equal ones put together, are many enough to write."""
        if self.size >= self.combined + HELD_ENTRIES // 2:
            self.parts = {m: [_combined(p)] if p else [] for m, p in self.parts.items()}
            self.size = self.combined = sum(len(p[0][0]) for p in self.parts.values() if p)
        return self.combined >= HELD_ENTRIES

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """Rows (deal, stripes): the stripes (lang, prefix, words, counts) of a deal."""
        known = np.array(sorted(self.strings), np.uint64)
        text = pa.array([self.strings[h] for h in known.tolist()], pa.string())
        pieces = []
        for m, parts in self.parts.items():
            if not parts:
                continue
            _, lang, columns, n = _combined(parts)
            # Stripes: the phrases of one prefix (and one piece of it) side by side.
            seg = columns[:, -1] % np.uint64(SEGMENTS.get(m - 1, 1))
            prefix = lang + np.uint64(m)
            for j in range(m - 1):
                prefix = mix(prefix * _PAIR + columns[:, j])
            prefix = mix(prefix * _PAIR + seg)
            order = np.argsort(prefix, kind="stable")
            prefix, lang, columns, n = prefix[order], lang[order], columns[order], n[order]
            new = np.ones(len(prefix), bool)
            new[1:] = ((prefix[1:] != prefix[:-1]) | (lang[1:] != lang[:-1])
                       | (columns[1:, :-1] != columns[:-1, :-1]).any(1))
            cuts = np.flatnonzero(new)
            taken = [text.take(pa.array(np.searchsorted(known, columns[:, j]))) for j in range(m)]
            first = [t.take(pa.array(cuts)) for t in taken[:-1]]
            pieces.append((prefix[cuts] % np.uint64(DEALS), lang[cuts],
                           pc.binary_join_element_wise(*first, " ") if m > 1
                           else pa.array([""] * len(cuts), pa.string()),
                           np.diff(np.append(cuts, len(n))), taken[-1], n))
        if self.others:  # what the words ruled out add to n: the empty word of no prefix
            heard = np.array(list(self.others), np.uint64)
            empty = pa.array([""] * len(heard), pa.string())
            pieces.append((heard % np.uint64(DEALS), heard, empty, np.ones(len(heard), np.int64),
                           empty, np.array(list(self.others.values()), np.int64)))
        yield from self._rows(pieces)
        self.clear()

    def _rows(self, pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not pieces:
            return
        deal, lang, size = (np.concatenate([p[i] for p in pieces]) for i in (0, 1, 3))
        prefix, word = (pa.concat_arrays([p[i] for p in pieces]) for i in (2, 4))
        n = np.concatenate([p[5] for p in pieces])
        order = np.argsort(deal, kind="stable")
        start = np.cumsum(size) - size
        entry = np.repeat(start[order] - (np.cumsum(size[order]) - size[order]), size[order]) \
            + np.arange(size.sum())
        bounds = pa.array(np.append(0, np.cumsum(size[order])).astype(np.int32))
        entry = pa.array(entry)
        stripes = pa.StructArray.from_arrays(
            [pa.array([self.names[x] for x in lang[order].tolist()], pa.string()),
             prefix.take(pa.array(order)), pa.ListArray.from_arrays(bounds, word.take(entry)),
             pa.ListArray.from_arrays(bounds, pa.array(n).take(entry))],
            names=["lang", "prefix", "words", "counts"])
        deal = deal[order]
        cuts = np.flatnonzero(np.diff(deal.astype(np.int64), prepend=-1))
        rows = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(deal)).astype(np.int32)), stripes)
        yield from pa.table({"deal": pa.array(deal[cuts].astype(np.int32)), "stripes": rows}
                            ).to_batches(max_chunksize=256)


def _combined(parts: list[tuple]) -> tuple:
    """(key, lang, words, n) with equal phrases put together."""
    key, lang, words, n = (np.concatenate([p[i] for p in parts]) for i in range(4))
    order = np.argsort(key, kind="stable")
    key, lang, words, n = key[order], lang[order], words[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = ((key[1:] != key[:-1]) | (lang[1:] != lang[:-1])
               | (words[1:] != words[:-1]).any(1))  # phrases that share a key stay apart
    cuts = np.flatnonzero(new)
    return key[cuts], lang[cuts], words[cuts], np.add.reduceat(n, cuts)


def merged_stripes(texts: DataFrame, min_count: int) -> DataFrame:
    """(lang, prefix, word, f): the merged stripes of ``texts`` (text, lang),
    entries of ``min_count`` and more, and all of the empty prefix."""
    share = texts.sparkSession.sparkContext.broadcast
    bits = [share(_counters(texts, min_count, []))]
    bits.append(share(_counters(texts, min_count, bits[:1])))

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(_rule([np.frombuffer(b.value, np.uint8) for b in bits]))
        for batch in batches:
            for words, langs in _words_of(batch):
                if len(words.hash):
                    held.add(words, langs)
                if held.full():
                    yield from held.stripes()
        yield from held.stripes()

    local = map_batches(texts, stripes, "deal int, stripes array<struct<lang: string, "
                                        "prefix: string, words: array<string>, counts: array<long>>>")
    # All stripes of a prefix (or of its piece) have one deal, so that adding them up
    # word by word needs no further shuffle.
    return (local.repartition("deal").select("deal", F.inline("stripes"))
            .select("deal", "lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e"))
            .groupBy("deal", "lang", "prefix", F.col("e.words").alias("word"))
            .agg(F.sum("e.counts").alias("f"))
            .where((F.col("f") >= min_count) | (F.col("prefix") == "")).drop("deal"))


def _phrases(stripes: DataFrame) -> DataFrame:
    """(lang, phrase, m, f, prefix): an entry as the phrase of its m words."""
    alone = F.col("prefix") == ""
    return stripes.where(F.col("word") != "").select(
        "lang", F.when(alone, F.col("word")).otherwise(F.concat_ws(" ", "prefix", "word"))
        .alias("phrase"),
        F.when(alone, 1).otherwise(F.size(F.split("prefix", " ")) + 1).alias("m"), "f", "prefix")


def _with_parts(phrases: DataFrame, candidates: DataFrame) -> DataFrame:
    """``candidates`` with l1, r1, l2, r2, ...: the frequencies of the two parts of
    every cut. Parts of one word may be a third of all parts, so they are salted by
    the phrase, and the words' few rows repeated once per salt."""
    words = F.split("phrase", " ")

    def part(k: int, side: str, text: Column) -> Column:
        alone = F.lit(k == 1) if side == "l" else F.col("m") == k + 1
        salt = F.when(alone, F.pmod(F.hash("phrase"), F.lit(SALTS))).otherwise(0)
        return F.when(F.col("m") > k, F.struct(F.lit(f"{side}{k}").alias("name"),
                                               text.alias("part"), salt.alias("salt")))

    cuts = [part(k, side, F.array_join(taken, " ")) for k in range(1, MAX_WORDS)
            for side, taken in (("l", F.slice(words, 1, k)),
                                ("r", F.slice(words, k + 1, MAX_WORDS)))]
    parts = (candidates.select("lang", "phrase", "m", F.col("f").alias("a"),
                               F.explode(F.array_compact(F.array(*cuts))).alias("p"))
             .select("lang", "phrase", "m", "a", "p.*"))
    known = phrases.select(
        "lang", F.col("phrase").alias("part"), "f",
        F.explode(F.when(F.col("m") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1)))
                  .otherwise(F.array(F.lit(0)))).alias("salt"))
    names = [f"{side}{k}" for k in range(1, MAX_WORDS) for side in "lr"]
    return (parts.join(known, ["lang", "part", "salt"])
            .groupBy("lang", "phrase").agg(F.max("m").alias("m"), F.max("a").alias("a"), *[
                F.max(F.when(F.col("name") == name, F.col("f"))).alias(name) for name in names]))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                 min_count: int = MIN_COUNT, top: int = TOP, subsumed: int = 80) -> DataFrame:
    """The first ``top`` phrases of every language by score: lang, rank (from 1),
    phrase, a (its occurrences), l, r (those of the parts of its weakest cut), n
    (the language's words), score = floor(2000000 a / (l + r)).

    Phrases have 2 to 4 words of one piece and ``min_count`` occurrences or more;
    those inside a longer such phrase that has ``subsumed`` percent of their
    occurrences go. A null text counts as empty, a null language as ``und``; the empty
    language is a language. Repeated rows count each. Ties in score go by occurrences,
    then by the phrase's bytes; ties of cuts to the earliest. Texts may be of any
    length. Other columns are ignored, whatever their names; without any phrase, or
    any row, the result is empty.
    """
    texts = docs.select(text_of(text_col).alias("text"),
                        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    stripes = stored(merged_stripes(texts, min_count), "collocation-stripes")
    phrases = _phrases(stripes).where(F.col("f") >= min_count)
    candidates = phrases.where(F.col("m") > 1)

    def cut(k: int) -> Column:  # ``div`` of decimals: whole numbers of any size
        score = F.expr(f"(CAST(a AS decimal(20,0)) * 2000000) div (l{k} + r{k})")
        return F.when(F.col("m") > k, F.struct(score.alias("score"), F.lit(k).alias("k"),
                                               F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    scored = _with_parts(phrases, candidates).select(
        "lang", "phrase", "a", F.array_min(F.array(*[cut(k) for k in range(1, MAX_WORDS)]))
        .alias("cut"))
    # The phrases one word longer that hold a phrase: its own stripe's entries, and
    # those that it ends. Longer ones still are no more frequent than these.
    longer = candidates.where(F.col("m") > 2)
    inner = (longer.select("lang", F.explode(F.array(
        F.col("prefix"), F.array_join(F.slice(F.split("phrase", " "), 2, MAX_WORDS), " ")))
        .alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most")))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100
                                  < F.col("a").cast("decimal(20,0)") * subsumed))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = stripes.where(F.col("prefix") == "").groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
        F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").cast("long").alias("score"))
