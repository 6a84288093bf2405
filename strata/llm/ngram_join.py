"""N-gram Jaccard join with prefix trees.

Documents with equal shingle sets are one node. Nodes that cannot have a
partner leave early: with the shingles of every set in one global order, two
similar sets share several of their first ones, so a node whose first shingles
are (nearly) its own alone is out. The sets of the others are ordered rarest
first and linked in rounds, each verified by walking a trie of ordered sets:

* every first shingle links its nodes to one hub, which makes components;
* nodes that a shingle's largest component has not reached try its members;
* those still apart from it try one another.

The rounds together compare, or connect, every pair that shares a first shingle,
and no pairs are listed: probes walk tries, and only links come out.

The many joins of the rounds are sort-merge joins by hint: small sides would become
broadcast tables, which the driver builds and holds, two or more a round.

The number of links of every document is counted on request: all pairs of a
component that can be similar are compared in blocks of sets, and each block
pair gives one number per node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (map_batches, mix, slices, stored, text_of, utf8, word_bytes, words)

SHINGLE = 5
#: Similarity as a fraction: intersection * DEN >= union * NUM.
NUM, DEN = 3, 4
SPACED = word_bytes("space")
#: Text bytes per bucket of first shingles, and members per trie.
BUCKET_BYTES = 64 << 20
TRIE_MEMBERS = 512
STEP = 128
#: Sets and tokens per block of the link count, and tokens per step of a product.
BLOCK_SETS, BLOCK_TOKENS = 512, 1 << 20
COLUMNS = 4096


def first_count(n):
    """How many first shingles of a set of ``n`` must hold a common one."""
    return n - -(-NUM * n // DEN) + 1


def tested_count(n):
    """How many first shingles are looked at before the sets are compared."""
    p = first_count(n)
    return np.minimum(n, p + (p + 1) // 2)


def needed_count(n):
    """How many of these some other set must share: a partner may be smaller,
    by the threshold, and then guarantees fewer."""
    small = -(-NUM * n // DEN)
    return tested_count(small) - first_count(small) + 1


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each row; with fewer words than
    ``size``, the whole sequence is one shingle."""
    hashes, bounds = words(data, offsets, SPACED)
    odd = np.uint64(0xA0761D6478BD642F)
    if len(hashes) >= size:
        n = len(hashes) - size + 1
        rolled = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            rolled = rolled * odd + hashes[k:k + n]
        rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for w in hashes[a:b]:
                h = np.uint64((int(h) * int(odd) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([h])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def _nodes(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, node) per document row; no node without words."""
    schema = T.StructType([T.StructField("id", docs.schema["id"].dataType),
                           T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            n, node = [], []
            for a, b in slices(offsets):
                for s in shingles(data, offsets[a:b + 1], size):
                    n.append(len(s))
                    node.append(node_of(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary())],
                names=schema.names)

    return map_batches(docs, run, schema)


# --- which nodes can have a partner ------------------------------------------

def _short(node: bytes) -> int:
    return int.from_bytes(node[:5], "little")


def _pack(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]) \
        .tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def _shared_counts(docs: DataFrame, buckets: int, size: int) -> DataFrame:
    """(short, shared): per node (its first 40 bits) how many of its tested
    shingles (48 bits of the hash) another node tests too. Shortened numbers
    that collide only raise a count, which keeps a node, never drops one.

    A shingle leaves a slice of texts at most once, so even one that all
    documents share comes to its bucket once per slice."""
    first = "bucket int, shingle binary, node binary, seen binary"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                sets = {node_of(s): s for s in shingles(data, offsets[a:b + 1], size) if len(s)}
                if not sets:
                    continue
                tests = [s[:int(tested_count(len(s)))] for s in sets.values()]
                h = np.concatenate(tests) >> np.uint64(16)
                node = np.repeat(np.array([_short(x) for x in sets], dtype=np.uint64),
                                 [len(t) for t in tests])
                order = np.argsort(h, kind="stable")
                h, node = h[order], node[order]
                head = np.ones(len(h), dtype=bool)
                head[1:] = h[1:] != h[:-1]
                alone = head & np.append(head[1:], True)
                local, count = np.unique(node[~alone], return_counts=True)
                h, node, seen = h[head], node[head], ~alone[head]
                cuts = np.searchsorted(h, (np.arange(buckets + 1, dtype=np.uint64)
                                           * np.uint64((1 << 48) // buckets + 1)))
                rows = [(k, _pack(h[x:y], 6), _pack(node[x:y], 5), seen[x:y].tobytes())
                        for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]
                if len(local):
                    rows.append((-1 - int(local[0]) % buckets, b"", _pack(local, 5),
                                 count.astype("<i8").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                    names=["bucket", "shingle", "node", "seen"])

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        h = np.concatenate([_unpack(r[0], 6) for r in rows])
        node = np.concatenate([_unpack(r[1], 5) for r in rows])
        seen = np.concatenate([np.frombuffer(r[2], dtype=bool) for r in rows])
        order = np.argsort(h, kind="stable")
        h, node, seen = h[order], node[order], seen[order]
        same = h[1:] == h[:-1]
        shared = np.append(same, False) | np.insert(same, 0, False)
        return counted(*np.unique(node[shared & ~seen], return_counts=True))

    def counted(node: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(node.astype(np.int64)),
                                           pa.array(count.astype(np.int64))],
                                          names=["short", "shared"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for k, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k < 0:
                    yield counted(_unpack(rest[1], 5), np.frombuffer(rest[2], dtype="<i8"))
                    continue
                if k != bucket and rows:
                    yield answer(rows)
                    rows = []
                bucket = k
                rows.append(rest)
        if rows:
            yield answer(rows)

    dealt = (map_batches(docs, split, first)
             .repartition("bucket").sortWithinPartitions("bucket"))
    return (map_batches(dealt, meet, "short long, shared long")
            .groupBy("short").agg(F.sum("shared").alias("shared")))


def _able(nodes: DataFrame, docs: DataFrame, buckets: int, size: int) -> DataFrame:
    """(node, n, id) of the nodes that may have a partner; id: one document's."""
    counts = _shared_counts(docs, buckets, size)
    # The first 5 bytes of the node as a little-endian number.
    byte = [F.conv(F.hex(F.substring("node", i, 1)), 16, 10).cast("long") for i in range(1, 6)]
    short = sum((b * F.lit(1 << (8 * i)) for i, b in enumerate(byte)), F.lit(0))
    reps = nodes.filter("node is not null").groupBy("node", "n").agg(F.min("id").alias("id"))
    small = F.ceil(F.col("n") * NUM / DEN)
    p = small - F.ceil(small * NUM / DEN) + 1
    needed = F.least(small, p + F.floor((p + 1) / 2)) - p + 1
    return (reps.withColumn("short", short).join(counts, "short")
            .filter(F.col("shared") >= needed).select("node", "n", "id"))


def _sets(docs: DataFrame, able: DataFrame, size: int) -> DataFrame:
    """(node, n, shingles) of the able nodes, read from one document each."""
    ids = able.select(F.col("id").alias("want")).distinct()
    picked = docs.join(ids, docs["id"].eqNullSafe(ids["want"]), "left_semi")
    schema = "node binary, n long, shingles array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                sets = [s for s in shingles(data, offsets[a:b + 1], size) if len(s)]
                ends = np.cumsum([0, *(len(s) for s in sets)])
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in sets], pa.binary()),
                     pa.array(np.diff(ends), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    names=["node", "n", "shingles"])

    sets = map_batches(picked.select("id", "text"), run, schema)
    return sets.join(able.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _ordered(sets: DataFrame) -> DataFrame:
    """(node, n, tokens): the shingles that more than one of the sets holds, in
    the global order, rarest first; those of one set alone come before them."""
    one = sets.select("node", "n", F.explode("shingles").alias("h"))
    often = one.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1")
    held = one.join(often, "h").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("c", "h"))).alias("held"))
    return held.select("node", "n", F.col("held.h").alias("tokens"))


# --- verification by a trie ----------------------------------------------------

class Trie:
    """Sets as the paths of a prefix tree, most frequent shingle first, with one node
    per branching. ``sets``: (name, size, tokens rarest first); sizes count the
    shingles of one set alone. A node knows the smallest and largest size below it and
    its ``reach``: the best that a path below it can make of its remaining length."""

    def __init__(self, sets: list[tuple[bytes, int, np.ndarray]]) -> None:
        order = sorted((tokens[::-1].astype(">u8").tobytes(), name, size)
                       for name, size, tokens in sets)
        self.paths = [np.frombuffer(raw, dtype=">u8").astype(np.uint64) for raw, _, _ in order]
        self.names = [name for _, name, _ in order]
        self.sizes = [size for _, _, size in order]
        # Per node: depth, a path through it, the paths that end at it, its children.
        self.depth, self.via, self.own, self.children = [0], [0], [[]], [[]]
        open_ = [0]  # the nodes on the last path
        for i, path in enumerate(self.paths):
            common = self._shared(i)
            below = None
            while self.depth[open_[-1]] > common:
                below = open_.pop()
            if self.depth[open_[-1]] < common:  # branch inside the edge to ``below``
                node = self._add(common, i, [], [below])
                self.children[open_[-1]][-1] = node
                open_.append(node)
            if len(path) > common:
                node = self._add(len(path), i, [i], [])
                self.children[open_[-1]].append(node)
                open_.append(node)
            else:
                self.own[open_[-1]].append(i)
        n = len(self.depth)
        self.reach, self.small, self.large = [None] * n, [None] * n, [None] * n
        todo = [(0, False)]
        while todo:
            node, ready = todo.pop()
            if not ready:
                todo += [(node, True), *((c, False) for c in self.children[node])]
                continue
            own, kids = self.own[node], self.children[node]
            self.reach[node] = max([(NUM + DEN) * len(self.paths[i]) - NUM * self.sizes[i] for i in own]
                                   + [self.reach[c] for c in kids], default=0)
            self.small[node] = min([self.sizes[i] for i in own] + [self.small[c] for c in kids], default=0)
            self.large[node] = max([self.sizes[i] for i in own] + [self.large[c] for c in kids], default=0)

    def _shared(self, i: int) -> int:
        """The length that path ``i`` shares with the one before."""
        if not i:
            return 0
        x, y = self.paths[i - 1], self.paths[i]
        k = min(len(x), len(y))
        differ = np.flatnonzero(x[:k] != y[:k])
        return int(differ[0]) if len(differ) else k

    def _add(self, depth: int, via: int, own: list[int], children: list[int]) -> int:
        self.depth.append(depth)
        self.via.append(via)
        self.own.append(own)
        self.children.append(children)
        return len(self.depth) - 1

    def similar(self, tokens: np.ndarray, n: int, first: bool = False) -> list[bytes]:
        """The sets similar to a probe (only one, if ``first``). What paths share is
        walked once, and a subtree is left where even a full match of the remaining
        length of its best path cannot reach the threshold, or no size below fits."""
        known = np.sort(tokens)
        links: list[bytes] = []
        if not len(known):
            return links
        todo = [(0, 0, 0)]
        while todo:
            node, depth, count = todo.pop()
            end, path, reach = self.depth[node], self.paths[self.via[node]] if self.paths else known, \
                self.reach[node]
            while depth < end and (NUM + DEN) * (count - depth) + reach >= NUM * n:
                part = path[depth:min(depth + STEP, end)]
                at = np.minimum(np.searchsorted(known, part), len(known) - 1)
                count += int((known[at] == part).sum())
                depth += len(part)
            if depth < end:
                continue
            for i in self.own[node]:
                if (NUM + DEN) * count >= NUM * (n + self.sizes[i]):
                    links.append(self.names[i])
                    if first:
                        return links
            todo += [(c, depth, count) for c in reversed(self.children[node])
                     if (NUM + DEN) * (count - depth) + self.reach[c] >= NUM * n
                     and DEN * self.large[c] >= NUM * n and DEN * n >= NUM * self.small[c]]
        return links


def _tried(sides: DataFrame, ordered: DataFrame, first: bool = False) -> DataFrame:
    """(a, b) links between the probes and the members of each group. ``sides``:
    (group, node, probe), each once. A group's members are dealt over tries of
    about ``TRIE_MEMBERS``; each probe walks all of them, and links to all
    similar members, or to one per trie if ``first``. Only links come out."""
    sizes = (sides.filter("not probe").groupBy("group")
             .agg(F.ceil(F.count("*") / TRIE_MEMBERS).alias("tries")))
    dealt = sides.join(sizes.hint("merge"), "group")
    dealt = dealt.select("group", "node", "probe", F.explode(F.when(
        F.col("probe"), F.sequence(F.lit(0).cast("long"), F.col("tries") - 1))
        .otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("tries"))))).alias("trie"))
    rows = dealt.join(ordered.hint("merge"), "node").select(
        "group", "trie", "probe", "node", "n", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, members, trie = None, [], None
        for batch in batches:
            lists = batch.column(5)
            flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            ends = lists.offsets.to_numpy()
            a, b = [], []
            for i, (group, number, probe, node, n) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in range(5)), strict=True)):
                if (group, number) != unit:
                    unit, members, trie = (group, number), [], None
                own = flat[ends[i]:ends[i + 1]]
                if not probe:
                    members.append((node, n, own.copy()))
                    continue
                trie = trie or Trie(members)
                found = trie.similar(own, n, first)
                a.extend([node] * len(found))
                b.extend(found)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()),
                                                  pa.array(b, pa.binary())], names=["a", "b"])

    units = rows.repartition("group", "trie").sortWithinPartitions(
        "group", "trie", "probe")  # members, then probes
    return map_batches(units, run, "a binary, b binary")


def _verified(pairs: DataFrame, ordered: DataFrame) -> DataFrame:
    """Of ``pairs`` (probe, member; distinct) the similar ones."""
    members = pairs.select(F.col("probe").alias("group"), F.col("member").alias("node"),
                           F.lit(False).alias("probe"))
    probes = pairs.select(F.col("probe").alias("group"), F.col("probe").alias("node"),
                          F.lit(True).alias("probe")).distinct()
    return _tried(members.unionByName(probes), ordered)


# --- connected components --------------------------------------------------------

def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node it
    reaches. Alternates large and small stars until nothing changes; every
    round is stored, so the lineage stays short."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.join(least.hint("merge"), "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low.hint("merge"), "a").filter("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = stored(small.unionByName(low.withColumnRenamed("m", "b")).distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            ends = edges.select(F.col("b").alias("a"), "b").distinct()
            return edges.unionByName(ends).select(
                F.col("a").alias("node"), F.col("b").alias("component"))
        before = now


# --- the join ---------------------------------------------------------------------

def _fits(n: Column, m: Column) -> Column:
    return F.least(n, m) * DEN >= F.greatest(n, m) * NUM


def _first_tokens() -> Column:
    """The tokens of a set of which similar sets share one at least."""
    own = F.col("n") - F.size("tokens")  # shingles that stand before the tokens
    p = F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1
    return F.slice("tokens", F.lit(1), F.greatest(p - own, F.lit(0)).cast("int"))


def _node_components(ordered: DataFrame) -> DataFrame:
    """(node, component) of the linked nodes: exactly what similar pairs connect.
    Every later round starts from the components so far, as stars, and its own links;
    one that finds no links leaves them as they are."""
    firsts = ordered.select("node", "n", F.explode(_first_tokens()).alias("token"))
    firsts = stored(firsts, "ngram-firsts")
    hubs = firsts.groupBy("token").agg(F.min(F.struct("node", "n")).alias("hub"))
    stars = (firsts.join(hubs.hint("merge"), "token").filter(F.col("node") != F.col("hub.node"))
             .filter(_fits(F.col("n"), F.col("hub.n")))
             .select(F.col("hub.node").alias("probe"), F.col("node").alias("member")).distinct())
    comps = components(_verified(stars, ordered), "ngram-round")

    # What a token's largest component (main) has not reached tries its members.
    open_ = stored(_mixed(firsts, comps), "ngram-open")
    rest = stored(open_.filter("component <> main").select(
        F.col("main").alias("group"), "node").distinct(), "ngram-rest")
    members = open_.filter("component = main").select(
        F.col("main").alias("group"), "node", F.lit(False).alias("probe")).distinct()
    probes = rest.withColumn("probe", F.lit(True))
    comps = _joined(comps, _tried(members.unionByName(probes), ordered, first=True))

    # What is still apart from it tries all others that were. (A component's
    # name is one of its nodes, so it can be looked up among the new ones.)
    now = comps.select("node", F.col("component").alias("c"))
    its = comps.select(F.col("node").alias("group"), F.col("component").alias("g"))
    apart = stored(rest.join(now.hint("merge"), "node", "left").join(its.hint("merge"), "group", "left")
                   .filter(F.coalesce("c", "node") != F.coalesce("g", "group"))
                   .select("group", "node"), "ngram-apart")
    members = (rest.join(apart.select("group").distinct().hint("merge"), "group", "left_semi")
               .withColumn("probe", F.lit(False)))
    probes = apart.withColumn("probe", F.lit(True))
    return _joined(comps, _tried(members.unionByName(probes), ordered))


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further ``links``."""
    links = stored(links, "ngram-links")
    if links.isEmpty():
        return comps
    old = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(old.unionByName(links), "ngram-round")


def _mixed(firsts: DataFrame, comps: DataFrame) -> DataFrame:
    """``firsts`` with each node's component and its token's largest one (main),
    of the tokens that more than one component has."""
    left = firsts.join(comps.hint("merge"), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    by_comp = left.groupBy("token", "component").agg(F.count("*").alias("c"))
    mixed = (by_comp.groupBy("token")
             .agg(F.count("*").alias("parts"),
                  F.max_by("component", F.struct("c", "component")).alias("main"))
             .filter("parts > 1").select("token", "main"))
    return left.join(mixed.hint("merge"), "token")


# --- the number of links ----------------------------------------------------------

def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values every list of ``left`` shares with every one of ``right``;
    a list holds a value once."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    if not left or not right:
        return out
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(y) for y in x]))
             for x in (left, right)]
    both = np.intersect1d(sides[0][0], sides[1][0])
    if not len(both):
        return out
    placed = []
    for flat, row in sides:
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        held = both[at] == flat
        at, row = at[held], row[held]
        order = np.argsort(at, kind="stable")
        placed.append((at[order], row[order]))
    for a in range(0, len(both), COLUMNS):
        dense = []
        for (at, row), lists in zip(placed, (left, right), strict=True):
            x, y = np.searchsorted(at, (a, a + COLUMNS))
            part = np.zeros((len(lists), min(COLUMNS, len(both) - a)), dtype=np.float32)
            part[row[x:y], at[x:y] - a] = 1
            dense.append(part)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out


def _block_links(left: list[tuple], right: list[tuple] | None) -> dict[bytes, int]:
    """Per node its partners' copies between two blocks, or in one (``right``
    None). Rows: (node, n, copies, tokens, at); a pair that shares a token before
    ``at`` is counted in that token's group."""
    other = left if right is None else right
    n, m = (np.array([r[1] for r in x], dtype=np.int64) for x in (left, other))
    counts = shared_counts([r[3] for r in left], [r[3] for r in other])
    similar = (NUM + DEN) * counts >= NUM * (n[:, None] + m[None, :])
    if any(r[4] for r in left) and any(r[4] for r in other):
        similar &= shared_counts([r[3][:r[4]] for r in left], [r[3][:r[4]] for r in other]) == 0
    if right is None:
        np.fill_diagonal(similar, False)
    links = {}
    for x, y, found in ((left, other, similar), (right or [], left, similar.T)):
        copies = np.array([r[2] for r in y], dtype=np.int64)
        links.update((r[0], int(copies[row].sum())) for r, row in zip(x, found, strict=False)
                     if row.any())
    return links


def _link_counts(ordered: DataFrame, comps: DataFrame, copies: DataFrame) -> DataFrame:
    """(node, links): the documents in the similar nodes of every node; ``copies``:
    (node, copies). Similar nodes are in one component, and share a first token.
    A component is compared as a whole, or by first token (a pair in the group
    of the first token that it shares) where these groups have fewer pairs."""
    held = ordered.join(comps, "node").withColumn("held", F.size("tokens").cast("long"))
    firsts = stored(held.select("component", "node", "held", F.posexplode(_first_tokens())
                                .alias("at", "token")), "ngram-link-firsts")
    whole = held.groupBy("component").agg(F.count("*").alias("m"), F.sum("held").alias("t"))
    by_token = (firsts.groupBy("component", "token")
                .agg(F.count("*").alias("m"), F.sum("held").alias("t")).filter("m > 1"))
    cost = by_token.groupBy("component").agg(F.sum(F.col("m") * F.col("m")).alias("cost"))
    whole = stored(whole.join(cost, "component"), "ngram-link-groups")
    apart = whole.filter("m * m > cost").select("component")
    units = (held.select("component", "node").withColumn("token", F.lit(None).cast("long"))
             .withColumn("at", F.lit(0))
             .join(whole.filter("m * m <= cost").drop("cost"), "component")
             .unionByName(firsts.select("component", "node", "token", "at").join(
                 by_token.join(apart, "component"), ["component", "token"])))
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_SETS, F.col("t") / BLOCK_TOKENS))
    dealt = (units.withColumn("blocks", blocks)
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("component", "token", F.least("own", "other").alias("lo"),
                     F.greatest("own", "other").alias("hi"),
                     (F.col("own") > F.col("other")).alias("second"), "node", "at"))
    rows = dealt.join(ordered.join(copies, "node"), "node").select(
        "component", "token", "lo", "hi", "second", "node", "n", "copies", "at", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, sides = None, ([], [])

        def answer() -> pa.RecordBatch:
            found = _block_links(sides[0], None if unit[2] == unit[3] else sides[1])
            return pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())],
                names=["node", "links"])

        for batch in batches:
            lists = batch.column(9)
            flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            ends = lists.offsets.to_numpy()
            for i, (*key, second, node, n, copies_, at) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in range(9)), strict=True)):
                if key != unit:
                    if unit:
                        yield answer()
                    unit, sides = key, ([], [])
                sides[second].append((node, n, copies_, flat[ends[i]:ends[i + 1]].copy(), at))
        if unit:
            yield answer()

    key = ["component", "token", "lo", "hi"]
    return (map_batches(rows.repartition(*key).sortWithinPartitions(*key), run,
                        "node binary, links long")
            .groupBy("node").agg(F.sum("links").alias("links")))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = SHINGLE, links: bool = False) -> DataFrame:
    """One row per document row: ``id_col``, n_shingles, component_id (smallest
    id reachable over links of similarity 0.75 or more, its own included); with
    ``links`` also n_links, the number of other document rows it links with.

    Null and empty texts, and those without words, have no shingles and link
    with nothing: component_id is their own id. A null id is reached like any
    other; null is no smallest id unless a component has no other. Repeated
    rows link with each other. Other columns are ignored; an empty table gives
    an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    nodes = stored(_nodes(rows, size), "ngram-nodes")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, -(-total // BUCKET_BYTES))
    able = stored(_able(nodes, rows, buckets, size), "ngram-able")
    ordered = stored(_ordered(stored(_sets(rows, able, size), "ngram-sets")), "ngram-ordered")
    comps = _node_components(ordered)
    classes = nodes.filter("node is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"))
    linked = (classes.join(comps, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    names = linked.join(linked.groupBy("component").agg(F.min("id").alias("component_id")),
                        "component").select("node", "component_id", "copies")
    if links:
        counts = stored(_link_counts(ordered, comps, classes.select("node", "copies")),
                        "ngram-link-counts")
        names = names.join(counts, "node", "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    more = ["n_links"] if links else []
    with_words = nodes.filter("node is not null").join(names, "node").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", *more)
    without = nodes.filter("node is null").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"),
        *(F.lit(0).cast("long").alias(c) for c in more))
    return with_words.unionByName(without)


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of similar documents: the one with
    the group's smallest id; rows without words all stay. All columns stay."""
    groups = similar_groups(docs, id_col, text_col)
    keep = (groups.filter((F.col("n_shingles") == 0)
                          | F.col(id_col).eqNullSafe(F.col("component_id")))
            .select(F.col(id_col).alias("_id")).distinct())
    return docs.join(keep, docs[id_col].eqNullSafe(keep["_id"]), "left_semi")
