"""Secret scans through a trigram inverted index.

From each rule's regex the driver derives a Boolean query over lower-cased
trigrams that every match must satisfy. The trigrams of these queries are
indexed: postings per trigram and block of documents. Each rule's query is
answered by intersecting and uniting postings, and only its candidates are
searched with the regex; a rule without mandatory trigrams searches every text.
Built-in SQL functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .spans import listed, match_spans, tagged

#: Documents per block of the index: bounds a posting list.
BLOCK_DOCS = 2048
#: Strings that one part of a regex may expand to while a query is derived.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those whose ``group`` is shorter than
    ``at_least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 0


#: The base rules, in listing order.
BASE_RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Further rules; each has mandatory trigrams.
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("chat_hook", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)


# --- Boolean trigram queries ------------------------------------------------

Query = frozenset  # OR over AND: a set of sets of trigrams; holding the empty set: no demand
ANY: Query = frozenset([frozenset()])


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _demand(strings: set[str]) -> Query:
    """One of ``strings`` occurs."""
    found = {_trigrams(s) for s in strings}
    return ANY if frozenset() in found else frozenset(found)


def _both(a: Query, b: Query) -> Query:
    out = frozenset(x | y for x in a for y in b)
    return out if len(out) <= MAX_STRINGS else min((a, b), key=len)


def _strings(op, arg) -> set[str] | None:
    """All texts that a regex node matches, where they are few."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        if all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= 6:
            return {chr(a).lower() for _, a in arg}
        return None
    if name == "SUBPATTERN":
        return _sequence_strings(arg[3])
    if name == "BRANCH":
        parts = [_sequence_strings(p) for p in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if name.endswith("REPEAT") and arg[1] == 1:
        inner = _sequence_strings(arg[2])
        return inner if inner is None or arg[0] else inner | {""}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        part = _strings(op, arg)
        if part is None or len(out) * len(part) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _derive(nodes) -> Query:
    query, run = ANY, {""}
    for op, arg in nodes:
        part = _strings(op, arg)
        if part is not None and len(run) * len(part) <= MAX_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        query, run = _both(query, _demand(run)), {""}
        name = str(op)
        if part is not None:
            run = part
        elif name == "SUBPATTERN":
            query = _both(query, _derive(arg[3]))
        elif name == "BRANCH":
            query = _both(query, frozenset().union(*(_derive(p) for p in arg[1])))
        elif name.endswith("REPEAT") and arg[0] >= 1:
            query = _both(query, _derive(arg[2]))
    return _both(query, _demand(run))


def trigram_query(pattern: str) -> Query:
    """A set of trigram sets: any text with a match of ``pattern`` holds, in
    lower case, all trigrams of one of them. An empty inner set: no demand."""
    query = _derive(list(re._parser.parse(pattern)))
    if frozenset() in query:
        return ANY
    return frozenset(q for q in query if not any(other < q for other in query))


# --- the index --------------------------------------------------------------

def _answer(rule: int):
    # Spark counts a lambda's parameters, so loop values come in by closure.
    return lambda key: F.struct(key.alias("_key"), F.lit(rule).alias("rule"))


def _long_enough(at_least: int):
    return lambda span: F.length(span["value"]) >= at_least


def candidates(docs: DataFrame, rules: tuple[Rule, ...], key: Column, text: Column,
               block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(_key, _rules): the rules whose trigram query a document satisfies."""
    queries = {i: q for i, q in ((i, trigram_query(r.pattern)) for i, r in enumerate(rules))
               if q != ANY}
    wanted = sorted({t for q in queries.values() for part in q for t in part})
    blocks = max(1, -(-docs.count() // block_docs))
    # ``lower`` also maps a few non-ASCII letters to ASCII: more candidates, never fewer.
    # The one-element array binds the lower-cased text, so that it is made once.
    held = F.transform(F.array(F.lower(text)), lambda lower: F.filter(
        F.array(*[F.lit(t) for t in wanted]), lambda t: F.contains(lower, t)))[0]
    postings = (docs.select(key.alias("_key"), held.alias("_held"))
                .select("_key", F.explode_outer("_held").alias("trigram"))
                .filter("trigram is not null")
                .groupBy(F.pmod("_key", F.lit(blocks)).alias("block"), "trigram")
                .agg(F.collect_set("_key").alias("keys")))
    index = postings.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("index"))
    none = F.array().cast("array<bigint>")

    def posting(t: str) -> Column:
        return F.coalesce(F.col("index")[t], none)

    answers = []
    for i, query in queries.items():
        parts = [reduce(F.array_intersect, [posting(t) for t in sorted(part)])
                 for part in sorted(query, key=sorted)]
        hits = reduce(F.array_union, parts)
        answers.append(F.transform(hits, _answer(i)))
    found = index.select(F.explode(F.concat(*answers)).alias("hit")).select("hit.*")
    return found.groupBy("_key").agg(F.collect_set("rule").alias("_rules"))


def scan_secrets(docs: DataFrame, added: tuple[Rule, ...] = ADDED_RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document row: ``id_col``, n_assign, n_access, n_hex,
    base_sha256 (base spans) and spans (those of every rule), each span as
    ``kind:start:end`` in code points, by start, then rule order.

    Null text counts as empty. Repeated rows and null ids are scanned like any
    other row; spans of different kinds may overlap, both stay. Other columns
    are ignored; an empty table gives an empty result.
    """
    rules = BASE_RULES + tuple(added)
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    text = text_of(text_col)
    rows = docs.select(F.col(id_col), text.alias("_text"), key.alias("_key"))
    found = candidates(docs, rules, key, text)
    rows = rows.join(found, "_key", "left")
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    columns = []
    for i, rule in enumerate(rules):
        spans = match_spans(F.col("_text"), rule.pattern, rule.group)
        if rule.at_least:
            spans = F.filter(spans, _long_enough(rule.at_least))
        spans = tagged(spans, rule.kind, i)
        if trigram_query(rule.pattern) != ANY:
            spans = F.when(F.array_contains("_rules", i), spans).otherwise(none)
        columns.append(spans.alias(f"_s{i}"))
    spans = rows.select(id_col, *columns)
    base = F.concat(*[F.col(f"_s{i}") for i in range(len(BASE_RULES))])
    every = F.concat(*[F.col(f"_s{i}") for i in range(len(rules))])
    return spans.select(
        id_col, *[F.size(f"_s{i}").cast("long").alias(f"n_{r.kind}")
                  for i, r in enumerate(BASE_RULES)],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(every).alias("spans"))
