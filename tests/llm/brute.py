"""Plain, slow statements of what the operators return."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

DOC_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def contamination(docs, bench, window=13):
    items, lengths = defaultdict(set), set()
    for i, t in bench:
        w = DOC_WORD.findall(low(t or ""))
        if w:
            n = min(window, len(w))
            lengths.add(n)
            for k in range(len(w) - n + 1):
                items[tuple(w[k:k + n])].add(i)
    out = []
    for d, t in docs:
        w, hit, seen = DOC_WORD.findall(low(t or "")), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                found = items.get(tuple(w[k:k + n]))
                if found:
                    hit.update(range(k, k + n))
                    seen |= found
        ids = sorted("" if i is None else str(i) for i in seen)
        out.append((d, len(w), len(hit), len(seen), sha(",".join(ids)),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def _listed(spans, kinds):
    flat = sorted((a, kinds.index(k), b) for k in kinds for a, b in spans[k])
    return (*(len(spans[k]) for k in kinds), sha(",".join(f"{kinds[k]}:{a}:{b}"
                                                          for a, k, b in flat)))


def secrets(docs):
    out = []
    for d, t in docs:
        t = t or ""
        out.append((d, *_listed({
            "assign": [m.span() for m in ASSIGN.finditer(t) if len(m[2]) >= 8],
            "access": [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16],
            "hex": [m.span() for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]},
            ["assign", "access", "hex"])))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def personal_data(docs):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = []
    for d, t in docs:
        t = t or ""
        out.append((d, *_listed({
            "email": [m.span() for m in re.finditer(
                r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
            "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
                   if all(int(x) <= 255 for x in m[0].split("."))],
            "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
                     if 12 <= len(digits(m)) <= 19 and luhn(digits(m))],
            "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                      if 9 <= len(digits(m)) <= 15]}, ["email", "ip", "card", "phone"])))
    return out


def shingle_sets(docs):
    sets = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t or ""))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 \
            else ({tuple(w)} if w else set())
    return sets


def links(docs):
    """(id, number of similar documents); ids must differ."""
    sets = shingle_sets(docs)
    return [(a, sum(a != b and bool(x & y) and 100 * len(x & y) >= 75 * len(x | y)
                    for b, y in sets.items())) for a, x in sets.items()]


def components(docs):
    """(id, shingles, smallest reachable id); ids must differ."""
    sets = shingle_sets(docs)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(d, len(sets[d]), find(d)) for d in ids]


def exact(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[low(t or "")].append(d)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(d, keep, len(ids), d == keep, sha(t)) for d in ids]
    return out


def chat(turns):
    groups = defaultdict(list)
    for c, t, r, x in turns:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, rows in groups.items():
        rows.sort()
        said = "".join(x for _, _, r, x in rows if r == "assistant")
        out.append((c, len(rows), sha("".join(f"{r}\n{x}\n" for _, _, r, x in rows)),
                    len(said), sha(said)))
    return out
