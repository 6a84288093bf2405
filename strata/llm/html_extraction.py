"""Main text of web pages by tag-path ratios.

A page is read tag by tag into blocks: runs of text between block-level tags.
Each block has a root-to-leaf tag path (``body/div.story/p``). Per path the text
length, the punctuation and the link text are summed over the path's blocks; the
ratios to the number of blocks are given back to the blocks, smoothed over the page
order, fused into one score, and averaged per path. Paths that score above a share
of the scores' deviation are content, and the element that holds the strongest
path's blocks is the page's content root, whose other blocks (a heading, a
one-word paragraph) belong to the text as well.

A page is one row, so all of this is local to the row: no shuffle, and memory bounded
by a slice of pages or by one longer page. Every step is linear in the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches, slices, text_of, utf8

#: A path is content above this share of the scores' standard deviation, and above
#: half the score of the page's typical character.
LAMBDA = 0.8
#: Weights of a block's neighbours in page order.
KERNEL = np.array([0.25, 0.5, 0.25])

# Fixed values of HTML: elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
NOT_TEXT = frozenset("button canvas datalist dialog form head math menu nav object option select "
                     "svg template aside audio footer map picture video".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div "
                  "dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
                  "hgroup hr html legend li main menu nav ol option p pre search section summary "
                  "table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("body caption dd dt head html legend li option tbody td tfoot th thead "
                           "tr".split())
#: A start tag ends these open elements, unless one of the second lies between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
        "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption ul ol "
                 "dl".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words that mark an element as not of the article, in a class, id or role.
CUES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promoted "
                 "banner sidebar sidenav nav navbar navigation menu breadcrumb breadcrumbs footer "
                 "masthead cookie cookies consent gdpr notice notices alert newsletter subscribe "
                 "signup popup modal overlay share sharing social related recommended "
                 "recommendations comment comments respond disqus widget pagination pager toolbar "
                 "skip login search complementary contentinfo advertorial".split())
SITE_HEADER = frozenset("site page top global main".split())
NO_CUE_AFTER = frozenset("has with no without".split())

_ATTRIBUTES = r"""(?:[^>=]|=[\x20\t\n\r\f]*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![A-Za-z]))[^>]*+(?:>|\Z)"
                  r"|<(/?)([A-Za-z][^\s/>]*+)(" + _ATTRIBUTES + r")(?:>|\Z)", re.DOTALL)
_MARKS = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style)"""
                    r"""(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|\Z)""", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


def _cue(words: str) -> bool:
    """Whether a class, id or role names something that is not the article."""
    for word in words.lower().split():
        parts = [p for p in re.split(r"[-_]+", word) if p]
        for i, part in enumerate(parts):
            if part in CUES and not (i and parts[i - 1] in NO_CUE_AFTER):
                return True
        if "header" in parts and (len(parts) == 1 or SITE_HEADER & set(parts)):
            return True
    return False


class _Page:
    """The blocks of one page. ``elements`` are numbered from 0 (the document)."""

    def __init__(self, source: str) -> None:
        self.parent, self.depth, self.tag, self.path, self.off = [-1], [0], [""], [0], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int]] = []  # element, text, link characters
        self._stack, self._open = [0], {}
        self._parts: list[tuple[str, bool]] = []
        self._links = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            match = _TAG.search(source, at)
            if match is None:
                self._text(source[at:])
                break
            if match.start() > at:
                self._text(source[at:match.start()])
            at = match.end()
            name = match[2]
            if name is None:
                continue
            if not source.endswith(">", 0, at):
                break  # a tag that the page's end cuts
            name = name.lower()
            if match[1]:
                self._end(name)
            else:
                self._start(name, match[3])
                if name in RAW:
                    closing = _RAW_END[name].search(source, at)
                    if closing is None:
                        break
                    at = closing.start()
        self._flush()

    def _text(self, text: str) -> None:
        if not self.off[self._stack[-1]]:
            self._parts.append((text, self._links > 0))

    def _flush(self) -> None:
        if not self._parts:
            return
        text = " ".join(html.unescape("".join(t for t, _ in self._parts)).split())
        if text:
            linked = sum(len(" ".join(t.split())) for t, inside in self._parts if inside)
            element = self._stack[-1]
            while self.tag[element] not in BLOCK and element:
                element = self.parent[element]
            self.blocks.append((element, text, min(linked, len(text))))
        self._parts = []

    def _pop(self) -> None:
        tag = self.tag[self._stack.pop()]
        self._open[tag] -= 1
        if tag == "a":
            self._links -= 1

    def _close(self, names: set[str], stops: set[str] | frozenset[str]) -> None:
        """Close down to the topmost open element of ``names`` above any of ``stops``."""
        if not any(self._open.get(n) for n in names):
            return
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[i]]
            if tag in names:
                while len(self._stack) > i:
                    self._pop()
                return
            if tag in stops:
                return

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self._flush()
            if name in ENDS_P:
                self._close({"p"}, {"td", "th", "caption", "table", "button", "object"})
                if name in HEADING:
                    self._close(HEADING, BLOCK - HEADING)
            if name in ENDS:
                closed, stops = ENDS[name]
                while (open_ := sum(self._open.get(n, 0) for n in closed)):
                    self._close(closed, stops)
                    if sum(self._open.get(n, 0) for n in closed) == open_:
                        break
        elif name == "br":
            self._text(" ")
        elif name == "a":
            self._close({"a"}, BLOCK)
        if name in VOID:
            return
        above = self._stack[-1]
        label = name
        off = self.off[above] or name in NOT_TEXT or name in RAW
        off = off or (name == "header" and not self._open.get("article"))
        if not off and attributes and not attributes.isspace():
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _MARKS.finditer(attributes)}
            if name not in ("html", "body", "article", "main"):
                off = any(_cue(found.get(k, "")) for k in ("class", "id", "role"))
            off = off or "hidden" in found or found.get("aria-hidden", "").lower() == "true" \
                or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden",
                             found.get("style", ""), re.I) is not None
            if found.get("class"):
                label = ".".join([name, *sorted(found["class"].split())])
        if off and not self.off[above]:
            self._text(" ")  # what follows an excluded part is not glued to what precedes it
        path = self.path[above]
        if name in BLOCK:
            path = self.paths.setdefault((path, label), len(self.paths) + 1)
        self._stack.append(len(self.tag))
        self.parent.append(above)
        self.depth.append(self.depth[above] + 1)
        self.tag.append(name)
        self.path.append(path)
        self.off.append(off)
        self._open[name] = self._open.get(name, 0) + 1
        if name == "a":
            self._links += 1

    def _end(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
        if self._open.get(name):
            if name in HEADING:
                self._close(HEADING, frozenset())
            else:
                self._close({name}, frozenset() if name in BLOCK else BLOCK)


def path_scores(path: np.ndarray, chars: np.ndarray, marks: np.ndarray, linked: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """(score, content) per path, for blocks in page order: ``path`` (numbers from
    0), text length, punctuation and link characters of each block."""
    n = int(path.max()) + 1
    nodes = np.maximum(np.bincount(path, minlength=n), 1)
    total = np.bincount(path, chars, n)
    own = 1 - np.bincount(path, linked, n) / np.maximum(total, 1)
    fused = np.ones(len(path))
    for ratio in (total / nodes * own, (np.bincount(path, marks, n) / nodes + 1) * own):
        spread = ratio[path]
        smooth = np.convolve(np.pad(spread, 1, mode="edge"), KERNEL, mode="valid")
        fused *= np.where(spread > 0, smooth, 0)  # a path of links only stays out
    score = np.bincount(path, fused, n) / nodes
    typical = float((score[path] * chars).sum() / max(chars.sum(), 1))
    return score, score > max(LAMBDA * score[path].std(), typical / 2)


def _holder(page: _Page, elements: list[int]) -> int:
    """The lowest element that holds all ``elements``; every element is climbed once."""
    chain, e = {}, elements[0]
    while e >= 0:
        chain[e] = page.depth[e]
        e = page.parent[e]
    lowest, seen = elements[0], set(chain)
    for e in elements[1:]:
        while e not in seen:
            seen.add(e)
            e = page.parent[e]
        if e in chain and chain[e] < page.depth[lowest]:
            lowest = e
    return lowest


def main_text(source: str) -> str:
    """The main text of one page, its blocks joined by line breaks."""
    page = _Page(source)
    if not page.blocks:
        return ""
    element = [e for e, _, _ in page.blocks]
    path = np.unique([page.path[e] for e in element], return_inverse=True)[1]
    chars = np.array([len(t) for _, t, _ in page.blocks], np.float64)
    marks = np.array([len(_PUNCTUATION.findall(t)) for _, t, _ in page.blocks], np.float64)
    linked = np.array([n for _, _, n in page.blocks], np.float64)
    score, content = path_scores(path, chars, marks, linked)
    # Content root: the holder of the path that weighs most, up to its article.
    weight = np.bincount(path, chars) * score
    inside_article = np.array([_ancestor(page, e, ("article",)) for e in element])
    if (inside_article >= 0).any():  # an article outweighs what stands outside
        weight = np.bincount(path, chars * (inside_article >= 0)) * (score + 1e-9)
    strongest = int(weight.argmax())
    lowest = _holder(page, [e for e, p in zip(element, path, strict=True) if p == strongest])
    declared = _ancestor(page, lowest, ("article", "main"))
    root = declared if declared >= 0 else lowest
    while declared < 0 and root > 0 and page.tag[root] in LEAF:
        root = page.parent[root]
    inside = [False] * len(page.tag)
    if declared >= 0 or page.tag[root] not in ("", "html", "body"):
        for e in range(root, len(page.tag)):
            inside[e] = e == root or inside[page.parent[e]]
    menu = np.bincount(path, linked) >= np.bincount(path, chars)
    menu &= np.bincount(path) >= 3  # three or more blocks that are links only
    kept = [bool(inside[e] and not menu[p] or declared < 0 and content[p])
            for e, p in zip(element, path, strict=True)]
    for i in range(len(kept) - 2, -1, -1):  # a heading goes with the block it heads
        if not kept[i] and kept[i + 1] and declared < 0 and page.tag[element[i]] in HEADING:
            kept[i] = page.parent[element[i]] == page.parent[element[i + 1]]
    return "\n".join(t for (_, t, _), keep in zip(page.blocks, kept, strict=True) if keep)


def _ancestor(page: _Page, element: int, tags: tuple[str, ...]) -> int:
    """The nearest of ``element`` and its ancestors with the first of ``tags``
    that any of them has, or -1."""
    memo = page.__dict__.setdefault("_ancestors", {}).setdefault(tags, {0: (-1,) * len(tags)})
    climbed, e = [], element
    while e not in memo:
        climbed.append(e)
        e = page.parent[e]
    found = memo[e]
    for e in reversed(climbed):
        if page.tag[e] in tags:
            found = tuple(e if page.tag[e] == t else f for t, f in zip(tags, found, strict=True))
        memo[e] = found
    return next((f for f in memo[element] if f >= 0), -1)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per page row: ``id_col``, ``url_col``, text, n_chars (code points).

    The text is the article's: no menus, headers, footers, side columns, notices,
    adverts, forms, scripts, styles, reader comments or markup. Character
    references are decoded, white space inside a block is one space, blocks are
    joined by one line break, in page order. A null or empty page, and one of
    markup only, has the empty text; a page without any tag is all text. Tags that
    never close, overlap or are cut by the end of the page are read as browsers do
    in the main (an open paragraph ends at the next block). Repeated rows and null
    ids and urls are rows like any other; other columns are ignored; an empty table
    gives an empty result. Pages may be of any length.
    """
    source = pages.select(id_col, url_col, text_of(html_col).alias("_html"))
    schema = T.StructType([pages.schema[id_col], pages.schema[url_col],
                           T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = utf8(batch.column(2))
            for a, b in slices(offsets):
                part = batch.slice(a, b - a)
                texts = [main_text(s) for s in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return map_batches(source, run, schema)
