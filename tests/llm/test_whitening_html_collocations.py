"""Whitening, main texts of pages and phrase collocations against plain statements
of what they must give, on odd rows and small tables."""

from __future__ import annotations

import html
import random
import re
from collections import Counter

import numpy as np
import pytest
from strata.llm import collocations, html_extraction, queries, whitening
from strata.llm.html_extraction import main_text
from strata.llm.whitening import Spectrum, rank_one, whiten

from .conftest import ordered, rows_of

SF = "/root/testdata/sf0.001"


# --- 11 whitening

VECTORS = "vec_id long, embedding array<float>, n string, _x int, component string"


def vector_rows(dim=5, n=60, seed=3):
    rng = np.random.default_rng(seed)
    turn = rng.normal(size=(dim, dim))
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=dim) @ turn], "s", 1, "c")
            for i in range(n)]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * dim,
           [0.0, float("inf"), 0.0, 0.0, 0.0]]
    return rows + [(100 + i, v, None, None, None) for i, v in enumerate(bad)] + \
        [rows[0], (None, rows[1][1], "s", 1, "c")]


def brute_whiten(vectors, k):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    centred = x - total / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return x, ((n * x - total) ** 2).sum(1), centred @ u / np.sqrt(e), e / np.trace(
        centred.T @ centred / n)


@pytest.mark.parametrize("block", [1 << 21, 16])
def test_whitening_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", block)
    rows = vector_rows()
    good = [r for r in rows if r[1] and all(c is not None and np.isfinite(c) for c in r[1])]
    _, deviation, white, explained = brute_whiten([r[1] for r in good], 8)
    got = whiten(spark.createDataFrame(rows, VECTORS).repartition(3)).collect()
    assert len(got) == 5 * len(good)  # 5 dimensions, so 5 components
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == \
        {(r[0], int(d)) for r, d in zip(good, deviation, strict=True)}
    assert all(r["n"] == len(good) and r["identity_error"] < 1e-9 for r in got)
    for c in range(1, 6):
        mine = {r["vec_id"]: r["whitened"] for r in got if r["component"] == c}
        theirs = dict(zip((r[0] for r in good), white[:, c - 1], strict=True))
        sign = np.sign(sum(mine[i] * theirs[i] for i in mine))
        assert max(abs(mine[i] * sign - theirs[i]) for i in mine) < 1e-9
        assert {r["explained"] for r in got if r["component"] == c}.pop() == pytest.approx(
            explained[c - 1], rel=1e-9)


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<double>")
    got = whiten(same).collect()
    assert len(got) == 8 and all(r["whitened"] is None and r["explained"] is None
                                 and r["identity_error"] is None and r["deviation"] == 0 for r in got)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(4)],
                                 "vec_id long, embedding array<double>")
    got = whiten(line).collect()
    assert [r["whitened"] is None for r in sorted(got, key=lambda r: (r["component"], r["vec_id"]))] \
        == [False] * 4 + [True] * 4
    assert all(r["identity_error"] < 1e-9 for r in got)
    one = whiten(same.limit(1)).collect()
    assert [(r["n"], r["whitened"]) for r in one] == [(1, None), (1, None)]


def test_whitening_empty_and_unequal(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whiten(empty).columns == ["vec_id", "component", "n", "deviation", "whitened",
                                     "explained", "identity_error"]
    assert whiten(empty).count() == 0
    unequal = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="differ in length"):
        whiten(unequal).collect()


def test_large_deviation_is_exact():
    block = np.array([[3, 5], [7, 11]], np.int64) * 10**6
    sums = np.array([10**16, 10**15], np.int64)
    n = 10**9
    want = [sum((n * int(x) - int(s)) ** 2 for x, s in zip(row, sums, strict=True)) for row in block]
    assert [int(v) for v in whitening._deviations(block, n, sums).to_pylist()] == want


@pytest.mark.parametrize("kind", ["spread", "ties", "zero", "scales"])
def test_rank_one_update(kind):
    rng = np.random.default_rng(len(kind))
    for trial in range(40):
        d = int(rng.integers(1, 24))
        values = {"spread": rng.random(d), "ties": rng.integers(0, 3, d).astype(float),
                  "zero": np.zeros(d), "scales": 10.0 ** rng.uniform(-12, 4, d)}[kind]
        values = np.sort(values)
        q = np.linalg.qr(rng.normal(size=(d, d)))[0]
        v = q[:, 0] * 3 if trial % 4 == 0 else rng.normal(size=d) * 10 ** rng.uniform(-6, 3)
        want = q @ np.diag(values) @ q.T + np.outer(v, v)
        e, u = rank_one(values, q, v)
        assert np.abs(u.T @ u - np.eye(d)).max() < 1e-12
        assert np.abs(u @ np.diag(e) @ u.T - want).max() < 1e-12 * np.linalg.norm(want)


def test_spectra_of_parts_merge_to_the_whole():
    x = np.random.default_rng(1).normal(size=(300, 7)) * 50 + 1e5
    total = Spectrum.empty(7)
    for part in (x[:3], x[3:120], x[120:]):
        one = Spectrum.empty(7)
        one.add_block(part)
        total.merge(one)
    centred = x - x.mean(0)
    assert total.n == 300 and np.allclose(total.mean, x.mean(0), rtol=1e-12)
    assert np.allclose(total.vectors @ np.diag(total.values) @ total.vectors.T,
                       centred.T @ centred, rtol=1e-9, atol=1e-6)


# --- 12 main text

def test_pages_of_the_test_data(spark):
    """The article's blocks by plain patterns that fit these pages only."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in queries.op12_html_extraction(spark, SF).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split())
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want
        assert got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


STORY = ("<p>The river rose again, as it does each spring; nobody was surprised.</p>"
         "<p>Short.</p><p>By noon, the lower road was closed, and the ferry stayed in port.</p>")
STORY_TEXT = ("The river rose again, as it does each spring; nobody was surprised.\nShort.\n"
              "By noon, the lower road was closed, and the ferry stayed in port.")
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li><li><a href=/c>Sport</a></li></ul>"


@pytest.mark.parametrize("page", [
    f"<body><nav>{MENU}</nav><article>{STORY}</article><footer>Owned by us.</footer></body>",
    f"<body>{MENU}<div id=main>{STORY}</div>{MENU}</body>",
    f"<body><div class='site-header'>Our paper, daily.</div><div>{STORY}</div>"
    f"<div class='cookie-banner'><p>We use cookies, as all do. Please agree, or leave.</p></div></body>",
    f"<main><aside>See also, perhaps, this. And that.</aside>{STORY}"
    f"<section class=comments><h2>Comments</h2><p>Nice one, thanks! I was there, too.</p></section></main>",
    f"<article>{STORY}<form>Your name, please: <input><button>Go</button></form></article>",
    f"<article><div class='ad'><p>Buy now, or never!</p></div>{STORY}"
    "<script>if (a<b) { x = '</p><p>no, not this.'; }</script><style>p:after{content:'x'}</style></article>",
    f"<header><h1>Paper</h1></header><article>{STORY}<!-- <p>hidden, too.</p> --><p hidden>No.</p>"
    "<p style='display: none'>No, no.</p></article><div role=alert>Notice, all.</div>",
    "<ARTICLE>" + STORY.replace("</p>", "") + "</ARTICLE>",
    STORY])
def test_boilerplate_goes(page):
    assert main_text(page) == STORY_TEXT


def test_headings_and_layout_without_article():
    page = (f"<body><div>{MENU}</div><div class=c><h2>Flood</h2><div class=s>{STORY}</div>"
            f"<div class=s>{STORY}</div></div><div><p>All rights reserved</p></div></body>")
    assert main_text(page) == f"Flood\n{STORY_TEXT}\n{STORY_TEXT}"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("  \n ", ""), ("plain &amp; simple", "plain & simple"), ("<nav>Home</nav>", ""),
    ("<article></article>", ""), ("<article>a<br>b &lt;c&gt; 1 < 2</article>", "a b <c> 1 < 2"),
    ("<article><p>one\n\t two&nbsp;&nbsp;three<p>four</article>", "one two three\nfour"),
    ("<article><p>a<b>b</b>c <i>d</p><p>e</i>f</p></article>", "abc d\nef"),
    ("<article><p>cut <a hre", "cut"), ("<article><p>x</p><!-- open", "x"),
    ("<article><p title='a>b'>q</p></article>", "q"), ("<article>x<script>var a = 1;", "x"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>three<td>four</table></article>",
     "one\ntwo\nthree\nfour"),
    ("<article></p></div>odd</article></b>", "odd"),
    ("<title>Not this.</title><article><h1>Head</h1><p>Body, text.</p></article>", "Head\nBody, text.")])
def test_odd_markup(page, text):
    assert main_text(page) == text


def test_long_and_deep_pages():
    assert main_text("<article>" + "<p>word, word.</p>" * 20_000 + "</article>").count("\n") == 19_999
    assert main_text("<div>" * 20_000 + "deep, deep." + "</b>" * 20_000) == "deep, deep."
    assert main_text("<a '" * 20_000 + "<p \"=" * 20_000) == ""
    assert len(main_text("<article>" + "x" * 1_000_000)) == 1_000_000


def test_page_rows(spark):
    schema = "page_id long, url string, html string, text int, n_chars string, _html int"
    rows = [(1, "u", STORY, 1, "a", 2), (1, "u", STORY, 1, "a", 2), (None, None, None, None, None, None),
            (2, None, "", 1, None, 3)]
    got = html_extraction.extract_main_text(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    n = len(STORY_TEXT)
    assert rows_of(got, "page_id", "url", "text", "n_chars") == ordered(
        [(1, "u", STORY_TEXT, n), (1, "u", STORY_TEXT, n), (None, None, "", 0), (2, None, "", 0)])
    assert html_extraction.extract_main_text(spark.createDataFrame([], schema)).count() == 0


# --- 13 collocations

def brute_collocations(docs, min_count, top, subsumed=80):
    """By plain counters: (lang, rank, phrase, a, l, r, n, score)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    freq, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    freq[lang, tuple(words[i:i + m])] += 1
    found = {k: a for k, a in freq.items() if len(k[1]) > 1 and a >= min_count}
    most = Counter()
    for (lang, p), a in found.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                most[lang, p[i:i + m]] = max(most[lang, p[i:i + m]], a)
    out = []
    for (lang, p), a in found.items():
        if 100 * most[lang, p] >= subsumed * a:
            continue
        cuts = [(2000000 * a // (freq[lang, p[:k]] + freq[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), freq[lang, p[:k]], freq[lang, p[k:]]))
    rows, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return rows


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrase_docs():
    rng = random.Random(8)
    words = ["New", "york", "CITY", "the", "of", "über", "x", "a b", "end"]
    docs = [(rng.choice(["en", "de", "", None]),
             "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"])
                     for _ in range(rng.randrange(0, 60)))) for _ in range(150)]
    docs += [("en", None), ("en", ""), (None, " .,\t"), ("en", "new york city hall " * 40),
             ("en", "long " * 30_000), ("fr", "seul")]
    return docs + docs[:5]


@pytest.mark.parametrize("min_count, held", [(5, 1 << 20), (2, 50), (30, 1 << 20)])
def test_collocations(spark, monkeypatch, min_count, held):
    monkeypatch.setattr(collocations, "HELD_ENTRIES", held)
    docs = phrase_docs()
    frame = spark.createDataFrame([(*d, 1, "p", None) for d in docs],
                                  "lang string, text string, n int, phrase string, word string")
    got = collocations.collocations(frame.repartition(4), min_count=min_count, top=25)
    assert got.columns == list(COLUMNS)
    assert rows_of(got, *COLUMNS) == ordered(brute_collocations(docs, min_count, 25))


def test_collocations_of_few_counters(spark, monkeypatch):
    """Counters that everything shares rule nothing out, and the result is the same."""
    monkeypatch.setattr(collocations, "_counters", lambda texts, n, known: b"\xff" * (1 << 24))
    docs = phrase_docs()
    got = collocations.collocations(spark.createDataFrame(docs, "lang string, text string"),
                                    min_count=6, top=2000)
    assert rows_of(got, *COLUMNS) == ordered(brute_collocations(docs, 6, 2000))


def test_collocations_of_nothing(spark):
    schema = "lang string, text string"
    assert collocations.collocations(spark.createDataFrame([], schema)).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, "a")], schema)).count() == 0


def test_stripes_meet_in_one_shuffle(spark):
    """The stripes are added where they were dealt: no exchange after the one of stripes."""
    texts = spark.createDataFrame([("en", "a b c " * 50)], "lang string, text string").select("text", "lang")
    plan = collocations.merged_stripes(texts, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_collocations_of_the_test_data(spark):
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op13_collocations(spark, SF)
    assert rows_of(got, *COLUMNS) == ordered(brute_collocations(docs, 30, 2000))
