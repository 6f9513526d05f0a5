"""Operator 12: the parser on fixed pages, decoding against brute force, the extractor on unseen pages."""

import html
import itertools
import re

import numpy as np
import pytest

from ontime.llm import extraction as ex
from ontime.llm.htmlblocks import parse
from ontime.llm.pagesamples import MARK, labelled_pages


@pytest.fixture(scope="module")
def model(spark):
    return ex.fit(spark)


def texts(source):
    return [t for t in parse(source).text if t]


@pytest.mark.parametrize("source, want", [
    (None, []), ("", []), ("  \n", []), ("plain  text\n here", ["plain text here"]),
    ("<p>a<p>b</p>c", ["a", "b", "c"]),
    ("<p><b>bold.<br><p>next &amp;amp; &lt;x&gt; &copy; &#233;&nbsp;z</p>", ["bold.", "next &amp; <x> © é z"]),
    ("a<br>b<!-- <p>no</p> -->c<!DOCTYPE x><?php no ?>d", ["a bcd"]),
    ("<script>var t='</p>';</script>x<style>p{}</SCRIPT></style>y<SCRIPT>no", ["xy"]),
    ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>", ["one", "two", "in", "three"]),
    ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
    ("<div title='a > b' class=\"x'y>\">in</div>", ["in"]),
    ("1 < 2 <3 </> </ x> a<b", ["1 < 2 <3 a"]),
    ("<select><option>no</select><textarea><p>no</textarea><button>no</button><noscript>no</noscript>yes", ["yes"]),
    ("<select>open and yes", ["open and yes"]),
    ("</p></div>x</article>", ["x"]), ("<p title=\"never closed>x</p>y", ["x", "y"]),
    ("<DIV>İ<STYLE>no</STYLE>in</DIV>", ["İin"]),
])
def test_parse(source, want):
    assert texts(source) == want


def test_long_and_deep_pages_take_linear_time():
    for source in ("<div>" * 20_000 + "x", "<a \"" * 100_000, "<p>x" * 50_000, "&amp;" * 200_000, "<" * 300_000, "a" * 3_000_000,
                   "<!--" * 100_000, "<select>" * 100_000, "<x class=" + "a" * 500_000 + ">y"):
        parse(source)


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(3)
    for _ in range(40):
        size = int(rng.integers(1, 10))
        parent = [-1] + [int(rng.integers(i)) for i in range(1, size)]
        depth = [0] * size
        for i in range(1, size):
            depth[i] = depth[parent[i]] + 1
        n = ex.Nodes(np.array([0, size]), np.array(parent), np.array(depth), [], [], np.zeros((size, 8)))
        odds = rng.normal(size=size)
        keep = ex.decode(n, odds)
        allowed = [k for k in itertools.product([False, True], repeat=size) if all(not k[i] or parent[i] < 0 or k[parent[i]] for i in range(size))]
        assert tuple(keep) in allowed
        assert odds[keep].sum() == pytest.approx(max(odds[np.array(k)].sum() for k in allowed))


def test_features_are_a_page_s_own(model):
    """A page gets the same features beside other pages."""
    sources = labelled_pages(12, 5)
    together = ex.nodes([parse(s) for s in sources])
    f = ex.features(together, model.odds)
    for i, s in enumerate(sources):
        alone = ex.features(ex.nodes([parse(s)]), model.odds)
        assert np.allclose(alone, f[together.page[i]:together.page[i + 1]])


def test_held_out_pages(model):
    """Pages that training did not see: block for block."""
    pages = [parse(s) for s in labelled_pages(300, 1234)]
    n = ex.nodes(pages)
    want = np.array([t.startswith(MARK) for p in pages for t in p.text])
    got = ex.decode(n, model.trees.log_odds(ex.features(n, model.odds)))
    some = n.counts[:, 0] > 0
    chars = n.counts[some, 0]
    want, got = want[some], got[some]
    assert chars[want & got].sum() / chars[want].sum() > 0.99
    assert chars[want & got].sum() / chars[got].sum() > 0.99


BODY = [f"This is paragraph {i} of the report, and it says something about the weather, the roads and the trains." for i in range(6)]


def page(before="", after="", inside="{}", wrap="<div class='articleText'>{}</div>"):
    return f"<html><head><title>T</title></head><body>{before}{wrap.format(inside.format(''.join(f'<p>{b}</p>' for b in BODY)))}{after}</body></html>"


@pytest.mark.parametrize("source", [
    page("<nav><a href=/>Home</a> <a href=/a>About</a></nav>", "<footer>Copyright 2020 Somebody</footer>"),
    page("<div id='mainNav'><ul><li><a href=/>Home</a></li><li><a href=/x>News</a></li></ul></div>", "<div class='siteFooter'>All rights reserved.</div>",
         wrap="<main><article>{}</article></main>"),
    page("<header><h2>The Paper</h2><p>News since 1900</p></header>", "<aside><h3>More</h3><ul><li><a href=/1>Other story</a></li><li><a href=/2>Third story</a></li></ul></aside>"),
    page("<div class='cookie-bar notice'>We use cookies to improve your visit. <button>Accept</button></div>", wrap="<article>{}</article>"),
    page(after="<section id='comments'><h3>Comments</h3><div class='comment'><b>Ann</b><p>I do not agree with this at all, and I say so.</p></div>"
         "<div class='comment'><b>Bob</b><p>Well said! I liked the part about the trains.</p></div></section>", wrap="<article>{}</article>"),
    page(after="<form class='newsletter'><p>Sign up for our letter.</p><input name=q><button>Go</button></form>", wrap="<div class='post'><div class='entry-content'>{}</div></div>"),
    page("<div class='ad-banner'>Buy two shoes and get one free, only today.</div>", wrap="<section class='story-body'>{}</section>"),
    page("<table><tr><td><a href=/>Home</a><br><a href=/b>Links</a></td></tr></table>", wrap="<table><tr><td>{}</td></tr></table>"),
])
def test_pages_written_by_hand(model, source):
    assert model.main_texts([source]) == ["\n\n".join(BODY)]


def test_the_given_pages(spark, model):
    """The supplied pages hold their text in one element; compared with a cut by hand."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in ex.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), model).collect()}
    assert len(got) == len(rows)
    same = 0
    for r in rows:
        cut = re.sub("<br>", " ", r["html"][r["html"].index("<article>") + 9:r["html"].index("</article>")])
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?p>|</?h1>", cut)]
        same += got[r["page_id"]] == "\n\n".join(b for b in blocks if b)
    assert same >= 0.98 * len(rows)


def test_odd_rows(spark, model):
    rows = [(1, "u", None, "x", 3), (None, None, "", "x", 3), (2, "u", "<nav><a>x</a></nav>", None, 3), (3, "u", "<p>" + "word, " * 200_000 + "</p>", "x", 3),
            (4, "u", page(), "x", 3), (4, "u", page(), "x", 3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    out = ex.extract(frame, model)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r["page_id"] or 0, r["n_chars"], len(r["text"])) for r in out.collect())
    assert [g[0] for g in got] == [0, 1, 2, 3, 4, 4] and all(a == b for _, a, b in got)
    assert [g[1] for g in got[:3]] == [0, 0, 0] and got[3][1] == 200_000 * 6 - 1 and got[4][1] == len("\n\n".join(BODY))
    assert ex.extract(frame.limit(0), model).collect() == []
