"""Main text of pages: the cut against brute force, whole pages against a plain reading, sketches left out of training, odd markup."""

from __future__ import annotations

import html
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import maintext, queries
from tessera.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def weights():
    return maintext.train()


def energy(kept, costs, edges):
    return sum(c[1] if k else c[0] for k, c in zip(kept, costs, strict=True)) + sum(w for a, b, w in edges if kept[a] != kept[b])


def test_cuts_are_minimal():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 9)
        costs = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 6)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.4]
        best = min(energy(k, costs, edges) for k in itertools.product((False, True), repeat=n))
        got = maintext.minimum_cut(costs, edges)
        assert energy(got, costs, edges) == best
        # of equal cuts, the one with the fewest blocks of content
        assert sum(got) == min(sum(k) for k in itertools.product((False, True), repeat=n) if energy(k, costs, edges) == best)
    assert maintext.minimum_cut([], []) == []


def test_cuts_of_pages_are_minimal(weights):
    for page in maintext.SKETCHES:
        blocks = maintext.blocks_of(page)[:14]
        costs, edges = [maintext.terminal(z) for z in (maintext.features(blocks) @ weights).tolist()], maintext.smoothness(blocks)
        assert len(edges) < 2 * len(blocks)
        assert energy(maintext.label(blocks, weights), costs, edges) == min(energy(k, costs, edges) for k in itertools.product((False, True), repeat=len(blocks)))


def test_neighbours_settle_doubtful_blocks():
    """The cut is more than a threshold: a doubtful block goes with its neighbours, and less so the further away they are."""
    page = "<div><p>a<p>b<p>c</div>"
    blocks = maintext.blocks_of(page)
    edges = maintext.smoothness(blocks)
    sure, doubtful = maintext.terminal(6.0), maintext.terminal(-0.3)
    assert maintext.minimum_cut([sure, doubtful, sure], edges) == [True, True, True]
    assert maintext.minimum_cut([sure, doubtful, sure], []) == [True, False, True]
    far = maintext.smoothness(maintext.blocks_of("<div><p>a</div><div><div><div><div><p>b</div></div></div></div>"))
    assert 0 < far[0][2] < edges[0][2] / 4


def plain_text(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", y)).split()) for y in re.split(r"</?(?:p|h1|article)>", inner)) if x)


def test_pages_match_a_plain_reading(spark):
    pages = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    df = queries.op12_main_text(spark, SF)
    assert df.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    got = df.collect()
    assert len(got) == len(pages) and all((r.text, r.url, r.n_chars) == (plain_text(pages[r.page_id].html), pages[r.page_id].url, len(r.text)) for r in got)


def test_sketches_left_out_of_training():
    right = total = 0
    for i, page in enumerate(maintext.SKETCHES):
        blocks = maintext.blocks_of(page)
        kept = maintext.label(blocks, maintext.train(maintext.SKETCHES[:i] + maintext.SKETCHES[i + 1 :]))
        right += sum(k == bool(b.flags & maintext.MARK) for b, k in zip(blocks, kept, strict=True))
        total += len(blocks)
    assert right / total >= 0.93


NEWS = """<!DOCTYPE html><html><head><title>Harbour reopens - The Post</title><script>if (a < b) document.write("<p>no</p>")</script></head><body class="article-page">
<header class="site-header"><a href="/">The Post</a><div>Independent since 1901</div></header><nav class="primary"><ul><li><a href="/w">World</a></li><li><a href="/s">Sport</a></li></ul></nav>
<div class="cookie-consent"><p>We use cookies to improve your visit. You can change this at any time in your settings.</p><button>Accept</button></div>
<main><article class="story"><h1>Harbour reopens after storm</h1><p>The harbour opened at <b>dawn</b> on Monday, two days
 after the storm.</p><div class="advert"><p>Buy one boat, get another at half the price, only this week!</p></div><p>&ldquo;Ships &amp; crews are safe&rdquo;, the captain said.</p><p>No.</p><ul><li>Three ferries run</li><li>Two wait</li></ul>
<form action="/mail"><label>Get our letter</label><input name=q></form><p>Fishing resumes tomorrow.<br>Weather permitting.</p></article>
<section id="comments"><h2>2 comments</h2><article class="comment"><p>Great news for everyone who lives by the sea, I hope.</p></article><article class="comment"><p>At last!</p></article></section></main>
<aside class="sidebar"><h3>Most read</h3><p>Ten harbours to see before the summer is over.</p></aside><footer><p>&copy; The Post. All rights reserved.</p></footer></body></html>"""
NEWS_TEXT = "Harbour reopens after storm\nThe harbour opened at dawn on Monday, two days after the storm.\n“Ships & crews are safe”, the captain said.\nNo.\nThree ferries run\nTwo wait\nFishing resumes tomorrow. Weather permitting."


def test_a_page_with_all_kinds_of_boilerplate(weights):
    assert maintext.main_text(NEWS, weights) == NEWS_TEXT
    # the same page without the elements that name their parts
    bare = re.sub(r"<(/?)(?:article|main|section)\b", r"<\1div", NEWS)
    bare = bare.replace("<header", "<div").replace("</header>", "</div>").replace("<aside", "<div").replace("</aside>", "</div>").replace("<footer", '<div class="footer"').replace("</footer>", "</div>")
    assert maintext.main_text(bare, weights) == NEWS_TEXT


def texts(page):
    return [b.text for b in maintext.blocks_of(page)]


def test_markup_is_read_as_browsers_read_it():
    assert texts("a<b>b</b>c<br>d") == ["abc d"]
    assert texts("<p>one<p>two</p>three") == ["one", "two", "three"]
    assert texts("<ul><li>a<ul><li>b</ul><li>c</ul>") == ["a", "b", "c"]
    assert texts('<p title="a > b">x</p><p title=\'<p>\'>y') == ["x", "y"]
    assert texts("1 < 2 &lt;b&gt; &amp;amp; &#8364; &unknown; &#xD800;") == ["1 < 2 <b> &amp; € &unknown; �"]
    assert texts("<!-- <p>no</p> --><p>yes<!-->still<!---> and<!doctype x><?php no ?>") == ["yesstill and"]
    assert texts("<script>'</p>' <p>no</script>a<STYLE>p{}</style>b<svg><svg></svg><text>no</text></svg>c") == ["abc"]
    assert texts("<head><title>no</title><body>yes") == ["yes"] and texts("<button>a<p>b") == ["a", "b"]
    assert texts("x<script>never ends <p>no") == ["x"] and texts("x<p never ends") == ["x"] and texts("x<p a='never ends><p>y") == ["x", "y"]
    assert texts("</div></p>a</b></section>b") == ["ab"] or texts("</div></p>a</b></section>b") == ["a", "b"]
    assert texts("  a \t\r\n b \x00") == ["a b \x00"] and texts("") == [] and texts(" \n") == [] and texts("<p></p>") == []


def test_odd_rows(spark, weights):
    deep = "<div>" * 30_000 + "deep" + "</section>" * 30_000 + "</div>" * 30_000
    wide = "<article>" + "".join(f"<p>Paragraph number {i} of many.</p>" for i in range(20_000)) + "</article>"
    long = "<article><p>" + "many words " * 300_000 + "</p></article>"
    rows = [(1, "u", NEWS), (1, "u", NEWS), (2, None, None), (None, "v", ""), (3, "w", "Only text, without any markup at all."), (4, "x", "<"), (5, "y", deep), (6, "z", wide), (7, "l", long), (8, "q", "<button>" * 20_000), (9, "r", "<a \"" * 20_001)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit("y"))
    got = sorted(((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in maintext.extract(df, weights).collect()), key=lambda r: r[:2])
    assert [g[:2] for g in got] == sorted((r[0] or 0, r[1] or "") for r in rows) and all(n == len(t) for _, _, t, n in got)
    text = {g[0]: g[2] for g in got}
    assert text[0] == text[2] == "" and text[1] == NEWS_TEXT and text[3] == "Only text, without any markup at all." and text[5] in ("", "deep")
    assert text[6].count("\n") == 19_999 and len(text[7]) == 3_299_999
    assert maintext.extract(df.limit(0), weights).count() == 0


def test_blocks_tell_what_was_kept(spark, weights):
    df = maintext.labelled_blocks(spark.createDataFrame([(1, "u", NEWS), (2, "v", None)], "page_id bigint, url string, html string"), weights)
    rows = df.orderBy("page_id", "position").collect()
    assert "\n".join(r.text for r in rows if r.kept) == NEWS_TEXT and [r.position for r in rows] == list(range(len(rows))) and all(0 <= r.probability <= 1 for r in rows)
    assert maintext.train(["<p data-main>a b c.</p>"]).shape == maintext.train().shape and np.isfinite(maintext.train(["<nav>a</nav>"])).all()
