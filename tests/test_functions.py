"""Column functions on enumerated cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.functions import numbers as N
from tessera.functions import text as X
from tessera.functions import urls as U


def run(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.withColumn("o", f(F.col("v"))).orderBy("i").select("o").collect()]


def test_entities(spark):
    cases = {"&#39;": "'", "&#x27;": "'", "&#X27;": "'", "&#8217;": "’", "&#038;": "&", "&#x1F600;": "\U0001f600", "&Eacute;": "é", "&euro;5 &deg;": "€5 °", "&#999999999999;": "", "&#0;": "", "&#x110000;": "",
             "&notanentity;": "&notanentity;", "&": "&", "&#;": "&#;", "a&lt;b&gt;c": "a<b>c", "plain": "plain", "x &#65; y &#x42; z": "x A y B z"}
    assert run(spark, X.decode_entities_once, list(cases)) == list(cases.values())
    assert run(spark, X.decode_entities, ["&amp;#8217;", "&amp;amp;", "éèü", None]) == ["’", "&", "éèü", ""]


def test_markup_and_titles(spark):
    assert run(spark, X.strip_html, ["<p>a <b>b</b></p><script>x<y</script>&lt;i&gt;c", None]) == ["a b c", ""]
    assert run(spark, X.normalise_title, ["Rates rise - Some News", "Rates - rise - more", "One|two", " x ", "A – B News"]) == ["Rates rise", "Rates - rise", "One|two", "x", "A"]
    assert run(spark, X.is_boilerplate, ["Daily cartoon for Monday", "5 May 2026", "What we know"]) == [True, True, False]
    d = spark.createDataFrame([("Rates rise. And, more", "u"), ("One thing", "https://x/newsletter/1"), ("One thing", "https://x/a"), ("A b. C d. E f", None)], "t string, u string")
    assert [r[0] for r in d.select(X.is_digest(F.col("t"), F.col("u"))).collect()] == [True, True, False, True]


def test_tokens(spark):
    assert run(spark, X.tokenise, ["The Fed's $20 million plan is 7% of it-all, U.S. too", None]) == [["fed", "20", "million", "plan", "7", "all", "too"], []]
    assert run(spark, X.tokenise, ["dock fees 12% of 20"]) == [["dock", "fees", "12", "20"]]


def test_excerpts_and_cuts(spark):
    long = "Word " * 60 + "ends here. " + "tail " * 60
    out = run(spark, X.excerpt, [long, "short", "x" * 500])
    assert out[0].endswith("ends here. …") and out[1] == "short" and out[2] == "x" * 400 + " …"
    assert run(spark, lambda c: X.trim_to_words(c, 3), ["a b c", "a b c, d"]) == ["a b c", "a b c …"]
    assert run(spark, X.normalise_name, ["The Daily News (UK)", "Sud-Ouest 24"]) == ["", "sudouest24"]


def test_paragraphs_and_sentences(spark):
    prose = "The harbour authority said on Monday that it would raise all of its dock fees."
    html = f"<nav>{prose}</nav><p>{prose}</p><p>Too short.</p><div>Subscribe to our newsletter today and read all of the stories that we ever publish.</div><!-- {prose} -->"
    assert run(spark, X.paragraphs, [html, None]) == [[prose], []]
    got = run(spark, lambda c: X.sentences(F.array(c)), ["One two three four five six. “Seven eight nine ten eleven twelve.” Short one."])
    assert got == [["One two three four five six.", "“Seven eight nine ten eleven twelve.”"]]


def test_domains(spark):
    cases = {"https://www.bbc.co.uk/news": "bbc.co.uk", "https://feeds.bbci.co.uk/rss": "bbci.co.uk", "https://z.net.in/d": "z.net.in", "https://sub.domain.example.com/x": "example.com", "www2.example.org/a?b": "example.org",
             "https://net.in/": None, "https://co.uk/": None, "": None, "not a url": None, "http://": None, "localhost": None, "https://user:p@A.Example.com:8443/x": "example.com"}
    assert run(spark, U.registrable, list(cases)) == list(cases.values())
    pair = spark.createDataFrame([("https://www.bbc.co.uk/a", "https://bbc.co.uk/b"), ("https://a.net.in/x", "https://b.net.in/y"), (None, None)], "a string, b string")
    assert [r[0] for r in pair.select(U.same_domain(F.col("a"), F.col("b"))).collect()] == [True, False, False]
    assert run(spark, U.normalise_domain, ["https://www.Example.com/a", "example.com"]) == ["example.com", "example.com"]


def test_canonical_urls(spark):
    cases = {"https://Example.com/a/?utm_source=x&b=1#top": "https://example.com/a?b=1", "http://example.com:80/": "http://example.com", "https://e.com/a?ref=1&refresh=2&id=3": "https://e.com/a?id=3", "nonsense": "nonsense"}
    assert run(spark, U.canonical, list(cases)) == list(cases.values())
    assert run(spark, U.decode_url, ["https://e.com/?a=1&#038;b=2", "https://e.com/?a=1&amp;b=2"]) == ["https://e.com/?a=1&b=2"] * 2


def test_search_and_feeds(spark):
    urls = ["https://s.com/search/?f=rss", "https://p.in/ViewRss.aspx?reg=1&lang=1", "https://w.com/?s=x", "https://w.com/?feed=rss2", "https://w.com/a?Search-Term=1", "bad", "https://w.com/research/feed"]
    assert run(spark, U.is_search_endpoint, urls) == [True, False, True, False, True, False, False]
    html = """<link rel="alternate" type="application/rss+xml" href="/main.xml"><link rel="alternate" type="application/rss+xml" href="/comments/feed">
      <link rel="stylesheet" href="/x.css"><a href="https://o.com/rss/world">r</a><a href="feeds/feed">f</a><a href="//cdn.o.com/feed">c</a>"""
    got = run(spark, lambda c: U.declared_feeds(c, F.lit("https://o.com/news/index.html")), [html])
    assert got == [["https://o.com/main.xml", "https://o.com/rss/world", "https://o.com/news/feeds/feed", "https://cdn.o.com/feed"]]
    v = run(spark, lambda c: U.feed_verdict(c, F.lit("text/html")), ["<rss><item>a</item><ITEM >b</ITEM></rss>", "<feed><entry>x</entry></feed>", "<html><item>"])
    assert [(x.is_feed, x.items) for x in v] == [(True, 2), (True, 1), (False, 0)]


def test_quantities(spark):
    got = run(spark, N.quantities, ["25 members and 12 by-elections, 5 kids", "Fees of $20 million, 12% and 900 boats; 1,500 seats", "between 3.75% and 4%", None])
    assert [q.value for q in got[0]] == [2.5e7, 1.2e10, 5e3]
    assert [(q.value, q.kind, q.currency) for q in got[1]] == [(2e7, "currency", "$"), (12.0, "percent", None), (9e11, "count", None), (1500.0, "count", None)]
    assert [q.in_range for q in got[2]] == [True, False]
    assert got[3] == []
    f = run(spark, N.figures, ["It cost $5 million to 30 people, or 7 percent."])[0]
    assert [x.value for x in f] == ["$5 million", "7 percent"]


def test_labels(spark):
    assert run(spark, L.side_of, ["left", "LEAN_RIGHT", "center", "state", None]) == ["left", "right", "centre", None, None]
    assert run(spark, L.reason_for_no_side, ["unrated", "state", "odd"]) == ["no bias rating on file for this outlet yet", 'lean "state" is not a left-right position', 'unmapped lean "odd"']
    assert run(spark, L.ad_fontes_scale, [-7.0, 7.0, 60.0, None], "double") == [0, 1, 3, None]
    assert run(spark, lambda c: L.normalise_rating(F.lit("mbfc"), c), ["Left-Center", "satire"]) == [-1, None]
    assert L.parse_quotas("Canada=3, India=2,X=,bad,Y=z") == {"Canada": 3, "India": 2, "X": 0}


def test_fnv(spark):
    assert run(spark, X.fnv1a, ["abc"]) == ["7aigaz"]
