"""Operators on small stories with values worked out by hand."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster as C
from tessera.operators import feeds, matching, stories, validation
from tessera.sources import landed, reports, sinks
from tessera.streaming.seen import unseen

ITEM = "ord bigint, outlet_id string, outlet string, lean string, country string, title string, url string, excerpt string, published_at timestamp, via string"
NOW = dt.datetime(2026, 9, 16, 9)


def item(n, outlet, lean, country, title, excerpt, url=None, when=NOW, via="rss"):
    return (n, outlet, outlet.title(), lean, country, title, url or f"https://{outlet}.example/{n}", excerpt, when, via)


HARBOUR = [
    item(0, "northwind", "lean_left", "CA", "Harbour authority raises dock fees by 12% after budget vote", "The harbour authority approved a dock fee increase worth $20 million to operators."),
    item(1, "southport", "right", "CA", "Dock fee rise of 12 percent confirmed by harbour authority", "Harbour authority confirmed the dock fee rise after a split budget vote."),
    item(2, "midland", "centre", "CA", "Harbour dock fees to rise 12% as budget vote splits council", "Council split over the harbour dock fee increase, which operators value at $28 million."),
    item(3, "northwind", "lean_left", "CA", "Harbour authority raises dock fees by 12% after budget vote (updated)", "Updated: the harbour authority approved the dock fee increase."),
    item(4, "midland", "centre", "CA", "Regional orchestra announces winter programme", "The orchestra will perform four concerts between December and February."),
]


@pytest.fixture(scope="module")
def harbour(spark):
    return spark.createDataFrame(HARBOUR, ITEM)


def test_similarities(harbour):
    vecs = C.vectors(harbour)
    got = {(r.i, r.j): round(r.sim, 4) for r in C.similar_pairs(harbour, vecs).collect()}
    assert got == {(0, 1): 0.4374, (0, 2): 0.5066, (1, 2): 0.4248, (1, 3): 0.4133, (2, 3): 0.4261}


def test_cluster_of_three_outlets(harbour):
    got = {r.cluster_id: r for r in C.cluster_items(harbour).collect()}
    assert [i.ord for i in got[0]["items"]] == [0, 1, 2, 3] and got[0].outlet_count == 3
    s = got[0].similarity
    assert (round(s.min, 4), round(s.max, 4), s.pairs, s.pruned_for_cohesion) == (0.4133, 0.5066, 5, 0)
    assert got[4].outlet_count == 1 and got[4].similarity.pairs == 0 and got[0].leans == ["lean_left", "right", "centre"]


def test_time_window_and_same_outlet(spark, harbour):
    late = harbour.withColumn("published_at", F.when(F.col("ord") == 1, F.lit("2026-08-01").cast("timestamp")).otherwise(F.col("published_at")))
    assert all(1 not in [i.ord for i in r["items"]] or len(r["items"]) == 1 for r in C.cluster_items(late).collect())
    one = harbour.where("outlet_id = 'northwind'")
    assert {r.outlet_count for r in C.cluster_items(one).collect()} == {1}
    assert C.cluster_items(harbour.limit(0)).count() == 0


def test_pruning_drops_the_loosest(spark):
    # a chain: 0-1 and 1-2 alike, 3 only near 2
    terms = {0: "ab", 1: "abc", 2: "bcd", 3: "dxyz"}
    rows = [(o, t, 1.0 / len(s) ** 0.5) for o, s in terms.items() for t in s]
    members = spark.createDataFrame([(o, 0) for o in terms], "ord bigint, cluster_id bigint")
    got = sorted(r.ord for r in C.prune(members, spark.createDataFrame(rows, "ord bigint, term string, w double"), floor=0.5).collect())
    assert got == [0, 1, 2]


def test_dedupe_keeps_the_first_place(spark):
    rows = [item(0, "a", None, None, "t", "x", "https://a.com/1?utm_x=1", via="gdelt"), item(1, "b", None, None, "t", "x", "https://b.com/"), item(2, "c", None, None, "t2", "x", "https://a.com/1/"), item(3, "d", None, None, "t3", "x", "https://a.com/1#z")]
    got = C.dedupe(spark.createDataFrame(rows, ITEM)).orderBy("ord").collect()
    assert [(r.ord, r.outlet_id) for r in got] == [(0, "c"), (1, "b")]


def test_fresh_and_complete(spark, harbour):
    df = harbour.withColumn("published_at", F.when(F.col("ord") == 0, None).when(F.col("ord") == 1, F.lit("2026-09-01").cast("timestamp")).otherwise(F.col("published_at")))
    assert sorted(r.ord for r in C.fresh(df, "2026-09-17").collect()) == [0, 2, 3, 4]
    assert C.complete(harbour.withColumn("title", F.when(F.col("ord") > 0, F.col("title")))).count() == 4


def test_conflict_and_terms(harbour):
    rows = stories.conflicts(harbour.withColumn("cluster_id", F.lit(0))).collect()
    assert len(rows) == 1 and rows[0].spread == 0.286 and rows[0].about == ["operators", "harbour", "dock", "increase"]
    assert [r.value for r in rows[0].readings] == ["$20 million", "$28 million"]
    terms = stories.key_terms(harbour.withColumn("cluster_id", F.lit(0))).first().terms
    assert terms[0] == "Harbour" and len(terms) <= 6


def test_regions(spark):
    df = spark.createDataFrame([("Ottawa and the rcmp agree", ["US"]), ("A bank in indiana", ["CA"]), ("europe and nato and the commissioner", []), ("Delhi", ["IN"])], "t string, c array<string>")
    got = [r.r for r in df.select(stories.regions(F.col("t"), F.col("c")).alias("r")).collect()]
    assert [r.regions for r in got] == [["Canada", "Global"], ["Global"], ["Europe", "Global"], ["Global"]]
    assert got[0].scores["Canada"] == 6 and got[0].matched == {"Canada": ["ottawa", "rcmp"]} and got[3].scores["India"] == 2


def test_framing(spark, harbour):
    c = C.cluster_items(harbour)
    f = {r.cluster_id: r.f for r in c.select("cluster_id", stories.frame(F.col("items")).alias("f")).collect()}
    assert f[0].axis.applies and f[0].axis.name == "left-right"
    assert [(v.side, v.status, len(v.outlets)) for v in f[0].views] == [("left", "sourced", 2), ("centre", "sourced", 1), ("right", "sourced", 1)]
    assert f[4].axis.reason == "only 1 of 1 items come from outlets placed on the left-right axis"


def test_quotas_report_and_backfill(spark):
    rows = [(i, n, ["CA"], (0.5,), i, r) for i, (n, r) in enumerate([(2, ["Canada", "Global"]), (5, ["Global"]), (4, ["Global"]), (3, ["Europe", "Global"])])]
    df = spark.createDataFrame(rows, "cluster_id bigint, outlet_count int, countries array<string>, similarity struct<max:double>, min_ord bigint, regs array<string>").withColumn("region", F.struct(F.col("regs").alias("regions")))
    picked, fill = stories.select_by_region(df, {"Canada": 2, "Europe": 1}, 3)
    assert [(r.cluster_id, r.quota_region) for r in picked.orderBy("slot").collect()] == [(0, "Canada"), (3, "Europe"), (1, None)]
    assert {r.region: (r.quota, r.filled, r.available) for r in fill.collect()} == {"Canada": (2, 1, 1), "Europe": (1, 1, 1)}


def test_candidates(spark, harbour):
    c = stories.with_regions(C.cluster_items(harbour)).where("outlet_count >= 2")
    docs = spark.createDataFrame([], "cluster_id bigint, title string, url string, published date, publisher string, doc_type string, ref string")
    c = stories.verify(c, docs, "2026-09-17")
    roster = spark.createDataFrame([("northwind", "lean_left", ("left-center", "https://r/1")), ("southport", "right", None)], "id string, lean string, mbfc struct<bias:string,url:string>")
    articles = spark.createDataFrame([("https://northwind.example/0", True, ["q"], []), ("https://southport.example/1", False, [], [])], "url string, ok boolean, quotes array<string>, figures array<struct<value:string,context:string>>")
    cands = stories.candidates(c, roster, articles, stories.conflicts(c.select("cluster_id", F.inline("items"))))
    r = cands.first()
    assert r.tier == "multi" and r.tier_basis == "reported independently by 3 outlets" and r.context is None and len(r.disputed_candidates) == 1
    assert r.sources[0].b == "left-center" and r.sources[0].label_source.provider == "mbfc" and r.sources[0].read == "article read"
    assert r.sources[1].b == "right" and r.sources[1].read == "headline and feed excerpt"
    assert r.verification.gap.startswith("No primary document found. 10 of 11")
    balance = stories.side_balance(cands)
    assert {x.side: x.candidates for x in balance.collect()} == {"left": 1, "centre": 1, "right": 1, "none": 0}
    assert stories.starved_sides(balance, 1).count() == 0
    primary = docs.union(spark.createDataFrame([(0, "t", "u", dt.date(2026, 9, 10), None, "Rule", "1")], docs.schema))
    us = c.drop("verification").withColumn("countries", F.array(F.lit("US")))
    assert stories.candidates(stories.verify(us, primary, "2026-09-17"), roster, articles, stories.conflicts(c.select("cluster_id", F.inline("items")))).first().tier == "primary"


def test_distil_budgets(spark):
    said = [f"The minister said on day {i} that the plan would go ahead in spite of objections from many members and all of the unions of the port." for i in range(8)]
    filler = ["This is a long paragraph of ordinary words that only fills the article so that its share is large enough for quotes."] * 30
    df = spark.createDataFrame([(said + filler,), (said[:1],), ([],)], "p array<string>")
    a, b, c = (r.d for r in df.select(stories.distil(F.col("p")).alias("d")).collect())
    assert 1 <= len(a.quotes) <= 3 and all(len(q.split()) <= 31 for q in a.quotes) and sum(map(len, a.quotes)) <= 450 and a.quoted_words <= a.word_count * 0.1 + 1
    assert len({q[:40] for q in a.quotes}) == len(a.quotes)
    assert b.quotes == [] and c.quotes == [] and c.word_count == 0


def test_robots(spark):
    text = "# c\nUser-agent: BadBot\nDisallow: /\n\nUser-agent: *\nDisallow: /private\nAllow: /private/feed.xml\nDisallow:\nDisallow: /*?\nDisallow: /*.pdf$\n"
    rules = feeds.parse_robots(spark.createDataFrame([("h", text)], "host string, text string"), "tessera")
    assert rules.count() == 4
    paths = ["/private/x", "/private/feed.xml", "/news", "/news?x=1", "/a.pdf", "/a.pdfx"]
    probes = spark.createDataFrame([("h", p) for p in paths] + [("other", "/private")], "host string, path string")
    got = {(r.host, r.path): r.allowed for r in feeds.robots_allowed(probes, rules).collect()}
    assert [got["h", p] for p in paths] == [False, True, True, False, False, True] and got["other", "/private"]


def test_feed_checks_and_probes(spark):
    targets = spark.createDataFrame([("a", "A", "left", "CA", "https://a/rss"), ("b", "B", "right", "CA", ""), ("c", "C", "left", "CA", "https://c/rss"), ("d", "D", None, None, "https://d/rss")], "id string, name string, lean string, country string, feed string")
    responses = spark.createDataFrame([("https://a/rss", 200, "https://a/new", "", "<rss><item>x</item></rss>", None, None), ("https://c/rss", 404, "https://c/rss", "", "", None, None), ("https://d/feed", 200, "https://d/feed", "", "<rss><item>x</item></rss>", None, None)], "url string, status int, final_url string, content_type string, body string, error string, blocked_by string")
    got = {r.id: r for r in feeds.check_feeds(targets, responses).collect()}
    assert (got["a"].ok, got["a"].redirected, got["b"].note, got["c"].note, got["d"].note) == (True, "https://a/new", "no feed url", "HTTP 404", "not fetched")
    failed = targets.where("id = 'd'").select("id", "feed", *(F.lit(None).cast("string").alias(c) for c in ("feed_index", "index_html", "page_html", "page_type", "home_html")))
    probes = feeds.probe_list(failed)
    assert feeds.first_working(probes, responses).collect()[0].suggested == "https://d/feed"
    roster = targets.withColumn("verified", F.lit(False)).withColumn("feed_items", F.lit(None).cast("int")).withColumn("feed_checked", F.lit(None).cast("date")).withColumn("feed_error", F.lit(None).cast("string"))
    merged = {r.id: r for r in matching.merge_roster(roster, feeds.check_feeds(targets, responses).withColumn("suggested", F.lit(None).cast("string")), "2026-09-17").collect()}
    assert merged["a"].verified and merged["a"].feed == "https://a/new" and merged["c"].feed_error == "HTTP 404"
    good, bad = feeds.targets(roster)
    assert good.count() == 0 and {r.reason for r in bad.collect()} == {"feed not verified", "no feed url in roster"}
    diag = spark.createDataFrame([("x", "current", False, "HTTP 403"), ("x", "browser", True, ""), ("y", "current", False, "robots.txt")], "id string, agent string, ok boolean, note string")
    assert {r.id: r.verdict[:10] for r in feeds.diagnose(diag).collect()} == {"x": "only a bro", "y": "robots.txt"}


def test_probe_ladder(spark):
    link = lambda *paths: "".join(f'<link rel="alternate" type="application/rss+xml" href="{p}">' for p in paths)
    rows = [("theprint", "https://theprint.in/old", "https://theprint.in/feeds", link(*(f"/i{i}" for i in range(8))), link("/p1", "/i0"), "text/html", link("/h1", "/old")), ("b", "https://b.org/x", None, None, link("/p1"), "application/xml", None), ("reuters", None, None, None, None, None, link("/w"))]
    failed = spark.createDataFrame(rows, "id string, feed string, feed_index string, index_html string, page_html string, page_type string, home_html string")
    got = {i: [r.url for r in feeds.candidate_urls(failed).where(F.col("id") == i).orderBy("nth").collect()] for i in ("theprint", "b", "reuters")}
    site = "https://theprint.in"
    assert got["theprint"][:9] == [*(f"{site}/i{i}" for i in range(5)), f"{site}/feed", f"{site}/rss", f"{site}/p1", f"{site}/h1"]
    assert len(got["theprint"]) == 9 + 12 and f"{site}/old" not in got["theprint"]
    assert got["b"] == [f"https://b.org{p}" for p in feeds.USUAL] and got["reuters"][:2] == ["https://www.reuters.com/w", "https://www.reuters.com/feed"]
    found = spark.createDataFrame([("b", "https://b.org/feed")], "id string, suggested string")
    assert {r.id for r in feeds.gave_up(feeds.candidate_urls(failed), found, most=14).collect()} == {"theprint", "reuters"}
    assert feeds.probe_list(failed, most=3).groupBy("id").count().where("count = 3").count() == 3


def test_records_with_fields_of_the_same_letters(spark):
    recs = spark.createDataFrame([('[{"Source":"","source":"B","Bias":null,"bias ":"Left"},{"Source ":"A","source":"B"},{}]',)], "body string")
    assert [(r.source, r.bias) for r in landed.records(recs).orderBy("pos").collect()] == [("B", "Left"), ("A", None), (None, None)]


def test_articles_to_read(harbour):
    got = stories.articles_to_read(C.cluster_items(harbour), 2).orderBy("cluster_id", "pos").collect()
    assert [(r.cluster_id, r.pos) for r in got] == [(0, 0), (0, 1), (4, 0)]


def test_ratings(spark):
    r = spark.createDataFrame([("a", 0, "mbfc", "Left", None), ("a", 1, "allsides", "lean left", ["satire", "x"]), ("b", 0, "mbfc", "Right", None), ("b", 1, "allsides", "Left", None), ("c", 0, "mbfc", "Conspiracy", ["conspiracy"]), ("d", 0, "adfontes", "20", None)], "outlet_id string, pos int, provider string, raw string, flags array<string>")
    o = spark.createDataFrame([("a", "right"), ("b", None), ("c", "left"), ("d", "left"), ("e", "left")], "outlet_id string, roster_lean string")
    got = {x.outlet_id: x for x in matching.consensus(r, o).collect()}
    assert [got[k].status for k in "abcde"] == ["agree", "disagree", "unplaced", "single_source", "unrated"]
    assert got["a"].consensus == -1 and got["a"].roster_disagrees and got["a"].flags == ["satire"] and got["a"].display == "mbfc: Left  ·  allsides: lean left"
    assert got["b"].spread == 4 and got["b"].consensus is None and not got["b"].roster_disagrees and got["d"].consensus == 1 and got["d"].roster_disagrees


def test_card_rules(spark):
    views = lambda *drop: [(s, "", "A", [0], "text", "sourced") if s != "right" else (s, "", None, [], None, "not sourced") for s in ("left", "centre", "right") if s not in drop]
    src = [("A", "t", "https://a/1", "left", ("roster", None), None), ("B", "t", "https://b/1", None, None, "primary")]
    schema = "card bigint, sources array<struct<n:string,t:string,u:string,b:string,label_source:struct<provider:string,url:string>,kind:string>>, headline string, context string, coverage string, regions array<string>, facts array<struct<t:string,s:array<int>,tier:string>>, disputed array<struct<t:string>>, views array<struct<side:string,label:string,outlet:string,s:array<int>,text:string,status:string>>, axis struct<applies:boolean,name:string>, gaps array<string>, _prose string"
    good = (0, src, "h", "c", "v", ["Global"], [("f", [0, 1], "multi"), ("p", [1], "primary")], [], views(), (True, "left-right"), ["g"], None)
    bad = (1, [("", "", "ftp://x", "left", None, None), ("C", "t", "https://c", "r", ("mbfc", None), None), ("C", "t", "https://c", None, None, None)], None, " ", "v", [], [("", [], "odd"), ("f", [9], "multi"), ("f", [1], "primary"), ("f", [0, 1], "single")], [("",)],
           [("left", "", "Z", [1], "t", None), ("left", "", "Q", [], "", "sourced"), ("left", "", "", [0], "text", "sourced"), ("up", "", "", [], "", None), ("right", "", None, [], "text", "not sourced")], (False, ""), [""], "x")
    df = spark.createDataFrame([good, bad], schema)
    found = validation.problems(df).collect()
    assert [r for r in found if r.card == 0] == []
    codes = {r.code for r in found}
    assert codes >= {"source-unnamed", "source-untitled", "source-url", "source-duplicate", "mbfc-unlinked", "label-unattributed", "prose-missing", "prose-null", "no-regions", "fact-empty", "fact-uncited", "fact-bad-index", "tier-missing", "tier-multi-unsupported", "tier-primary-unsupported", "tier-single-understated",
                     "view-missing", "view-side", "view-duplicate", "view-synthesised", "view-empty", "view-unattributed", "view-uncited", "view-outlet-mismatch", "axis-unnamed", "gap-empty", "disputed-empty", "candidate-leftover"}
    assert {r.code for r in validation.problems(df.where("card = 0").withColumn("sources", F.filter("sources", lambda s: F.lit(False))).withColumn("facts", F.filter("facts", lambda s: F.lit(False)))).collect()} >= {"no-sources", "no-facts", "view-bad-index"}
    starved = validation.payload_problems(df.where("card = 0")).where("code = 'balance-starved'").collect()
    assert [r.path for r in starved] == ["right"]
    s = validation.summarise(validation.problems(df.where("card = 1"))).first()
    assert not s.ok and s.errors > 20 and s.warnings >= 4
    raw = spark.createDataFrame([(0, '{"gaps": "x", "disputed": 3}'), (1, "[]"), (2, '{"gaps": []}')], "card bigint, json string")
    assert sorted((r.card, r.code) for r in validation.raw_shapes(raw).collect()) == [(0, "disputed-shape"), (0, "gaps-shape"), (1, "payload-shape")]


def test_feed_items(spark):
    rss = """<?xml version="1.0"?><rss><channel><title>c</title><item><title><![CDATA[A & b]]></title><link>https://a.com/1?x=1&amp;y=2</link><description>&lt;p&gt;Hello&lt;/p&gt;</description><pubDate>Wed, 16 Sep 2026 09:00:00 GMT</pubDate></item>
    <item><title>No link</title></item><item><title>By guid</title><guid isPermaLink="true">https://a.com/2</guid><dc:date>2026-09-16T10:00:00Z</dc:date></item></channel></rss>"""
    atom = """<feed><entry><title type="html">C</title><link rel="self" href="https://b.com/self"/><link href="https://b.com/1"/><summary>s</summary><updated>2026-09-16T11:00:00+02:00</updated></entry></feed>"""
    bodies = spark.createDataFrame([("a", rss), ("b", atom)], "outlet_id string, body string")
    outlets = spark.createDataFrame([(0, "a", "A", "left", "CA"), (1, "b", "B", None, None)], "pos int, id string, name string, lean string, country string")
    got = landed.feed_items(bodies, outlets, "2026-09-17").orderBy("ord").collect()
    assert [(r.title, r.url, r.excerpt) for r in got] == [("A & b", "https://a.com/1?x=1&y=2", "Hello"), ("By guid", "https://a.com/2", ""), ("C", "https://b.com/1", "s")]
    assert [r.published_at.hour for r in got] == [9, 10, 9] and got[0].outlet == "A" and got[2].ord == 1_000_000


def test_search_hits_records_and_roster_file(spark, tmp_path):
    assert landed.build_query(["Canada", "European Union"], "CA") == 'Canada "European Union" sourcecountry:CA sourcelang:english'
    body = '{"articles":[{"title":"T","url":"https://www.a.com/1","domain":"a.com","seendate":"20260917T143000Z","sourcecountry":"Canada"},{"title":"","url":"x"}]}'
    hits = landed.search_hits(spark.createDataFrame([("q", 0, body)], "query string, n int, body string"), "2026-09-17")
    roster = spark.createDataFrame([(0, "a", "A", "left", "CA", "https://rss.a.com/x"), (1, "z", "Z", "right", "US", "https://feeds.a.com/y")], "pos int, id string, name string, lean string, country string, feed string")
    m = matching.match_to_roster(hits, roster)
    r = m.first()
    assert (r.outlet_id, r.country, r.matched, r.published_at.hour) == ("z", "US", True, 14)
    assert matching.query_counts(m).first().known == 1
    recs = landed.records(spark.createDataFrame([('{"data":[{"Source ID#":"7","Source":"A","Source URL":"a.com","Bias":"Left","MBFC URL":"https://m/1"}]}',), ('[{"source":"B","Bias":"Satire"}]',)], "body string"))
    parsed = {x.name: x for x in matching.parse_ratings(recs).collect()}
    assert parsed["A"].score == -2 and parsed["A"].mbfc_id == "7" and parsed["B"].score is None and parsed["B"].flags == ["satire"]
    path = tmp_path / "r.json"
    path.write_text('{"outlets":[{"id":"a","name":"A","feed":"","verified":true},{"id":"b","name":"B","feed":"https://b/rss","mbfc":{"bias":"left"}}]}')
    rows = landed.roster(spark, f"file://{path}").orderBy("pos").collect()
    assert rows[0].feed is None and rows[1].mbfc.bias == "left" and rows[1].pos == 1


def said(report):
    return "\n".join(r.line for r in report.orderBy("part", "kind", "line").collect())


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert not sinks.write_json(df, f"file://{tmp_path}/o", dry_run=True) and not (tmp_path / "o").exists()
    assert sinks.write_json(df, f"file://{tmp_path}/o")
    # empty partitions may leave files of their own
    assert '"b":null' in "".join(f.read_text() for f in (tmp_path / "o").glob("part-*"))
    piped = spark.createDataFrame([(1, "a|b"), (2, None)], "a int, b string")
    report = sinks.lines(spark, "R", [spark.createDataFrame([("one",), ], "line string")], {"S": sinks.table_rows(piped), "E": sinks.table_rows(df.limit(0))}, {"S": sinks.table_head(piped)})
    assert said(report) == "# R\n\none\n\n## S\n\n| a | b |\n|-|-|\n| 1 | a\\|b |\n| 2 |  |\n\n## E\n\nNone.\n"
    sinks.write_lines(report, f"file://{tmp_path}/report")
    (file,) = (tmp_path / "report").glob("part-*.txt")
    assert file.read_text() == said(report) + "\n"
    pages = {
        'x const S = [1, "]", [2]]; y': "x const S = [9]; y", "const S = []": "const S = [9]", "const S = [[], '\\']', `[`, \"\\\\\"] z]": "const S = [9] z]", "const S = [1": None, "const T = [1]": None, "": None, None: None,
        "const S = [" + '"a\\"]", ' * 3000 + "];": "const S = [9];", "const S = ['" + "x" * 200_000 + "']": "const S = [9]",
    }
    got = spark.createDataFrame([(p, w) for p, w in pages.items()], "page string, want string").select(sinks.splice(F.col("page"), "S", F.lit("[9]")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)
    none = spark.range(0)
    gate = sinks.gate(none, none, none, validation.summarise(none.select(F.lit("error").alias("level")))).first()
    assert gate.exit_code == 0


def test_reports(spark):
    checks = spark.createDataFrame([("a", "A", "left", "CA", "https://a/rss", True, None, "https://a/new", None), ("b", "B", None, "CA", None, False, "no feed url", None, "https://b/feed"), ("z", "Z", "left", None, "https://z", False, "HTTP 404", None, None)], "id string, name string, lean string, country string, url string, ok boolean, note string, redirected string, suggested string")
    text = said(reports.feed_report(checks, "now"))
    assert "Verified: 1/3" in text and "- left: 1/2 verified" in text and "- **B** (CA) — no feed url — try `https://b/feed`\n  - tried: `(none)`" in text and "- **A**: `https://a/rss` -> `https://a/new`" in text
    assert "## Redirects worth pinning\n\nNone." in said(reports.feed_report(checks.where("NOT ok"), "now"))
    diag = spark.createDataFrame([("x", "current", False, "HTTP 403"), ("x", "browser", True, "7")], "id string, agent string, ok boolean, note string")
    assert "| x | HTTP 403 | - | OK (7) | only a browser string works" in said(reports.diagnosis_report(diag, "now"))
    roster = spark.createDataFrame([("a", "A", "CA", "left", "https://a/rss"), ("b", "B", "CA", "right", None), ("c", "C", "IN", "centre", None)], "id string, name string, country string, lean string, feed string")
    ladder = spark.createDataFrame([("a", "applied", "domain", "A"), ("b", "review", "name", "Bee"), ("c", "missed", None, None)], "id string, status string, matched_on string, rating_name string")
    ratings = spark.createDataFrame([("A", "Left-Center", "High", "https://m/a"), ("Bee", "Right", None, None)], "name string, bias string, factual string, mbfc_url string")
    text = said(reports.rating_review(ladder, roster, ratings))
    assert "Applied: 1/3" in text and "- **A** — roster `left` vs rating `Left-Center`" in text and "link none: cannot be shown" in text and "- **C** (IN, centre)" in text
    merged = roster.withColumn("feed", F.when(F.col("id") == "a", "https://a/new").otherwise(F.col("feed")))
    text = said(reports.applied_report(checks, roster, merged, "now"))
    assert "  - was: `https://a/rss`\n  - now: `https://a/new`" in text and "- z (Z)" in text and "- **Z** (left) — HTTP 404" in text


def test_unseen_stream(spark, tmp_path):
    rows = [("https://a.com/1", NOW), ("https://a.com/1/?utm_a=1", NOW), ("https://a.com/2", NOW)]
    spark.createDataFrame(rows, "url string, published_at timestamp").write.parquet(f"file://{tmp_path}/in")
    stream = unseen(spark.readStream.schema("url string, published_at timestamp").parquet(f"file://{tmp_path}/in"))
    q = stream.writeStream.format("memory").queryName("seen").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("SELECT count(*) AS n FROM seen").first().n == 2
