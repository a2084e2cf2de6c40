"""Queries over landed inputs: feeds, search hits, registries, rating files, feed checks. The inputs are made of the benchmark tables,
in pieces of at most 50 rows a body, so that no group of any size comes into one row."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.functions import urls as U
from tessera.operators import cluster as C
from tessera.operators import feeds, matching, stories, validation
from tessera.plans import adapters as A
from tessera.plans import sql as S
from tessera.plans.catalog import query
from tessera.plans.run import daily
from tessera.sources import bodies as landed_bodies
from tessera.sources import landed
from tessera.storage import Stored, delete, shared_dir

_KINDS = ("rss", "atom", "rdf")
_WORDS = "trim(regexp_replace(coalesce(text, ''), '[^A-Za-z .]+', ' '{g}))"


def _entry(kind: Column) -> Column:
    """One entry of a feed: RSS with CDATA and RFC 822 times, Atom with two links, RDF with dc:date; every seventh lacks its link."""
    title = F.concat(F.lit("Report "), F.col("doc_id").cast("string"), F.lit(" &amp;amp; more from "), F.col("source"))
    link = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("doc_id").cast("string"))
    words = F.expr(_WORDS.format(g=""))
    when = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)
    rss = F.concat(F.lit("<item><title>"), title, F.lit("</title>"), F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("<link>"), link, F.lit("?a=1&amp;b=2</link>"))).otherwise(""), F.lit("<description><![CDATA[<p>"), words, F.lit("</p>]]></description><pubDate>"), F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate></item>"))
    atom = F.concat(F.lit('<entry><title type="html">'), title, F.lit('</title><link rel="self" href="https://self.example.com/"/><link rel="alternate" href="'), link, F.lit('"/><summary>'), words, F.lit("</summary><updated>"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</updated></entry>"))
    rdf = F.concat(F.lit("<item><title>"), title, F.lit('</title><guid isPermaLink="true">'), link, F.lit("</guid><description>"), words, F.lit("</description><dc:date>"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00</dc:date></item>"))
    return F.when(kind == 0, rss).when(kind == 1, atom).otherwise(rdf)


def _bodies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(landed bodies, outlets) made of the documents."""
    d = A.table(spark, sf_dir, "documents").withColumn("kind", F.regexp_extract("source", r"(\d+)", 1).cast("int") % 3)
    d = d.withColumn("part", F.expr("doc_id div 50")).withColumn("xml", _entry(F.col("kind")))
    grouped = d.groupBy(F.col("source").alias("outlet_id"), "kind", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "xml"))), lambda x: x["xml"]), "\n").alias("all"))
    head = F.when(F.col("kind") == 0, "<?xml version='1.0'?><rss><channel><title>c</title>").when(F.col("kind") == 1, "<feed xmlns='http://www.w3.org/2005/Atom'>").otherwise("<rdf:RDF>")
    number = F.regexp_extract("outlet_id", r"(\d+)", 1).cast("int")
    outlets = d.select(F.col("source").alias("outlet_id")).distinct().select(number.alias("pos"), F.col("outlet_id").alias("id"), F.upper("outlet_id").alias("name"), F.get(F.array(*(F.lit(x) for x in A.LEANS)), number % 7).alias("lean"), F.get(F.array(*(F.lit(x) for x in A.COUNTRIES)), number % 5).alias("country"))
    return grouped.select("outlet_id", (F.col("part") * 50).alias("start"), F.concat(head, "all").alias("body")), outlets


_FEED_SQL = f"""src AS (SELECT doc_id, source, regexp_extract(source, '(\\d+)', 1)::INT AS k, {_WORDS.format(g=", 'g'")} AS w FROM documents),
fit AS (SELECT *, trim(regexp_replace(w, ' +', ' ', 'g'), ' ') AS body FROM src WHERE NOT (k % 3 = 0 AND doc_id % 7 = 0)),
fcut AS (SELECT *, substr(body, 1, 400) AS head, length(regexp_extract(substr(body, 1, 400), '(?s)^(.*[.?!]) ', 1)) AS last FROM fit),
feed AS (SELECT doc_id, source AS outlet_id, upper(source) AS outlet, ({A._LEANS})[k % 7 + 1] AS lean, ({A._COUNTRIES})[k % 5 + 1] AS country, 'Report ' || doc_id || ' & more from ' || source AS title,
  'https://' || source || '.example.com/' || doc_id || CASE WHEN k % 3 = 0 THEN '?a=1&b=2' ELSE '' END AS url,
  CASE WHEN length(body) <= 400 THEN body ELSE (CASE WHEN last > 201 THEN substr(head, 1, last) ELSE rtrim(head, ' ') END) || ' …' END AS excerpt,
  to_timestamp(1704067200 + doc_id * 60)::TIMESTAMP - INTERVAL 1 HOUR * (k % 3 = 2)::INT AS published_at FROM fcut)"""


@query(f"WITH {_FEED_SQL} SELECT outlet_id, outlet, lean, country, title, url, excerpt, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published FROM feed")
def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of RSS, Atom and RDF bodies."""
    items = landed.feed_items(*_bodies(spark, sf_dir), "2024-02-01")
    return items.select("outlet_id", "outlet", "lean", "country", "title", "url", "excerpt", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"))


@query(f"WITH {_FEED_SQL} SELECT outlet_id, outlet, title, url, excerpt, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published FROM feed WHERE doc_id // 50 * 50 >= 200 AND regexp_extract(outlet_id, '(\\d+)', 1)::INT % 4 <> 2")
def landed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of bodies that were landed in folders by hour and read again: those from a certain hour on, of some outlets."""
    found, outlets = _bodies(spark, sf_dir)
    landed_bodies.register(spark)
    path = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    found.select("outlet_id", F.timestamp_seconds(F.lit(1704067200) + F.col("start") * 60).alias("landed_at"), "body").write.format("landed").mode("append").save(path)
    read = spark.read.format("landed").load(path).where("landed_at >= TIMESTAMP '2024-01-01 03:20:00'")
    chosen = outlets.where("pos % 4 <> 2")
    items = Stored(landed.feed_items(read, chosen, "2024-02-01"), "feeds")
    delete(spark, path)
    return items.df.select("outlet_id", "outlet", "title", "url", "excerpt", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses made of the pages: 50 a body, every eleventh hit without a title."""
    p = A.table(spark, sf_dir, "pages").withColumn("n", F.expr("int(page_id div 50)"))
    hit = F.struct("page_id", F.when(F.col("page_id") % 11 != 0, F.concat(F.lit("Page &amp; "), F.col("page_id").cast("string"))).otherwise("").alias("title"), F.concat(F.lit(" https://www.s"), (F.col("page_id") % 60).cast("string"), F.lit(".co.uk/a?x=1&amp;y="), F.col("page_id").cast("string")).alias("url"), F.lit("d").alias("domain"), F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 60), "yyyyMMdd'T'HHmmss'Z'").alias("seendate"), F.lit("Canada").alias("sourcecountry"))
    b = p.groupBy("n").agg(F.array_sort(F.collect_list(hit)).alias("articles"))
    return landed.search_hits(b.select(F.concat(F.lit("q"), (F.col("n") % 4).cast("string")).alias("query"), "n", F.to_json(F.struct("articles")).alias("body")), "2024-02-01")


_HITS_SQL = """hits AS (SELECT page_id, 'q' || ((page_id // 50) % 4) AS query, 'Page & ' || page_id AS title, 'https://www.s' || (page_id % 60) || '.co.uk/a?x=1&y=' || page_id AS url,
  's' || (page_id % 60) || '.co.uk' AS domain, to_timestamp(1704067200 + page_id * 60)::TIMESTAMP AS published_at FROM pages WHERE page_id % 11 <> 0)"""


@query(f"WITH {_HITS_SQL} SELECT title, url, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published, 'headline only' AS read, query FROM hits")
def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir).select("title", "url", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"), "read", "query")


@query(f"""WITH {A.ROSTER_SQL}, {_HITS_SQL}, known AS (SELECT DISTINCT domain FROM roster WHERE domain IS NOT NULL)
SELECT query, count(*) AS total, count(known.domain) AS known, count(*) - count(known.domain) AS unknown FROM hits LEFT JOIN known USING (domain) GROUP BY query""")
def query_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many hits of each search are of known outlets."""
    return matching.query_counts(matching.match_to_roster(_hits(spark, sf_dir), A.roster(spark, sf_dir)))


@query(f"""WITH {A.ROSTER_SQL}, {_FEED_SQL}, {_HITS_SQL},
found AS (SELECT url, published_at FROM feed UNION ALL SELECT h.url, h.published_at FROM hits h),
keyed AS (SELECT url, published_at FROM found GROUP BY ALL),
known AS (SELECT DISTINCT 'https://www.' || domain || '/' AS site FROM roster WHERE domain IS NOT NULL)
SELECT (SELECT count(*) FROM feed) AS rss, (SELECT count(*) FROM hits) AS searched, (SELECT count(*) FROM keyed) AS merged,
  (SELECT count(*) FROM keyed WHERE published_at >= TIMESTAMP '2024-01-01 12:00:00' - INTERVAL 11 HOURS) AS fresh,
  (SELECT count(*) FROM keyed WHERE published_at >= TIMESTAMP '2024-01-01 12:00:00' - INTERVAL 11 HOURS AND EXISTS (SELECT 1 FROM known WHERE starts_with(url, site))) AS matched,
  (SELECT count(*) FROM roster WHERE domain IS NULL OR NOT verified) AS failures""")
def ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds and search hits together, once each, fresh ones, matched to the roster; and outlets that could not be read: counts."""
    rss, hits = landed.feed_items(*_bodies(spark, sf_dir), "2024-02-01"), _hits(spark, sf_dir)
    both = C.complete(rss.unionByName(hits.withColumn("ord", F.col("ord") + 10**15), allowMissingColumns=True))
    merged = C.dedupe(both)
    fresh = C.fresh(merged, "2024-01-01 12:00:00", 11)
    matched = matching.match_to_roster(fresh, A.roster(spark, sf_dir)).where("matched")
    _, failures = feeds.targets(A.roster(spark, sf_dir))
    out = None
    for name, df in (("rss", rss), ("searched", hits), ("merged", merged), ("fresh", fresh), ("matched", matched), ("failures", failures)):
        one = df.agg(F.count(F.lit(1)).alias(name))
        out = one if out is None else out.join(F.broadcast(one))
    return out


_RUN_QUOTAS = {"Canada": 2, "India": 2, "Europe": 2, "Global": 1}
#: Items of verified outlets' feeds, every fifth outlet's not, and hits: one a page, on document 4 * page_id, on 25 sites of which the roster has some; every tenth has the address of the one before.
_RUN_ITEMS = f"""{_FEED_SQL},
nth AS (SELECT doc_id, doc_id // 50 * 50 + row_number() OVER (PARTITION BY source, doc_id // 50 ORDER BY doc_id) - 1 AS n FROM src),
placed AS (SELECT feed.*, k AS pos, n FROM feed JOIN src USING (doc_id) JOIN nth USING (doc_id)),
rss AS (SELECT pos * 1000000 + n AS ord, doc_id, epoch(published_at) / 60 AS minute, outlet_id, outlet, lean, country, title, excerpt, doc_id % 2 = 0 AS readable FROM placed WHERE pos % 5 <> 4),
sites AS (SELECT DISTINCT source, regexp_extract(source, '(\\d+)', 1)::INT AS pos FROM documents),
given AS (SELECT page_id, page_id - (page_id % 10 = 9)::INT AS u, page_id // 50 * 1000 + row_number() OVER (PARTITION BY page_id // 50 ORDER BY page_id) - 1 AS place FROM pages),
hits AS (SELECT * FROM given WHERE page_id % 11 <> 0),
known AS (SELECT 1000000000000000 + place AS ord, u, 1704067200 / 60 + page_id * 4 AS minute, source AS outlet_id, upper(source) AS outlet, ({A._LEANS})[pos % 7 + 1] AS lean, ({A._COUNTRIES})[pos % 5 + 1] AS country, trim('Report ' || page_id * 4 || ' & more, ' || (['Ottawa', 'Modi', 'Brussels', ''])[page_id % 4 + 1]) AS title, '' AS excerpt
  FROM hits JOIN sites ON pos = u % 25),
items AS (SELECT ord, doc_id, minute, outlet_id, outlet, lean, country, title, excerpt, readable FROM rss
  UNION ALL SELECT ord, NULL, minute, outlet_id, outlet, lean, country, title, excerpt, false FROM known QUALIFY row_number() OVER (PARTITION BY u ORDER BY ord) = 1),
it AS (SELECT * FROM items WHERE minute >= epoch(TIMESTAMP '2024-01-02 00:00:00') / 60 - 18 * 60)"""


@query(f"""WITH RECURSIVE {S.stories_of(_RUN_ITEMS)}, told AS (SELECT * FROM stories WHERE outlet_count >= 2),
{S.quota_steps(_RUN_QUOTAS, 'told')},
picked AS (SELECT r.*, quota_region, list_contains(countries, 'US') OR len(list_filter(titles, lambda t: regexp_matches(t, '\\b(U\\.?S\\.?|Washington|White House|Congress|Federal)\\b'))) > 0 AS applies FROM filled JOIN ranked r USING (cluster_id) WHERE slot < 8),
fill AS (SELECT q.region, q.quota, (SELECT count(*) FROM taken{len(_RUN_QUOTAS)} WHERE quota_region = q.region) AS filled, (SELECT count(*) FROM told WHERE list_contains(regions, q.region)) AS available FROM (VALUES {', '.join(f"('{r}', {n})" for r, n in _RUN_QUOTAS.items())}) q(region, quota))
SELECT (SELECT count(*) FROM rss) AS rss_items, (SELECT count(*) FROM hits) AS hits, (SELECT count(*) FROM known) AS hits_matched, (SELECT count(*) FROM items) AS items, (SELECT count(*) FROM clusters) AS clusters, (SELECT count(*) FROM told) AS stories, (SELECT count(*) FROM picked) AS candidates,
  coalesce((SELECT list(cluster_id ORDER BY cluster_id) FROM picked), []) AS chosen, (SELECT count(*) FROM picked WHERE len(list_filter(leans, lambda x: x IN ('left', 'lean_left'))) > 0) AS left_side, (SELECT list(region || ' ' || filled || ' of ' || quota || ', ' || available ORDER BY region) FROM fill) AS fill,
  (SELECT count(*) FROM picked WHERE applies AND cluster_id IN (SELECT ord FROM rss WHERE doc_id % 3 <> 1)) AS confirmed, (SELECT count(*) FROM own JOIN picked USING (cluster_id) WHERE own.ord IN (SELECT ord FROM rss WHERE readable)) AS articles,
  (SELECT count(*) FROM own JOIN picked USING (cluster_id) WHERE own.ord >= 1000000000000000) AS chosen_hits, (SELECT count(DISTINCT outlet_id) FROM feed WHERE regexp_extract(outlet_id, '(\\d+)', 1)::INT % 5 = 4) AS failures""")
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over feeds and search hits, registry documents and read articles, under quotas for all regions: its report and
    what its candidates rest on."""
    d = A.table(spark, sf_dir, "documents")
    found, outlets = _bodies(spark, sf_dir)
    roster = outlets.withColumn("feed", F.concat(F.lit("https://"), "id", F.lit(".org/rss"))).withColumn("verified", F.col("pos") % 5 != 4).withColumn("mbfc", F.lit(None).cast("struct<bias:string,url:string>"))
    p = A.table(spark, sf_dir, "pages").withColumn("n", F.expr("int(page_id div 50)"))
    u = F.col("page_id") - (F.col("page_id") % 10 == 9).cast("int")
    url = F.concat(F.lit("https://www.src"), (u % 25).cast("string"), F.lit(".org/a?y="), u.cast("string"), F.lit("&amp;utm_source=f"), F.col("page_id").cast("string"))
    hit = F.struct("page_id", F.when(F.col("page_id") % 11 != 0, F.concat(F.lit("Report "), (F.col("page_id") * 4).cast("string"), F.lit(" &amp; more, "), F.get(F.array(*(F.lit(x) for x in ("Ottawa", "Modi", "Brussels", ""))), (F.col("page_id") % 4).cast("int")))).otherwise("").alias("title"), url.alias("url"), F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 240), "yyyyMMdd'T'HHmmss'Z'").alias("seendate"))
    answers = p.groupBy("n").agg(F.array_sort(F.collect_list(hit)).alias("articles"))
    hits = landed.search_hits(answers.select(F.lit("q").alias("query"), "n", F.to_json(F.struct("articles")).alias("body")), "2024-02-01")
    # places in the feeds, as the pieces of _bodies have them
    part = F.expr("doc_id div 50")
    number = F.regexp_extract("source", r"(\d+)", 1).cast("bigint")
    placed = d.select("doc_id", "source", number.alias("k"), (number * 1_000_000 + part * 50 + F.row_number().over(Window.partitionBy("source", part).orderBy("doc_id")) - 1).alias("ord"))
    null = F.lit(None).cast("string")
    documents = placed.where("doc_id % 3 <> 1").select(F.col("ord").alias("cluster_id"), F.lit("Rule").alias("title"), F.lit("https://r.example/").alias("url"), F.lit("2024-01-01").cast("date").alias("published"), null.alias("publisher"), F.lit("Rule").alias("doc_type"), F.col("doc_id").cast("string").alias("ref"))
    address = F.concat(F.lit("https://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string"), F.when(F.col("k") % 3 == 0, "?a=1&b=2").otherwise(""))
    articles = placed.where("doc_id % 2 = 0").select(address.alias("url"), F.lit(True).alias("ok"), F.array(F.lit("quote")).alias("quotes"), F.from_json(F.lit("[]"), "array<struct<value:string,context:string>>").alias("figures"))
    cands, report = daily(found, hits, roster, documents, articles, "2024-01-02 00:00:00", _RUN_QUOTAS, 8, hours=18)
    count = lambda keep: F.size(F.filter("sources", keep))
    chosen = cands.agg(F.sort_array(F.collect_list("cluster_id")).alias("chosen"), F.count_if(F.col("tier") == "primary").alias("confirmed"), F.sum(count(lambda s: s["read"] == "article read")).alias("articles"), F.sum(count(lambda s: s["u"].contains(".org/a"))).alias("chosen_hits"))
    counts = [F.col("counts")[c].alias(c) for c in ("rss_items", "hits", "hits_matched", "items", "clusters", "stories", "candidates")]
    failed = F.aggregate("failures", F.lit(0).cast("bigint"), lambda a, x: a + x["n"]).alias("failures")
    fill = F.array_sort(F.transform(F.map_entries("region_fill"), lambda e: F.concat(e["key"], F.lit(" "), e["value"]["filled"].cast("string"), F.lit(" of "), e["value"]["quota"].cast("string"), F.lit(", "), e["value"]["available"].cast("string"))))
    return report.select(*counts, F.col("balance")["left"].alias("left_side"), fill.alias("fill"), failed).join(F.broadcast(chosen)).withColumns({"articles": F.coalesce("articles", F.lit(0)), "chosen_hits": F.coalesce("chosen_hits", F.lit(0))})


@query("""SELECT c_custkey % 100 AS cluster_id, c_name AS title, 'https://r.example/' || c_custkey AS url, (DATE '2024-01-01' + (c_custkey % 60)::INT)::VARCHAR AS published, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN c_mktsegment ELSE c_mktsegment || ', B' END AS publisher, c_custkey::VARCHAR AS ref FROM customer""")
def registry_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of landed registry responses."""
    c = A.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    agency = lambda x: F.struct(x.alias("name"))
    agencies = F.when(k % 3 == 0, F.array().cast("array<struct<name:string>>")).when(k % 3 == 1, F.array(agency(F.col("c_mktsegment")))).otherwise(F.array(agency(F.col("c_mktsegment")), agency(F.lit("B"))))
    row = F.struct(F.col("c_name").alias("title"), F.concat(F.lit("https://r.example/"), k.cast("string")).alias("html_url"), F.date_add(F.lit("2024-01-01").cast("date"), (k % 60).cast("int")).cast("string").alias("publication_date"), F.lit("Rule").alias("type"), k.cast("string").alias("document_number"), agencies.alias("agencies"))
    bodies = c.select((k % 100).alias("cluster_id"), F.to_json(F.struct(F.array(row).alias("results"))).alias("body"))
    return landed.registry_documents(bodies).select("cluster_id", "title", "url", F.col("published").cast("string").alias("published"), "publisher", "ref")


_BIASES = ["Left", " left-center ", "LEAST BIASED", "Right-Center", "Conspiracy", "Satire", ""]


@query(f"""WITH r AS (SELECT c_custkey AS k, ({_BIASES})[(c_custkey % 7)::INT + 1] AS bias, c_name, c_mktsegment FROM customer)
SELECT 'mbfc' AS provider, k::VARCHAR AS mbfc_id, c_name AS name, 's' || k || '.example.com' AS domain, nullif(trim(bias), '') AS raw,
  CASE lower(trim(bias)) WHEN 'left' THEN -2 WHEN 'left-center' THEN -1 WHEN 'least biased' THEN 0 WHEN 'right-center' THEN 1 END AS score, CASE WHEN lower(bias) IN ('conspiracy', 'satire') THEN lower(bias) ELSE '' END AS flags, c_mktsegment AS factual,
  'https://m.example/' || k AS report_url FROM r""")
def rating_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of rating files in three shapes: a bare list, and under two keys; field names in several spellings, some twice."""
    c = A.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    bias = F.get(F.array(*(F.lit(x) for x in _BIASES)), (k % 7).cast("int"))
    site = F.concat(F.lit("https://www.s"), k.cast("string"), F.lit(".example.com/"))
    row = F.to_json(F.create_map(F.lit("Source ID#"), k.cast("string"), F.lit("source"), F.lit(" "), F.lit("Source"), F.col("c_name"), F.lit("Source URL"), site, F.lit("Bias"), bias, F.lit("Factual Reporting"), F.col("c_mktsegment"), F.lit("MBFC URL"), F.concat(F.lit("https://m.example/"), k.cast("string"))))
    body = F.when(k % 3 == 0, F.concat(F.lit("["), row, F.lit("]"))).when(k % 3 == 1, F.concat(F.lit('{"data": ['), row, F.lit("]}"))).otherwise(F.concat(F.lit('{"sources": ['), row, F.lit("]}")))
    got = matching.parse_ratings(landed.records(c.select(body.alias("body"))))
    return got.select("provider", "mbfc_id", "name", "domain", "raw", "score", F.array_join("flags", ",").alias("flags"), "factual", "report_url")


def _responses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(targets, responses): answers of all kinds, by the outlet's position."""
    r = A.roster(spark, sf_dir).withColumn("feed", F.concat("feed", F.lit("?"), "id"))
    k = F.col("pos") % 8
    body = F.when(k == 4, "<html>no feed</html>").when(k == 5, "<rss></rss>").otherwise("<rss><item>a</item><item >b</item></rss>")
    resp = r.where("feed IS NOT NULL AND pos % 8 <> 7").select(F.col("feed").alias("url"), F.when(k == 1, 404).otherwise(200).alias("status"), F.when(k == 6, F.concat("feed", F.lit("/moved"))).otherwise(F.col("feed")).alias("final_url"), F.lit("text/html").alias("content_type"), body.alias("body"), F.when(k == 2, "timed out").alias("error"), F.when(k == 3, "robots.txt").alias("blocked_by"))
    return r, resp


_NOTE = """CASE WHEN domain IS NULL THEN 'no feed url' WHEN pos % 8 = 3 THEN 'robots.txt' WHEN pos % 8 = 2 THEN 'timed out' WHEN pos % 8 = 7 THEN 'not fetched' WHEN pos % 8 = 1 THEN 'HTTP 404' WHEN pos % 8 = 4 THEN '200, not a feed' WHEN pos % 8 = 5 THEN 'feed parsed but has 0 items' END"""


@query(f"""WITH {A.ROSTER_SQL} SELECT id, coalesce(domain IS NOT NULL AND pos % 8 IN (0, 2, 3, 6), false) AS ok, CASE WHEN domain IS NOT NULL AND pos % 8 IN (0, 1, 2, 3, 6) THEN 2 ELSE 0 END AS items, {_NOTE} AS note, CASE WHEN domain IS NOT NULL AND pos % 8 = 6 THEN 'https://www.' || domain || '/rss?' || id || '/moved' END AS redirected FROM roster""")
def feed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on each outlet's feed."""
    return feeds.check_feeds(*_responses(spark, sf_dir)).select("id", "ok", F.col("items").cast("int").alias("items"), "note", "redirected")


@query(f"""WITH {A.ROSTER_SQL}, f AS (SELECT id, pos, 'https://www.' || domain AS site FROM roster WHERE domain IS NOT NULL),
c AS (
  SELECT id, pos, site, 0 AS step, 0 AS spot, site || '/listed.xml' AS url FROM f WHERE pos % 2 = 0
  UNION ALL SELECT id, pos, site, 2, i, site || '/d' || i || '/feed' FROM f, (SELECT unnest(range(5)) AS i) WHERE pos % 3 = 0
  UNION ALL SELECT id, pos, site, 3, 0, site || '/home/rss' FROM f
  UNION ALL SELECT id, pos, site, 4, i - 1, site || p FROM f, (SELECT unnest({feeds.USUAL}) AS p, unnest(range(1, {len(feeds.USUAL)} + 1)) AS i) WHERE p <> '/rss'),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step, spot) AS nth FROM c),
w AS (SELECT id, arg_min(url, nth) AS suggested FROM n WHERE nth <= 16 AND (url = site || CASE pos % 5 WHEN 0 THEN '/rss.xml' WHEN 1 THEN '/d3/feed' WHEN 2 THEN '/latest/feed' ELSE '/none' END) GROUP BY id)
SELECT f.id, count(*) FILTER (nth <= 16) AS tried, any_value(w.suggested) AS suggested, max(nth) > 16 AND any_value(w.suggested) IS NULL AS gave_up FROM f JOIN n USING (id) LEFT JOIN w USING (id) GROUP BY f.id""")
def feed_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where else failed feeds were looked for, at most 16 addresses each, what was found, and where the search was cut short."""
    tag = lambda *paths: F.concat(*(F.lit(f'<link rel="alternate" type="application/rss+xml" href="{p}">') for p in paths))
    r = A.roster(spark, sf_dir).where("feed IS NOT NULL")
    site = F.regexp_extract("feed", "^[a-z]+://[^/]+", 0)
    failed = r.select("id", "pos", "feed", F.when(F.col("pos") % 2 == 0, F.concat(site, F.lit("/feeds"))).alias("feed_index"), F.when(F.col("pos") % 2 == 0, tag("/listed.xml")).alias("index_html"), F.when(F.col("pos") % 3 == 0, tag(*(f"/d{i}/feed" for i in range(7)))).alias("page_html"), F.lit("text/html").alias("page_type"), tag("/home/rss").alias("home_html"))
    all_ = feeds.candidate_urls(failed)
    path = F.when(F.col("pos") % 5 == 0, "/rss.xml").when(F.col("pos") % 5 == 1, "/d3/feed").when(F.col("pos") % 5 == 2, "/latest/feed")
    # outlets share sites, so an address answers those only whose it is
    probes = feeds.probe_list(failed, most=16)
    tagged = probes.join(failed.select("id", path.alias("path"), site.alias("site")), "id").select("id", "step", "pos", "url", F.col("url").eqNullSafe(F.concat("site", "path")).alias("works"))
    own = tagged.select("id", "step", "pos", F.concat("url", F.lit("#"), "id").alias("url"), "works")
    responses = own.select("url", F.when(F.col("works"), 200).otherwise(404).alias("status"), F.lit("").alias("content_type"), F.lit("<rss><item>x</item></rss>").alias("body"))
    found = feeds.first_working(own.drop("works"), responses).withColumn("suggested", F.substring_index("suggested", "#", 1))
    gave = feeds.gave_up(all_, found, 16)
    out = failed.select("id").join(probes.groupBy("id").agg(F.count(F.lit(1)).alias("tried")), "id", "left").join(found, "id", "left").join(gave, "id", "left")
    return out.select("id", "tried", "suggested", F.col("note").isNotNull().alias("gave_up"))


@query("""WITH p AS (SELECT c_custkey % 500 AS id, c_custkey % 3 AS agent, c_custkey % 500 % 6 AS k FROM customer),
g AS (SELECT id, any_value(k) AS k, bool_or(agent = 0) AS cu, bool_or(agent = 1) AS co, bool_or(agent = 2) AS br FROM p GROUP BY id)
SELECT id::VARCHAR AS id, CASE WHEN k = 0 AND cu THEN 'works today — no change needed' WHEN k = 1 AND co THEN '**fixed by the compatible agent** — safe to deploy' WHEN k = 2 AND br THEN 'only a browser string works — the outlet is refusing automated clients'
  WHEN k = 3 THEN 'robots.txt forbids it — not ours to take' WHEN k = 4 THEN 'url is wrong, not a client problem' ELSE 'fails under every agent — not a User-Agent problem' END AS verdict FROM g""")
def diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What probes under three agents tell of each outlet."""
    k, agent = F.col("c_custkey") % 500 % 6, F.get(F.array(F.lit("current"), F.lit("compatible"), F.lit("browser")), (F.col("c_custkey") % 3).cast("int"))
    ok = ((k == 0) & (agent == "current")) | ((k == 1) & (agent == "compatible")) | ((k == 2) & (agent == "browser"))
    note = F.when(k == 3, "robots.txt").when(k == 4, "200, not a feed").otherwise("HTTP 403")
    return feeds.diagnose(A.table(spark, sf_dir, "customer").select((F.col("c_custkey") % 500).cast("string").alias("id"), agent.alias("agent"), ok.alias("ok"), note.alias("note")))


@query(f"""WITH {A.ROSTER_SQL} SELECT id, CASE WHEN domain IS NULL THEN 'no feed url in roster' WHEN NOT verified THEN 'feed not verified' ELSE 'read' END AS state FROM roster""")
def feed_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outlets that are read, and why others are not."""
    good, bad = feeds.targets(A.roster(spark, sf_dir))
    return good.select("id", F.lit("read").alias("state")).union(bad.select("id", "reason"))


_SIDE = "CASE lean WHEN 'left' THEN 'left' WHEN 'lean_left' THEN 'left' WHEN 'centre' THEN 'centre' WHEN 'lean_right' THEN 'right' WHEN 'right' THEN 'right' END"


@query(f"""WITH {A.ITEMS_SQL}, s AS (SELECT ord // 3 AS g, {_SIDE} AS side FROM items WHERE lean <> 'right' AND lean <> 'lean_right'),
h AS (SELECT g, bool_or(side = 'left') AS l, bool_or(side = 'centre') AS c, bool_or(side = 'right') AS r FROM s GROUP BY g),
b AS (SELECT count(*) FILTER (l) AS l, count(*) FILTER (c) AS c, count(*) FILTER (r) AS r, count(*) FILTER (NOT coalesce(l, false) AND NOT coalesce(c, false) AND NOT coalesce(r, false)) AS n FROM h)
SELECT 'left' AS side, l AS candidates, l = 0 AS starved FROM b UNION ALL SELECT 'centre', c, c = 0 FROM b UNION ALL SELECT 'right', r, r = 0 FROM b UNION ALL SELECT 'none', n, false FROM b""")
def side_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many groups of three neighbouring items, those of the right left out, have each side; and the sides that none has."""
    i = A.items(spark, sf_dir).where("lean NOT IN ('right', 'lean_right')")
    g = i.groupBy(F.expr("ord div 3").alias("g")).agg(F.array_sort(F.collect_list(F.struct("ord", "outlet", "outlet_id", "lean", "country", "title", "url"))).alias("items"))
    balance = stories.side_balance(g.select(stories.frame(F.col("items")).alias("framing")))
    starved = stories.starved_sides(balance, 1).withColumn("starved", F.lit(True))
    return balance.join(starved, "side", "left").select("side", "candidates", F.coalesce("starved", F.lit(False)).alias("starved"))


@query("""SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_matches(url, '^[a-z]+://([^/?#]*[.])?example[.]com([/?#]|$)') AS same, CASE WHEN page_id % 2 = 0 THEN url || '&x=1' ELSE url END AS decoded, 'Rating: mbfc' AS credit, page_id % 3 = 0 AS required FROM pages""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts, equal domains, decoded addresses and credits for every page."""
    u, provider = F.col("url"), F.when(F.col("page_id") % 3 == 0, "mbfc").otherwise("allsides")
    odd = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" "), u, F.lit("&amp;x=1 "))).otherwise(u)
    credit = matching.attribution(provider, F.lit(None).cast("string"))
    return A.table(spark, sf_dir, "pages").select("page_id", U.host_of(u).alias("host"), U.same_domain(u, F.lit("https://www.example.com/")).alias("same"), U.decode_url(odd).alias("decoded"), matching.attribution(F.lit("mbfc"), u)["text"].alias("credit"), credit["required"].alias("required"))


@query(f"""WITH RECURSIVE {S.CLUSTERS} SELECT cluster_id, (n - 1)::INT AS pos, 'https://' || outlet_id || '.example.com/' || ord AS url FROM (SELECT cluster_id, ord, outlet_id, row_number() OVER (PARTITION BY cluster_id ORDER BY ord) AS n FROM own) WHERE n <= 6""")
def articles_to_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first six items of every cluster."""
    return stories.articles_to_read(C.cluster_items(A.items(spark, sf_dir)))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 10 DAYS")
def unexpired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached rows of the last ten days."""
    return matching.unexpired(A.table(spark, sf_dir, "events").withColumn("fetched_at", F.col("ts")), "2024-01-20 00:00:00", 10).select("event_id")


@query(f"""WITH {A.ROSTER_SQL} SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_custkey::VARCHAR NOT IN (SELECT id FROM roster)""")
def strangers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of ids that the roster does not have."""
    return matching.strangers(A.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id")), A.roster(spark, sf_dir))


@query("""SELECT c_nationkey::VARCHAR AS outlet, list_sort(list(DISTINCT c_mktsegment)) AS owners, list_sort(list(DISTINCT 'p' || c_custkey % 3)) AS parents, 'CA' AS country FROM customer GROUP BY c_nationkey""")
def ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners and parents of landed knowledge-base bindings."""
    return landed.ownership(A.table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("outlet"), F.col("c_mktsegment").alias("owner"), F.concat(F.lit("p"), (F.col("c_custkey") % 3).cast("string")).alias("parent"), F.lit("CA").alias("country")))


@query("""SELECT doc_id, CASE quality * 6 - 3 + toxic WHEN -3 THEN 'strongly left' WHEN -2 THEN 'left' WHEN 3 THEN 'strongly right' ELSE 'unplaced' END AS label,
  CASE WHEN toxic = 1 THEN 'lean "state" is not a left-right position' WHEN quality = 1 THEN 'no bias rating on file for this outlet yet' ELSE 'unmapped lean "odd"' END AS reason FROM labels""")
def label_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale labels, and why a lean has no side."""
    lean = F.when(F.col("toxic") == 1, "state").when(F.col("quality") == 1, "Unrated").otherwise("odd")
    return A.table(spark, sf_dir, "labels").select("doc_id", L.scale_label(F.col("quality") * 6 - 3 + F.col("toxic")).alias("label"), L.reason_for_no_side(lean).alias("reason"))


@query("""SELECT doc_id AS card, unnest(CASE doc_id % 4 WHEN 0 THEN ['gaps-shape', 'disputed-shape'] WHEN 1 THEN ['payload-shape'] WHEN 2 THEN ['gaps-shape'] ELSE [] END) AS code FROM documents""")
def raw_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cards whose parts have the wrong shape."""
    k = F.col("doc_id") % 4
    raw = F.when(k == 0, '{"gaps": "x", "disputed": {"t": 1}}').when(k == 1, '["no", "object"]').when(k == 2, '{"gaps": 3, "disputed": []}').otherwise('{"gaps": ["a"], "disputed": [{"t": "b"}]}')
    return validation.raw_shapes(A.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("card"), raw.alias("json"))).select("card", "code")
