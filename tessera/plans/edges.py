"""Queries for branches that the other queries' rows do not reach: roster files, standing searches, winners, aliases, known addresses."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import numbers as N
from tessera.functions import text as X
from tessera.operators import cluster as C
from tessera.operators import feeds, matching
from tessera.plans import adapters as A
from tessera.plans.catalog import query
from tessera.sources import landed, reports, sinks
from tessera.storage import Stored, delete, shared_dir


@query(f"""WITH {A.ROSTER_SQL} SELECT id, (pos % 100)::INT AS pos, name, country, lean, CASE WHEN domain IS NOT NULL THEN 'https://www.' || domain || '/rss' END AS feed, verified, CASE WHEN pos % 4 = 0 THEN 'left' END AS bias FROM roster""")
def roster_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlets of roster files of 100 each, which are written and read again; feeds that are blank are none."""
    k = F.col("pos")
    blank = F.when(k % 2 == 0, "").otherwise("  ")
    mbfc = F.when(k % 4 == 0, F.struct(F.lit("mbfc").alias("provider"), F.lit("left").alias("bias")))
    outlet = F.struct("pos", "id", "name", "country", "lean", F.coalesce("feed", blank).alias("feed"), "verified", mbfc.alias("mbfc"), F.lit("not in the schema").alias("more"))
    rosters = A.roster(spark, sf_dir).groupBy(F.expr("int(pos div 100)").alias("part")).agg(F.array_sort(F.collect_list(outlet)).alias("outlets"))
    path = f"{shared_dir(spark)}/rosters-{uuid.uuid4().hex}"
    # one object a folder, as rosters are one object a file
    rosters.select("part", F.to_json(F.struct("outlets")).alias("value")).write.partitionBy("part").text(path)
    found = Stored(landed.roster(spark, path).select("id", "pos", "name", "country", "lean", "feed", "verified", F.col("mbfc.bias").alias("bias")), "roster")
    delete(spark, path)
    return found.df


_SEARCHES = [(label, landed.build_query(terms, country)) for label, terms, country in landed.STANDING]


@query(f"""WITH s AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{label}', '{q}')" for i, (label, q) in enumerate(_SEARCHES))}) s(i, label, query)), {A.ROSTER_SQL},
h AS (SELECT page_id % 5 AS i, 's' || (page_id % 60) || '.co.uk' AS domain FROM pages WHERE page_id % 11 <> 0), known AS (SELECT DISTINCT domain FROM roster WHERE domain IS NOT NULL)
SELECT label, query, count(h.i) AS total, count(known.domain) AS known FROM s LEFT JOIN h USING (i) LEFT JOIN known USING (domain) GROUP BY label, query""")
def standing_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the standing searches found, and how much of it is of known outlets; responses to other searches are left out."""
    asked = landed.standing_searches(spark)
    p = A.table(spark, sf_dir, "pages").withColumn("n", F.expr("int(page_id div 50)")).withColumn("i", (F.col("page_id") % 5).cast("int"))
    hit = F.struct("page_id", F.when(F.col("page_id") % 11 != 0, "Page").otherwise("").alias("title"), F.concat(F.lit("https://www.s"), (F.col("page_id") % 60).cast("string"), F.lit(".co.uk/"), F.col("page_id").cast("string")).alias("url"))
    # what a response answers is said by the search's own words
    names = F.create_map(*(F.lit(x) for i, (_, q) in enumerate(_SEARCHES) for x in (i, q)))
    bodies = p.groupBy("n", "i").agg(F.array_sort(F.collect_list(hit)).alias("articles")).select(F.coalesce(F.try_element_at(names, "i"), F.lit("another search")).alias("query"), "n", F.to_json(F.struct("articles")).alias("body"))
    matched = matching.match_to_roster(landed.search_hits(bodies, "2024-02-01"), A.roster(spark, sf_dir))
    counts = matching.query_counts(matched)
    return F.broadcast(asked).join(counts, "query", "left").select("label", "query", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("known", F.lit(0)).alias("known"))


@query("""WITH i AS (SELECT page_id AS ord, page_id // 3 AS k, 'gdelt' AS via, 'Hit ' || page_id AS title FROM pages UNION ALL SELECT 500000000 + page_id, page_id // 3, 'rss', 'Item ' || page_id FROM pages WHERE page_id % 4 = 1)
SELECT 'https://x.example/' || k AS canonical, arg_min(via, (via <> 'rss')::BIGINT * 10000000000 + ord) AS via, arg_min(title, (via <> 'rss')::BIGINT * 10000000000 + ord) AS title, min(ord) AS ord FROM i GROUP BY k""")
def dedupe_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which item of an address stays: the first, but a feed's instead of a search's, at the first one's place."""
    p = A.table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("https://x.example/"), F.expr("page_id div 3").cast("string")).alias("address"))
    n = F.col("page_id").cast("string")
    hits = p.select(F.col("page_id").alias("ord"), F.concat("address", F.lit("?utm_source="), n).alias("url"), F.lit("gdelt").alias("via"), F.concat(F.lit("Hit "), n).alias("title"))
    items = p.where("page_id % 4 = 1").select((F.lit(500000000) + F.col("page_id")).alias("ord"), F.concat("address", F.lit("/#top")).alias("url"), F.lit("rss").alias("via"), F.concat(F.lit("Item "), n).alias("title"))
    from tessera.functions.urls import canonical

    return C.dedupe(hits.unionByName(items)).select(canonical(F.col("url")).alias("canonical"), "via", "title", "ord")


#: Feed hosts of the outlets below, by the remainder of their number, and the domains of the ratings.
_HOSTS = ("feeds.bbci.co.uk", "feeds.a.dj.com", "focustaiwan.tw", "asia.nikkei.com", "other.example")
_RATED = ("bbc.com", "wsj.com", "cna.com.tw", "nikkei.com", "bbc.co.uk", "x.example")


@query(f"""WITH o AS (SELECT s_suppkey::VARCHAR AS id, (['bbci.co.uk', 'dj.com', 'focustaiwan.tw', 'nikkei.com', 'other.example'])[(s_suppkey % 5)::INT + 1] AS domain FROM supplier),
r AS (SELECT c_custkey AS pos, c_name AS name, ({list(_RATED)})[(c_custkey % 6)::INT + 1] AS domain, CASE WHEN c_custkey % 4 <> 3 THEN 'https://r.example/' || c_custkey END AS link FROM customer WHERE c_custkey % 6 <> 4 OR c_custkey > 20),
d AS (SELECT domain, arg_min(name, pos) AS name, arg_min(coalesce(link, ''), pos) AS link FROM r GROUP BY domain),
a AS (SELECT * FROM (VALUES {', '.join(f"('{k}', {i}, '{'nikkei.com' if 'nikkei' in v else v}')" for k, vs in matching.ALIASES.items() for i, v in enumerate(vs))}) a(domain, i, other)),
x AS (SELECT a.domain, arg_min(d.name, i) AS name FROM a JOIN d ON d.domain = other GROUP BY a.domain)
SELECT id, CASE WHEN d.name IS NOT NULL AND d.link <> '' THEN 'applied' WHEN d.name IS NOT NULL THEN 'missed' WHEN x.name IS NOT NULL THEN 'review' ELSE 'missed' END AS status, CASE WHEN d.name IS NOT NULL THEN 'domain' WHEN x.name IS NOT NULL THEN 'alias' END AS matched_on, coalesce(d.name, x.name) AS rating_name
FROM o LEFT JOIN d USING (domain) LEFT JOIN x USING (domain)""")
def alias_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlets whose feeds come from hosts that are not their domains, with the ratings found under their other domains."""
    s, c = A.table(spark, sf_dir, "supplier"), A.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    host = F.get(F.array(*(F.lit(h) for h in _HOSTS)), (F.col("s_suppkey") % 5).cast("int"))
    outlets = s.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("https://"), host, F.lit("/rss")).alias("feed"))
    rated = c.where((k % 6 != 4) | (k > 20)).select(k.alias("pos"), F.col("c_name").alias("name"), F.concat(F.lit("https://www."), F.get(F.array(*(F.lit(h) for h in _RATED)), (k % 6).cast("int"))).alias("source_url"), F.when(k % 4 != 3, F.concat(F.lit("https://r.example/"), k.cast("string"))).alias("mbfc_url"))
    return matching.rating_ladder(outlets, rated)


_KNOWN = list(dict.fromkeys([*feeds.ALTERNATES, *feeds.HOMEPAGES]))
_SITES = {i: u.rstrip("/") if u.count("/") == 3 else "/".join(u.split("/")[:3]) for i, u in feeds.HOMEPAGES.items()}


@query(f"""WITH o AS (SELECT s_suppkey, ({_KNOWN})[(s_suppkey % {len(_KNOWN)})::INT + 1] AS name FROM supplier),
f AS (SELECT DISTINCT name AS id, CASE name {' '.join(f"WHEN '{i}' THEN '{u}'" for i, u in _SITES.items())} ELSE 'https://www.' || name || '.org' END AS site, name NOT IN ({', '.join(f"'{i}'" for i in _SITES)}) AS fed FROM o),
c AS (SELECT id, 1 AS step, i::INT AS pos, url FROM f JOIN (VALUES {', '.join(f"('{k}', {i}, '{u}')" for k, us in feeds.ALTERNATES.items() for i, u in enumerate(us))}) a(id, i, url) USING (id)
  UNION ALL SELECT id, 4, (i - 1)::INT, site || p FROM f, (SELECT unnest({feeds.USUAL}) AS p, unnest(range(1, {len(feeds.USUAL)} + 1)) AS i) WHERE NOT (fed AND p = '/rss')),
g AS (SELECT id, url, arg_min(step, step * 100 + pos) AS step, arg_min(pos, step * 100 + pos) AS pos FROM c GROUP BY ALL)
SELECT id, step, pos, url, row_number() OVER (PARTITION BY id ORDER BY step, pos)::INT AS nth FROM g""")
def known_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the feeds of outlets with known addresses or homepages may be, in the order in which they are tried."""
    names = F.get(F.array(*(F.lit(n) for n in _KNOWN)), (F.col("s_suppkey") % len(_KNOWN)).cast("int"))
    null = F.lit(None).cast("string")
    failed = A.table(spark, sf_dir, "supplier").select(names.alias("id")).distinct()
    feed = F.when(~F.col("id").isin(*_SITES), F.concat(F.lit("https://www."), "id", F.lit(".org/rss")))
    return feeds.candidate_urls(failed.select("id", feed.alias("feed"), null.alias("feed_index"), null.alias("index_html"), null.alias("page_html"), null.alias("page_type"), null.alias("home_html")))


@query(f"""WITH t AS (SELECT c_custkey, {A.BALANCE_SQL} AS t, '$' || abs(round(c_acctbal / 100))::INT || ' million' AS a, ' ' || c_custkey % 9 || ' percent' AS b FROM customer),
u AS (SELECT c_custkey, t, unnest([a, b]) AS m, unnest([0, 1]) AS pos FROM t), v AS (SELECT *, instr(t, m) AS p FROM u)
SELECT c_custkey, pos::INT AS pos, trim(m) AS value, trim(substr(t, greatest(1, p - 50), p + length(m) + 50 - greatest(1, p - 50))) AS context FROM v""")
def figures_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of customers' balances with what stands around them."""
    c = A.table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.posexplode(N.figures(A.balance_text())).alias("pos", "f")).select("c_custkey", "pos", "f.value", "f.context")


@query("""SELECT page_id, 'x' || chr(65 + (page_id % 26)::INT) || chr(8364) || chr(97 + (page_id % 26)::INT) || '&lt;é&nope;' || chr(233) || page_id AS once, 'x' || chr(65 + (page_id % 26)::INT) || chr(8364) || chr(97 + (page_id % 26)::INT) || '<é&nope;' || chr(233) || page_id AS twice FROM pages""")
def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hexadecimal, decimal and named references, decoded once and twice."""
    n = F.col("page_id") % 26
    hexed = lambda base: F.lower(F.hex(n + base))
    text = F.concat(F.lit("x&#x"), hexed(65), F.lit(";&#X20AC;&#"), (n + 97).cast("string"), F.lit(";&amp;lt;&#x26;eacute;&nope;&Eacute;"), F.col("page_id").cast("string"))
    return A.table(spark, sf_dir, "pages").select("page_id", X.decode_entities_once(text).alias("once"), X.decode_entities(text).alias("twice"))


@query(f"""WITH t AS (SELECT page_id, url || (['/Live-Updates', '/news', '/week-in-review/1', ''])[(page_id % 4)::INT + 1] AS url, (['Report', 'One. And, two', 'Is it? It is. So', 'Report. Also'])[(page_id % 3)::INT + 1] AS title FROM pages)
SELECT page_id, regexp_matches(title, '{X.DIGEST_TITLE}') OR regexp_matches(url, '{X.DIGEST_URL}') AS digest FROM t""")
def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, by title or by address."""
    pick = lambda n, *xs: F.get(F.array(*(F.lit(x) for x in xs)), (F.col("page_id") % n).cast("int"))
    url, title = F.concat("url", pick(4, "/Live-Updates", "/news", "/week-in-review/1", "")), pick(3, "Report", "One. And, two", "Is it? It is. So", "Report. Also")
    return A.table(spark, sf_dir, "pages").select("page_id", X.is_digest(title, url).alias("digest"))


@query(f"""WITH {A.ROSTER_SQL}, c AS (SELECT *, CASE WHEN domain IS NOT NULL THEN 'https://www.' || domain || '/rss' END AS feed, CASE WHEN verified AND pos % 5 = 0 THEN 'https://new.example/' || pos END AS moved, CASE WHEN NOT verified AND pos % 6 = 0 THEN 'https://try.example/' || pos END AS try FROM roster)
SELECT 0 AS part, 0 AS kind, '# Feed validation report' AS line UNION ALL SELECT 0, 1, '' UNION ALL SELECT 0, 2, 'Run: now' UNION ALL SELECT 0, 3, 'Verified: ' || count(*) FILTER (verified) || '/' || count(*) FROM c UNION ALL SELECT 0, 9, ''
UNION ALL SELECT part, unnest([0, 1, 9]), unnest(['## ' || name, '', '']) FROM (VALUES (1, 'Balance by lean'), (2, 'Failures'), (3, 'Redirects worth pinning')) h(part, name)
UNION ALL SELECT 1, 3, '- ' || lean || ': ' || count(*) FILTER (verified) || '/' || count(*) || ' verified' FROM c GROUP BY lean
UNION ALL SELECT 2, 3, '- **' || name || '** (' || lean || ') — HTTP 404' || CASE WHEN try IS NOT NULL THEN ' — try `' || try || '`' ELSE '' END || chr(10) || '  - tried: `' || coalesce(feed, '(none)') || '`' FROM c WHERE NOT verified
UNION ALL SELECT 3, 3, '- **' || name || '**: `' || coalesce(feed, '-') || '` -> `' || moved || '`' FROM c WHERE moved IS NOT NULL""")
def feed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on checked feeds, line by line."""
    k = F.col("pos")
    address = lambda host: F.concat(F.lit(f"https://{host}.example/"), k.cast("string"))
    checks = A.roster(spark, sf_dir).select("name", "lean", "country", F.col("feed").alias("url"), F.col("verified").alias("ok"), F.lit("HTTP 404").alias("note"), F.when(F.col("verified") & (k % 5 == 0), address("new")).alias("redirected"), F.when(~F.col("verified") & (k % 6 == 0), address("try")).alias("suggested"))
    return reports.feed_report(checks, "now")


@query("""SELECT page_id, CASE WHEN page_id % 5 <> 3 THEN '<p>' || url || '</p>const STORIES = [{"id": ' || page_id || '}]; const OTHER = [1];' END AS page FROM pages""")
def spliced_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose list of stories is replaced; one that does not end gives no page."""
    old = F.concat(F.lit('["a]\\"]", [\'['), F.col("url"), F.lit("'], `]` /* "), F.col("page_id").cast("string"), F.lit(" */, []"))
    page = F.concat(F.lit("<p>"), F.col("url"), F.lit("</p>const STORIES = "), old, F.when(F.col("page_id") % 5 == 3, "").otherwise("]; const OTHER = [1];"))
    payload = F.concat(F.lit('[{"id": '), F.col("page_id").cast("string"), F.lit("}]"))
    return A.table(spark, sf_dir, "pages").select("page_id", sinks.splice(page, "STORIES", payload).alias("page"))


@query(f"WITH {A.ITEMS_SQL} SELECT ord, title, excerpt, country, CASE WHEN ord % 3 = 0 THEN lean END AS lean, ord % 3 <> 0 AS null_kept FROM it")
def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items written as JSON and read again, nulls included."""
    path = f"{shared_dir(spark)}/json-{uuid.uuid4().hex}"
    items = A.items(spark, sf_dir).select("ord", "title", "excerpt", "country", F.when(F.col("ord") % 3 == 0, F.col("lean")).alias("lean"))
    sinks.write_json(items, path)
    text = spark.read.text(path)
    found = Stored(text.select(F.from_json("value", items.schema).alias("i"), F.col("value").contains('"lean":null').alias("null_kept")).select("i.*", "null_kept"), "items")
    delete(spark, path)
    return found.df
