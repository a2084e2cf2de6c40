"""The registered queries of the engine's own operators, over whole tables, and the same as SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.functions import numbers as N
from tessera.functions import text as X
from tessera.functions import urls as U
from tessera.operators import cluster as C
from tessera.operators import feeds, matching, stories, validation
from tessera.plans import adapters as A
from tessera.plans import edges, history, ingest  # noqa: F401
from tessera.plans import sql as S
from tessera.plans.catalog import ORACLE_SQL, QUERIES, query  # noqa: F401
from tessera.sources import sinks
from tessera.storage import Stored

@query(f"WITH {A.ITEMS_SQL} SELECT ord, title, excerpt FROM it")
def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.items(spark, sf_dir).select("ord", "title", "excerpt")


@query(f"WITH {S.VECS} SELECT ord, count(*) AS terms, sum(tf)::BIGINT AS tf, round(sum(w), 5) AS total FROM vec GROUP BY ord")
def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = C.vectors(C.exclude(A.items(spark, sf_dir))[0])
    return vecs.groupBy("ord").agg(F.count(F.lit(1)).alias("terms"), F.sum("tf").alias("tf"), F.round(F.sum("w"), 5).alias("total"))


@query(f"WITH {S.PAIRS} SELECT i, j, round(sim, 5) AS sim FROM edges")
def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = C.exclude(A.items(spark, sf_dir))[0]
    vecs = Stored(C.vectors(items), "vectors").df
    return C.similar_pairs(items, vecs).select("i", "j", F.round("sim", 5).alias("sim"))


@query(f"""WITH RECURSIVE {S.CLUSTERS}
SELECT cluster_id, outlet_count, n_items, ords, countries, leans, round(lo, 5) AS sim_min, round(hi, 5) AS sim_max, pairs, pruned FROM clusters""")
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All clusters: components of similar pairs, pruned for cohesion; those of most outlets first."""
    c = C.cluster_items(A.items(spark, sf_dir))
    sims = [F.round("similarity.min", 5).alias("sim_min"), F.round("similarity.max", 5).alias("sim_max"), F.col("similarity.pairs").alias("pairs"), F.col("similarity.pruned_for_cohesion").alias("pruned")]
    return c.select("cluster_id", "outlet_count", F.size("items").alias("n_items"), F.transform("items", lambda i: i["ord"]).alias("ords"), "countries", "leans", *sims).orderBy(F.desc("outlet_count"), F.desc("n_items"), "cluster_id")


@query(f"""WITH RECURSIVE {S.STORIES}
SELECT cluster_id, outlet_count, n_items, regions, round(hi, 5) AS sim_max, countries FROM stories WHERE outlet_count >= 2""", "stories")
def stories_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories that at least two independent sources report, with regions."""
    c = stories.with_regions(C.cluster_items(A.items(spark, sf_dir)).where("outlet_count >= 2"))
    return c.select("cluster_id", "outlet_count", F.size("items").alias("n_items"), F.col("region.regions").alias("regions"), F.round("similarity.max", 5).alias("sim_max"), "countries")


_QUOTAS = L.parse_quotas("Canada=3, India=3,Europe=3,Global=3,Asia=x")


_CHOSEN = "SELECT slot::INT AS slot, cluster_id::BIGINT AS cluster_id, quota_region, round(rank_score, 4) AS rank_score FROM filled JOIN ranked USING (cluster_id) WHERE slot < 14"


@query(f"WITH RECURSIVE {S.STORIES},\n{S.quota_steps(_QUOTAS)}\n{_CHOSEN}")
def quota_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories of all clusters under quotas a region, and two more to fill up."""
    c = Stored(stories.with_regions(C.cluster_items(A.items(spark, sf_dir))), "regions").df
    picked, _ = stories.select_by_region(c, _QUOTAS, 14)
    return picked.select("slot", "cluster_id", "quota_region", F.round("rank_score", 4).alias("rank_score"))


_ASKED = f"{len(stories.REGISTRIES)}"


@query(f"""WITH RECURSIVE {S.CLUSTERS}, st AS (SELECT * FROM clusters WHERE outlet_count >= 2),
v AS (SELECT *, list_contains(countries, 'US') OR len(list_filter(titles, lambda t: regexp_matches(t, '\\b(U\\.?S\\.?|Washington|White House|Congress|Federal)\\b'))) > 0 AS applies FROM st),
d AS (SELECT *, CASE WHEN applies AND cluster_id % 2 = 0 THEN 1 ELSE 0 END AS docs FROM v)
SELECT d.cluster_id, CASE WHEN docs > 0 THEN 'primary' WHEN outlet_count >= 2 THEN 'multi' ELSE 'single' END AS tier,
  CASE WHEN docs > 0 THEN 'confirmed against 1 primary document(s)' ELSE 'reported independently by ' || outlet_count || ' outlets' END AS tier_basis,
  docs = 0 AS gap, applies AS attempted, o.ord AS ord, CASE WHEN o.ord % 4 = 0 THEN 'least biased' ELSE o.lean END AS label, CASE WHEN o.ord % 4 = 0 THEN 'mbfc' ELSE 'roster' END AS provider,
  CASE WHEN o.ord % 3 = 0 THEN 'article read' WHEN length(o.excerpt) > 0 THEN 'headline and feed excerpt' ELSE 'headline only' END AS read, CASE WHEN o.ord % 3 = 0 THEN 1 ELSE 0 END AS n_quotes,
  len(list_filter(leans, lambda x: x IN ('left', 'lean_left'))) > 0 AS has_left
FROM d JOIN own o ON o.cluster_id = d.cluster_id""")
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of candidates of all stories of two outlets or more: read states, labels, tiers, registries. Every fourth source is
    of an outlet with a rating, every third article has been read, and every other story has a document in a registry."""
    items = A.items(spark, sf_dir).withColumn("outlet_id", F.when(F.col("ord") % 4 == 0, F.concat("outlet_id", F.lit(" rated"))).otherwise(F.col("outlet_id")))
    c = Stored(C.cluster_items(A.items(spark, sf_dir)).where("outlet_count >= 2"), "stories").df
    rated = lambda i: F.when(i["ord"] % 4 == 0, F.concat(i["outlet_id"], F.lit(" rated"))).otherwise(i["outlet_id"])
    c = c.withColumn("items", F.transform("items", lambda i: i.withField("outlet_id", rated(i))))
    documents = c.where("cluster_id % 2 = 0").select("cluster_id", F.lit("Rule").alias("title"), F.lit("https://registry.example/1").alias("url"), F.lit("2024-01-20").cast("date").alias("published"), F.lit(None).cast("string").alias("publisher"), F.lit("Rule").alias("doc_type"), F.lit("1").alias("ref"))
    c = stories.verify(c, documents.union(documents.withColumn("published", F.lit("2023-01-01").cast("date"))), "2024-02-01")
    one = items.select("outlet_id", "lean").distinct()
    outlets = one.select(F.col("outlet_id").alias("id"), "lean", F.when(F.col("outlet_id").endswith(" rated"), F.struct(F.lit("least biased").alias("bias"), F.lit("https://r.example/").alias("url"))).alias("mbfc"))
    articles = items.select("url", (F.col("ord") % 3 == 0).alias("ok"), F.array("title").alias("quotes"), F.from_json(F.lit("[]"), "array<struct<value:string,context:string>>").alias("figures"))
    found = stories.candidates(c, outlets, articles, stories.conflicts(c.select("cluster_id", F.inline("items"))))
    out = found.select("cluster_id", "tier", "tier_basis", F.col("verification.gap").isNotNull().alias("gap"), F.col("verification.attempts")[0]["attempted"].alias("attempted"), F.exists("framing.views", lambda v: (v["side"] == "left") & (F.size(v["outlets"]) > 0)).alias("has_left"), F.explode("sources").alias("s"))
    return out.select("cluster_id", "tier", "tier_basis", "gap", "attempted", F.regexp_extract("s.u", r"(\d+)$", 1).cast("bigint").alias("ord"), F.col("s.b").alias("label"), F.col("s.label_source.provider").alias("provider"), F.col("s.read").alias("read"), F.size("s.quotes").alias("n_quotes"), "has_left")


@query(f"""WITH {A.ITEMS_SQL}, s AS (SELECT *, CASE lean WHEN 'left' THEN 'left' WHEN 'lean_left' THEN 'left' WHEN 'centre' THEN 'centre' WHEN 'lean_right' THEN 'right' WHEN 'right' THEN 'right' END AS side FROM items),
g AS (SELECT regexp_extract(title, '^.', 0) AS g, count(side) AS on_axis, count(DISTINCT side) AS sides, count(*) AS n FROM s GROUP BY 1)
SELECT g, on_axis >= 2 AND sides >= 2 AS applies, on_axis, (n - on_axis) AS off_axis,
  CASE WHEN on_axis >= 2 AND sides >= 2 THEN NULL WHEN on_axis < 2 THEN 'only ' || on_axis || ' of ' || n || ' items come from outlets placed on the left-right axis' ELSE 'one side' END AS reason FROM g""")
def framing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framing of items grouped by the first letter of their titles."""
    i = A.items(spark, sf_dir).withColumn("g", F.regexp_extract("title", "^.", 0))
    g = i.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("ord", "outlet", "outlet_id", "lean", "country", "title", "url"))).alias("items")).withColumn("f", stories.frame(F.col("items")))
    on = F.aggregate("f.views", F.lit(0).cast("bigint"), lambda a, v: a + F.size(v["outlets"]))
    reason = F.when(F.col("f.axis.reason").startswith("coverage sits"), "one side").otherwise(F.col("f.axis.reason"))
    return g.select("g", F.col("f.axis.applies").alias("applies"), on.alias("on_axis"), F.size("f.off_axis").cast("bigint").alias("off_axis"), reason.alias("reason"))


@query("WITH " + A.ITEMS_SQL + ", t AS (SELECT ord, title || ' ' || excerpt AS t, country FROM it) SELECT ord, " + ", ".join(
    f"{S.region_score(r, 't', 'country IN (' + ', '.join(repr(x) for x in stories.PUBLISHERS[r]) + ')')} AS {r.lower()}" for r in stories.STRONG) + " FROM t")
def region_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = stories.regions(F.concat_ws(" ", "title", "excerpt"), F.array("country"))
    return A.items(spark, sf_dir).withColumn("r", r).select("ord", *(F.col("r.scores")[x].alias(x.lower()) for x in stories.STRONG))


@query(f"""WITH {A.ITEMS_SQL}, src AS (SELECT ord, title || '. ' || excerpt AS text FROM it), {S.quantities("src", "ord")}
SELECT ord, count(*) AS n, round(sum(log10(1 + value)), 4) AS magnitude, count(*) FILTER (in_range) AS ranges, count(*) FILTER (kind = 'percent') AS percents, count(*) FILTER (kind = 'currency') AS currencies, sum(len(subject))::BIGINT AS subjects FROM quant GROUP BY ord""")
def quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = A.items(spark, sf_dir).select("ord", F.explode(N.quantities(F.concat("title", F.lit(". "), "excerpt"))).alias("q"))
    sums = [F.round(F.sum(F.log10(1 + F.col("q.value"))), 4).alias("magnitude"), F.count_if("q.in_range").alias("ranges"), F.count_if(F.col("q.kind") == "percent").alias("percents"), F.count_if(F.col("q.kind") == "currency").alias("currencies"), F.sum(F.size("q.subject")).alias("subjects")]
    return q.groupBy("ord").agg(F.count(F.lit(1)).alias("n"), *sums)


@query(f"""WITH src AS (SELECT c_custkey AS ord, c_custkey // 500 * 25 + c_nationkey AS g, c_mktsegment AS outlet, {A.BALANCE_SQL} AS text FROM customer), {S.quantities("src", "ord, g, outlet")},
good AS (SELECT * FROM quant WHERE NOT in_range),
met AS (SELECT x.g, x.kind, x.ord AS ord1, x.pos AS pos1, y.ord AS ord2, y.pos AS pos2, x.outlet AS outlet1, y.outlet AS outlet2, x.raw AS value1, y.raw AS value2, list_filter(x.subject, lambda w: list_contains(y.subject, w)) AS shared,
    (greatest(x.value, y.value) - least(x.value, y.value)) / greatest(x.value, y.value) AS spread
  FROM good x JOIN good y ON x.g = y.g AND x.kind = y.kind AND (x.ord, x.pos) < (y.ord, y.pos) AND x.outlet <> y.outlet AND coalesce(x.currency = y.currency, true) AND greatest(x.value, y.value) <> 0),
firsts AS (SELECT * FROM met WHERE spread > 0.05 AND len(shared) >= 2 QUALIFY row_number() OVER (PARTITION BY g, array_to_string(list_sort([outlet1 || ':' || value1, outlet2 || ':' || value2]), '|') ORDER BY ord1, pos1, ord2, pos2) = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY round(spread, 3) DESC, ord1, pos1, ord2, pos2) AS rn FROM firsts)
SELECT g, rn::INT AS rank, kind, array_to_string(list_slice(shared, 1, 4), ' ') AS about, round(spread, 3) AS spread, outlet1, value1, outlet2, value2 FROM top WHERE rn <= 8""")
def numeric_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disagreeing numbers among reports on customers of one nation in pieces of some 20, as stories are; the market segments are their outlets."""
    c = A.table(spark, sf_dir, "customer")
    i = c.select(F.expr("c_custkey div 500 * 25 + c_nationkey").alias("g"), F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("outlet"), F.lit("").alias("url"), A.balance_text().alias("title"), F.lit("").alias("excerpt"))
    r = stories.conflicts(i, "g")
    return r.select("g", "rank", "kind", F.array_join("about", " ").alias("about"), "spread", *(F.col("readings")[n - 1][c].alias(f"{c}{n}") for n in (1, 2) for c in ("outlet", "value")))


@query(f"""WITH {A.ITEMS_SQL}, r AS (SELECT outlet, ord, unnest(regexp_extract_all(title, '\\b([A-Z][\\w.''-]+(?:\\s+[A-Z][\\w.''-]+){{0,3}})\\b', 1)) AS term, generate_subscripts(regexp_extract_all(title, '\\b([A-Z][\\w.''-]+(?:\\s+[A-Z][\\w.''-]+){{0,3}})\\b', 1), 1) AS pos FROM items),
c AS (SELECT outlet, term, count(*) AS n, min(ord * 1000000 + pos) AS first FROM r WHERE length(term) >= 4 GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY outlet ORDER BY n DESC, length(term) DESC, first) AS rn FROM c)
SELECT outlet AS cluster_id, list(term ORDER BY rn) AS terms FROM k WHERE rn <= 6 GROUP BY outlet""")
def key_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stories.key_terms(A.items(spark, sf_dir).withColumnRenamed("outlet", "cluster_id"))


@query(f"""WITH {A.ITEMS_SQL}, b AS (SELECT outlet, list_aggregate(list_sort(list('https://' || outlet || '.example.com/' || ord)), 'string_agg', '|') AS s FROM items GROUP BY outlet),
h AS (SELECT outlet, list_reduce(list_prepend(2166136261::UBIGINT, list_transform(string_split(s, ''), lambda x: ascii(x)::UBIGINT)), lambda h, x: (xor(h, x) * 16777619::UBIGINT) % 4294967296::UBIGINT) AS h FROM b)
SELECT outlet, h::BIGINT AS hash FROM h""")
def story_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The FNV-1a hash under a story's id, over the urls of each outlet's items."""
    g = A.items(spark, sf_dir).groupBy("outlet").agg(stories.candidate_id(F.collect_list("url")).alias("id"))
    return g.select("outlet", F.conv(F.substring("id", 2, 20), 36, 10).cast("bigint").alias("hash"))


@query(f"WITH {A.ITEMS_SQL} SELECT ord, regexp_matches({S.TITLE.format(c='title')}, '{S.BOIL}') AS boilerplate, {S.DIGEST} AS digest FROM items")
def excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.items(spark, sf_dir).select("ord", X.is_boilerplate(F.col("title")).alias("boilerplate"), X.is_digest(F.col("title"), F.col("url")).alias("digest"))


_CANON = """regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) || '://' || lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) || regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/$', '')
 || CASE WHEN len(kept) = 0 THEN '' ELSE '?' || array_to_string(kept, '&') END"""
_KEPT = "list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_|fbclid|gclid|ref|cmpid|smid)')) AS kept"


@query(f"SELECT page_id, {_CANON} AS canonical FROM (SELECT page_id, url, {_KEPT} FROM pages)")
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical"))


@query(f"WITH c AS (SELECT page_id, {_CANON} AS k FROM (SELECT page_id, url, {_KEPT} FROM pages)) SELECT min(page_id) AS ord, count(*) AS n FROM c GROUP BY k")
def deduped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), "url", F.when(F.col("page_id") % 3 == 0, "rss").otherwise("gdelt").alias("via"))
    n = p.groupBy(U.canonical(F.col("url")).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return C.dedupe(p).select("ord", U.canonical(F.col("url")).alias("k")).join(n, "k").select("ord", "n")


@query("""SELECT page_id, regexp_extract(lower(regexp_extract(url, '://([^/?#]*)', 1)), '([^.]+\\.[^.]+)$', 1) AS domain, regexp_matches(url, '(?i)^[a-z]+://[^/?#]*[^?#]*/search\\b') OR regexp_matches(url, '(?i)[?&](q|query|s|search|searchterm|keyword|keywords|term|terms|text|kw|phrase)(=|&|#|$)') AS search FROM pages""")
def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", U.registrable(F.col("url")).alias("domain"), U.is_search_endpoint(F.col("url")).alias("search"))


@query(f"""WITH p AS (SELECT page_id, url, html || {A.FEED_TAGS_SQL} AS html FROM pages),
a AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS t FROM p),
d AS (SELECT *, {A.decoded_sql(A.decoded_sql('t'))} AS t2 FROM a)
SELECT page_id, trim(regexp_replace(regexp_replace(t2, '<[^>]+>', ' ', 'g'), '[\\s\\x0B\\p{{Z}}\\x{{85}}]+', ' ', 'g'), ' ') AS text,
  CASE page_id % 3 WHEN 0 THEN [regexp_extract(url, '^[a-z]+://[^/?#]+') || '/f.xml', regexp_extract(url, '^[a-z]+://[^/?#]+') || '/news/feed'] ELSE [] END AS feeds, page_id % 3 = 1 AS is_feed FROM d""")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, declared feeds and feed verdict of every page; every third declares feeds, every third is said to be one by its type."""
    p = A.table(spark, sf_dir, "pages").withColumn("html", F.concat("html", A.feed_tags()))
    kind = F.when(F.col("page_id") % 3 == 1, "application/rss+xml; charset=utf-8").otherwise("text/html")
    return p.select("page_id", X.strip_html(F.col("html")).alias("text"), U.declared_feeds(F.col("html"), F.col("url")).alias("feeds"), U.feed_verdict(F.col("html"), kind)["is_feed"].alias("is_feed"))


_LINES = f"""b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|nav|footer|aside|form|noscript|figure|header)[^>]*>.*?</(script|style|nav|footer|aside|form|noscript|figure|header)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?i)</?(p|div|section|article|main|h[1-6]|li|br|blockquote)[^>]*>', chr(10), 'g') AS t FROM pages),
l AS (SELECT page_id, unnest(string_split(regexp_replace(t, '<[^>]+>', ' ', 'g'), chr(10))) AS raw, generate_subscripts(string_split(regexp_replace(t, '<[^>]+>', ' ', 'g'), chr(10)), 1) AS n FROM b),
c AS (SELECT page_id, n, trim(regexp_replace({A.decoded_sql(A.decoded_sql('raw'))}, '[\\s\\x0B\\p{{Z}}\\x{{85}}]+', ' ', 'g'), ' ') AS line FROM l),
lines AS (SELECT * FROM c WHERE len(string_split(line, ' ')) >= 12 AND regexp_matches(line, '[.!?"''”]$') AND NOT regexp_matches(line, '(?i)^(share|subscribe|sign up|read more|advertisement|cookie)'))"""


@query(f"""WITH {_LINES}
SELECT pages.page_id, count(line) AS paragraphs, coalesce(sum(len(string_split(line, ' '))), 0)::BIGINT AS words, coalesce(max(length(line)), 0)::BIGINT AS longest, md5(coalesce(string_agg(line, chr(10) ORDER BY n), '')) AS digest FROM pages LEFT JOIN lines USING (page_id) GROUP BY 1""")
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prose of every page: how many paragraphs and words, and a digest of all of it."""
    p = A.table(spark, sf_dir, "pages").select("page_id", X.paragraphs(F.col("html")).alias("l"))
    words = F.aggregate("l", F.lit(0).cast("bigint"), lambda a, x: a + F.size(F.split(x, " ")))
    return p.select("page_id", F.size("l").cast("bigint").alias("paragraphs"), words.alias("words"), F.coalesce(F.array_max(F.transform("l", lambda x: F.length(x))), F.lit(0)).cast("bigint").alias("longest"), F.md5(F.encode(F.array_join("l", "\n"), "UTF-8")).alias("digest"))


_FIGURE = "(?i)([$€£₹]|\\bUS\\$|\\bC\\$)?\\s?(\\d[\\d,]*(?:\\.\\d+)?)\\s*(percent|per cent|%|thousand|million|billion|trillion|bn|tn)?"
_SPOKEN = "(?i)\\b(said|says|told|according to|wrote|announced|confirmed|denied|warned|argued|stated|testified)\\b"
_CUT = "CASE WHEN len(string_split(x.s, ' ')) > greatest(1, least(30, a.words)) THEN regexp_replace(array_to_string(list_slice(string_split(x.s, ' '), 1, greatest(1, least(30, a.words))), ' '), '[,;:]$', '') || ' …' ELSE x.s END"


@query(f"""WITH {_LINES.replace("FROM pages),", "FROM (SELECT page_id, " + A.prose_sql() + " AS html FROM pages)),", 1)},
cut AS (SELECT page_id, n, unnest(string_split(regexp_replace(line, '([.!?][”"'']?)\\s+([A-Z"“])', '\\1' || chr(1) || '\\2', 'g'), chr(1))) AS s, generate_subscripts(string_split(regexp_replace(line, '([.!?][”"'']?)\\s+([A-Z"“])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), 1) AS k FROM lines),
sent AS (SELECT page_id, trim(s) AS s, row_number() OVER (PARTITION BY page_id ORDER BY n, k) - 1 AS i FROM cut WHERE len(string_split(trim(s), ' ')) >= 6),
scored AS (SELECT page_id, s, i, CASE WHEN regexp_matches(s, '["“][^"”]{{25,}}["”]') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(s, '{_SPOKEN}') THEN 2 ELSE 0 END + (i < 3)::INT + regexp_matches(s, '[0-9]')::INT AS score FROM sent),
ranked AS (SELECT page_id, list({{'quotes': CAST([] AS VARCHAR[]), 'chars': 0, 'words': 0, 's': s}} ORDER BY score DESC, i) AS xs FROM scored GROUP BY page_id),
size AS (SELECT page_id, sum(len(string_split(line, ' '))) AS words, count(*) AS paragraphs, string_agg(line, ' ' ORDER BY n) FILTER (place <= 6) AS opening FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n) AS place FROM lines) GROUP BY page_id),
picked AS (SELECT page_id, list_reduce(list_prepend({{'quotes': CAST([] AS VARCHAR[]), 'chars': 450, 'words': floor(words * 0.10)::INT, 's': ''}}, xs), lambda a, x: list_transform([{_CUT}], lambda q:
    CASE WHEN len(a.quotes) < 3 AND a.words > 0 AND len(string_split(q, ' ')) >= 5 AND length(q) <= a.chars AND len(list_filter(a.quotes, lambda o: substr(o, 1, 40) = substr(q, 1, 40))) = 0
      THEN {{'quotes': list_append(a.quotes, q), 'chars': (a.chars - length(q))::INT, 'words': (a.words - len(string_split(q, ' ')))::INT, 's': ''}} ELSE {{'quotes': a.quotes, 'chars': a.chars, 'words': a.words, 's': ''}} END)[1]).quotes AS quotes FROM ranked JOIN size USING (page_id))
SELECT p.page_id, array_to_string(coalesce(quotes, []), ' | ') AS quotes, coalesce(list_sum(list_transform(quotes, lambda q: len(string_split(q, ' ')))), 0)::INT AS quoted_words, coalesce(words, 0)::INT AS word_count, coalesce(paragraphs, 0)::INT AS paragraph_count,
  least(6, len(list_filter(regexp_extract_all(coalesce(opening, ''), '{_FIGURE}'), lambda m: regexp_matches(m, '(?i)[$€£₹]|percent|per cent|%|thousand|million|billion|trillion|bn|tn'))))::INT AS n_figures
FROM pages p LEFT JOIN size USING (page_id) LEFT JOIN picked USING (page_id)""")
def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, figures and counts of every page's prose, to which some sentences with speech and numbers are added."""
    d = stories.distil(X.paragraphs(A.prose()))
    return A.table(spark, sf_dir, "pages").withColumn("d", d).select("page_id", F.array_join("d.quotes", " | ").alias("quotes"), "d.quoted_words", "d.word_count", "d.paragraph_count", F.size("d.figures").alias("n_figures"))


@query(f"""WITH {A.ROSTER_SQL}, last AS (SELECT domain, arg_max(id, pos) AS id, arg_max(lean, pos) AS lean FROM roster WHERE domain IS NOT NULL GROUP BY domain),
i AS (SELECT c_custkey AS ord, 's' || (c_custkey % 60) || '.co.uk' AS domain FROM customer)
SELECT ord, id AS outlet_id, lean, id IS NOT NULL AS matched FROM i LEFT JOIN last USING (domain)""")
def roster_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = A.ratings(spark, sf_dir).select(F.col("pos").alias("ord"), F.concat(F.lit("http://news."), "source_url", F.lit("/a?b=1")).alias("url"), F.lit(None).cast("string").alias("outlet_id"), F.lit(None).cast("string").alias("lean"))
    return matching.match_to_roster(i, A.roster(spark, sf_dir)).select("ord", "outlet_id", "lean", "matched")


_KEY = "regexp_replace(regexp_replace(regexp_replace(lower(name), '\\(.*?\\)', ' ', 'g'), '\\b(the|news|online|daily|post|times|com)\\b', ' ', 'g'), '[^a-z0-9]+', '', 'g')"


@query(f"""WITH {A.ROSTER_SQL}, {A.RATINGS_SQL}, d AS (SELECT domain, arg_min(name, pos) AS dn, arg_min(coalesce(mbfc_url, ''), pos) AS dl FROM ratings GROUP BY domain),
n AS (SELECT {_KEY} AS k, arg_min(name, pos) AS kn FROM ratings GROUP BY 1)
SELECT id, CASE WHEN dn IS NOT NULL AND dl <> '' THEN 'applied' WHEN dn IS NOT NULL THEN 'missed' WHEN kn IS NOT NULL THEN 'review' ELSE 'missed' END AS status,
  CASE WHEN dn IS NOT NULL THEN 'domain' WHEN kn IS NOT NULL THEN 'name' END AS matched_on, coalesce(dn, kn) AS rating_name FROM roster LEFT JOIN d USING (domain) LEFT JOIN n ON {_KEY.replace('name', 'roster.name')} = k""")
def rating_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.rating_ladder(A.roster(spark, sf_dir), A.ratings(spark, sf_dir))


@query(f"""WITH {A.ROSTER_SQL}, {A.RATINGS_SQL} SELECT pos FROM ratings WHERE domain IN (SELECT domain FROM roster WHERE domain IS NOT NULL) OR {_KEY} IN (SELECT {_KEY} FROM roster)""")
def trimmed_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.trim_ratings(A.ratings(spark, sf_dir), A.roster(spark, sf_dir)).select("pos")


@query(f"""WITH {A.ROSTER_SQL}, {A.RATINGS_SQL}, i AS (SELECT mbfc_id, max(pos) AS pi FROM ratings GROUP BY 1), d AS (SELECT domain, max(pos) AS pd FROM ratings GROUP BY 1)
SELECT id, coalesce(pi, pd) AS rating_pos, CASE WHEN pi IS NOT NULL THEN 'id' WHEN pd IS NOT NULL THEN 'domain' END AS rated_by FROM roster LEFT JOIN i ON i.mbfc_id = roster.id AND roster.pos % 2 = 0 LEFT JOIN d ON d.domain = roster.domain""")
def rating_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.roster(spark, sf_dir).select("id", F.when(F.col("pos") % 2 == 0, F.col("id")).alias("mbfc_id"), F.lit(None).cast("string").alias("domain"), F.lit(None).cast("string").alias("site"), F.regexp_replace("feed", "/rss$", "").alias("feed"))
    return matching.rating_lookup(o, A.ratings(spark, sf_dir)).select("id", "rating_pos", "rated_by")


_RAW = "['left', 'lean left', 'center', 'lean right', 'right', 'mixed']"


@query(f"""WITH lab AS (SELECT doc_id FROM labels), r AS (SELECT d.source || ':' || (d.doc_id % 97) AS outlet_id, ({_RAW})[(d.doc_id % 6)::INT + 1] AS raw, d.doc_id AS pos FROM documents d JOIN lab USING (doc_id)),
s AS (SELECT *, CASE raw WHEN 'left' THEN -2 WHEN 'lean left' THEN -1 WHEN 'center' THEN 0 WHEN 'lean right' THEN 1 WHEN 'right' THEN 2 END AS score FROM r),
a AS (SELECT outlet_id, count(*) AS n, count(score) AS k, max(score) - min(score) AS spread, avg(score) AS mean, min(score) AS lo, max(score) AS hi, string_agg('allsides: ' || raw, '  ·  ' ORDER BY pos) FILTER (score IS NOT NULL) AS shown,
  max((raw = 'mixed')::INT) AS flagged FROM s GROUP BY 1),
o AS (SELECT DISTINCT source || ':' || (doc_id % 97) AS outlet_id FROM documents)
SELECT outlet_id, CASE WHEN n IS NULL THEN 'unrated' WHEN k = 0 THEN 'unplaced' WHEN k = 1 THEN 'single_source' WHEN spread <= 1 THEN 'agree' ELSE 'disagree' END AS status, CASE WHEN k > 1 THEN spread END AS spread,
  CASE WHEN k = 1 THEN lo WHEN k > 1 AND spread <= 1 THEN floor(mean + 0.5)::INT END AS consensus, coalesce(k > 0 AND greatest(abs(lo), abs(hi)) >= 2, false) AS roster_disagrees,
  CASE WHEN k = 1 THEN shown || ' (unconfirmed by a second rater)' WHEN k > 1 THEN shown END AS display, CASE WHEN flagged = 1 THEN 'satire' ELSE '' END AS flags, CASE WHEN coalesce(k, 0) = 0 THEN 'ownership' END AS fallback FROM o LEFT JOIN a USING (outlet_id)""")
def rating_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lab = A.table(spark, sf_dir, "documents"), A.table(spark, sf_dir, "labels").select("doc_id")
    raw = F.get(F.array(*(F.lit(x) for x in ("left", "lean left", "center", "lean right", "right", "mixed"))), (F.col("doc_id") % 6).cast("int"))
    outlet = F.concat("source", F.lit(":"), (F.col("doc_id") % 97).cast("string")).alias("outlet_id")
    flags = F.when(raw == "mixed", F.array(F.lit("satire"), F.lit("other"))).otherwise(F.array().cast("array<string>"))
    r = d.join(lab, "doc_id").select(outlet, F.col("doc_id").alias("pos"), F.lit("allsides").alias("provider"), raw.alias("raw"), flags.alias("flags"))
    o = d.select(outlet, F.lit("centre").alias("roster_lean")).distinct()
    return matching.consensus(r, o).select("outlet_id", "status", "spread", "consensus", "roster_disagrees", "display", F.array_join("flags", ",").alias("flags"), "fallback")


@query(f"WITH {A.ROSTER_SQL} SELECT lean, count(*) AS total, count(*) FILTER (verified) AS ok FROM roster GROUP BY lean")
def lean_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.lean_balance(A.roster(spark, sf_dir).withColumn("ok", F.col("verified")))


@query(f"""WITH {A.ROSTER_SQL}, s AS (SELECT CASE lean WHEN 'left' THEN 'left' WHEN 'lean_left' THEN 'left' WHEN 'centre' THEN 'centre' WHEN 'lean_right' THEN 'right' WHEN 'right' THEN 'right' END AS side, verified FROM roster)
SELECT t.side AS side, count(*) FILTER (verified) AS ok FROM (VALUES ('left'), ('centre'), ('right')) t(side) LEFT JOIN s ON s.side = t.side GROUP BY 1""")
def spectrum_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.spectrum_balance(A.roster(spark, sf_dir).withColumn("ok", F.col("verified")))


@query(f"""WITH {A.ROSTER_SQL}, r AS (SELECT id AS rid, pos % 2 = 0 AS ok FROM roster WHERE pos % 5 <> 0)
SELECT id, CASE WHEN rid IS NULL THEN verified ELSE ok END AS verified, CASE WHEN ok THEN 7 END AS feed_items, CASE WHEN rid IS NOT NULL AND NOT ok THEN 'HTTP 404' END AS feed_error FROM roster LEFT JOIN r ON rid = id""")
def roster_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    ro = A.roster(spark, sf_dir)
    null = F.lit(None).cast("string")
    res = ro.where("pos % 5 <> 0").select("id", (F.col("pos") % 2 == 0).alias("ok"), F.lit(7).alias("items"), F.lit("HTTP 404").alias("note"), null.alias("redirected"), null.alias("suggested"))
    return matching.merge_roster(ro, res, "2024-02-01").select("id", "verified", "feed_items", "feed_error")


_ROBOTS = "User-agent: *\nDisallow: /en/\nAllow: /en/2*\nDisallow: /*/5$\nUser-agent: other\nDisallow: /\n"


@query("""WITH p AS (SELECT DISTINCT regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT host, path, NOT (CASE WHEN regexp_matches(path, '^/en/2.*') THEN false WHEN regexp_matches(path, '^/en/') THEN true WHEN regexp_matches(path, '^/.*/5$') THEN true ELSE false END) AS allowed FROM p""")
def robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1).alias("path")).distinct()
    rules = feeds.parse_robots(p.select("host", F.lit(_ROBOTS).alias("text")).distinct(), "tessera")
    return feeds.robots_allowed(p, rules)


@query("""SELECT event_id, ts FROM events WHERE ts >= (TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 72 HOURS)""")
def fresh_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.table(spark, sf_dir, "events").withColumn("published_at", F.col("ts"))
    return C.fresh(e, "2024-01-20 00:00:00").select("event_id", "ts")


#: What the cards below break, by the remainder m of their number: sources, facts, prose, regions, views and leftovers.
_CARDS_SQL = f"""{A.ITEMS_SQL}, k AS (SELECT ord AS card, ord % 12 AS m, ord % 3 AS i, ord % 2 = 0 AS even, outlet, title, excerpt FROM it),
found AS (
  SELECT card, 'no-sources' AS code FROM k WHERE m = 6
  UNION ALL SELECT card, 'source-untitled' FROM k WHERE m <> 6 AND title = ''
  UNION ALL SELECT card, 'source-url' FROM k WHERE m = 1
  UNION ALL SELECT card, 'mbfc-unlinked' FROM k WHERE m = 2
  UNION ALL SELECT card, 'label-unattributed' FROM k WHERE m = 3
  UNION ALL SELECT card, 'source-unnamed' FROM k WHERE m = 4
  UNION ALL SELECT card, 'source-duplicate' FROM k WHERE m = 5
  UNION ALL SELECT card, 'prose-missing' FROM k WHERE trim(title, ' ') = ''
  UNION ALL SELECT card, 'prose-missing' FROM k WHERE trim(excerpt, ' ') = ''
  UNION ALL SELECT card, unnest(['prose-missing', 'prose-null']) FROM k WHERE m = 7
  UNION ALL SELECT card, 'no-regions' FROM k WHERE m = 8
  UNION ALL SELECT card, 'no-facts' FROM k WHERE m = 10
  UNION ALL SELECT card, 'fact-empty' FROM k WHERE m <> 10 AND trim(excerpt, ' ') = ''
  UNION ALL SELECT card, 'fact-bad-index' FROM k WHERE m <> 10 AND (m = 6 OR i = 2)
  UNION ALL SELECT card, 'fact-bad-index' FROM k, range(2) WHERE m = 6
  UNION ALL SELECT card, 'tier-missing' FROM k WHERE m = 9
  UNION ALL SELECT card, 'tier-multi-unsupported' FROM k WHERE m NOT IN (9, 10) AND even AND (i <> 1 OR m = 6)
  UNION ALL SELECT card, 'tier-single-understated' FROM k WHERE m NOT IN (9, 10, 6) AND NOT even AND i = 1
  UNION ALL SELECT card, 'tier-primary-unsupported' FROM k WHERE m = 6
  UNION ALL SELECT card, 'disputed-empty' FROM k WHERE m = 11
  UNION ALL SELECT card, 'gap-empty' FROM k WHERE m = 0
  UNION ALL SELECT card, 'candidate-leftover' FROM k WHERE m = 11
  UNION ALL SELECT card, 'axis-unnamed' FROM k WHERE m = 10
  UNION ALL SELECT card, 'view-missing' FROM k WHERE m IN (7, 8, 9)
  UNION ALL SELECT card, 'view-side' FROM k WHERE m = 8
  UNION ALL SELECT card, 'view-duplicate' FROM k WHERE m = 9
  UNION ALL SELECT card, 'view-outlet-mismatch' FROM k WHERE m = 1
  UNION ALL SELECT card, 'view-empty' FROM k WHERE m = 2
  UNION ALL SELECT card, 'view-uncited' FROM k WHERE m = 3
  UNION ALL SELECT card, 'view-unattributed' FROM k WHERE m = 0
  UNION ALL SELECT card, 'view-outlet-mismatch' FROM k WHERE m = 0
  UNION ALL SELECT card, 'view-bad-index' FROM k WHERE m IN (4, 6)
  UNION ALL SELECT card, 'view-bad-index' FROM k WHERE m = 6
  UNION ALL SELECT card, 'view-synthesised' FROM k WHERE m = 5)"""


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card a document, each of twelve kinds with its own faults."""
    i = A.items(spark, sf_dir).withColumn("m", (F.col("ord") % 12).cast("int"))
    m, url, null = F.col("m"), F.col("url"), F.lit(None).cast("string")
    label = lambda p: F.struct(p.alias("provider"), null.alias("url"))
    one = F.struct(F.col("outlet").alias("n"), F.col("title").alias("t"), F.when(m == 1, "ftp://x").otherwise(url).alias("u"), F.col("lean").alias("b"), label(F.when(m == 2, "mbfc").when(m == 3, null).otherwise("roster")).alias("label_source"), null.alias("kind"))
    two = F.struct(F.when(m == 4, "").otherwise("Second").alias("n"), F.lit("t").alias("t"), F.when(m == 5, url).otherwise(F.concat(F.lit("https://second.example/"), F.col("ord").cast("string"))).alias("u"), null.alias("b"), label(null).alias("label_source"), F.lit("primary").alias("kind"))
    fact = F.array(F.struct(F.col("excerpt").alias("t"), F.array(F.lit(0), (F.col("ord") % 3).cast("int")).alias("s"), F.when(m == 9, "odd").when(F.col("ord") % 2 == 0, "multi").otherwise("single").alias("tier")), F.struct(F.lit("x").alias("t"), F.array(F.lit(1)).alias("s"), F.lit("primary").alias("tier")))
    cites = lambda c: F.from_json(c, "array<int>")
    view = lambda side, outlet, s, text, status: F.struct(side.alias("side"), F.lit("").alias("label"), outlet.alias("outlet"), cites(s).alias("s"), text.alias("text"), status.alias("status"))
    sourced, none = F.lit("sourced"), F.lit("not sourced")
    left = view(F.lit("left"), F.col("outlet"), F.lit("[0]"), F.lit("text"), sourced)
    middle = view(F.lit("centre"), F.when(m == 1, "Nobody").when(m == 0, "").when(m == 4, F.col("outlet")).otherwise("Second"), F.when(m == 3, "[]").when(m == 4, "[0, 7]").otherwise("[1]"), F.when(m == 2, " ").otherwise("text"), F.when(m == 5, none).otherwise(sourced))
    right = view(F.when(m == 8, "up").when(m == 9, "left").otherwise("right"), null, F.lit("[]"), null, none)
    some = lambda drop, xs: F.when(m == drop, F.slice(xs, 1, 0)).otherwise(xs)
    views = F.array(left, middle, right)
    return i.select(
        F.col("ord").alias("card"), some(6, F.array(one, two)).alias("sources"), F.col("title").alias("headline"), F.col("excerpt").alias("context"), F.when(m != 7, "c").alias("coverage"), some(8, F.array(F.lit("Global"))).alias("regions"), some(10, fact).alias("facts"),
        F.array(F.struct(F.when(m == 11, "").otherwise("d").alias("t"))).alias("disputed"), F.when(m == 7, F.slice(views, 1, 2)).otherwise(views).alias("views"), F.struct((m != 10).alias("applies"), F.when(m == 10, "").otherwise("left-right").alias("name")).alias("axis"), F.array(F.when(m == 0, "").otherwise("g")).alias("gaps"), F.when(m == 11, "x").alias("_prose"),
    )


@query(f"WITH {_CARDS_SQL} SELECT card, code, count(*) AS n FROM found GROUP BY ALL")
def card_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule that cards made of the documents break: sources, facts, prose, views, leftovers."""
    return validation.problems(_cards(spark, sf_dir)).groupBy("card", "code").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_CARDS_SQL}, kept AS (SELECT * FROM found WHERE card % 13 <> 7 AND NOT (card % 13 = 5 AND code = 'gap-empty') AND NOT (card % 13 = 6 AND code = 'disputed-empty') AND NOT (card % 13 = 8 AND code = 'prose-null') AND NOT (card % 13 = 9 AND code = 'no-facts')
  UNION ALL SELECT card, CASE card % 13 WHEN 5 THEN 'gaps-shape' WHEN 6 THEN 'disputed-shape' WHEN 7 THEN 'payload-shape' END FROM k WHERE card % 13 IN (5, 6, 7)
  UNION ALL SELECT card, 'fact-uncited' FROM k WHERE card % 13 = 9 UNION ALL SELECT card, 'fact-bad-index' FROM k, range(3) WHERE card % 13 = 9 UNION ALL SELECT card, 'tier-missing' FROM k WHERE card % 13 = 9 UNION ALL SELECT card, 'tier-primary-unsupported' FROM k WHERE card % 13 = 9)
SELECT card, code, count(*) AS n FROM kept GROUP BY ALL""")
def raw_card_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule that the cards break as JSON text, some of them with parts of the wrong shape or without a part."""
    c, k = _cards(spark, sf_dir), F.col("card") % 13
    as_json = lambda *cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    part = lambda col: F.to_json(F.col(col), {"ignoreNullFields": "false"})
    sources = F.transform("sources", lambda s: F.struct(s["n"].alias("n"), s["t"].alias("t"), s["u"].alias("u"), s["b"].alias("b"), s["label_source"].alias("labelSource"), s["kind"].alias("kind")))
    # two facts more where the indices are none: no list, and a text, a fraction and a null in one
    facts = F.when(k == 9, F.concat(F.expr("substring(to_json(facts), 1, length(to_json(facts)) - 1)"), F.when(F.size("facts") > 0, ",").otherwise(""), F.lit('{"t": "a", "s": 0, "tier": "primary"}, {"t": "b", "s": ["0", 0.5, null], "tier": 1}]'))).otherwise(part("facts"))
    rest = as_json(sources.alias("sources"), "headline", "context", "regions", "views", "axis", "_prose")
    coverage = F.when(F.col("coverage").isNotNull(), F.lit(', "coverage": "c"')).when(k == 8, "").otherwise(', "coverage": null')
    gaps, disputed = F.when(k == 5, '"x"').otherwise(part("gaps")), F.when(k == 6, '{"t": 1}').otherwise(part("disputed"))
    raw = F.concat(F.regexp_replace(rest, r"\}$", ""), coverage, F.lit(', "facts": '), facts, F.lit(', "gaps": '), gaps, F.lit(', "disputed": '), disputed, F.lit("}"))
    return validation.raw_problems(c.select("card", F.when(k == 7, '["no", "object"]').otherwise(raw).alias("json"))).groupBy("card", "code").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_CARDS_SQL} SELECT NULL::BIGINT AS card, 'balance-starved' AS code, 'right' AS path FROM (SELECT count(*) AS n FROM k) WHERE n > 0")
def payload_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sides that no card has a sourced view of."""
    return validation.payload_problems(_cards(spark, sf_dir)).where("code = 'balance-starved'").select("card", "code", "path")


@query(f"""WITH {_CARDS_SQL}, {A.ROSTER_SQL}, s AS (SELECT lean, CASE lean WHEN 'left' THEN 'left' WHEN 'lean_left' THEN 'left' WHEN 'centre' THEN 'centre' WHEN 'lean_right' THEN 'right' WHEN 'right' THEN 'right' END AS side, verified AND pos % 7 NOT IN (3, 4, 5) AS ok FROM roster),
n AS (SELECT (SELECT count(*) FROM (VALUES ('left'), ('centre'), ('right')) t(x) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.side = x AND ok)) AS sides, (SELECT count(*) FROM (SELECT lean FROM s GROUP BY lean HAVING count(*) FILTER (ok) = 0)) AS leans,
  (SELECT count(*) FROM found WHERE code NOT IN ('source-duplicate', 'label-unattributed', 'tier-single-understated', 'candidate-leftover')) AS errors FROM (SELECT 1))
SELECT sides AS starved, sides AS empty_sides, leans AS empty_leans, errors, (sides + leans + errors > 0)::INT AS exit_code FROM n""")
def exit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What would stop a run: sides or leans without a verified outlet, errors in cards."""
    checks = A.roster(spark, sf_dir).withColumn("ok", F.col("verified") & ~(F.col("pos") % 7).isin(3, 4, 5))
    sides = matching.spectrum_balance(checks).where("ok = 0")
    leans = matching.lean_balance(checks).where("ok = 0")
    return sinks.gate(sides, sides, leans, validation.summarise(validation.problems(_cards(spark, sf_dir))))


@query("SELECT doc_id, CASE WHEN quality IS NULL THEN NULL ELSE greatest(-3, least(3, floor(((quality * 30 - toxic * 21 - 7)::DOUBLE) / 14 + 0.5)))::INT END AS scale FROM labels")
def rating_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "labels").select("doc_id", L.ad_fontes_scale((F.col("quality") * 30 - F.col("toxic") * 21 - 7).cast("double")).alias("scale"))
