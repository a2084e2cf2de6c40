"""Landed inputs as typed DataFrames: rosters, feeds, search hits, registry documents, rating files. Nothing is fetched."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions.urls import decode_url

OUTLET = "id string, name string, country string, lean string, funding string, feed string, feed_index string, verified boolean, feed_checked date, feed_items int, feed_error string, notes string, mbfc struct<provider:string,id:string,url:string,bias:string,factual:string,credibility:string,media_type:string,mbfc_country:string,mbfc_name:string,matched_on:string,fetched:date>"
PRIMARY = "id string, name string, region string, access string, url string, endpoint string, feed string, role string, limits string, signup string, auth string, notes string, verified boolean, feed_checked date, feed_items int, feed_error string"

# The standing searches.
STANDING = [("Canada federal", ["Canada"], "CA"), ("India policy", ["India"], "IN"), ("European Union", ["European Union"], None)]


def roster(spark: SparkSession, path: str) -> DataFrame:
    """Outlets of a roster file with their position; empty feeds are null."""
    file = spark.read.schema(f"outlets array<struct<{_fields(OUTLET)}>>").option("multiLine", True).json(path)
    rows = file.select(F.posexplode("outlets").alias("pos", "o")).select("pos", "o.*")
    return rows.withColumn("feed", F.nullif(F.trim("feed"), F.lit("")))


def primary_sources(spark: SparkSession, path: str, key: str = "primary") -> DataFrame:
    file = spark.read.schema(f"{key} array<struct<{_fields(PRIMARY)}>>").option("multiLine", True).json(path)
    return file.select(F.posexplode(key).alias("pos", "o")).select("pos", "o.*")


def _fields(ddl: str) -> str:
    out, depth, start, parts = [], 0, 0, []
    for i, ch in enumerate(ddl + ","):
        depth += ch == "<"
        depth -= ch == ">"
        if ch == "," and not depth:
            parts.append(ddl[start:i].strip())
            start = i + 1
    for p in parts:
        name, _, kind = p.partition(" ")
        out.append(f"{name}:{kind}")
    return ",".join(out)


def parse_date(*candidates: Column) -> Column:
    """The first that reads as a time: RFC 822 with or without weekday and seconds, or ISO 8601."""
    out = []
    for c in candidates:
        plain = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3,9},?\s+", "")
        plain = F.regexp_replace(F.regexp_replace(plain, r"\b(GMT|UTC|UT|Z)\z", "+0000"), r"\s+", " ")
        for fmt in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss z"):
            out.append(F.try_to_timestamp(plain, F.lit(fmt)))
        out.append(F.try_to_timestamp(F.trim(c)))
    return F.coalesce(*out)


_LINK = "array<struct<_href:string,_rel:string,_VALUE:string>>"
_GUID = "struct<_VALUE:string,_isPermaLink:string>"
_TEXT = "struct<_VALUE:string,_type:string>"
_ENTRY = f"title:{_TEXT},link:{_LINK},guid:{_GUID},id:string,pubDate:string,published:string,updated:string,`dc:date`:string,`dcterms:date`:string,description:{_TEXT},summary:{_TEXT},content:{_TEXT},`content:encoded`:string"


def first_link(link: Column, guid: Column) -> Column:
    """An alternate link with an address, any address, a link's text, or a guid that is an address."""
    has = lambda x: F.coalesce(x["_href"], F.lit("")) != ""
    alternate = F.get(F.filter(link, lambda x: (F.coalesce(x["_rel"], F.lit("alternate")) == "alternate") & has(x)), 0)["_href"]
    any_ = F.get(F.filter(link, has), 0)["_href"]
    words = F.trim(F.get(F.filter(link, lambda x: ~F.coalesce(F.trim(x["_VALUE"]) == "", F.lit(True))), 0)["_VALUE"])
    return F.coalesce(alternate, any_, words, F.when(F.trim(guid).rlike("(?i)^https?://"), F.trim(guid)))


def feed_items(bodies: DataFrame, outlets: DataFrame, retrieved_at) -> DataFrame:
    """Items of landed feed bodies (outlet_id, body): RSS, RDF and Atom alike, in feed order, complete ones only.

    Items are cut out as XML fragments and read with from_xml, so one feed of any number of items is one row until then.
    ord is the outlet's position times 1,000,000 plus the place in the feed; a body that is a later piece of a feed says in a column
    ``start`` how many items come before it.
    """
    start = F.col("start").cast("bigint") if "start" in bodies.columns else F.lit(0).cast("bigint")
    fragments = F.regexp_extract_all("body", F.lit(r"(?is)<(item|entry)(?:\s[^>]*)?>.*?</\1>"), F.lit(0))
    rows = bodies.select("outlet_id", start.alias("start"), F.posexplode(fragments).alias("n", "xml"))
    # prefixes need no declaration once they are part of the name
    plain = F.regexp_replace("xml", r"(?i)^<(item|entry)(?:\s[^>]*)?>", "<item>")
    plain = F.regexp_replace(plain, r"(?i)</(item|entry)>$", "</item>")
    plain = F.regexp_replace(plain, r"(</?)(dc|dcterms|content):", "$1$2_")
    schema = f"struct<{_ENTRY}>".replace("`dc:date`", "dc_date").replace("`dcterms:date`", "dcterms_date").replace("`content:encoded`", "content_encoded")
    e = rows.select("outlet_id", (F.col("start") + F.col("n")).alias("n"), F.from_xml(plain, schema, {"ignoreNamespace": "true"}).alias("e"))
    title = X.strip_html(F.col("e.title._VALUE"))
    body = F.coalesce(F.col("e.description._VALUE"), F.col("e.summary._VALUE"), F.col("e.content._VALUE"), F.col("e.content_encoded"))
    o = outlets.select(F.col("id").alias("outlet_id"), F.col("pos").alias("__pos"), F.col("name").alias("outlet"), "lean", "country")
    when = parse_date(*(F.col(f"e.{c}") for c in ("pubDate", "published", "updated", "dc_date", "dcterms_date")))
    out = e.join(o, "outlet_id").select(
        (F.col("__pos").cast("bigint") * 1_000_000 + F.col("n")).alias("ord"), "outlet_id", "outlet", "lean", "country", title.alias("title"),
        decode_url(first_link(F.col("e.link"), F.col("e.guid._VALUE"))).alias("url"), when.alias("published_at"), X.excerpt(X.strip_html(body)).alias("excerpt"),
        F.lit(retrieved_at).cast("timestamp").alias("retrieved_at"), F.lit("rss").alias("via"), F.lit(None).cast("string").alias("read"),
    )
    return out.where("length(title) > 0 AND length(url) > 0")


def build_query(terms: list[str], country: str | None = None, language: str = "english", extra: str = "") -> str:
    """A search query: terms of several words in quotes, then country and language. On the driver: a query is one line."""
    parts = [f'"{t}"' if re.search(r"\s", t) else t for t in terms]
    parts += [f"sourcecountry:{country}"] * bool(country) + [f"sourcelang:{language}"] * bool(language) + [extra] * bool(extra)
    return " ".join(parts)


def standing_searches(spark: SparkSession) -> DataFrame:
    """(label, query) of the standing searches; landed responses are joined by the query."""
    return spark.createDataFrame([(label, build_query(terms, country)) for label, terms, country in STANDING], "label string, query string")


def seen_date(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyyMMdd'T'HHmmssX"))


def search_hits(bodies: DataFrame, retrieved_at, start: int = 0) -> DataFrame:
    """Items of landed search responses (query, n, body JSON): no outlet yet, no excerpt, 'headline only'."""
    schema = "articles array<struct<title:string,url:string,domain:string,seendate:string,sourcecountry:string,language:string>>"
    rows = bodies.select("query", "n", F.posexplode(F.from_json("body", schema)["articles"]).alias("k", "a"))
    null = F.lit(None).cast("string")
    out = rows.select(
        (F.lit(start) + F.col("n").cast("bigint") * 1000 + F.col("k")).alias("ord"), null.alias("outlet_id"), F.col("a.domain").alias("outlet"), null.alias("lean"), F.col("a.sourcecountry").alias("country"),
        X.strip_html(F.col("a.title")).alias("title"), decode_url(F.col("a.url")).alias("url"), seen_date(F.col("a.seendate")).alias("published_at"), F.lit("").alias("excerpt"),
        F.lit(retrieved_at).cast("timestamp").alias("retrieved_at"), F.lit("gdelt").alias("via"), F.lit("headline only").alias("read"), "query",
    )
    return out.where("length(title) > 0 AND length(url) > 0")


def registry_documents(bodies: DataFrame) -> DataFrame:
    """Rows of landed registry responses (cluster_id, body JSON): metadata only."""
    schema = "results array<struct<title:string,html_url:string,publication_date:string,type:string,document_number:string,agencies:array<struct<name:string>>>>"
    d = bodies.select("cluster_id", F.explode(F.from_json("body", schema)["results"]).alias("d"))
    publisher = F.nullif(F.array_join(F.transform("d.agencies", lambda a: a["name"]), ", "), F.lit(""))
    return d.select("cluster_id", F.col("d.title").alias("title"), F.col("d.html_url").alias("url"), F.to_date("d.publication_date").alias("published"), publisher.alias("publisher"), F.col("d.type").alias("doc_type"), F.col("d.document_number").alias("ref"))


def field_name(name: str) -> str:
    """Letters only, lower case: how fields of rating files are told apart."""
    return re.sub("[^a-z]", "", name.lower())


def _named(name: str):
    return lambda e: e["k"] == name


def records(files: DataFrame) -> DataFrame:
    """One row a record of rating files (path, body JSON): a list, or one under data, sources or results; fields by letters only."""
    bare = F.when(F.ltrim("body").startswith("["), F.col("body"))
    under = [F.get_json_object("body", f"$.{k}") for k in ("data", "sources", "results")]
    rows = files.select(F.posexplode(F.from_json(F.coalesce(bare, *under), "array<map<string,string>>")).alias("pos", "r"))
    # fields whose names come to the same letters: the first that is not blank
    flat = F.filter(F.transform(F.map_entries("r"), lambda e: F.struct(F.regexp_replace(F.lower(e["key"]), "[^a-z]", "").alias("k"), F.trim(e["value"]).alias("v"))), lambda e: F.coalesce(e["v"], F.lit("")) != "")
    get = lambda *names: F.coalesce(*(F.get(F.filter("m", _named(field_name(n))), 0)["v"] for n in names))
    cols = {"source_id": ("Source ID#",), "source": ("Source", "name"), "source_url": ("Source URL", "sourceurl", "url", "domain"), "mbfc_url": ("MBFC URL",), "bias": ("Bias",), "factual": ("Factual Reporting",), "credibility": ("Credibility",), "country": ("Country",), "media_type": ("Media Type",)}
    return rows.select("pos", flat.alias("m")).select("pos", *(get(*v).alias(k) for k, v in cols.items()))


def ownership(bindings: DataFrame) -> DataFrame:
    """(outlet, owners, parents, country) of landed knowledge-base bindings (outlet, owner, parent, country)."""
    return bindings.groupBy("outlet").agg(F.sort_array(F.collect_set("owner")).alias("owners"), F.sort_array(F.collect_set("parent")).alias("parents"), F.min("country").alias("country"))
