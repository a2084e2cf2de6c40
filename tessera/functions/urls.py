"""Column functions on urls, hosts and domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of two labels under which names are registered.
SUFFIXES = """
co.uk org.uk gov.uk ac.uk net.uk sch.uk
co.in net.in org.in gov.in ac.in edu.in
co.il org.il net.il ac.il gov.il
com.au net.au org.au gov.au edu.au
co.jp or.jp ne.jp go.jp ac.jp co.kr or.kr go.kr
com.hk org.hk net.hk com.tw org.tw com.cn net.cn
org.cn gov.cn edu.cn
com.sg com.my com.br com.mx com.ar com.tr com.sa
com.eg com.pk com.bd com.np com.lk co.za co.ke
co.nz com.ph com.vn or.id co.id com.ua
""".split()

# Query keys that carry a search.
SEARCH_KEYS = "q query s search searchterm keyword keywords term terms text kw phrase".split()
# Prefixes of query parameters that only track.
TRACKING = r"(?i)^(utm_|fbclid|gclid|ref|cmpid|smid)"

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def host_of(url: Column) -> Column:
    """The lower-cased host of an absolute url without user and port, or null."""
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(F.trim(url), "(?s)" + _URL, 2), "^.*@", ""), r":\d*\z", ""))
    return F.when(host.rlike(r"^[^\s<>^|%]+\z"), host)


def registrable(c: Column) -> Column:
    """The registrable domain of a url or host; null for bare suffixes, single labels and blanks."""
    low = F.lower(F.trim(c))
    bare = F.regexp_extract(F.regexp_replace(low, "^/+", ""), r"^[^/?]*", 0)
    host = F.when(low.contains("://"), host_of(low)).otherwise(bare)
    host = F.regexp_replace(F.regexp_replace(host, r"^www\d?\.", ""), r"\.\z", "")
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    two = F.array_join(F.slice(labels, -2, 2), ".")
    three = F.when(F.size(labels) >= 3, F.array_join(F.slice(labels, -3, 3), "."))
    return F.when((F.size(labels) >= 2) & ~host.contains(" "), F.when(two.isin(SUFFIXES), three).otherwise(two))


def same_domain(a: Column, b: Column) -> Column:
    return F.coalesce(registrable(a) == registrable(b), F.lit(False))


def normalise_domain(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "^https?://", ""), r"^www\.", "")
    return F.regexp_extract(c, r"^[^/]*", 0)


def canonical(url: Column) -> Column:
    """One key for the same page: no fragment, no tracking parameters, no trailing slash; what is no url stays as it is."""
    scheme, host = F.lower(F.regexp_extract(url, _URL, 1)), F.lower(F.regexp_extract(url, _URL, 2))
    host = F.when(scheme == "http", F.regexp_replace(host, r":80\z", "")).when(scheme == "https", F.regexp_replace(host, r":443\z", "")).otherwise(host)
    path = F.regexp_extract(url, _URL, 3)
    kept = F.array_join(F.filter(F.split(F.regexp_extract(url, _URL, 4), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    out = F.concat(scheme, F.lit("://"), host, F.regexp_replace(path, r"/\z", ""), F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))
    return F.when(url.rlike(_URL) & (host != ""), out).otherwise(url)


def decode_url(url: Column) -> Column:
    """Entities decoded if the result is still a url, else the trimmed input."""
    from tessera.functions.text import decode_entities

    out = decode_entities(F.trim(url))
    return F.when(out.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/?#\s]+|[^/\s])"), out).otherwise(F.trim(F.coalesce(url, F.lit(""))))


def is_search_endpoint(url: Column) -> Column:
    """A /search path, or a query key that carries a search term."""
    keys = F.transform(F.split(F.regexp_extract(url, _URL, 4), "&"), lambda p: F.regexp_replace(F.lower(F.regexp_extract(p, r"^[^=]*", 0)), "[^a-z]", ""))
    asks = F.exists(keys, lambda k: k.isin(SEARCH_KEYS))
    return F.coalesce(url.rlike(_URL) & (F.regexp_extract(url, _URL, 3).rlike(r"(?i)/search\b") | asks), F.lit(False))


def resolve(href: Column, base: Column) -> Column:
    """An absolute url for an absolute, scheme-relative, rooted or relative reference; null where there is none."""
    origin = F.regexp_extract(base, r"^[a-zA-Z]+://[^/?#]+", 0)
    folder = F.regexp_extract(base, r"^[a-zA-Z]+://[^/?#]+[^?#]*/", 0)
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), href)
        .when(href.rlike("^//"), F.concat(F.regexp_extract(base, "^[a-zA-Z]+:", 0), href))
        .when(href.rlike("^/"), F.concat(origin, href))
        .when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(href != "", F.concat(F.when(folder != "", folder).otherwise(F.concat(origin, F.lit("/"))), href))
    )


def declared_feeds(html: Column, base: Column) -> Column:
    """Feeds that a page declares, then links that look like feeds; in order, distinct, without searches and side sections."""
    links = F.filter(F.regexp_extract_all(html, F.lit("(?i)<link[^>]+>"), F.lit(0)), lambda t: t.rlike("(?i)rel=[\"']?alternate") & t.rlike(r"(?i)application/(?:rss|atom)\+xml"))
    first = F.transform(links, lambda t: F.regexp_extract(t, "(?i)href=[\"']([^\"']+)[\"']", 1))
    then = F.regexp_extract_all(html, F.lit("(?i)href=[\"']([^\"']*(?:/feed|/rss)[^\"'?]*)[\"']"), F.lit(1))
    full = F.transform(F.filter(F.concat(first, then), lambda h: h != ""), lambda h: resolve(h, base))
    off = r"(?i)\b(comments?|author|tag|tags|search|podcast|shop|jobs)\b"
    return F.array_distinct(F.filter(full, lambda u: u.isNotNull() & ~F.regexp_extract(u, _URL, 3).rlike(off) & ~is_search_endpoint(u)))


def feed_verdict(body: Column, content_type: Column) -> Column:
    """struct(is_feed, items) of a fetched body."""
    head = F.lower(F.substring(body, 1, 4000))
    feed = head.contains("<rss") | head.contains("<feed") | head.contains("<rdf:rdf") | F.coalesce(content_type, F.lit("")).rlike(r"(?i)application/(rss|atom)\+xml")
    items = F.regexp_count(body, F.lit(r"(?i)<item[\s>]")) + F.regexp_count(body, F.lit(r"(?i)<entry[\s>]"))
    return F.struct(feed.alias("is_feed"), F.when(feed, items).otherwise(F.lit(0)).alias("items"))


def robots_pattern(c: Column) -> Column:
    """A robots path pattern as a regular expression: * matches anything, a trailing $ anchors."""
    anchored = c.endswith("$")
    body = F.when(anchored, F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)
    body = F.regexp_replace(F.regexp_replace(body, r"([.+?^${}()|\[\]\\])", r"\\$1"), r"\*", ".*")
    return F.concat(F.lit("^"), body, F.when(anchored, F.lit(r"\z")).otherwise(F.lit("")))
