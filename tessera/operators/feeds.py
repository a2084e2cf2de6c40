"""Robots rules and feed checks over landed responses. Nothing is fetched here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.urls import declared_feeds, feed_verdict, robots_pattern


def parse_robots(robots: DataFrame, agent: str) -> DataFrame:
    """(host, allow, path) of robots texts (host, text): groups for * and for agents whose name holds ``agent``.

    Each User-agent line sets anew whether rules apply; an empty Disallow allows all and is no rule.
    """
    lines = robots.select("host", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r?\n")).alias("n", "line"))
    lines = lines.withColumn("line", F.trim(F.regexp_replace("line", "#.*$", "")))
    key, value = F.lower(F.regexp_extract("line", r"^([A-Za-z-]+)\s*:\s*(.*)$", 1)), F.trim(F.regexp_extract("line", r"^([A-Za-z-]+)\s*:\s*(.*)$", 2))
    rows = lines.select("host", "n", key.alias("key"), value.alias("value")).where("key <> ''")
    named = F.when(F.col("key") == "user-agent", (F.col("value") == "*") | F.lower("value").contains(agent.lower()))
    applies = F.last_value(named, ignoreNulls=True).over(Window.partitionBy("host").orderBy("n"))
    ruled = rows.withColumn("applies", applies).where("applies AND key IN ('allow', 'disallow') AND NOT (key = 'disallow' AND value = '')")
    return ruled.select("host", (F.col("key") == "allow").alias("allow"), F.col("value").alias("path"))


def robots_allowed(probes: DataFrame, rules: DataFrame) -> DataFrame:
    """Probes (host, path) with ``allowed``: the longest pattern that matches decides, Allow at equal length, all if none does."""
    r = rules.where("path <> ''").select(F.col("host").alias("__h"), "allow", F.col("path").alias("__p"), robots_pattern(F.col("path")).alias("__re"))
    met = probes.join(r, probes["host"] == F.col("__h"), "left").withColumn("__hit", F.expr("coalesce(path RLIKE __re, false)"))
    best = F.max_by(F.when(F.col("__hit"), F.col("allow")), F.when(F.col("__hit"), F.struct(F.length("__p"), "allow")))
    return met.groupBy("host", "path").agg(F.coalesce(best, F.lit(True)).alias("allowed"))


def check_feeds(targets: DataFrame, responses: DataFrame) -> DataFrame:
    """A verdict for each target (id, name, lean, country, feed): ok, items, note, redirected, blocked_by.

    responses: url, status, final_url, content_type, body, error, blocked_by.
    """
    r = responses.select(F.col("url").alias("__u"), "status", "final_url", "error", "blocked_by", feed_verdict(F.coalesce("body", F.lit("")), F.col("content_type")).alias("v")).dropDuplicates(["__u"])
    j = targets.withColumn("feed", F.nullif(F.trim("feed"), F.lit(""))).join(r, F.col("feed") == F.col("__u"), "left")
    good = F.coalesce(F.col("status").between(200, 299) & F.col("v.is_feed") & (F.col("v.items") > 0), F.lit(False))
    note = (
        F.when(F.col("feed").isNull(), "no feed url")
        .when(F.col("blocked_by").isNotNull(), F.col("blocked_by"))
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("__u").isNull(), "not fetched")
        .when(~F.col("status").between(200, 299), F.concat(F.lit("HTTP "), F.col("status").cast("string")))
        .when(~F.col("v.is_feed"), F.concat(F.col("status").cast("string"), F.lit(", not a feed")))
        .when(F.col("v.items") == 0, F.lit("feed parsed but has 0 items"))
    )
    moved = F.when(good & (F.col("final_url") != F.col("feed")), F.col("final_url"))
    return j.select("id", "name", "lean", "country", F.col("feed").alias("url"), good.alias("ok"), F.coalesce("v.items", F.lit(0)).alias("items"), note.alias("note"), moved.alias("redirected"), "blocked_by")


# Paths under which feeds usually are, in the order in which they are tried.
USUAL = ["/feed", "/feed/", "/rss", "/rss.xml", "/index.xml", "/atom.xml", "/feed/rss", "/rss/", "/rssfeeds", "/?feed=rss2", "/feeds/posts/default", "/section/india/feed/", "/rss/india", "/latest/feed"]
# Homepages of outlets that have no feed address to start from.
HOMEPAGES = {"torstar": "https://www.thestar.com/", "reuters": "https://www.reuters.com/world/", "xinhua": "https://english.news.cn/"}
# Addresses where the feeds of some outlets may be.
ALTERNATES = {
    "ap": ["https://apnews.com/index.rss", "https://apnews.com/hub/world-news/rss", "https://apnews.com/rss"],
    "washtimes": ["https://www.washingtontimes.com/rss/headlines/news/politics/", "https://www.washingtontimes.com/rss/headlines/news/"],
    "thewire-in": ["https://thewire.in/rss/", "https://m.thewire.in/rss"],
    "indianexp": ["https://indianexpress.com/section/india/feed/", "https://indianexpress.com/section/world/feed/"],
    "theprint": ["https://theprint.in/feed", "https://theprint.in/rss"],
    "swarajya": ["https://swarajyamag.com/rss/all", "https://swarajyamag.com/commentary/feed"],
    "haaretz": ["https://www.haaretz.com/cmlink/1.4605102", "https://www.haaretz.com/srv/rss"],
    "timesofisrael": ["https://www.timesofisrael.com/feed", "https://www.timesofisrael.com/rss"],
    "xinhua": ["https://english.news.cn/rss/world.xml", "https://english.news.cn/home.xml"],
    "focustaiwan": ["https://focustaiwan.tw/rss/all", "https://focustaiwan.tw/rss/politics.xml"],
}


def candidate_urls(failed: DataFrame, per_step: int = 5, alternates: dict[str, list[str]] | None = None) -> DataFrame:
    """(id, step, pos, url, nth): where else a feed may be, each address at its first place: what the outlet's feed index declares,
    known addresses, what the page that failed declares, what the homepage declares, usual paths.

    failed: id, feed, feed_index, index_html, page_html, page_type, home_html. At most ``per_step`` of each step but the last.
    """
    known = ALTERNATES if alternates is None else alternates
    none = F.array().cast("array<string>")
    start = F.coalesce("feed", F.try_element_at(F.create_map(*(F.lit(x) for kv in HOMEPAGES.items() for x in kv)), F.col("id")))
    site = lambda c: F.regexp_extract(c, r"^[a-zA-Z]+://[^/?#]+", 0)
    origin = site(start)
    some = lambda html, base: F.slice(F.coalesce(declared_feeds(html, base), none), 1, per_step)
    listed = F.coalesce(F.try_element_at(F.create_map(*(x for k, v in known.items() for x in (F.lit(k), F.array(*(F.lit(u) for u in v[:per_step]))))), F.col("id")), none) if known else none
    page = F.when(~F.coalesce(F.col("page_type"), F.lit("")).rlike("(?i)xml"), F.col("page_html"))
    steps = F.array(some(F.col("index_html"), site(F.col("feed_index"))), listed, some(page, origin), some(F.col("home_html"), origin), F.transform(F.array(*(F.lit(u) for u in USUAL)), lambda p: F.concat(origin, p)))
    flat = failed.select("id", "feed", F.posexplode(steps).alias("step", "urls")).select("id", "feed", "step", F.posexplode("urls").alias("pos", "url")).where("NOT url <=> feed")
    first = flat.groupBy("id", "url").agg(F.min(F.struct("step", "pos")).alias("at"))
    return first.select("id", "at.step", "at.pos", "url", F.row_number().over(Window.partitionBy("id").orderBy("at")).alias("nth"))


def probe_list(failed: DataFrame, most: int = 40, per_step: int = 5) -> DataFrame:
    """(id, step, pos, url): the first ``most`` of the candidate addresses."""
    return candidate_urls(failed, per_step).where(f"nth <= {most}").select("id", "step", "pos", "url")


def gave_up(candidates: DataFrame, found: DataFrame, most: int = 40) -> DataFrame:
    """(id, note) for outlets without a working feed among their first ``most`` addresses that have more: not all were tried."""
    more = candidates.groupBy("id").agg(F.max("nth").alias("n")).where(f"n > {most}").join(found, "id", "left_anti")
    return more.select("id", F.lit(f"gave up after {most} probes (cap {most}) — not all candidates were tried").alias("note"))


def first_working(probes: DataFrame, responses: DataFrame) -> DataFrame:
    """(id, suggested): the first probe in order whose response is a feed with items."""
    r = responses.select("url", "status", feed_verdict(F.coalesce("body", F.lit("")), F.col("content_type")).alias("v"))
    good = probes.join(r, "url").where("status BETWEEN 200 AND 299 AND v.is_feed AND v.items > 0")
    return good.groupBy("id").agg(F.min_by("url", F.struct("step", "pos")).alias("suggested"))


def diagnose(results: DataFrame) -> DataFrame:
    """(id, verdict) of probes (id, agent, ok, note) by the agents current, compatible and browser."""
    rows = results.groupBy("id").agg(
        F.count("agent").alias("n"), *(F.coalesce(F.bool_or(F.when(F.col("agent") == a, F.col("ok"))), F.lit(False)).alias(a) for a in ("current", "compatible", "browser")),
        F.bool_and(F.coalesce(F.col("note") == "robots.txt", F.lit(False))).alias("robots"), F.bool_and(F.coalesce(F.col("note").startswith("200, not a feed"), F.lit(False))).alias("wrong"),
    )
    return rows.select("id", verdict(*(F.col(c) for c in ("n", "current", "compatible", "browser", "robots", "wrong"))).alias("verdict"))


def verdict(n: Column, current: Column, compatible: Column, browser: Column, robots: Column, wrong: Column) -> Column:
    # The wording of the verdicts.
    return (
        F.when(n == 0, "no candidate url")
        .when(current, "works today — no change needed")
        .when(compatible, "**fixed by the compatible agent** — safe to deploy")
        .when(browser, "only a browser string works — the outlet is refusing automated clients")
        .when(robots, "robots.txt forbids it — not ours to take")
        .when(wrong, "url is wrong, not a client problem")
        .otherwise("fails under every agent — not a User-Agent problem")
    )


def targets(roster: DataFrame, include_unverified: bool = False) -> tuple[DataFrame, DataFrame]:
    """(outlets to read, failures (layer, source, id, url, reason)): unverified and feedless outlets are failures, not silence."""
    feed = F.nullif(F.trim("feed"), F.lit(""))
    reason = F.when(feed.isNull(), "no feed url in roster").when(~F.coalesce("verified", F.lit(False)) & F.lit(not include_unverified), "feed not verified")
    rows = roster.withColumn("__reason", reason)
    return rows.where("__reason IS NULL").drop("__reason"), rows.where("__reason IS NOT NULL").select(F.lit("discover-rss").alias("layer"), F.col("name").alias("source"), "id", feed.alias("url"), F.col("__reason").alias("reason"))
