"""Joins with the roster and with ratings: by domain, by alias, by name, by id. Rosters are small; Spark broadcasts them if they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.functions.text import normalise_name
from tessera.functions.urls import normalise_domain, registrable

# Feed hosts whose outlet is known under other domains.
ALIASES = {
    "bbci.co.uk": ["bbc.co.uk", "bbc.com"],
    "dj.com": ["wsj.com"],
    "nikkei.com": ["asia.nikkei.com", "nikkei.com"],
    "focustaiwan.tw": ["cna.com.tw", "focustaiwan.tw"],
}
# The roster's leans on the rating scale.
ROSTER_SCALE = {"left": -2, "lean_left": -1, "centre": 0, "center": 0, "lean_right": 1, "right": 2}


def one_per(df: DataFrame, key: str, order: str, last: bool = False) -> DataFrame:
    """The first (or last) row of each key that is not null."""
    by = F.desc(order) if last else F.asc(order)
    return df.where(F.col(key).isNotNull()).withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(by))).where("__rn = 1").drop("__rn")


def match_to_roster(items: DataFrame, roster: DataFrame) -> DataFrame:
    """Items with outlet_id, outlet, lean and country of the roster's outlet of the same registrable domain, and ``matched``.

    roster: pos, id, name, lean, country, feed. The last outlet of a domain wins; a null domain never matches.
    """
    r = one_per(roster.withColumn("__domain", registrable(F.col("feed"))), "__domain", "pos", last=True)
    r = r.select("__domain", F.col("id").alias("__id"), F.col("name").alias("__name"), F.col("lean").alias("__lean"), F.col("country").alias("__country"))
    joined = items.withColumn("__domain", registrable(F.col("url"))).join(r, "__domain", "left")
    hit = F.col("__id").isNotNull()
    new = {"outlet_id": "__id", "outlet": "__name", "lean": "__lean", "country": "__country"}
    kept = [c for c in items.columns if c not in new]
    return joined.select(*kept, *(F.when(hit, F.col(v)).otherwise(F.col(k) if k in items.columns else F.lit(None)).alias(k) for k, v in new.items()), hit.alias("matched"))


def query_counts(items: DataFrame) -> DataFrame:
    """(query, total, known, unknown) of matched search hits."""
    return items.groupBy("query").agg(F.count(F.lit(1)).alias("total"), F.count_if("matched").alias("known"), F.count_if(~F.col("matched")).alias("unknown"))


def rating_ladder(roster: DataFrame, ratings: DataFrame) -> DataFrame:
    """(id, status, matched_on, rating_name): exact domain applies, alias or name is for review, else missed.

    ratings: pos, name, source_url, mbfc_url. An exact match without a link is missed and does not fall through. First row of a
    key wins.
    """
    rated = ratings.withColumn("domain", registrable(F.col("source_url"))).withColumn("key", normalise_name(F.col("name")))
    by_domain = one_per(rated, "domain", "pos").select(F.col("domain").alias("d"), F.col("name").alias("dn"), F.col("mbfc_url").alias("dl"))
    by_name = one_per(rated.where("key <> ''"), "key", "pos").select(F.col("key").alias("k"), F.col("name").alias("kn"), F.col("mbfc_url").alias("kl"))
    own = roster.withColumn("domain", registrable(F.col("feed"))).withColumn("key", normalise_name(F.col("name")))
    pairs = [(a, i, b) for a, bs in ALIASES.items() for i, b in enumerate(bs)]
    alias = roster.sparkSession.createDataFrame(pairs, "a string, i int, b string").withColumn("b", registrable(F.col("b")))
    by_alias = alias.join(by_domain.withColumnRenamed("d", "b"), "b").groupBy(F.col("a").alias("domain")).agg(F.min_by("dn", "i").alias("an"), F.min_by("dl", "i").alias("al"))
    j = own.join(by_domain, own.domain == F.col("d"), "left").join(by_alias, "domain", "left").join(by_name, F.col("key") == F.col("k"), "left")
    exact, aliased, named = F.col("dn").isNotNull(), F.col("an").isNotNull(), F.col("kn").isNotNull()
    status = F.when(exact & (F.coalesce("dl", F.lit("")) != ""), "applied").when(exact, "missed").when(aliased | named, "review").otherwise("missed")
    on = F.when(exact, "domain").when(aliased, "alias").when(named, "name")
    return j.select("id", status.alias("status"), on.alias("matched_on"), F.when(exact, F.col("dn")).when(aliased, F.col("an")).otherwise(F.col("kn")).alias("rating_name"))


def trim_ratings(ratings: DataFrame, roster: DataFrame) -> DataFrame:
    """Ratings whose domain or name key the roster has: two semi joins, so no nested loop."""
    rows = ratings.withColumn("__d", registrable(F.col("source_url"))).withColumn("__k", normalise_name(F.col("name")))
    domains = roster.select(registrable(F.col("feed")).alias("__d")).where("__d IS NOT NULL").distinct()
    names = roster.select(normalise_name(F.col("name")).alias("__k")).where("__k <> ''").distinct()
    return rows.join(domains, "__d", "left_semi").select(*ratings.columns).union(rows.join(names, "__k", "left_semi").select(*ratings.columns)).distinct()


def rating_lookup(outlets: DataFrame, ratings: DataFrame) -> DataFrame:
    """Outlets with ``rating_pos`` and ``rated_by``: by the service's id, else by domain; here the last row of a key wins."""
    ids = one_per(ratings, "mbfc_id", "pos", last=True).select(F.col("mbfc_id").alias("__i"), F.col("pos").alias("__pi"))
    dom = one_per(ratings.withColumn("__d", F.nullif(normalise_domain(F.col("source_url")), F.lit(""))), "__d", "pos", last=True).select("__d", F.col("pos").alias("__pd"))
    j = outlets.withColumn("__key", F.nullif(normalise_domain(F.coalesce("domain", "site", "feed")), F.lit(""))).join(ids, F.col("mbfc_id") == F.col("__i"), "left").join(dom, F.col("__key") == F.col("__d"), "left")
    return j.select(*outlets.columns, F.coalesce("__pi", "__pd").alias("rating_pos"), F.when(F.col("__pi").isNotNull(), "id").when(F.col("__pd").isNotNull(), "domain").alias("rated_by"))


def parse_ratings(records: DataFrame) -> DataFrame:
    """Records of the rating service as structs of one shape: score null and a flag for tags that are no position."""
    raw = F.trim("bias")
    key = F.lower(raw)
    flags = F.when(key.isin(*L.FLAGS), F.array(key)).otherwise(F.array().cast("array<string>"))
    return records.select(F.lit("mbfc").alias("provider"), F.col("source_id").alias("mbfc_id"), F.col("source").alias("name"), normalise_domain(F.col("source_url")).alias("domain"), raw.alias("raw"), L.lookup(L.SCALES["mbfc"], key).alias("score"), flags.alias("flags"), "factual", "credibility", "country", "media_type", F.col("mbfc_url").alias("report_url"))


# Fixed values in consensus: the note on services that disagree.
def consensus(ratings: DataFrame, rosters: DataFrame) -> DataFrame:
    """One row an outlet of ``rosters`` (outlet_id, roster_lean): status, spread, consensus, roster_disagrees, display, flags, note.

    ratings: outlet_id, pos, provider, raw, flags. Statuses: unrated, unplaced, single_source, agree, disagree.
    """
    r = ratings.withColumn("score", L.normalise_rating(F.col("provider"), F.col("raw")))
    scored = F.col("score").isNotNull()
    shown = F.when(scored, F.struct("pos", F.concat_ws(": ", "provider", "raw").alias("d")))
    agg = r.groupBy("outlet_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("score").alias("k"), F.min("score").alias("lo"), F.max("score").alias("hi"), F.avg("score").alias("mean"),
        F.transform(F.array_sort(F.collect_list(shown)), lambda x: x["d"]).alias("shown"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.filter(F.coalesce("flags", F.array().cast("array<string>")), lambda f: F.lower(f).isin(*L.FLAGS)).alias("f")))), lambda x: x["f"]))).alias("flags"),
    )
    j = rosters.join(agg, "outlet_id", "left")
    n, k = F.coalesce("n", F.lit(0)), F.coalesce("k", F.lit(0))
    spread = F.col("hi") - F.col("lo")
    status = F.when(n == 0, "unrated").when(k == 0, "unplaced").when(k == 1, "single_source").when(spread <= 1, "agree").otherwise("disagree")
    own = L.lookup(ROSTER_SCALE, F.col("roster_lean"))
    off = F.coalesce(own.isNotNull() & (k > 0) & (F.greatest(F.abs(F.col("lo") - own), F.abs(F.col("hi") - own)) >= 2), F.lit(False))
    agreed = F.when(k == 1, F.col("lo")).when((k > 1) & (spread <= 1), L.half_up(F.col("mean")))
    display = F.when(k == 1, F.concat(F.col("shown")[0], F.lit(" (unconfirmed by a second rater)"))).when(k > 1, F.array_join("shown", "  ·  "))
    note = F.when((k > 1) & (spread >= 2), F.lit("Rating services disagree on this outlet. Both labels shown; neither is treated as settled."))
    return j.select("outlet_id", "roster_lean", status.alias("status"), F.when(k > 1, spread).alias("spread"), agreed.alias("consensus"), off.alias("roster_disagrees"), display.alias("display"), F.coalesce("flags", F.array().cast("array<string>")).alias("flags"), note.alias("note"), F.when(k == 0, F.lit("ownership")).alias("fallback"))


# Fixed values in resolve_labels: the wording of what is shown where no position is known.
def resolve_labels(outlets: DataFrame, providers: dict[str, DataFrame | None], owned: DataFrame | None = None) -> DataFrame:
    """One row an outlet: the columns of ``consensus``, with attribution, owners, funding and declared_lean.

    outlets: id, name, lean, funding, mbfc_id, domain, site, feed. providers, in order: a rating file (pos, mbfc_id, source_url, raw,
    flags, report_url), looked up by id, else domain; or the answers of a service (outlet_id, raw, flags, report_url); or None for
    one that failed. A failed provider gives each outlet a rating without a score, so that it is unplaced and not unrated. owned:
    outlet (its name), owners; None if that lookup failed. Without any position the owners are shown, else the funding.
    """
    one = None
    for i, (provider, rows) in enumerate(providers.items()):
        flags, null = F.array().cast("array<string>").alias("flags"), F.lit(None).cast("string")
        if rows is None:
            found = outlets.select(F.col("id").alias("outlet_id"), null.alias("raw"), flags, null.alias("report_url"))
        elif "outlet_id" in rows.columns:
            found = outlets.select(F.col("id").alias("outlet_id")).join(rows.select("outlet_id", "raw", "flags", "report_url"), "outlet_id")
        else:
            index = rating_lookup(outlets.select("id", "mbfc_id", "domain", "site", "feed"), rows).where("rating_pos IS NOT NULL")
            found = index.select(F.col("id").alias("outlet_id"), F.col("rating_pos").alias("pos")).join(rows.select("pos", "raw", "flags", "report_url"), "pos").drop("pos")
        found = found.withColumns({"pos": F.lit(i), "provider": F.lit(provider)})
        one = found if one is None else one.unionByName(found)
    if one is None:
        one = outlets.limit(0).select(F.col("id").alias("outlet_id"), F.lit(None).cast("string").alias("raw"), F.array().cast("array<string>").alias("flags"), F.lit(None).cast("string").alias("report_url"), F.lit(0).alias("pos"), F.lit("").alias("provider"))
    verdict = consensus(one, outlets.select(F.col("id").alias("outlet_id"), F.col("lean").alias("roster_lean")))
    credit = one.where("provider = 'mbfc' AND report_url IS NOT NULL").groupBy("outlet_id").agg(F.min(attribution(F.col("provider"), F.col("report_url"))).alias("attribution"))
    about = outlets.select(F.col("id").alias("outlet_id"), "name", "funding")
    if owned is None:
        named, unknown = about.withColumn("owners", F.lit(None).cast("array<string>")), F.lit("Unrated")
    else:
        one_each = owned.groupBy(F.col("outlet").alias("name")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("owners")))).alias("owners"))
        named, unknown = about.join(one_each, "name", "left"), F.lit("Unrated; ownership unknown")
    shown = F.when(F.coalesce(F.size("owners"), F.lit(0)) > 0, F.concat(F.lit("Ownership: "), F.array_join("owners", ", "))).when(F.coalesce("funding", F.lit("")) != "", F.concat(F.lit("Funding: "), F.col("funding"))).otherwise(unknown)
    j = verdict.join(credit, "outlet_id", "left").join(named, "outlet_id", "left")
    need = F.col("fallback") == "ownership"
    kept = [c for c in verdict.columns if c not in ("roster_lean", "display")]
    return j.select(*kept, F.when(F.coalesce(need, F.lit(False)), shown).otherwise(F.col("display")).alias("display"), "attribution", F.when(need, F.col("owners")).alias("owners"), "funding", F.col("roster_lean").alias("declared_lean"))


def unexpired(cache: DataFrame, now, days: int = 30) -> DataFrame:
    """Cached rows that are not older than ``days``."""
    return cache.where(F.col("fetched_at") >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"))


# Fixed values in attribution: the providers' sites.
def attribution(provider: Column, report_url: Column) -> Column:
    """struct(text, href, required): who is to be credited for a rating."""
    site = L.lookup({"mbfc": "https://mediabiasfactcheck.com", "allsides": "https://www.allsides.com", "adfontes": "https://adfontesmedia.com"}, provider)
    return F.struct(F.concat(F.lit("Rating: "), provider).alias("text"), F.coalesce(report_url, site).alias("href"), (provider == "mbfc").alias("required"))


def merge_roster(roster: DataFrame, results: DataFrame, checked, prefer: str = "redirected") -> DataFrame:
    """The roster with feed checks applied by id: verified ones get feed, items and date, failed ones their error; others stay.

    prefer: 'redirected' or 'suggested', the address that wins where a check found both.
    """
    other = "suggested" if prefer == "redirected" else "redirected"
    r = results.select(F.col("id").alias("__id"), "ok", "items", "note", F.col(prefer).alias("__a"), F.col(other).alias("__b")).dropDuplicates(["__id"])
    j = roster.join(r, roster["id"] == F.col("__id"), "left")
    seen, ok = F.col("__id").isNotNull(), F.coalesce("ok", F.lit(False))
    new = {
        "verified": F.when(seen, ok).otherwise(F.col("verified")),
        "feed": F.when(ok, F.coalesce("__a", "__b", "feed")).otherwise(F.col("feed")),
        "feed_items": F.when(ok, F.col("items")).otherwise(F.col("feed_items")),
        "feed_checked": F.when(seen, F.lit(checked).cast("date")).otherwise(F.col("feed_checked")),
        "feed_error": F.when(ok, F.lit(None)).when(seen, F.col("note")).otherwise(F.col("feed_error")),
    }
    return j.select(*(new[c].alias(c) if c in new else roster[c] for c in roster.columns))


def strangers(results: DataFrame, roster: DataFrame) -> DataFrame:
    """Results of ids that the roster does not have."""
    return results.join(roster.select("id"), "id", "left_anti")


def lean_balance(checks: DataFrame) -> DataFrame:
    """(lean, total, ok) over feed checks."""
    return checks.groupBy("lean").agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("ok"))


def spectrum_balance(checks: DataFrame) -> DataFrame:
    """(side, ok) for all three sides, those without any row too."""
    sides = checks.sparkSession.createDataFrame([(s,) for s in L.SIDE_LABELS], "side string")
    return sides.join(checks.withColumn("side", L.side_of(F.col("lean"))).groupBy("side").agg(F.count_if("ok").alias("ok")), "side", "left").select("side", F.coalesce("ok", F.lit(0)).alias("ok"))
