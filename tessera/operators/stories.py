"""What is known of a story: region, framing, selection, numeric conflicts, key terms, verification, candidates, balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.functions import numbers as N
from tessera.functions import text as X

# Terms that place a story (weight 3) and that suggest a place (weight 1).
STRONG = {
    "Canada": ["canada", "canadian government", "ottawa", "parliament hill", "bank of canada", "statistics canada", "carney", "poilievre", "csis", "rcmp", "quebec", "ontario", "alberta",
               "british columbia", "manitoba", "saskatchewan", "nova scotia"],
    "India": ["india", "new delhi", "indian government", "modi", "lok sabha", "rajya sabha", "reserve bank of india", "bjp", "congress party", "gujarat", "maharashtra", "tamil nadu", "kerala",
              "uttar pradesh", "karnataka", "mumbai", "bengaluru", "kolkata", "chennai", "ahmedabad", "hyderabad"],
    "Europe": ["european union", "european commission", "european parliament", "brussels", "von der leyen", "eurozone", "european central bank", "eur-lex", "schengen", "germany", "france", "italy",
               "spain", "poland", "netherlands", "sweden", "denmark", "finland", "norway", "ireland", "portugal", "greece", "austria", "belgium", "hungary", "czech", "slovakia", "romania", "bulgaria",
               "croatia", "kosovo", "serbia", "ukraine", "berlin", "paris", "madrid", "rome", "warsaw", "stockholm", "strasbourg", "the hague"],
}
WEAK = {
    "Canada": ["canadians", "toronto", "vancouver", "montreal", "calgary", "edmonton", "winnipeg", "brampton", "loonie", "provincial"],
    "India": ["indians", "delhi", "pune", "jaipur", "lucknow", "rupee", "crore", "lakh", "adani", "ambani"],
    "Europe": ["europe", "european", "eurostat", "brexit", "nato", "member state", "member states", "eurosceptic", "commissioner"],
}
PUBLISHERS = {"Canada": ["CA"], "India": ["IN"], "Europe": ["EU", "DE", "FR", "UK"]}
QUALIFIES = 3

# Registries of primary documents, in order; only the first is read.
REGISTRIES = [
    ("federal-register", "US Federal Register", True), ("csis-canada", "CSIS public reports", False), ("statcan", "Statistics Canada WDS", False), ("boc-valet", "Bank of Canada Valet", False),
    ("egazette", "India eGazette", False), ("pib", "Press Information Bureau", False), ("mea-india", "India Ministry of External Affairs", False), ("eur-lex", "EUR-Lex CELLAR", False),
    ("eurostat", "Eurostat", False), ("congress-gov", "Congress.gov", False), ("reliefweb", "ReliefWeb", False),
]


def _one_of(values: list[str]):
    return lambda c: c.isin(values)


def _on(side: str):
    return lambda e: e["side"] == side


def _found(text: Column, low: Column, terms: list[str]) -> Column:
    # a plain search turns most terms away before the pattern with its borders is tried
    hits = [F.when(low.contains(t) & text.rlike(r"(?i)(?<![a-z])" + t.replace("-", r"\-") + "(?![a-z])"), F.lit(t)) for t in terms]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def regions(text: Column, countries: Column) -> Column:
    """struct(regions, scores, matched): which regions a story concerns, by named places and, weakly, by who publishes."""
    return X.let(F.struct(text.alias("t"), F.lower(text).alias("low"), countries.alias("c")), lambda x: _regions(x["t"], x["low"], x["c"]))


def _regions(text: Column, low: Column, countries: Column) -> Column:
    parts = []
    for r in STRONG:
        strong, weak = _found(text, low, STRONG[r]), _found(text, low, WEAK[r])
        published = F.exists(countries, _one_of(PUBLISHERS[r]))
        near = F.when(F.coalesce(published, F.lit(False)), F.array(F.lit("(an outlet from the region covered it)"))).otherwise(F.array().cast("array<string>"))
        parts.append(F.struct(F.lit(r).alias("region"), strong.alias("strong"), weak.alias("weak"), near.alias("near")))
    score = lambda p: (3 * F.size(p["strong"]) + F.size(p["weak"]) + F.size(p["near"])).cast("int")
    return X.let(F.transform(F.array(*parts), lambda p: F.struct(p["region"].alias("region"), score(p).alias("score"), F.concat(p["strong"], p["weak"], p["near"]).alias("terms"))), _region_verdict)


def _region_verdict(rows: Column) -> Column:
    keep = F.transform(F.filter(rows, lambda p: p["score"] >= QUALIFIES), lambda p: p["region"])
    hit = F.filter(rows, lambda p: F.size(p["terms"]) > 0)
    scores = F.map_from_entries(F.transform(rows, lambda p: F.struct(p["region"], p["score"])))
    matched = F.map_from_entries(F.transform(hit, lambda p: F.struct(p["region"], F.slice(p["terms"], 1, 8))))
    return F.struct(F.concat(keep, F.array(F.lit("Global"))).alias("regions"), scores.alias("scores"), matched.alias("matched"))


def story_text(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda i: F.concat_ws(" ", i["title"], i["excerpt"])), " ")


def with_regions(clusters: DataFrame) -> DataFrame:
    return clusters.withColumn("__text", story_text(F.col("items"))).withColumn("region", regions(F.col("__text"), F.col("countries"))).drop("__text")


# The sentences that say why left to right is not the axis, here and in _framed.
def frame(items: Column) -> Column:
    """struct(views, axis, off_axis): who on each side published, and whether left to right is the axis at all."""
    return X.let(_entries(items), _framed)


def _entries(items: Column) -> Column:
    return F.transform(items, lambda i, k: F.struct(i["outlet"].alias("outlet"), i["outlet_id"].alias("outlet_id"), i["lean"].alias("lean"), i["country"].alias("country"), k.cast("int").alias("evidence_index"), i["title"].alias("headline"), i["url"].alias("url"), L.side_of(i["lean"]).alias("side")))


def _framed(entry: Column) -> Column:
    sides = ["left", "centre", "right"]
    on = {s: F.transform(F.filter(entry, _on(s)), lambda e: e.dropFields("side")) for s in sides}
    views = F.array(*(F.struct(F.lit(s).alias("side"), F.lit(L.SIDE_LABELS[s]).alias("label"), on[s].alias("outlets"), F.when(F.size(on[s]) > 0, "sourced").otherwise("not sourced").alias("status"), F.lit(None).cast("string").alias("text")) for s in sides))
    off = F.transform(F.filter(entry, lambda e: e["side"].isNull()), lambda e: e.dropFields("side").withField("reason", L.reason_for_no_side(e["lean"])))
    n = sum((F.size(on[s]) for s in sides), F.lit(0))
    present = F.array_compact(F.array(*(F.when(F.size(on[s]) > 0, F.lit(s)) for s in sides)))
    applies = (n >= 2) & (F.size(present) >= 2)
    reason = F.when(n < 2, F.concat(F.lit("only "), n.cast("string"), F.lit(" of "), F.size(entry).cast("string"), F.lit(" items come from outlets placed on the left-right axis"))).otherwise(F.concat(F.lit("coverage sits on one side only ("), F.array_join(present, ", "), F.lit(")")))
    axis = F.struct(applies.alias("applies"), F.when(applies, F.lit("left-right")).alias("name"), F.when(~applies, reason).alias("reason"))
    return F.struct(views.alias("views"), axis.alias("axis"), off.alias("off_axis"))


def ranking(clusters: DataFrame) -> DataFrame:
    """With ``rank_score``: outlets * 10 + countries * 2 + largest similarity * 5, to nine digits, so that copies tie on any cluster."""
    return clusters.withColumn("rank_score", F.round(F.col("outlet_count") * 10 + F.size("countries") * 2 + F.coalesce("similarity.max", F.lit(0.0)) * 5, 9))


def select_by_region(clusters: DataFrame, quotas: dict[str, int], limit: int) -> tuple[DataFrame, DataFrame]:
    """(selected with slot and quota_region, fill (region, quota, filled, available)): quotas in their order, then the best of the rest.

    A quota takes from what earlier quotas left. The head of each region that can matter (the sum of quotas) is small, so the
    choice is made over those heads, which one pass finds for all regions, each task sending its own heads only.
    """
    ranked = ranking(clusters)
    need = max(limit, sum(max(0, q) for q in quotas.values()))
    whole = ""  # no region is named so: all clusters
    asked = F.filter("region.regions", lambda r: r.isin(*quotas)) if quotas else F.array().cast("array<string>")
    rows = ranked.select("cluster_id", "rank_score", "min_ord", F.explode(F.array_append(F.array_distinct(asked), F.lit(whole))).alias("region"))
    rn = F.row_number().over(Window.partitionBy("region").orderBy(F.desc("rank_score"), F.asc("min_ord")))
    heads: dict[str, list[int]] = {}
    for r in rows.withColumn("rn", rn).where(F.col("rn") <= need).select("region", "rn", "cluster_id").orderBy("region", "rn").collect():
        heads.setdefault(r.region, []).append(r.cluster_id)
    available = {r.region: r.n for r in rows.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken, filled, slot = {}, {}, 0
    for region, quota in quotas.items():
        picks = [i for i in heads.get(region, []) if i not in taken][: max(0, quota)]
        filled[region] = len(picks)
        for i in picks:
            taken[i] = (slot, region)
            slot += 1
    for i in heads.get(whole, []):
        if slot >= limit:
            break
        if i not in taken:
            taken[i] = (slot, None)
            slot += 1
    chosen = [(int(c), s, r) for c, (s, r) in taken.items() if s < limit]
    spark = clusters.sparkSession
    picked = spark.createDataFrame(chosen, "cluster_id bigint, slot int, quota_region string")
    report = spark.createDataFrame([(r, q, filled[r], available.get(r, 0)) for r, q in quotas.items()], "region string, quota int, filled int, available bigint")
    return ranked.join(F.broadcast(picked), "cluster_id"), report


def conflicts(items: DataFrame, group: str = "cluster_id", tolerance: float = 0.05, most: int = 8) -> DataFrame:
    """(group, kind, about, spread, readings): outlets that give clearly different numbers for what looks like one quantity.

    ``items``: group, ord, outlet, url, title, excerpt. A self-join on group, kind and each shared subject word, so only
    numbers about the same thing meet, each outlet's once; pairs with two shared words or more are judged.
    """
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(". "), F.coalesce("excerpt", F.lit("")))
    q = items.select(group, "ord", "outlet", "url", F.posexplode(N.quantities(text)).alias("pos", "q")).select(group, "ord", "pos", "outlet", "url", "q.*").where("NOT in_range AND value IS NOT NULL")
    # what one outlet says in the same words again gives the same readings: its first place stands for all of them
    q = q.groupBy(group, "kind", "outlet", "raw", "value", "currency", "subject").agg(F.min(F.struct("ord", "pos", "url")).alias("at")).select(group, "kind", "outlet", "raw", "value", "currency", "subject", "at.*")
    word = q.withColumn("word", F.explode("subject"))
    # subjects on which all agree, or of which one outlet speaks, have no pair
    open_ = word.groupBy(group, "kind", "word").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.min(F.coalesce("outlet", F.lit(""))).alias("o1"), F.max(F.coalesce("outlet", F.lit(""))).alias("o2"), F.count_if(F.col("outlet").isNull()).alias("nulls"))
    open_ = open_.where(f"hi <> 0 AND (hi - lo) / hi > {tolerance} AND (o1 <> o2 OR nulls > 0)").select(group, "kind", "word")
    word = word.join(open_, [group, "kind", "word"])
    side = lambda d, s: d.select(F.col(group), "kind", "word", *(F.col(c).alias(c + s) for c in ("ord", "pos", "outlet", "url", "raw", "value", "currency", "subject")))
    met = side(word, "1").join(side(word, "2"), [group, "kind", "word"]).where("(ord1 < ord2 OR (ord1 = ord2 AND pos1 < pos2)) AND NOT outlet1 <=> outlet2 AND coalesce(currency1 = currency2, true) AND greatest(value1, value2) <> 0")
    met = met.withColumn("raw_spread", F.expr("(greatest(value1, value2) - least(value1, value2)) / greatest(value1, value2)")).where(F.col("raw_spread") > tolerance)
    pairs = met.groupBy(group, "kind", "ord1", "pos1", "ord2", "pos2").agg(*(F.first(c).alias(c) for c in ("outlet1", "url1", "raw1", "outlet2", "url2", "raw2", "subject1", "subject2", "raw_spread")))
    pairs = pairs.withColumn("shared", F.array_intersect("subject1", "subject2")).where("size(shared) >= 2")
    key = F.array_join(F.array_sort(F.array(F.concat_ws(":", "outlet1", "raw1"), F.concat_ws(":", "outlet2", "raw2"))), "|")
    seen = [F.col(c) for c in ("ord1", "pos1", "ord2", "pos2")]
    first = pairs.withColumn("key", key).withColumn("rn", F.row_number().over(Window.partitionBy(group, "key").orderBy(*seen))).where("rn = 1")
    spread = F.round("raw_spread", 3)
    top = first.withColumn("spread", spread).withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("spread"), *seen))).where(f"rn <= {most}")
    reading = lambda n: F.struct(F.col(f"outlet{n}").alias("outlet"), F.col(f"raw{n}").alias("value"), F.col(f"url{n}").alias("url"))
    return top.select(group, F.col("rn").alias("rank"), "kind", F.slice("shared", 1, 4).alias("about"), "spread", F.array(reading(1), reading(2)).alias("readings"))


def key_terms(items: DataFrame, group: str = "cluster_id", most: int = 6) -> DataFrame:
    """(group, terms): runs of capitalised words in titles, the most frequent first, then the longest, then the first seen."""
    runs = F.regexp_extract_all(F.coalesce("title", F.lit("")), F.lit(r"(?<!\w)([A-Z][\w.'-]+(?:\s+[A-Z][\w.'-]+){0,3})(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"), F.lit(1))
    seen = items.select(group, "ord", F.posexplode(runs).alias("pos", "run")).select(group, "ord", "pos", F.trim("run").alias("term")).where("length(term) >= 4")
    counts = seen.groupBy(group, "term").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "pos")).alias("first"))
    top = counts.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), F.desc(F.length("term")), "first"))).where(f"rn <= {most}")
    return top.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", "term"))), lambda x: x["term"]).alias("terms"))


# Fixed values in verify: the institutions that a title may name, and the sentences on sources that do not apply or were not found.
def verify(clusters: DataFrame, documents: DataFrame, now, days: int = 30, most: int = 5) -> DataFrame:
    """``clusters`` with ``verification``: registries tried, documents found, and what absence does not prove.

    ``documents`` are landed registry rows (cluster_id, title, url, published date, publisher, doc_type, ref). Only the wired
    registry can apply: to stories of the US, or whose titles name its institutions.
    """
    titles = F.exists("items", lambda i: i["title"].rlike(r"(?<!\w)(U\.?S\.?|Washington|White House|Congress|Federal)(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"))
    applies = F.coalesce(F.array_contains("countries", "US"), F.lit(False)) | F.coalesce(titles, F.lit(False))
    recent = documents.where(F.col("published") >= F.date_sub(F.lit(now).cast("date"), days))
    rn = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("published"), "ref"))
    doc = F.struct("title", "url", F.col("published").cast("string").alias("published"), F.coalesce("publisher", F.lit("unknown")).alias("publisher"), "doc_type", "ref", F.lit("metadata only").alias("read"), F.lit(REGISTRIES[0][1]).alias("source"))
    docs = recent.withColumn("rn", rn).where(f"rn <= {most}").groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", doc.alias("d")))), lambda x: x["d"]).alias("__docs"))
    joined = clusters.join(docs, "cluster_id", "left").withColumn("__applies", applies)
    none = F.filter("__docs", lambda d: F.lit(False))
    primary = F.coalesce(F.when(F.col("__applies"), F.col("__docs")), none, F.from_json(F.lit("[]"), docs.schema["__docs"].dataType))
    attempts = F.array(*(F.struct(F.lit(i).alias("source"), F.lit(n).alias("name"), (F.col("__applies") if w else F.lit(False)).alias("attempted"), F.when(~(F.col("__applies") if w else F.lit(False)), F.lit("does not apply to this story's countries or terms")).alias("reason")) for i, n, w in REGISTRIES))
    unwired = sum(1 for r in REGISTRIES if not r[2])
    gap = F.lit(f"No primary document found. {unwired} of {len(REGISTRIES)} document sources are not wired yet, so absence here is not evidence of absence.")
    out = F.struct(F.lit(True).alias("attempted"), attempts.alias("attempts"), primary.alias("primary"), F.when(F.size(primary) == 0, gap).alias("gap"))
    return joined.withColumn("verification", out).drop("__docs", "__applies")


def candidate_id(urls: Column) -> Column:
    return F.concat(F.lit("c"), X.fnv1a(F.array_join(F.array_sort(urls), "|")))


PROSE = ("headline", "context", "coverage", "dateline", "cat", "sub", "watch", "facts", "disputed")


# Fixed values in candidates: the sentences that give the basis of a tier.
def candidates(clusters: DataFrame, roster: DataFrame, articles: DataFrame, conflict_rows: DataFrame) -> DataFrame:
    """One row a candidate: id, tier, sources with read states and labels, regions, framing, conflicts; prose stays null."""
    conflict = conflict_rows.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "kind", "about", "spread", "readings"))), lambda x: x.dropFields("rank")).alias("disputed_candidates"))
    flat = clusters.select("cluster_id", F.posexplode("items").alias("pos", "i")).select("cluster_id", "pos", "i.*")
    good = articles.where("ok").select(F.col("url"), F.lit(True).alias("__ok"), F.col("quotes").alias("__quotes"), F.col("figures").alias("__figures")).dropDuplicates(["url"])
    rated = roster.select(F.col("id").alias("outlet_id"), F.col("mbfc.bias").alias("__bias"), F.col("mbfc.url").alias("__link"), F.col("lean").alias("__lean")).dropDuplicates(["outlet_id"])
    rows = flat.join(rated, "outlet_id", "left").join(good, "url", "left")
    linked = F.col("__link").isNotNull() & F.col("__bias").isNotNull()
    source = F.struct("pos", F.col("outlet").alias("n"), F.col("title").alias("t"), F.col("url").alias("u"), F.when(linked, F.col("__bias")).otherwise(F.coalesce("__lean", "lean")).alias("b"),
                      F.when(linked, F.struct(F.lit("mbfc").alias("provider"), F.col("__link").alias("url"))).otherwise(F.struct(F.lit("roster").alias("provider"), F.lit(None).cast("string").alias("url"))).alias("label_source"),
                      L.read_state(F.col("__ok"), F.col("excerpt")).alias("read"), F.coalesce("__quotes", F.array().cast("array<string>")).alias("quotes"), F.coalesce("__figures", F.array().cast("array<struct<value:string,context:string>>")).alias("figures"))
    sources = rows.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(source)), lambda x: x.dropFields("pos")).alias("sources"))
    joined = clusters.join(sources, "cluster_id").join(conflict, "cluster_id", "left")
    documents = F.size("verification.primary") if "verification" in clusters.columns else F.lit(0)
    tier = L.tier(documents, F.col("outlet_count"))
    basis = F.when(tier == "primary", F.concat(F.lit("confirmed against "), documents.cast("string"), F.lit(" primary document(s)"))).when(tier == "multi", F.concat(F.lit("reported independently by "), F.col("outlet_count").cast("string"), F.lit(" outlets"))).otherwise(F.lit("single outlet; must ship labelled `1 source` or not at all"))
    keep = [c for c in ("region", "verification", "similarity", "countries", "leans", "first_seen", "last_seen", "slot", "quota_region") if c in clusters.columns]
    return joined.select(candidate_id(F.col("items.url")).alias("id"), "cluster_id", tier.alias("tier"), basis.alias("tier_basis"), "outlet_count", "sources", frame(F.col("items")).alias("framing"), "disputed_candidates", *keep, *(F.lit(None).cast("string").alias(p) for p in PROSE), F.lit("to be written from the retrieved text").alias("_prose"))


def articles_to_read(clusters: DataFrame, most: int = 6) -> DataFrame:
    """(cluster_id, pos, url): the first ``most`` items of each cluster, whose articles are worth fetching."""
    return clusters.select("cluster_id", F.posexplode(F.slice("items", 1, most)).alias("pos", "i")).select("cluster_id", "pos", "i.url")


def side_balance(cands: DataFrame) -> DataFrame:
    """(side, candidates): how many candidates have an outlet on each side; 'none' for those with none."""
    has = lambda s: F.exists("framing.views", lambda v: (v["side"] == s) & (F.size(v["outlets"]) > 0))
    sides = [*L.SIDE_LABELS]
    none = ~(has("left") | has("centre") | has("right"))
    one = cands.agg(*(F.count_if(has(s)).alias(s) for s in sides), F.count_if(none).alias("none"))
    return one.select(F.inline(F.array(*(F.struct(F.lit(s).alias("side"), F.col(s).alias("candidates")) for s in [*sides, "none"]))))


def starved_sides(balance: DataFrame, total: int) -> DataFrame:
    return balance.where(F.col("side") != "none").where(F.lit(total > 0) & (F.col("candidates") == 0)).select("side")


def balance_levels(items: DataFrame, dims: list[str], sets: list[list[str]]) -> DataFrame:
    """(dims..., level, items, outlets, first_ord, share) of items (ord, outlet_id, dims...) for each set of dimensions.

    level is grouping_id: a bit for each dimension that is summed over, the first one's highest, so a null there is no value. Items are
    counted per outlet once, in the map tasks first; what is expanded into the sets is one row an outlet and combination.
    """
    fine = items.groupBy(*dims, "outlet_id").agg(F.count(F.lit(1)).alias("__n"), F.min("ord").alias("__first"))
    total = items.agg(F.count(F.lit(1)).alias("__total"))  # one row
    levels = fine.groupingSets(sets, *dims).agg(F.grouping_id(*dims).cast("int").alias("level"), F.sum("__n").alias("items"), F.count_distinct("outlet_id").alias("outlets"), F.min("__first").alias("first_ord"))
    return levels.crossJoin(F.broadcast(total)).select(*dims, "level", F.coalesce("items", F.lit(0)).alias("items"), "outlets", "first_ord", F.round(F.col("items") / F.nullif(F.col("__total"), F.lit(0)), 6).alias("share"))


def distil(lines: Column, most_quotes: int = 3, most_words: int = 30, most_chars: int = 450, share: float = 0.10) -> Column:
    """struct(quotes, figures, word_count, paragraph_count): a few short quotes under budgets of words, characters and share.

    Sentences are taken by score (speech 3, attribution 2, opening 1, number 1), then place; one that does not fit is skipped.
    """
    return X.let(lines, lambda x: _distilled(x, most_quotes, most_words, most_chars, share))


# Fixed values in _distilled: the words of attribution.
def _distilled(lines: Column, most_quotes: int, most_words: int, most_chars: int, share: float) -> Column:
    spoken = r"(?i)(?<!\w)(said|says|told|according to|wrote|announced|confirmed|denied|warned|argued|stated|testified)(?!\w)"
    scored = F.transform(X.sentences(lines), lambda s, i: F.struct((-(F.when(s.rlike("[\"“][^\"”]{25,}[\"”]"), 3).otherwise(0) + F.when(s.rlike(spoken), 2).otherwise(0) + F.when(i < 3, 1).otherwise(0) + F.when(s.rlike(r"\d"), 1).otherwise(0))).alias("score"), i.alias("i"), s.alias("s")))
    words = F.size(F.filter(F.split(F.array_join(lines, " "), r"\s+"), lambda w: w != ""))
    none = F.array().cast("array<string>")

    def step(a: Column, x: Column) -> Column:
        # whichever budget of words binds first cuts the sentence; its ellipsis counts, so the budget may end at -1
        cut = X.trim_to_words(x["s"], F.greatest(F.lit(1), F.least(F.lit(most_words), a["words"])))
        sized = X.let(cut, lambda q: F.struct(q.alias("q"), F.size(F.split(q, r"\s+")).alias("n"), F.length(q).alias("c")))
        open_ = (F.size(a["quotes"]) < most_quotes) & (a["words"] > 0)
        fits = lambda q: open_ & (q["n"] >= 5) & (q["c"] <= a["chars"]) & ~F.exists(a["quotes"], lambda k: F.substring(k, 1, 40) == F.substring(q["q"], 1, 40))
        more = lambda q: F.struct(F.concat(a["quotes"], F.array(q["q"])).alias("quotes"), (a["chars"] - q["c"]).alias("chars"), (a["words"] - q["n"]).alias("words"))
        return X.let(sized, lambda q: F.when(fits(q), more(q)).otherwise(a))

    start = F.struct(none.alias("quotes"), F.lit(most_chars).alias("chars"), F.floor(words * share).cast("int").alias("words"))
    quotes = F.aggregate(F.array_sort(scored), start, step, lambda a: a["quotes"])
    quoted = lambda q: F.size(F.filter(F.split(F.array_join(q, " "), r"\s+"), lambda w: w != ""))
    figures = N.figures(F.array_join(F.slice(lines, 1, 6), " "))
    return X.let(quotes, lambda q: F.struct(q.alias("quotes"), quoted(q).alias("quoted_words"), figures.alias("figures"), words.alias("word_count"), F.size(lines).alias("paragraph_count")))
