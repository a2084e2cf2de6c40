"""Registered queries over time and between runs, with their SQL: states valid at a moment, bursts, intervals, frames, changes, sketches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.operators import changes, matching, sketches, stories, temporal
from tessera.plans import adapters as A
from tessera.plans.catalog import query
from tessera.plans.run import Memory
from tessera.sources.cache import Cache
from tessera.storage import Stored, shared_dir


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as ratings that outlets got over time."""
    return A.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("outlet"), F.col("o_orderdate").alias("rated_at"), F.col("o_totalprice").alias("rating"), F.col("o_orderkey").alias("rating_id"))


_RATED = "rated AS (SELECT o_custkey % 50 AS outlet, o_orderdate AS rated_at, o_totalprice AS rating, o_orderkey AS rating_id FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey % 50, o_orderdate ORDER BY o_totalprice DESC, o_orderkey DESC) = 1)"


@query(f"""WITH {_RATED},
shipped AS (SELECT l_orderkey, l_linenumber, l_suppkey % 50 AS outlet, l_shipdate FROM lineitem)
SELECT l_orderkey, l_linenumber, s.outlet, l_shipdate, rated_at, rating, rating_id FROM shipped s ASOF LEFT JOIN rated r ON s.outlet = r.outlet AND s.l_shipdate >= r.rated_at""")
def rating_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery with the rating that its outlet had when it was shipped."""
    shipped = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 50).alias("outlet"), "l_shipdate")
    return temporal.as_of_join(shipped, _rated(spark, sf_dir), ["outlet"], "l_shipdate", "rated_at", cell="90 days")


def _events(spark: SparkSession, sf_dir: str, kind: str, *names: str) -> DataFrame:
    e = A.table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return e.select("user_id", *(F.col(c).alias(n) for c, n in zip(("event_id", "ts", "value"), names, strict=False)))


@query("""WITH p AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, event_id AS click_id, ts AS click_at, value AS click_value FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
e AS (SELECT user_id, event_id AS error_id, ts AS error_at FROM events WHERE event_type = 'error' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
j AS (SELECT p.*, click_id, click_at, click_value FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts > c.click_at),
k AS (SELECT j.*, error_id, error_at FROM j ASOF LEFT JOIN e ON j.user_id = e.user_id AND j.ts <= e.error_at)
SELECT user_id, event_id, ts, value, CASE WHEN near THEN click_id END AS click_id, CASE WHEN near THEN click_at END AS click_at, CASE WHEN near THEN click_value END AS click_value, error_id, error_at
FROM (SELECT *, click_at >= ts - INTERVAL 12 HOURS AS near FROM k)""")
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with its user's last click before it, if that is at most 12 hours ago, and the first error from then on."""
    bought = _events(spark, sf_dir, "purchase", "event_id", "ts", "value")
    clicked = temporal.as_of_join(bought, _events(spark, sf_dir, "click", "click_id", "click_at", "click_value"), ["user_id"], "ts", "click_at", tolerance="12 hours", exact=False)
    return temporal.as_of_join(clicked, _events(spark, sf_dir, "error", "error_id", "error_at"), ["user_id"], "ts", "error_at", forward=True)


@query("""WITH marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 4 HOURS THEN 0 ELSE 1 END AS new FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 4 HOURS AS "end", count(*) AS n, round(sum(value), 2) AS total, max(value) AS most FROM numbered GROUP BY user_id, s""")
def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bursts of events: those of a user at most four hours apart."""
    found = temporal.sessions(A.table(spark, sf_dir, "events"), ["user_id"], "ts", "4 hours", {"total": ("sum", "value"), "most": ("max", "value")})
    return found.withColumn("total", F.round("total", 2))


@query("""SELECT v.user_id, v.event_id AS view_id, v.ts AS viewed_at, c.event_id AS click_id, c.ts AS clicked_at
FROM events v JOIN events c ON v.user_id = c.user_id AND c.ts >= v.ts - INTERVAL 15 MINUTES AND c.ts <= v.ts + INTERVAL 2 HOURS WHERE v.event_type = 'view' AND c.event_type = 'click'""")
def views_with_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks of one user, from a quarter of an hour before the view to two hours after it."""
    return temporal.interval_join(_events(spark, sf_dir, "view", "view_id", "viewed_at"), _events(spark, sf_dir, "click", "click_id", "clicked_at"), ["user_id"], "viewed_at", "clicked_at", "15 minutes", "2 hours")


@query("""SELECT event_id, user_id, ts, count(*) OVER w AS n, round(sum(value) OVER w, 2) AS total, max(value) OVER w AS most, count(*) FILTER (event_type = 'error') OVER w AS errors
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 72 HOURS PRECEDING AND CURRENT ROW)""")
def recent_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the count, sum, maximum and errors of its user's events of the last 72 hours."""
    aggs = {"n": F.count(F.lit(1)), "total": F.sum("value"), "most": F.max("value"), "errors": F.count(F.when(F.col("event_type") == "error", 1))}
    found = temporal.running(A.table(spark, sf_dir, "events"), ["user_id"], "ts", "72 hours", aggs)
    return found.select("event_id", "user_id", "ts", "n", F.round("total", 2).alias("total"), "most", "errors")


_CUBE = [["lean"], ["country"], ["side"], ["country", "side"], ["lean", "country"], []]


@query(f"""WITH {A.ITEMS_SQL},
sided AS (SELECT *, CASE WHEN lean IN ('left', 'lean_left') THEN 'left' WHEN lean = 'centre' THEN 'centre' WHEN lean IN ('right', 'lean_right') THEN 'right' END AS side FROM it)
SELECT lean, country, side, grouping(lean, country, side)::INT AS level, count(*) AS items, count(DISTINCT outlet_id) AS outlets, min(ord) AS first_ord, round(count(*) / (SELECT count(*) FROM it), 6) AS share
FROM sided GROUP BY GROUPING SETS ({', '.join('(' + ', '.join(s) + ')' for s in _CUBE)})""")
def balance_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and outlets by lean, country and side, and by none of them, in one pass."""
    items = A.items(spark, sf_dir)
    sided = items.select("ord", "outlet_id", "lean", "country", L.side_of(F.col("lean")).alias("side"))
    return stories.balance_levels(sided, ["lean", "country", "side"], _CUBE)


@query("""WITH before AS (SELECT o_orderkey AS id, o_custkey AS outlet, o_orderstatus AS status, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 9 <> 4 UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 13 = 1),
after AS (SELECT o_orderkey AS id, o_custkey AS outlet, CASE WHEN o_orderkey % 17 = 3 THEN 'X' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice + (o_orderkey % 11 = 2)::INT END AS price FROM orders WHERE o_orderkey % 7 <> 3),
gone AS (SELECT * FROM before EXCEPT ALL SELECT * FROM after), new AS (SELECT * FROM after EXCEPT ALL SELECT * FROM before),
g AS (SELECT id, count(*) AS n, any_value(outlet) AS outlet, any_value(status) AS status, any_value(price) AS price FROM gone GROUP BY id), h AS (SELECT id, count(*) AS n, any_value(outlet) AS outlet, any_value(status) AS status, any_value(price) AS price FROM new GROUP BY id)
SELECT id, CASE WHEN id NOT IN (SELECT id FROM before) THEN 'added' WHEN id NOT IN (SELECT id FROM after) THEN 'removed' ELSE 'changed' END AS status, coalesce(g.n, 0) AS n_before, coalesce(h.n, 0) AS n_after,
  CASE WHEN g.n = 1 AND h.n = 1 THEN list_filter([CASE WHEN g.outlet IS DISTINCT FROM h.outlet THEN 'outlet' END, CASE WHEN g.status IS DISTINCT FROM h.status THEN 'status' END, CASE WHEN g.price IS DISTINCT FROM h.price THEN 'price' END], lambda x: x IS NOT NULL) END AS fields
FROM g FULL OUTER JOIN h USING (id)""")
def run_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was added, removed and changed between two runs over orders."""
    before, after = _runs(spark, sf_dir)
    found = changes.differences(before.withColumnRenamed("status", "state"), after.withColumnRenamed("status", "state"), ["id"])
    return found.withColumn("fields", F.transform("fields", lambda f: F.replace(f, F.lit("state"), F.lit("status"))))


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = A.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.when(k % 5 != 0, F.col("o_totalprice"))
    rows = lambda df, status, price: df.select(k.alias("id"), F.col("o_custkey").alias("outlet"), status.alias("status"), price.alias("price"))
    before = rows(o.where(k % 9 != 4), F.col("o_orderstatus"), price).unionByName(rows(o.where(k % 13 == 1), F.col("o_orderstatus"), F.col("o_totalprice")))
    return before, rows(o.where(k % 7 != 3), F.when(k % 17 == 3, "X").otherwise(F.col("o_orderstatus")), price + (k % 11 == 2).cast("int"))


_PAIR = """WITH a AS (SELECT l_suppkey % 30 AS outlet, CASE WHEN l_linenumber < 3 THEN l_returnflag END AS flag FROM lineitem WHERE l_orderkey % 3 <> 0), b AS (SELECT l_suppkey % 30 AS outlet, CASE WHEN l_linenumber < 3 THEN l_returnflag END AS flag FROM lineitem WHERE l_orderkey % 3 = 0)
SELECT outlet, flag, count(*) AS n FROM (SELECT * FROM a {} ALL SELECT * FROM b) GROUP BY outlet, flag"""


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = A.table(spark, sf_dir, "lineitem")
    of = lambda df: df.select((F.col("l_suppkey") % 30).alias("outlet"), F.when(F.col("l_linenumber") < 3, F.col("l_returnflag")).alias("flag"))
    return of(rows.where("l_orderkey % 3 <> 0")), of(rows.where("l_orderkey % 3 = 0"))


@query(_PAIR.format("INTERSECT"))
def run_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that both runs have, as often as both have them."""
    return changes.common(*_pair(spark, sf_dir)).groupBy("outlet", "flag").agg(F.count(F.lit(1)).alias("n"))


@query(_PAIR.format("EXCEPT"))
def run_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first run as often as the second lacks them."""
    return changes.missing(*_pair(spark, sf_dir)).groupBy("outlet", "flag").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type, month(ts)::INT AS month, count(*) AS n, count(DISTINCT (user_id, floor(value))) AS readers, true AS distinct_within, true AS median_within, true AS q90_within FROM events GROUP BY ALL""")
def reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct readers and values of a month from the sketches of its days, held against exact figures by their stated errors."""
    e = A.table(spark, sf_dir, "events")
    reader = F.concat_ws(":", "user_id", F.floor("value").cast("string"))
    days = sketches.daily(e, ["event_type"], "ts", reader, F.col("value"))
    by = ["event_type", "month"]
    months = sketches.estimates(sketches.merge(days.withColumn("month", F.month("day")), by), (0.5, 0.9))
    rows = e.withColumn("month", F.month("ts")).join(F.broadcast(months.select(*by, "q50", "q90")), by)  # a row a type and month
    below = lambda q, op: F.avg((F.col("value") < F.col(q) if op else F.col("value") <= F.col(q)).cast("int"))
    exact = rows.groupBy(*by).agg(F.count_distinct(reader).alias("readers"), *(below(q, op).alias(f"{q}_{op}") for q in ("q50", "q90") for op in (1, 0)))
    within = lambda q, part: (F.col(f"{q}_1") - sketches.rank_error() <= part) & (F.col(f"{q}_0") + sketches.rank_error() >= part)
    return months.join(exact, by).select(*by, "n", "readers", (F.abs(F.col("distinct_estimate") - F.col("readers")) <= sketches.distinct_error() * F.col("readers")).alias("distinct_within"), within("q50", 0.5).alias("median_within"), within("q90", 0.9).alias("q90_within"))


@query("""WITH b AS (SELECT o_custkey AS outlet, o_orderkey AS id, o_totalprice AS price, o_orderkey % 3 AS batch FROM orders WHERE o_custkey % 7 <> 6),
put AS (SELECT outlet, batch, max(price) AS price, DATE '2024-01-01' + (batch * 20)::INT AS written FROM b GROUP BY outlet, batch),
last AS (SELECT outlet, arg_max(price, batch) AS price, max(written) AS written FROM put GROUP BY outlet)
SELECT c_custkey AS outlet, price, CASE WHEN price IS NOT NULL THEN written::TIMESTAMP END AS written_at FROM customer LEFT JOIN last ON outlet = c_custkey AND written >= DATE '2024-02-15' - 30""")
def cached_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a cache of 30 days holds for every customer after three batches of orders, 20 days apart, five days after the last."""
    rows = A.table(spark, sf_dir, "orders").where("o_custkey % 7 <> 6").select(F.col("o_custkey").alias("outlet"), F.col("o_totalprice").alias("price"), (F.col("o_orderkey") % 3).alias("batch"))
    cache = Cache(spark, f"{shared_dir(spark)}/prices-{uuid.uuid4().hex}", "outlet bigint, price double", ["outlet"])
    for i, day in enumerate(("2024-01-01", "2024-01-21", "2024-02-10")):
        cache.set(rows.where(F.col("batch") == i), day, i)
    found = Stored(cache.get(A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("outlet")), "2024-02-15"), "prices")
    cache.drop()
    return found.df.withColumn("written_at", F.col("written_at").cast("timestamp_ntz"))


_BIASES = ("Left", "left-center", "Least Biased", "right-center", "Right", "Questionable", "extreme left")
_SIDES = ("left", "lean left", "center", "lean right", "right", "mixed")


@query(f"""WITH {A.ROSTER_SQL}, {A.RATINGS_SQL}, i AS (SELECT mbfc_id, max(pos) AS pi FROM ratings GROUP BY 1), d AS (SELECT domain, max(pos) AS pd FROM ratings GROUP BY 1),
o AS (SELECT id, pos, lean, CASE WHEN pos % 2 = 1 AND pos % 3 = 0 THEN 20 ELSE 40 END AS day, CASE WHEN pos % 5 = 0 THEN 'state' END AS funding, CASE WHEN pos % 2 = 0 THEN pi END AS by_id, pd FROM roster LEFT JOIN i ON i.mbfc_id = roster.id AND roster.pos % 2 = 0 LEFT JOIN d ON d.domain = roster.domain),
r AS (SELECT o.*, coalesce(by_id, pd) AS rp, ({list(_BIASES)})[(coalesce(by_id, pd) % 7)::INT + 1] AS m, CASE WHEN day = 40 AND pos % 4 <> 1 THEN ({list(_SIDES)})[(pos % 6)::INT + 1] END AS a FROM o),
s AS (SELECT *, CASE lower(m) WHEN 'extreme left' THEN -3 WHEN 'left' THEN -2 WHEN 'left-center' THEN -1 WHEN 'least biased' THEN 0 WHEN 'right-center' THEN 1 WHEN 'right' THEN 2 END AS ms,
  CASE a WHEN 'left' THEN -2 WHEN 'lean left' THEN -1 WHEN 'center' THEN 0 WHEN 'lean right' THEN 1 WHEN 'right' THEN 2 END AS sa, (rp IS NOT NULL)::INT + (a IS NOT NULL OR day = 20)::INT AS n FROM r),
k AS (SELECT *, (ms IS NOT NULL)::INT + (sa IS NOT NULL)::INT AS k, abs(ms - sa) AS gap, concat_ws('  ·  ', CASE WHEN ms IS NOT NULL THEN 'mbfc: ' || m END, CASE WHEN sa IS NOT NULL THEN 'allsides: ' || a END) AS shown, coalesce(ms, sa) AS any_score FROM s)
SELECT id, CASE WHEN n = 0 THEN 'unrated' WHEN k = 0 THEN 'unplaced' WHEN k = 1 THEN 'single_source' WHEN gap <= 1 THEN 'agree' ELSE 'disagree' END AS status, CASE WHEN k = 1 THEN any_score WHEN k = 2 AND gap <= 1 THEN floor((ms + sa) / 2.0 + 0.5)::INT END AS consensus,
  CASE WHEN k = 2 THEN shown WHEN k = 1 THEN shown || ' (unconfirmed by a second rater)' WHEN pos % 4 = 0 THEN 'Ownership: Holding ' || pos % 9 || ', Trust' WHEN funding IS NOT NULL THEN 'Funding: state' ELSE 'Unrated; ownership unknown' END AS display,
  CASE WHEN lower(m) = 'questionable' THEN 'questionable' ELSE '' END AS flags, CASE WHEN rp IS NOT NULL AND rp % 4 <> 0 THEN 'https://r.example/' || rp END AS credit, day FROM k""")
def resolved_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of all outlets on day 40, through a cache of 30 days that was filled on days 1 and 20, when some provider failed."""
    ro = A.roster(spark, sf_dir)
    k, null = F.col("pos"), F.lit(None).cast("string")
    outlets = ro.select("id", "name", "lean", F.when(k % 5 == 0, "state").alias("funding"), F.when(k % 2 == 0, F.col("id")).alias("mbfc_id"), null.alias("domain"), null.alias("site"), F.regexp_replace("feed", "/rss$", "").alias("feed"), k.alias("pos"))
    raw = F.get(F.array(*(F.lit(x) for x in _BIASES)), (k % 7).cast("int"))
    files = A.ratings(spark, sf_dir).select("pos", "mbfc_id", "source_url", raw.alias("raw"), F.when(raw == "Questionable", F.array(F.lit("questionable"), F.lit("other"))).otherwise(F.array().cast("array<string>")).alias("flags"), F.col("mbfc_url").alias("report_url"))
    sides = ro.where(k % 4 != 1).select(F.col("id").alias("outlet_id"), F.get(F.array(*(F.lit(x) for x in _SIDES)), (k % 6).cast("int")).alias("raw"), F.array().cast("array<string>").alias("flags"), null.alias("report_url"))
    owned = ro.where(k % 4 == 0).select(F.col("name").alias("outlet"), F.array(F.concat(F.lit("Holding "), (k % 9).cast("string")), F.lit("Trust")).alias("owners"))
    schema = "id string, status string, consensus int, display string, flags string, credit string, day int"
    cache = Cache(spark, f"{shared_dir(spark)}/labels-{uuid.uuid4().hex}", schema, ["id"])

    def produce(day: int, providers: dict):
        def run(keys: DataFrame) -> DataFrame:
            found = matching.resolve_labels(outlets.join(keys, "id", "left_semi"), providers, owned)
            return found.select(F.col("outlet_id").alias("id"), "status", "consensus", "display", F.array_join("flags", ",").alias("flags"), F.col("attribution.href").alias("credit"), F.lit(day).alias("day"))

        return run

    days = [(1, outlets.where(k % 2 == 0), {"mbfc": None, "allsides": sides}), (20, outlets.where(k % 3 == 0), {"mbfc": files, "allsides": None}), (40, outlets, {"mbfc": files, "allsides": sides})]
    for batch, (day, wanted, providers) in enumerate(days):
        out = cache.wrap(wanted.select("id"), produce(day, providers), f"2024-{'01' if day < 31 else '02'}-{day if day < 31 else day - 31:02d}", batch)
    found = Stored(out.drop("written_at"), "labels")
    cache.drop()
    return found.df


@query("""WITH c AS (SELECT page_id, page_id % 3 AS batch, lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]+')) AS k FROM pages),
f AS (SELECT *, min(batch) OVER (PARTITION BY k) AS first FROM c)
SELECT batch::INT AS batch, count(*) AS pages, count(*) FILTER (first = batch) AS unseen, coalesce(sum(page_id) FILTER (first = batch), 0)::BIGINT AS ids FROM f GROUP BY batch""")
def unseen_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages of three runs are on sites that no earlier run has taken, by their canonical addresses."""
    site = F.concat(F.regexp_extract("url", "^[A-Za-z]+://[^/?#]+", 0), F.lit("/?utm_source="), F.col("page_id").cast("string"))
    pages = A.table(spark, sf_dir, "pages").select("page_id", site.alias("url"))
    memory = Memory(spark, f"{shared_dir(spark)}/memory-{uuid.uuid4().hex}")
    out = None
    for batch in range(3):
        run = pages.where(F.col("page_id") % 3 == batch)
        new = memory.unseen(run, f"2024-01-0{batch + 1}", batch)
        one = run.agg(F.count(F.lit(1)).alias("pages")).join(F.broadcast(new.agg(F.count(F.lit(1)).alias("unseen"), F.coalesce(F.sum("page_id"), F.lit(0)).alias("ids")))).select(F.lit(batch).alias("batch"), "pages", "unseen", "ids")
        out = one if out is None else out.unionByName(one)
    memory.drop()
    return out


@query("""WITH d AS (SELECT doc_id FROM documents), one AS (SELECT doc_id, 'a' || doc_id // 4 AS id FROM d WHERE doc_id % 5 <> 0), two AS (SELECT doc_id, 'b' || (doc_id + 2) // 4 AS id FROM d),
links AS (SELECT two.id, min(one.id) AS known_as FROM two LEFT JOIN one USING (doc_id) GROUP BY two.id)
SELECT id, coalesce(known_as, id) AS known_as, CASE WHEN known_as IS NULL THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS known_since FROM links""")
def known_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of a second run with the stories of the first that they go on with, since they share a source."""
    d = A.table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://site.example/"), F.col("doc_id").cast("string"))
    cands = lambda df, name, n: df.groupBy(F.concat(F.lit(name), n.cast("string")).alias("id")).agg(F.collect_list(F.struct(url.alias("u"))).alias("sources"))  # noqa: E731  four documents each
    memory = Memory(spark, f"{shared_dir(spark)}/memory-{uuid.uuid4().hex}")
    memory.known(cands(d.where("doc_id % 5 <> 0"), "a", F.expr("doc_id div 4")), "2024-01-01", 0)
    found = memory.known(cands(d, "b", F.expr("(doc_id + 2) div 4")), "2024-01-02", 1)
    out = Stored(found.select("id", "known_as", F.col("known_since").cast("timestamp_ntz").alias("known_since")), "known").df
    memory.drop()
    return out
