"""URL filters: host and path rules, then logistic regression on hashed character n-grams of host and path.

Everything is DataFrame functions: parsing, rules, n-grams, training and scoring. The model is trained from a small labelled
table (of a larger one the MAX_LABELLED rows that a hash of the url puts first) by gradient descent inside one expression: labelled rows and the rows of
every slot become two arrays, and a fold over the epochs updates the weights. The weights (DIMS numbers) come to
the driver once and go into the scoring expression as a constant; scoring is one pass without a shuffle.

Defined cases: null urls and urls without :// have an empty host and path, no rule, and the verdict of the model's bias;
null ids are kept; repeated rows are judged alike; other columns are ignored; labelled rows with a null url or label teach
nothing, and without both labels the model allows all; of a url's labels the smallest counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DIMS = 4096
SIZES = (3, 4, 5)
#: The rate is for the mean over the labelled rows, so that tables of any size train alike.
EPOCHS, RATE, DECAY = 150, 30.0, 0.002
MAX_LABELLED = 5000

#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with the rule's; the longest wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: A small labelled table: 1 for urls of farms, lures and trackers, 0 for urls of ordinary sites.
LABELLED = [
    (u, y)
    for y, hosts, paths in (
        (1, ("spam-farm.example.org", "free-spam-links.test", "casino-bonus.example", "best-pills-cheap.example.org", "win-prize-now.test", "adult-cams.example",
             "link-farm.example.net", "click-track-ads.test", "cracked-warez.example", "crypto-doubler.test"),
         ("/en/728", "/win/free-bonus", "/click?id=9", "/buy/cheap-pills", "/download/crack.exe")),
        (0, ("news.example.org", "blog.garden.example.net", "docs.library.example.org", "university.example.edu", "m.journal.example.org", "wiki.history.example",
             "therin.example.net", "museum.example.org", "weather.example.net", "recipes.kitchen.example"),
         ("/en/728", "/articles/2021/spring.html", "/de/25", "/about", "/fr/825?page=2")),
    )
    for h in hosts
    for u in (f"https://{h}{p}" for p in paths)
]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where there is no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. The first of equally long ones wins."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = None
    for verdict, h, p in ordered:
        fit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = F.when(fit, hit) if fits is None else fits.when(fit, hit)
    return fits if fits is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def slots(host: str, path: str) -> Column:
    """The distinct hash slots of the n-grams of two columns, host and path marked apart."""
    grams = [
        f"transform(sequence(1, greatest(1, char_length({c}) + 2 - {n} + 1)), i -> substring(concat('^', {c}, '$'), i, {n}))"
        for c in (host, path)
        for n in SIZES
    ]
    marked = ", ".join(f"transform({g}, x -> int(pmod(xxhash64('{'h' if i < len(SIZES) else 'p'}', x), {DIMS})))" for i, g in enumerate(grams))
    return F.expr(f"array_distinct(concat({marked}))")


_TRAIN = f"""
aggregate(sequence(1, {EPOCHS}),
  named_struct('w', transform(slots, s -> 0D), 'b', 0D),
  (m, e) -> transform(array(
      transform(rows, r -> r.y - 1D / (1D + exp(-(m.b + aggregate(r.idx, 0D, (s, i) -> s + m.w[i]) / sqrt(1D + size(r.idx))))))
    ), err -> named_struct(
      'w', transform(slots, (s, j) -> m.w[j] * (1 - {DECAY}) + aggregate(s.ids, 0D, (g, i) -> g + err[i]) * {RATE} / size(rows)),
      'b', m.b + {RATE / 100} * aggregate(err, 0D, (g, x) -> g + x) / size(rows)))[0])"""


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED, "url string, label int")


def train(labelled: DataFrame) -> tuple[list[float], float]:
    """Dense weights over DIMS slots and the bias, from (url, label 0 or 1)."""
    host, path = parts(F.col("url"))
    rows = labelled.where("url IS NOT NULL AND label IN (0, 1)").select("url", "label", host.alias("host"), path.alias("path"))
    rows = rows.groupBy("url").agg(F.min("label").cast("double").alias("y"), F.first("host").alias("host"), F.first("path").alias("path"))
    rows = rows.orderBy(F.xxhash64("url"), "url").limit(MAX_LABELLED).withColumn("idx", slots("host", "path"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("up")).first()
    if not seen.n or seen.up in (0.0, float(seen.n)):
        return [0.0] * DIMS, -1.0
    # two rows of arrays, of the labelled rows and of the slots; their sizes are bounded by the labelled table's and by DIMS
    numbered = rows.withColumn("i", F.row_number().over(Window.orderBy("url")) - 1)
    of_slot = numbered.select("i", F.explode("idx").alias("slot")).groupBy("slot").agg(F.sort_array(F.collect_list("i")).alias("ids"))
    every = labelled.sparkSession.range(DIMS).select(F.col("id").cast("int").alias("slot")).join(of_slot, "slot", "left").select("slot", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    one = numbered.agg(F.array_sort(F.collect_list(F.struct("i", "y", "idx"))).alias("rows")).crossJoin(every.agg(F.array_sort(F.collect_list(F.struct("slot", "ids"))).alias("slots")))
    got = one.select(F.expr(_TRAIN).alias("m")).first().m
    return [round(w, 6) for w in got.w], round(got.b, 6)


def judge(pages: DataFrame, model: tuple[list[float], float], rules=RULES, threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row; the rule's verdict where one fits, else the model's."""
    weights, bias = model
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    constant = f"cast(split('{','.join(map(str, weights))}', ',') AS array<double>)"
    rows = rows.withColumn("__slots", slots("host", "path"))
    margin = F.expr(f"aggregate(__slots, 0D, (s, i) -> s + get({constant}, i)) / sqrt(1D + size(__slots))") + F.lit(bias)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    rule = best_rule(F.col("host"), F.col("path"), rules)
    out = rows.select("page_id", "host", "path", rule.alias("__rule"), score.alias("score"))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "score")
