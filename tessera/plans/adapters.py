"""The benchmark tables seen as what the engine works on. Lean, country and time are derived from the ids, since the tables have none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X

LEANS = ("left", "lean_left", "centre", "lean_right", "right", "state", "unrated")
COUNTRIES = ("CA", "IN", "UK", "US", "DE")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as items: the source is the outlet, the first line the title, the rest the excerpt."""
    d = table(spark, sf_dir, "documents")
    text, n = F.coalesce("text", F.lit("")), F.regexp_extract("source", r"(\d+)", 1).cast("int")
    pick = lambda xs: F.get(F.array(*(F.lit(x) for x in xs)), n % len(xs))
    return d.select(
        F.col("doc_id").alias("ord"), F.col("source").alias("outlet_id"), F.col("source").alias("outlet"), pick(LEANS).alias("lean"), pick(COUNTRIES).alias("country"),
        F.substring_index(text, "\n", 1).alias("title"), X.excerpt(F.when(F.instr(text, "\n") > 0, F.expr("substring(coalesce(text, ''), instr(text, '\n') + 1)")).otherwise(F.lit(""))).alias("excerpt"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("published_at"), F.lit("rss").alias("via"),
    )


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as a roster of outlets."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("pos"), k.cast("string").alias("id"), F.col("s_name").alias("name"), F.get(F.array(*(F.lit(x) for x in LEANS)), (k % 7).cast("int")).alias("lean"), F.get(F.array(*(F.lit(x) for x in COUNTRIES)), (k % 5).cast("int")).alias("country"),
        F.when(k % 11 != 0, F.concat(F.lit("https://www.s"), (k % 40).cast("string"), F.lit(".co.uk/rss"))).alias("feed"), (k % 3 != 0).alias("verified"),
        F.lit(None).cast("int").alias("feed_items"), F.lit(None).cast("date").alias("feed_checked"), F.lit(None).cast("string").alias("feed_error"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as rows of a rating file."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("pos"), F.regexp_replace("c_name", "Customer", "Supplier").alias("name"), F.concat(F.lit("s"), (k % 60).cast("string"), F.lit(".co.uk")).alias("source_url"), F.when(k % 4 != 0, F.concat(F.lit("https://r.example/"), k.cast("string"))).alias("mbfc_url"), (k % 50).cast("string").alias("mbfc_id"))


#: The same as SQL, for the oracles.
_LEANS = "['" + "', '".join(LEANS) + "']"
_COUNTRIES = "['" + "', '".join(COUNTRIES) + "']"
ITEMS_SQL = f"""items AS (
  SELECT doc_id AS ord, doc_id AS minute, source AS outlet_id, source AS outlet, ({_LEANS})[regexp_extract(source, '(\\d+)', 1)::INT % 7 + 1] AS lean, ({_COUNTRIES})[regexp_extract(source, '(\\d+)', 1)::INT % 5 + 1] AS country,
    split_part(coalesce(text, ''), chr(10), 1) AS title, CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS body FROM documents),
cut AS (SELECT *, substr(body, 1, 400) AS head, length(regexp_extract(substr(body, 1, 400), '(?s)^(.*[.?!]) ', 1)) AS last FROM items),
it AS (SELECT *, CASE WHEN length(body) <= 400 THEN body ELSE (CASE WHEN last > 201 THEN substr(head, 1, last) ELSE rtrim(head, ' ' || chr(9) || chr(10) || chr(13)) END) || ' …' END AS excerpt FROM cut)"""
ROSTER_SQL = f"""roster AS (
  SELECT s_suppkey AS pos, s_suppkey::VARCHAR AS id, s_name AS name, ({_LEANS})[(s_suppkey % 7)::INT + 1] AS lean, ({_COUNTRIES})[(s_suppkey % 5)::INT + 1] AS country,
    CASE WHEN s_suppkey % 11 <> 0 THEN 's' || (s_suppkey % 40) || '.co.uk' END AS domain, s_suppkey % 3 <> 0 AS verified FROM supplier)"""
RATINGS_SQL = """ratings AS (
  SELECT c_custkey AS pos, replace(c_name, 'Customer', 'Supplier') AS name, 's' || (c_custkey % 60) || '.co.uk' AS domain, CASE WHEN c_custkey % 4 <> 0 THEN 'https://r.example/' || c_custkey END AS mbfc_url, (c_custkey % 50)::VARCHAR AS mbfc_id FROM customer)"""


#: A sentence on a customer's balance, with a range of years that is no claim.
_BALANCE = "Account balance of retail customers reached ${} million in a yearly review, from 1990 to 2020, after {} percent growth"
BALANCE_SQL = "'" + _BALANCE.replace("{}", "' || abs(round(c_acctbal / 100))::INT || '", 1).replace("{}", "' || c_custkey % 9 || '", 1) + "'"


def balance_text() -> Column:
    a, b, c = _BALANCE.split("{}")
    return F.concat(F.lit(a), F.abs(F.round(F.col("c_acctbal") / 100)).cast("int").cast("string"), F.lit(b), (F.col("c_custkey") % 9).cast("string"), F.lit(c))


_TAGS = '<link rel="alternate" type="application/rss+xml" href="/f.xml"><a href="/news/feed">x</a><a href="/tag/rss">y</a><a href="/search/feed">z</a>'
FEED_TAGS_SQL = f"(CASE page_id % 3 WHEN 0 THEN '{_TAGS}' ELSE '' END)"


def feed_tags() -> Column:
    return F.when(F.col("page_id") % 3 == 0, _TAGS).otherwise("")


def decoded_sql(c: str) -> str:
    """Named entities, and the decimal ones of ASCII, decoded once; for the oracles."""
    for name, char in X.ENTITIES.items():
        if name != "amp":
            c = f"regexp_replace({c}, '(?i)&{name};', '{char.replace(chr(39), chr(39) * 2)}', 'g')"
    for n in (34, 38, 39, 60, 62, 160):
        c = f"replace({c}, '&#{n};', chr({n}))"
    return f"regexp_replace({c}, '(?i)&amp;', '&', 'g')"


#: Sentences with speech and numbers, for every second page.
_SAYINGS = [
    "The minister said on day {} that the plan for the harbour would go ahead in spite of objections from many members and all unions.",
    '"We will not accept a cut of {} percent in any of our ports this year," the chair of the union told reporters on Monday.',
    "Costs rose to $4.{} billion, according to the accounts that were published after the vote in the council of the town.",
]


def prose_sql() -> str:
    added = " || ".join("'<p>" + x.replace("'", "''").replace("{}", "' || page_id || '") + "</p>'" for x in _SAYINGS)
    return f"CASE WHEN page_id % 2 = 0 THEN replace(html, '</article>', {added} || '</article>') ELSE html END"


def prose() -> Column:
    k = F.col("page_id").cast("string")
    parts = [F.concat(F.lit("<p>" + a), k, F.lit(b + "</p>")) for a, b in (x.split("{}") for x in _SAYINGS)]
    return F.when(F.col("page_id") % 2 == 0, F.replace(F.col("html"), F.lit("</article>"), F.concat(*parts, F.lit("</article>")))).otherwise(F.col("html"))
