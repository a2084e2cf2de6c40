"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, chat, decontam, fim, maintext, mixing, neardup, negatives, quality, secrets, token_counts, toxicity, url_filter
from tessera.llm.common import Saved, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url: the longest fitting rule's, else the model's."""
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.train(url_filter.labelled_table(spark)))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document, scanned through a ledger of its own."""
    return secrets.secret_findings(table(spark, sf_dir, "documents"), secrets.BlobLedger(spark))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after two edits: the source's name goes in half-way, 16 characters go a third in."""
    docs = table(spark, sf_dir, "documents")
    size = F.length(F.coalesce("text", F.lit("")))
    edit = lambda start, remove, insert: F.struct(start.cast("int").alias("start"), F.lit(remove).alias("remove"), insert.alias("insert"))
    edits = F.array(edit(F.floor(size / 2), 0, F.concat(F.lit(" "), F.coalesce("source", F.lit("")), F.lit(" "))), edit(F.floor(size / 3), 16, F.lit("")))
    return token_counts.count_tokens(docs, edits)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents in which every source has the same share, as (doc_id, source, copy, shuffle_key)."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs.select("doc_id", "source")).select("doc_id", "source", "copy", "shuffle_key")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of every vector whose id is divisible by 100, among all rows."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(ann.build_index(rows), rows.where(F.col("vec_id") % 100 == 0))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages without their quotes, linked to what they answer, in reply order."""
    return chat.conversations(table(spark, sf_dir, "conversations"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item, the region and its edits."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 10 hard negatives for each of the first 5 positives of every vector whose id is divisible by 100; labels of ids
    divisible by 7 first become the next of ten."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, F.expr("try_add(label, 1) % 10")).otherwise(F.col("label"))
    return negatives.hard_negatives(negatives.build(rows.withColumn("label", label), F.col("vec_id") % 100 == 0))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return maintext.extract(table(spark, sf_dir, "pages"), maintext.train())


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for filling in its middle: what was cut, and digests of the output and of the text put together again."""
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality": op3_quality,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_toxicity": op7_toxicity,
    "op8_chat": op8_chat,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_main_text": op12_main_text,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": pipeline,
}

_OP2 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, text, unnest([
    {'kind': 'assign', 'ord': 0, 'all': regexp_extract_all(text, '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9+/_.=-]+')},
    {'kind': 'access', 'ord': 1, 'all': regexp_extract_all(text, 'AKIA[A-Z0-9]+')},
    {'kind': 'hex', 'ord': 2, 'all': regexp_extract_all(text, '[0-9a-f]{32,}')}]) AS k
  FROM t),
-- a match is the first occurrence of its string after the match before it
placed AS (
  SELECT doc_id, k.kind AS kind, k.ord AS ord, unnest(list_reduce(
    list_prepend({'at': 0, 'found': CAST([] AS STRUCT(s BIGINT, e BIGINT, v VARCHAR)[]), 'v': ''},
      list_transform(k.all, lambda v: {'at': 0, 'found': CAST([] AS STRUCT(s BIGINT, e BIGINT, v VARCHAR)[]), 'v': v})),
    lambda a, x: {
      'at': a.at + instr(substr(text, a.at + 1), x.v) - 1 + length(x.v),
      'found': list_append(a.found, {'s': a.at + instr(substr(text, a.at + 1), x.v) - 1, 'e': a.at + instr(substr(text, a.at + 1), x.v) - 1 + length(x.v), 'v': x.v}),
      'v': ''}).found) AS f
  FROM m WHERE len(k.all) > 0),
good AS (
  SELECT doc_id, kind, ord, f.s AS s, f.e AS e FROM placed
  WHERE (kind = 'hex') OR (kind = 'access' AND f.e - f.s >= 16)
     OR (kind = 'assign' AND length(regexp_extract(f.v, '^(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1)) >= 8)),
sums AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans
  FROM good GROUP BY doc_id)
SELECT d.doc_id, sha256(d.text) AS blob, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t d LEFT JOIN sums USING (doc_id)"""

_OP5 = """
WITH d AS (SELECT doc_id, source, coalesce(source, chr(0) || 'null') AS s FROM documents),
n AS (SELECT s, count(*) AS n FROM d GROUP BY s),
rates AS (SELECT s, (1.0::DOUBLE / (SELECT count(*) FROM n)) * (SELECT count(*) FROM d)::DOUBLE / n AS rate FROM n),
terms AS (
  SELECT s, rate, k, sum(CASE WHEN k = 0 THEN -rate ELSE ln(rate / k) END) OVER (PARTITION BY s ORDER BY k) AS lp
  FROM rates, LATERAL (SELECT unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 30)::INT)) AS k)),
cdf AS (SELECT s, k, sum(exp(lp)) OVER (PARTITION BY s ORDER BY k) AS c FROM terms),
u AS (SELECT doc_id, source, s, ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM d),
counts AS (SELECT u.doc_id, u.source, count(*) FILTER (cdf.c <= u.u) AS n FROM u JOIN cdf USING (s) GROUP BY u.doc_id, u.source)
SELECT doc_id, source, copy::INT AS copy, substr(md5('43:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 16) AS shuffle_key
FROM counts, LATERAL (SELECT unnest(generate_series(1, n)) AS copy)"""

_OP9 = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
  FROM w, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
r AS (SELECT a AS v, a AS c FROM e UNION SELECT e.b AS v, r.c FROM r JOIN e ON e.a = r.v),
comp AS (SELECT v, min(c) AS c FROM r GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(comp.c, d.doc_id), d.doc_id) AS component_id, d.doc_id = coalesce(least(comp.c, d.doc_id), d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.v = d.doc_id"""

_OP11 = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM e WHERE vec_id % 100 = 0),
own AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.label, a.v, e.r AS p, e.vec_id AS positive_id, list_dot_product(a.v, e.v)::BIGINT AS positive_score
  FROM a JOIN e ON e.label = a.label AND e.r <> a.r AND len(e.v) = len(a.v)
  QUALIFY row_number() OVER (PARTITION BY a.r ORDER BY positive_score DESC, e.vec_id, e.r) <= 5),
other AS (SELECT a.r AS a, e.r AS n, e.vec_id AS negative_id, list_dot_product(a.v, e.v)::BIGINT AS negative_score FROM a JOIN e ON e.label <> a.label AND len(e.v) = len(a.v))
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY own.a, own.p ORDER BY negative_score DESC, negative_id, n)::INT AS rank, negative_id, positive_score, negative_score
FROM own JOIN other ON other.a = own.a AND 30 * positive_score <= 100 * negative_score AND 100 * negative_score <= 90 * positive_score
QUALIFY rank <= 10"""

# places of the cuts are counted in code points, token by token, and the parts are cut out of the text
_OP13 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
units AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u FROM d),
drawn AS (
  SELECT * EXCLUDE (h), len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
long AS (SELECT r, a, b, unnest(u) AS w, unnest(generate_series(1, n)) AS i FROM drawn WHERE form <> 'plain'),
sums AS (SELECT r, sum(length(w)) FILTER (i <= least(a, b)) AS p, sum(length(w)) FILTER (i > least(a, b) AND i <= greatest(a, b)) AS m FROM long GROUP BY r),
parts AS (
  SELECT doc_id, n, form, text, coalesce(p, 0) AS p, coalesce(m, 0) AS m, substring(text, 1, coalesce(p, 0)::BIGINT) AS pre, substring(text, (coalesce(p, 0) + 1)::BIGINT, coalesce(m, 0)::BIGINT) AS mid,
    substring(text, (coalesce(p, 0) + coalesce(m, 0) + 1)::BIGINT) AS suf
  FROM drawn LEFT JOIN sums USING (r))
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN p::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN m::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""

ORACLE_SQL = {"op2_secret_scan": _OP2, "op5_mixing": _OP5, "op9_near_duplicates": _OP9, "op11_hard_negatives": _OP11, "op13_fill_in_middle": _OP13}
