"""Fill-in-the-middle against a plain version, and its defined cases."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from tessera.llm import fim, queries
from tessera.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def key(rows):
    return sorted(map(repr, rows))


def test_every_document_matches_a_plain_version(spark):
    docs = table(spark, SF, "documents")
    want = key(plain(r.doc_id, r.text) for r in docs.collect())
    assert key(map(tuple, fim.fill_in_middle(docs).collect())) == want
    assert {r.form for r in fim.fill_in_middle(docs).select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_odd_rows(spark):
    odd = ["", None, " ", "a", "<P>", "x<S>y", "<M", "P>", "<<P", "é中\U0001f600 ab\x00c\r\n\t z", "áb", "<", ">", "<S", "S>", "word " * 50_000, "中" * 300_000, "a" * 500_000, "<M<S<P"]
    rows = [(i, t) for i in range(40) for t in odd[: 15 + (i % 4)]] + [(None, "some words here"), (None, None), (7, "same"), (7, "same"), (-5, "negative id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("form", F.lit("x")).withColumn("n", F.lit("y")).withColumn("id", F.lit(3))
    made = fim.fill_in_middle(df)
    assert key(map(tuple, made.collect())) == key(plain(*r) for r in rows)
    back = made.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text"))
    assert key(map(tuple, back.collect())) == key((i, t or "") for i, t in rows)
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_shares_are_parameters(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    assert {r.form for r in fim.fill_in_middle(df, plain=0, suffix_first=0).collect()} == {"psm"}
    assert {r.form for r in fim.fill_in_middle(df, plain=0, suffix_first=100).collect()} == {"spm"}
    assert {r.form for r in fim.fill_in_middle(df, plain=100).collect()} == {"plain"}
    assert fim.fill_in_middle(df, seed=2).exceptAll(fim.fill_in_middle(df)).count() > 200


def test_query_keeps_its_contract(spark):
    df = queries.op13_fill_in_middle(spark, SF)
    assert df.dtypes == [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output_sha256", "string"), ("restored_sha256", "string")]
    text = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    assert all(r.restored_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in df.collect())
