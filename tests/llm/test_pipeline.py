"""The corpus pipeline against plain computations of each stage."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import decontam, mixing, quality, secrets
from tessera.llm.common import Saved, table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = Saved(stage(spark, docs, SF), "test").df
        before, after = {r.doc_id: r for r in docs.collect()}, out.collect()
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        if name == "quality":
            model = quality.train(docs, table(spark, SF, "labels"))
            f = quality.Features()
            assert {r.doc_id for r in after} == {d for d, r in before.items() if quality.score(model, f(r.text)) >= 0.5}
        elif name == "near_duplicates":
            from tests.llm.test_operators import brute_components

            want = brute_components([(d, r.text) for d, r in before.items()], 5, 80, 100)
            assert {r.doc_id for r in after} == set(want.values())
        elif name == "decontamination":
            index = decontam.Index(bench)
            assert {r.doc_id for r in after} == {d for d, r in before.items() if not index.hits(r.text)}
            assert all(t not in r.text for r in after for _, t in bench)
        elif name == "secrets":
            assert {r.doc_id for r in after} == set(before)
            for r in after:
                spans = secrets.find_spans(before[r.doc_id].text)
                assert (r.text == before[r.doc_id].text) == (not spans) and not secrets.find_spans(r.text)
                assert r.n_chars == (len(r.text) if spans else before[r.doc_id].n_chars)
        else:
            counts = {r.doc_id: 0 for r in before.values()}
            for r in after:
                counts[r.doc_id] += 1
            direct = {d: 0 for d in counts}
            for r in mixing.mix(docs.select("doc_id", "source"), ordered=False).collect():
                direct[r.doc_id] += 1
            assert counts == direct
        docs = out


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "copy", "shuffle_key"} <= set(got.columns)
    keys = [r.shuffle_key for r in got.select("shuffle_key").collect()]
    assert keys and keys == sorted(keys)


def test_pipeline_on_odd_rows_and_empty_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and ties, clashing columns; and every table empty."""
    long = " ".join(f"word{i}" for i in range(30_000))
    fine = [(100 + i, f"The committee of town {i} met on a calm day and agreed on plan {i * 7} for road {i * 3}.", "en", f"s{i % 3}") for i in range(40)]
    junk = [(200 + i, f"### {i} $$$ %%% ### {i} &&& ***", "en", "junk") for i in range(40)]
    odd = [(None, "A calm text without an id, about the plan of a town.", "en", "s"), (1, None, None, None), (2, "", "en", "s"), (3, long, "en", None), (4, fine[0][1], "en", "s1"), (4, fine[0][1], "en", "s1"), (5, "The key of the town is password=hunter2hunter2 as they agreed.", "en", "s0")]
    rows = [(*r, len(r[1]) if r[1] is not None else None) for r in fine + junk + odd]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for c in ("copy", "score", "rep", "bucket", "spans", "gone"):
        docs = docs.withColumn(c, F.lit("x"))
    labels = spark.createDataFrame([(r[0], int(r[0] < 200), 0) for r in fine + junk], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, fine[5][1]), (2, None), (3, "")], "item_id bigint, text string")
    for name, empty in (("full", False), ("none", True)):
        d = tmp_path / name
        for table_, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
            (df.limit(0) if empty else df).write.parquet(str(d / f"{table_}.parquet"))
        got = corpus_pipeline.run(spark, str(d)).collect()
        assert bool(got) != empty
        if not empty:
            assert not {r.doc_id for r in got} & ({r[0] for r in junk} | {105}) and not any("hunter2" in (r.text or "") for r in got)
            assert {r.copy_ for r in got} == {"x"} and not {100, 4} <= {r.doc_id for r in got}


def test_queries_carry_their_contracts(spark):
    import __spark_entry__

    found = __spark_entry__.queries()
    want = {
        "op1_": ["page_id", "host", "path", "rule", "verdict"], "op2_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"], "op3_": ["doc_id", "held_out", "score", "predicted"],
        "op6_": ["query_id", "rank", "vec_id", "score"], "op7_": ["doc_id", "held_out", "score", "predicted"], "op9_": ["doc_id", "n_shingles", "component_id", "kept"],
    }
    for prefix, columns in want.items():
        name = next(n for n in found if n.startswith(prefix))
        assert found[name](spark, SF).columns[: len(columns)] == columns
