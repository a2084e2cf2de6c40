"""Hard negatives against a plain version, the bounds of the approximation file, and defined cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import negatives, queries
from tessera.llm.common import table

SF = "/root/testdata/sf0.001"
KIND = "vec_id bigint, label int, embedding array<double>"


def plain(rows, is_anchor, positives=5, wanted=10, scale=256):
    good = [(i, y, [math.floor(x * scale) for x in v]) for i, y, v in rows if None not in (i, y, v) and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (a, label, v) in enumerate(good):
        if not is_anchor(a):
            continue
        scored = [(-sum(x * z for x, z in zip(v, w, strict=True)), i, y) for m, (i, y, w) in enumerate(good) if m != n and len(w) == len(v)]
        for p, pid, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fits = sorted(s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:wanted]
            out += [(a, pid, rank, i, -p, -s) for rank, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(df, shards=None, is_anchor="vec_id % 5 = 0"):
    return sorted(map(tuple, negatives.hard_negatives(negatives.build(df, F.expr(is_anchor), shards=shards)).collect()))


def test_bounds_enclose_every_score():
    rng = np.random.default_rng(5)
    for n, d, spread in ((1, 3, 40), (50, 7, 3), (700, 16, 60), (90, 5, 1e9), (64, 2, 0)):
        rows, anchors = (np.floor(rng.normal(0, 1, (k, d)) * spread) for k in (n, 9))
        lower, upper = negatives.bounds(*negatives.quantise(rows), anchors)
        exact = np.array([negatives.scores(rows, a) for a in anchors])
        assert (lower <= exact).all() and (exact <= upper).all()
        if n <= negatives.CELLS:  # each row is a cell of its own
            assert (upper - lower <= 1e-9 * np.abs(exact) + 2048 * (spread > 1e6)).all()


def test_few_rows_are_scored_exactly(spark):
    rows = np.array([r.embedding for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()])
    numbers = negatives.whole(rows, 256)
    n = len(numbers)
    r = {"n": n, "dims": 64, "rows": np.arange(n).tobytes(), "ids": np.arange(n).tobytes(), "labels": np.zeros(n, np.int64).tobytes(), "vectors": negatives._pack(numbers)}
    codes, low, high = negatives.quantise(numbers)
    block = negatives.Block(r | {"codes": codes.tobytes(), "low": negatives._pack(low), "high": negatives._pack(high)})
    share = []
    for a in range(0, n, 100):
        lower, upper = negatives.bounds(block.codes, block.low, block.high, numbers[a : a + 1])
        best = negatives.Best(-np.inf, np.inf, 5)
        best.offer(block, numbers[a], lower[0], upper[0], np.arange(n) != a)
        exact = numbers @ numbers[a]
        exact[a] = -np.inf
        assert [h[1] for h in best.held] == np.lexsort((np.arange(n), -exact))[:5].tolist()
        share.append(best.scored / n)
    assert np.mean(share) < 0.05


@pytest.mark.parametrize(("block", "shards"), [(4096, None), (64, 5), (16, 40)])
def test_hard_negatives_match_a_plain_version(spark, block, shards, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", block)
    df = table(spark, SF, "embeddings").repartition(3)
    rows = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    assert mined(df, shards) == plain(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(i % 3), [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(60)]  # many ties
    rows += rows[:8]  # repeated rows, anchors among them
    rows += [(None, 1, [1.0] * 4), (61, None, [1.0] * 4), (62, 1, None), (63, 1, []), (64, 1, [1.0, None, 1.0, 1.0]), (65, 1, [float("nan")] * 4), (66, 1, [float("inf")] * 4)]
    rows += [(70 + i, i % 2, [0.1 * i, -0.2, 0.3]) for i in range(9)]  # of another size
    rows += [(5, 2, [1.0, 2.0, 3.0, 4.0]), (5, 0, [0.5, 2.0, 3.0, 4.0])]  # one id, several rows
    rows += [(80, 1, [0.0] * 4), (81, 2, [0.0] * 4), (85, 0, [5e6, -5e6, 5e6, 3.0]), (86, 0, [5e6, -5e6, 5e6, 1.0]), (87, 1, [3e6, -3e6, 3e6, 1.0])]
    df = spark.createDataFrame(rows, KIND).withColumn("row", F.lit("x")).withColumn("id", F.lit("y")).withColumn("asked", F.lit(3))
    want = plain(rows, lambda i: i % 5 == 0)
    assert mined(df) == want and mined(df.repartition(7), shards=3) == want and len(want) > 100
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 5")) == plain([r for r in rows if r[0] == 5], lambda i: i % 5 == 0)
    assert mined(df.where("label = 1")) == []
    huge = [(i, i % 2, [10.0 ** (300 + i % 5), -(10.0**i), 1.0]) for i in range(10)]
    got = mined(spark.createDataFrame(huge, KIND))
    assert all(abs(r[4]) <= 2**63 and abs(r[5]) <= 2**63 for r in got)


def test_labels_and_vectors_that_many_rows_share(spark):
    rng = np.random.default_rng(8)
    rows = [(i, 1 if i % 3 else i % 10, [1.0, 2.0, 0.5] if i % 3 == 1 else [float(x) for x in rng.normal(0, 1, 3)]) for i in range(1500)]
    assert mined(spark.createDataFrame(rows, KIND).repartition(11), is_anchor="vec_id % 100 = 0") == plain(rows, lambda i: i % 100 == 0)


def test_query_matches_a_plain_version(spark):
    rows = [(r.vec_id, r.label if r.vec_id % 7 or r.label is None else (r.label + 1) % 10, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    df = queries.op11_hard_negatives(spark, SF)
    assert df.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert sorted(map(tuple, df.collect())) == plain(rows, lambda i: i % 100 == 0)
