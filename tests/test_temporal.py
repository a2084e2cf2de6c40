"""Joins and aggregates over time, changes between runs and sketch tables: against plain versions, on odd rows, in batch and as streams."""

from __future__ import annotations

import collections
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.operators import changes, sketches, temporal

T0 = datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def crowd(seed, n, keys=("a", "b", None, "hot", "hot", "hot"), span=4000):
    rng = random.Random(seed)
    return [(rng.choice(keys), at(rng.choice([None, rng.randrange(span), rng.randrange(span), 1440, 2880])), i) for i in range(n)]


def plain_as_of(left, right, tolerance=None, exact=True, forward=False):
    out = []
    for k, t, v in left:
        best = None
        for rk, rt, rv in right:
            if None in (k, t, rk, rt) or rk != k or (rt > t if not forward else rt < t) or (rt == t and not exact) or (tolerance and abs(t - rt) > tolerance):
                continue
            if best is None or ((rt, rv) > best if not forward else (rt < best[0] or rt == best[0] and rv > best[1])):
                best = (rt, rv)
        out.append((k, t, v, *(best or (None, None))))
    return sorted(map(repr, out))


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("tolerance", [None, 300])
def test_as_of_join_matches_a_plain_version(spark, exact, forward, tolerance):
    left, right = crowd(1, 200) + [("hot", at(1440), 500), ("hot", at(1440), 500), ("alone", at(5), 1)], crowd(2, 120) + [("hot", at(1440), -1), ("hot", at(9999), 3)]
    a = spark.createDataFrame(left, "k string, t timestamp, v int")
    b = spark.createDataFrame(right, "k string, rt timestamp, rv int")
    want = plain_as_of(left, right, tolerance and timedelta(minutes=tolerance), exact, forward)
    for cell, salts in (("1 day", 4), ("10 minutes", 1)):
        got = temporal.as_of_join(a, b, ["k"], "t", "rt", cell, tolerance and f"{tolerance} minutes", exact, forward, salts)
        assert rows_of(got) == want
    assert rows_of(temporal.as_of_join(a.limit(0), b, ["k"], "t", "rt")) == [] and rows_of(temporal.as_of_join(a, b.limit(0), ["k"], "t", "rt")) == plain_as_of(left, [])


def test_as_of_join_of_wide_states(spark):
    a = spark.createDataFrame([("x", 1, at(5)), ("x", 2, at(5)), ("x", 1, at(-60 * 24 * 365 * 80))], "k string, j int, t timestamp")
    b = spark.createDataFrame([("x", 1, at(4), {"p": 1}, [1, None]), ("x", 1, at(4), {"p": 2}, None), ("x", None, at(4), {}, [])], "k string, j int, rt timestamp, m map<string,int>, l array<int>")
    got = temporal.as_of_join(a, b, ["k", "j"], "t", "rt").orderBy("t", "j").collect()
    assert [(r.m, r.l) for r in got] == [(None, None), ({"p": 2}, None), (None, None)]
    with pytest.raises(ValueError, match="both sides"):
        temporal.as_of_join(a, a.select("k", F.col("t").alias("rt"), "j"), ["k"], "t", "rt")


def test_a_hot_key_is_dealt_out(spark):
    a = spark.range(40_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("t"), "id")
    b = spark.range(400).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 6000 + 30).alias("rt"), F.col("id").alias("state"))
    got = temporal.as_of_join(a, b, ["k"], "t", "rt")
    assert got.where(F.coalesce("state", F.lit(-1)) != F.floor((F.col("id") * 60 - 30) / 6000)).count() == 0
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def plain_sessions(rows, gap):
    by = collections.defaultdict(list)
    for k, t, v in rows:
        if t is not None:
            by[k].append((t, v))
    out = []
    for k, of in by.items():
        held = []
        for t, v in sorted(of):
            if held and t - held[-1][0] > gap:
                out.append((k, held[0][0], held[-1][0] + gap, len(held), sum(x for _, x in held), max(x for _, x in held)))
                held = []
            held.append((t, v))
        out.append((k, held[0][0], held[-1][0] + gap, len(held), sum(x for _, x in held), max(x for _, x in held)))
    return sorted(map(repr, out))


AGGS = {"total": ("sum", "v"), "most": ("max", "v")}


@pytest.mark.parametrize("gap", [1, 30, 600])
def test_sessions_match_a_plain_version_and_sparks_own(spark, gap):
    rows = crowd(3, 300) + [("edge", at(0), 1), ("edge", at(30), 2), ("edge", at(59), 3), ("edge", at(60), 4)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    got = temporal.sessions(df, ["k"], "t", f"{gap} minutes", AGGS)
    assert rows_of(got) == plain_sessions(rows, timedelta(minutes=gap))
    own = df.where("t IS NOT NULL").groupBy("k", F.session_window("t", f"{gap} minutes")).agg(F.count(F.lit(1)).alias("n"), F.sum("v"), F.max("v"))
    assert rows_of(got) == rows_of(own.select("k", "session_window.start", "session_window.end", "n", "sum(v)", "max(v)"))
    assert rows_of(temporal.sessions(df.limit(0), ["k"], "t", "1 minute", AGGS)) == []


class Replay:
    """A stream that gets one Parquet file a batch; what comes out is kept in memory."""

    def __init__(self, spark, tmp_path, schema, name):
        self.spark, self.path, self.schema, self.name, self.n = spark, str(tmp_path / name), schema, name, 0
        spark.createDataFrame([], schema).write.parquet(self.path)

    def frame(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)

    def give(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)


def played(query):
    query.processAllAvailable()


def test_sessions_of_a_stream_with_late_rows(spark, tmp_path):
    feed = Replay(spark, tmp_path, "k string, t timestamp, v int", "bursts")
    out = temporal.sessions(feed.frame(), ["k"], "t", "30 minutes", AGGS, late="60 minutes")
    q = out.writeStream.format("memory").queryName("bursts_out").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        batches = [
            [("a", at(0), 1), ("a", at(10), 2), ("b", at(5), 7)],
            [("a", at(60), 3), ("b", at(90), 8)],  # the watermark becomes 30
            [("a", at(35), 4), ("a", at(50), 5)],  # late, but within the watermark: they tie the sessions before them together
            [("a", at(400), 6)],  # the watermark becomes 340: the sessions before are given out
            [("a", at(200), 99)],  # too late: dropped
            [("a", at(900), 9)],
        ]
        for rows in batches:
            feed.give(rows)
            played(q)
        got = rows_of(spark.table("bursts_out"))
    finally:
        q.stop()
    kept = [r for b in batches for r in b if r[2] != 99]
    want = [r for r in plain_sessions(kept, timedelta(minutes=30)) if "900" not in r and repr(at(900)) not in r]
    assert got == want and len([r for r in got if r.startswith("('a'")]) == 2
    with pytest.raises(ValueError, match="watermark"):
        temporal.sessions(feed.frame(), ["k"], "t", "30 minutes", AGGS)


def plain_pairs(left, right, before, after):
    return sorted(repr((k, t, v, rt, rv)) for k, t, v in left for rk, rt, rv in right if None not in (k, t, rk, rt) and k == rk and -before <= rt - t <= after)


@pytest.mark.parametrize(("before", "after"), [(0, 0), (15, 120), (700, 3), (0, 5000)])
def test_interval_join_matches_a_plain_version(spark, before, after):
    left, right = crowd(4, 150), crowd(5, 150)
    a, b = spark.createDataFrame(left, "k string, t timestamp, v int"), spark.createDataFrame(right, "k string, rt timestamp, rv int")
    got = temporal.interval_join(a, b, ["k"], "t", "rt", f"{before} minutes", f"{after} minutes")
    assert rows_of(got) == plain_pairs(left, right, timedelta(minutes=before), timedelta(minutes=after))
    assert temporal.interval_join(a, b.limit(0), ["k"], "t", "rt", "1 day", "1 day").count() == 0


def test_interval_join_of_streams_equals_batch(spark, tmp_path):
    items, hits = Replay(spark, tmp_path, "k string, t timestamp, v int", "items"), Replay(spark, tmp_path, "k string, rt timestamp, rv int", "hits")
    joined = temporal.interval_join(items.frame(), hits.frame(), ["k"], "t", "rt", "15 minutes", "60 minutes", ("30 minutes", "30 minutes"))
    q = joined.writeStream.format("memory").queryName("pairs_out").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    left = sorted((r for r in crowd(6, 80, span=600) if r[1]), key=lambda r: r[1])
    right = sorted((r for r in crowd(7, 80, span=600) if r[1]), key=lambda r: r[1])
    try:
        last = max(left[-1][1], right[-1][1]) + timedelta(days=2)
        bounds = [at(m) for m in range(0, 3301, 300)]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            items.give([r for r in left if lo <= r[1] < hi])
            hits.give([r for r in right if lo <= r[1] < hi])
            played(q)
        for f in (items, hits):
            f.give([("end", last, 0)])
        played(q)
        played(q)
        kept = int(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        got = rows_of(spark.table("pairs_out").where("k <> 'end'"))
    finally:
        q.stop()
    assert got == plain_pairs(left, right, timedelta(minutes=15), timedelta(minutes=60)) and len(got) > 50
    assert kept < 20  # old rows have been let go


@pytest.mark.parametrize(("frame", "cell"), [(60, None), (1500, None), (60, "7 days"), (60, "1 minute")])
def test_running_frames_match_a_plain_version(spark, frame, cell):
    rows = crowd(8, 300)
    df = spark.createDataFrame(rows, "k string, t timestamp, v int")
    got = temporal.running(df, ["k"], "t", f"{frame} minutes", {"n": F.count(F.lit(1)), "total": F.sum("v"), "least": F.min("v")}, cell)
    want = []
    for k, t, v in rows:
        seen = [x for rk, rt, x in rows if rk == k and ((t is None and rt is None) or (t is not None and rt is not None and t - timedelta(minutes=frame) <= rt <= t))]
        want.append(repr((k, t, v, len(seen), sum(seen), min(seen))))
    assert rows_of(got) == sorted(want)
    assert temporal.running(df.limit(0), ["k"], "t", "1 day", {"n": F.count(F.lit(1))}).count() == 0


def test_set_algebra_with_counts(spark):
    a = [("x", 1), ("x", 1), ("x", 1), ("y", None), ("y", None), (None, 2), ("z", 5)]
    b = [("x", 1), ("y", None), (None, 2), (None, 2), ("w", 0)]
    da, db = spark.createDataFrame(a, "k string, v int"), spark.createDataFrame(b, "k string, v int")
    ca, cb = collections.Counter(a), collections.Counter(b)
    assert rows_of(changes.common(da, db)) == sorted(map(repr, (ca & cb).elements())) == rows_of(da.intersectAll(db))
    assert rows_of(changes.missing(da, db)) == sorted(map(repr, (ca - cb).elements())) == rows_of(da.exceptAll(db))
    assert rows_of(changes.missing(db, da)) == sorted(map(repr, (cb - ca).elements()))
    assert changes.common(da, db.limit(0)).count() == 0 and changes.missing(da, db.limit(0)).count() == len(a)


def test_differences_between_runs(spark):
    kind = "id int, name string, n double"
    before = [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "d", 4.0), (5, "e", 5.0), (5, "e", 5.0), (None, "f", 6.0), (7, "g", 7.0), (8, "h", float("nan"))]
    after = [(1, "a", 1.0), (2, "b", 2.0), (3, "C", None), (6, "x", 0.0), (5, "e", 5.0), (None, "f", 6.5), (7, "g", 7.0), (7, "g", 7.0), (8, "h", float("nan"))]
    got = changes.differences(spark.createDataFrame(before, kind), spark.createDataFrame(after, kind), ["id"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(2, "changed", 1, 1, ["n"]), (3, "changed", 1, 1, ["name", "n"]), (4, "removed", 1, 0, None), (5, "changed", 1, 0, None), (6, "added", 0, 1, None), (7, "changed", 0, 1, None), (None, "changed", 1, 1, ["n"])], key=repr
    )
    none = spark.createDataFrame([], kind)
    assert changes.differences(none, none, ["id"]).count() == 0 and changes.differences(none, spark.createDataFrame(after, kind), ["id", "name", "n"]).where("status = 'added'").count() == 8


def test_sketches_of_days_merge_within_their_errors(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("g"), F.timestamp_seconds(F.col("id") * 30).alias("t"), (F.col("id") * 7919 % 20_011).alias("reader"), (F.col("id") % 1000).cast("double").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(9, None, None, None)], "g bigint, t timestamp, reader bigint, v double"))
    days = sketches.daily(rows, ["g"], "t", F.col("reader"), F.col("v"))
    weeks = sketches.merge(days.withColumn("week", F.weekofyear("day")), ["g", "week"])
    got = {r.g: r for r in sketches.estimates(sketches.merge(weeks, ["g"]), (0.1, 0.5, 0.99)).collect()}
    exact = {r.g: r for r in rows.groupBy("g").agg(F.count_distinct("reader").alias("d"), F.count(F.lit(1)).alias("n")).collect()}
    for g in range(3):
        assert got[g].n == exact[g].n and abs(got[g].distinct_estimate - exact[g].d) <= sketches.distinct_error() * exact[g].d
        values = sorted(r.v for r in rows.where(F.col("g") == g).select("v").collect())
        for name, part in (("q10", 0.1), ("q50", 0.5), ("q99", 0.99)):
            q = got[g][name]
            assert sum(v < q for v in values) / len(values) - sketches.rank_error() <= part <= sum(v <= q for v in values) / len(values) + sketches.rank_error()
    assert (got[9].n, got[9].distinct_estimate, got[9].q50) == (1, 0, None)
    assert sketches.estimates(sketches.daily(rows.limit(0), ["g"], "t", F.col("reader"), F.col("v"))).count() == 0
