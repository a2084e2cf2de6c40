"""What is kept between runs and read from outside: the cache, labels resolved through it, landed bodies, raw cards."""

from __future__ import annotations

import json
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.operators import matching, validation
from tessera.plans import registry
from tessera.sources import bodies, landed
from tessera.sources.cache import Cache

SF = "/root/testdata/sf0.001"
DAY = "2024-01-{:02d}"


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_cache_over_three_batches(spark, tmp_path):
    cache = Cache(spark, str(tmp_path / "c"), "k string, v int, tags array<string>", ["k"], days=10)
    put = lambda rows, day, batch: cache.set(spark.createDataFrame(rows, "k string, v int, tags array<string>"), DAY.format(day), batch)
    wanted = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("zz", 5)], "k string, n int")
    got = lambda day: {(r.k, r.n): r.v for r in cache.get(wanted, DAY.format(day)).collect()}
    assert got(1) == {("a", 1): None, ("a", 2): None, ("b", 3): None, (None, 4): None, ("zz", 5): None} and cache.missing(wanted, DAY.format(1)).count() == 3
    put([("a", 1, ["x"]), ("b", 2, None), (None, 9, None), ("a", 7, None)], 1, 0)
    put([("a", 5, [])], 8, 1)
    assert got(9) == {("a", 1): 5, ("a", 2): 5, ("b", 3): 2, (None, 4): None, ("zz", 5): None}
    assert got(3)[("a", 1)] == 7  # as it was on that day: the greatest of one batch
    assert got(12) == {("a", 1): 5, ("a", 2): 5, ("b", 3): None, (None, 4): None, ("zz", 5): None}  # the first batch has expired
    put([("a", 6, None)], 8, 1)  # a batch that is written again replaces itself
    assert got(9)[("a", 1)] == 6 and cache.live(DAY.format(9)).count() == 2
    asked = []

    def produce(keys):
        asked.append(sorted(r.k for r in keys.collect()))
        return keys.select("k", F.lit(100).alias("v"), F.lit(None).cast("array<string>").alias("tags"))

    first = {(r.k, r.n): r.v for r in cache.wrap(wanted, produce, DAY.format(14), 2).collect()}
    again = {(r.k, r.n): r.v for r in cache.wrap(wanted, produce, DAY.format(15), 3).collect()}
    assert first == again == {("a", 1): 6, ("a", 2): 6, ("b", 3): 100, (None, 4): None, ("zz", 5): 100} and asked == [["b", "zz"], []]
    cache.expire(DAY.format(20))
    assert cache._batches() == [4] and {r.k for r in cache.live(DAY.format(20)).collect()} == {"b", "zz"}
    (tmp_path / "c" / "batch=9").mkdir()  # a batch that was never finished
    assert cache._batches() == [4]
    cache.drop()
    assert cache.live(DAY.format(20)).count() == 0


def test_cache_of_many_equal_keys(spark, tmp_path):
    cache = Cache(spark, str(tmp_path / "c"), "k bigint, j string, v double", ["k", "j"])
    rows = spark.range(20_000).select((F.col("id") % 3 * 0).alias("k"), F.lit("x").alias("j"), F.col("id").cast("double").alias("v"))
    cache.set(rows, DAY.format(1), 0)
    assert rows_of(cache.live(DAY.format(2)).select("k", "j", "v")) == ["(0, 'x', 19999.0)"]
    assert cache.get(rows.drop("v"), DAY.format(2)).where("v = 19999").count() == 20_000


def test_labels_of_failing_providers(spark):
    outlets = spark.createDataFrame([("1", "One", "left", "grants", None, "one.org", None, None), ("2", "Two", None, None, "m2", None, None, None), ("3", "Three", "centre", "", None, None, "https://three.org/x", None)], "id string, name string, lean string, funding string, mbfc_id string, domain string, site string, feed string")
    files = spark.createDataFrame([(1, "m1", "https://www.one.org/", "Right", ["satire", "?"], "https://r/1"), (2, "m2", "two.org", "Questionable", ["questionable"], None)], "pos int, mbfc_id string, source_url string, raw string, flags array<string>, report_url string")
    service = spark.createDataFrame([("1", "lean right", [], None)], "outlet_id string, raw string, flags array<string>, report_url string")
    owned = spark.createDataFrame([("Two", ["B", "A"]), ("Two", ["A"]), ("Three", [])], "outlet string, owners array<string>")
    got = {r.outlet_id: r for r in matching.resolve_labels(outlets, {"mbfc": files, "allsides": service}, owned).collect()}
    assert (got["1"].status, got["1"].consensus, got["1"].display, got["1"].roster_disagrees) == ("agree", 2, "mbfc: Right  ·  allsides: lean right", True)
    assert (got["1"].attribution.href, got["1"].attribution.required, got["1"].flags, got["1"].funding, got["1"].declared_lean) == ("https://r/1", True, ["satire"], "grants", "left")
    assert (got["2"].status, got["2"].display, got["2"].owners, got["2"].attribution) == ("unplaced", "Ownership: A, B", ["A", "B"], None)
    assert (got["3"].status, got["3"].display) == ("unrated", "Unrated; ownership unknown")
    failed = {r.outlet_id: r for r in matching.resolve_labels(outlets, {"mbfc": None, "allsides": service}).collect()}
    assert [failed[i].status for i in "123"] == ["single_source", "unplaced", "unplaced"] and (failed["3"].display, failed["2"].display) == ("Unrated", "Unrated")
    nothing = matching.resolve_labels(outlets, {})
    assert {(r.status, r.display) for r in nothing.collect()} == {("unrated", "Funding: grants"), ("unrated", "Unrated")}
    assert matching.resolve_labels(outlets.limit(0), {"mbfc": files}, owned).count() == 0


def landed_rows():
    rng = random.Random(4)
    t = datetime(2024, 1, 5, 3, 30, tzinfo=UTC)
    rows = [(rng.choice(["a", "b", None]), t + timedelta(minutes=17 * i), f"body {i}\n\"é\" " + "x" * rng.randrange(50)) for i in range(60)]
    return [*rows, ("a", None, "no time"), ("b", t, None), ("b", t, ""), ("c", t, "long " * 200_000)]


def test_landed_bodies_come_back_and_filters_are_pushed(spark, tmp_path):
    bodies.register(spark)
    path, rows = str(tmp_path / "landed"), landed_rows()
    df = spark.createDataFrame(rows, bodies.SCHEMA)
    df.repartition(4).write.format("landed").mode("append").save(path)
    df.limit(0).write.format("landed").mode("append").save(path)
    load = lambda **o: spark.read.format("landed").options(**o).load(path)
    assert rows_of(load()) == rows_of(df) == rows_of(load(partBytes=1))
    assert load(partBytes=1).rdd.getNumPartitions() > 10 > load().rdd.getNumPartitions()
    for where in ("landed_at >= TIMESTAMP '2024-01-05 09:10:00'", "landed_at < TIMESTAMP '2024-01-05 05:00:00' AND outlet_id = 'b'", "outlet_id IN ('a', 'c')", "landed_at = TIMESTAMP '2024-01-05 03:30:00'", "landed_at IS NULL", "outlet_id IS NULL AND landed_at > TIMESTAMP '2024-01-05 12:00:00'"):
        assert rows_of(load().where(where)) == rows_of(df.where(where)), where
    late = load(partBytes=1).where("landed_at >= TIMESTAMP '2024-01-05 18:00:00'")
    assert 0 < late.rdd.getNumPartitions() < load(partBytes=1).rdd.getNumPartitions()
    assert not list((tmp_path / "landed" / "_writing").glob("*"))
    assert spark.read.format("landed").load(str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="appended"):
        df.write.format("landed").mode("overwrite").save(path)


def test_items_of_landed_bodies_equal_items_of_parquet(spark, tmp_path):
    from tessera.plans import ingest

    bodies.register(spark)
    found, outlets = ingest._bodies(spark, SF)
    found = found.drop("start")
    path, file = str(tmp_path / "landed"), str(tmp_path / "file")
    found.withColumn("landed_at", F.timestamp_seconds(F.lit(1704067200) + F.hash("outlet_id") % 50_000)).select("outlet_id", "landed_at", "body").write.format("landed").mode("append").save(path)
    found.write.parquet(file)
    of = lambda df: rows_of(landed.feed_items(df, outlets, "2024-02-01"))
    assert of(spark.read.format("landed").load(path)) == of(spark.read.parquet(file)) != []


def test_landed_bodies_as_a_stream(spark, tmp_path):
    bodies.register(spark)
    path = str(tmp_path / "landed")
    rows = [r for r in landed_rows() if r[1]]
    put = lambda some: spark.createDataFrame(some, bodies.SCHEMA).write.format("landed").mode("append").save(path)
    hours = sorted({r[1].replace(minute=0) for r in rows})
    half = hours[len(hours) // 2]
    put([r for r in rows if r[1] < half])

    def run():
        q = spark.readStream.format("landed").load(path).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return rows_of(spark.read.schema(bodies.SCHEMA).parquet(str(tmp_path / "out")))

    before = max(h for h in hours if h < half)
    assert run() == rows_of(spark.createDataFrame([r for r in rows if r[1] < before], bodies.SCHEMA))
    put([r for r in rows if r[1] >= half] + [("z", hours[-1] + timedelta(hours=5), "last")])
    assert run() == rows_of(spark.createDataFrame(rows, bodies.SCHEMA))  # the hour that was not finished, once; none twice


def test_raw_cards_have_the_problems_of_struct_cards(spark):
    cards = registry._cards(spark, SF)
    keep = {"ignoreNullFields": "false"}
    sources = F.transform("sources", lambda s: F.struct(s["n"].alias("n"), s["t"].alias("t"), s["u"].alias("u"), s["b"].alias("b"), s["label_source"].alias("labelSource"), s["kind"].alias("kind")))
    raw = cards.select("card", F.to_json(F.struct(sources.alias("sources"), *(c for c in cards.columns if c not in ("card", "sources"))), keep).alias("json"))
    assert rows_of(validation.raw_problems(raw)) == rows_of(validation.problems(cards)) != []


def test_raw_cards_of_odd_shapes(spark):
    good = {"sources": [{"n": "A", "t": "t", "u": "https://a.example/"}, {"n": "B", "t": "t", "u": "https://b.example/"}], "headline": "h", "context": "c", "coverage": "c", "regions": ["Global"], "facts": [{"t": "f", "s": [0, 1.0], "tier": "multi"}],
            "views": [{"side": s, "status": "not sourced"} for s in ("left", "centre", "right")]}
    odd = {
        "good": good, "no json": "{", "list": [good], "text": "x", "null": None,
        "gaps": good | {"gaps": None}, "gaps text": good | {"gaps": "x"}, "gap": good | {"gaps": ["g", "", 3, None]}, "disputed": good | {"disputed": None}, "disputed number": good | {"disputed": 3}, "disputed empty": good | {"disputed": [{"t": " "}, {}, 5]},
        "no list": good | {"sources": {"n": 1}, "facts": "f", "views": None, "regions": "Global"}, "indices": good | {"facts": [{"t": "f", "s": ["0", 0.5, None, -1, 2, 10**30, [0], 1], "tier": "single"}]}, "absent": {k: v for k, v in good.items() if k != "headline"}, "null prose": good | {"headline": None, "context": " "},
        "axis": good | {"axis": {"applies": False}}, "axis text": good | {"axis": {"applies": "false"}}, "axis list": good | {"axis": []}, "uncited": good | {"facts": [{"t": "f", "s": [], "tier": "single"}, {"t": "f", "tier": "single"}]}, "elements": good | {"facts": [None, 3, "x"]}, "_prose": good | {"_prose": "left over"}, "empty": {},
    }
    raw = spark.createDataFrame([(i, v if k in ("no json", "null") else json.dumps(v)) for i, (k, v) in enumerate(odd.items())], "card bigint, json string")
    got = {k: [] for k in odd}
    for r in validation.raw_problems(raw).collect():
        got[list(odd)[r.card]].append(r.code)
    got = {k: sorted(v) for k, v in got.items()}
    assert got["good"] == [] and got["disputed"] == [] and got["axis text"] == [] and got["axis list"] == []
    assert got["no json"] == got["list"] == got["text"] == got["null"] == ["payload-shape"]
    assert got["gaps"] == got["gaps text"] == ["gaps-shape"] and got["gap"] == ["gap-empty"] * 2 and got["disputed number"] == ["disputed-shape"] and got["disputed empty"] == ["disputed-empty"] * 3
    assert got["no list"] == ["no-facts", "no-regions", "no-sources", *["view-missing"] * 3]
    assert got["indices"] == ["fact-bad-index"] * 7 and got["absent"] == ["prose-missing"] and got["null prose"] == ["prose-missing", "prose-missing", "prose-null"]
    assert got["axis"] == ["axis-unnamed"] and got["uncited"] == ["fact-uncited"] * 2 and got["elements"] == sorted(["fact-empty", "fact-uncited", "tier-missing"] * 3) and got["_prose"] == ["candidate-leftover"]
    assert got["empty"] == sorted(["no-sources", "no-regions", "no-facts", *["prose-missing"] * 3, *["view-missing"] * 3])
    assert validation.raw_problems(raw.limit(0)).count() == 0
