"""The whole daily run over landed inputs: feeds and hits, once each, fresh ones, stories, quotas, candidates, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.urls import canonical
from tessera.operators import cluster, feeds, matching, stories
from tessera.sources import landed, sinks
from tessera.sources.cache import Cache
from tessera.storage import Stored


class Memory:
    """What runs remember under ``path``: addresses of items that were taken, and the stories that candidates belonged to."""

    def __init__(self, spark: SparkSession, path: str, days: int = 30):
        self.seen = Cache(spark, f"{path}/seen", "__key string, first_seen timestamp", ["__key"], days)
        self.stories = Cache(spark, f"{path}/stories", "__key string, known_as string, known_since timestamp", ["__key"], days)

    def unseen(self, items: DataFrame, now, batch: int) -> DataFrame:
        """The items whose canonical address no earlier batch has taken; from now on those of this batch are taken. A batch that is run again finds the same."""
        keyed = items.withColumn("__key", canonical(F.col("url")))
        before = Stored(self.seen.get(keyed, now, before=batch).where("first_seen IS NULL").drop("first_seen", "written_at"), "unseen")
        self.seen.set(before.df.select("__key", F.lit(now).cast("timestamp").alias("first_seen")), now, batch)
        return before.df.drop("__key")

    def known(self, cands: DataFrame, now, batch: int) -> DataFrame:
        """Candidates (id, sources with u, ...) with ``known_as`` and ``known_since``: the oldest story that had one of their sources, of
        one time that of the smallest name; else themselves, now. Their sources belong to that story from now on."""
        urls = cands.select("id", F.explode("sources.u").alias("u")).select("id", canonical(F.col("u")).alias("__key")).distinct()
        oldest = self.stories.get(urls, now, before=batch).where("known_as IS NOT NULL").groupBy("id").agg(F.min(F.struct("known_since", "known_as")).alias("k"))
        at = F.lit(now).cast("timestamp")
        named = Stored(cands.select("id").distinct().join(oldest, "id", "left").select("id", F.coalesce("k.known_as", "id").alias("known_as"), F.coalesce("k.known_since", at).alias("known_since")), "known")
        self.stories.set(urls.join(named.df, "id").select("__key", "known_as", "known_since"), now, batch)
        return cands.join(named.df, "id")

    def expire(self, now) -> None:
        self.seen.expire(now)
        self.stories.expire(now)

    def drop(self) -> None:
        self.seen.drop()
        self.stories.drop()


def daily(bodies: DataFrame, hits: DataFrame, roster: DataFrame, documents: DataFrame, articles: DataFrame, now, quotas: dict[str, int], limit: int, hours: int = 72, min_outlets: int = 2, memory: Memory | None = None, batch: int = 0) -> tuple[DataFrame, DataFrame]:
    """(candidates, report of one row) of landed feed bodies (outlet_id, body), search hits, registry documents and read articles.

    roster: pos, id, name, lean, country, feed, verified, mbfc. Only feeds of outlets that may be read count; hits follow the feeds in
    order, and those of unknown outlets are left out. documents name stories by their smallest ord. With a memory, items that an
    earlier batch has taken are left out, and candidates say which story of earlier batches they go on with.
    """
    good, failures = feeds.targets(roster)
    rss = Stored(landed.feed_items(bodies, good, now), "rss").df
    matched = matching.match_to_roster(hits, roster)
    known = matched.where("matched").select(*(F.col(c) for c in rss.columns)).withColumn("ord", F.col("ord") + 10**15)
    merged = Stored(cluster.dedupe(cluster.complete(rss.unionByName(known))), "merged").df
    fresh = cluster.fresh(merged, now, hours)
    found = Stored(stories.with_regions(cluster.cluster_items(memory.unseen(fresh, now, batch) if memory else fresh)), "clusters").df
    told = found.where(F.col("outlet_count") >= min_outlets)
    picked, fill = stories.select_by_region(told, quotas, limit)
    picked = Stored(picked, "picked").df
    cands = Stored(stories.candidates(stories.verify(picked, documents, now), roster, articles, stories.conflicts(picked.select("cluster_id", F.inline("items")))), "candidates").df
    if memory:
        cands = Stored(memory.known(cands, now, batch), "candidates").df
    counts = {"rss_items": rss, "hits": hits, "hits_matched": known, "items": merged, "clusters": found, "stories": told, "candidates": cands}
    return cands, sinks.run_report(counts, stories.side_balance(cands), fill, failures)
