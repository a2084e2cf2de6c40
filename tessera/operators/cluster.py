"""Stories: TF-IDF vectors, a similarity join over an inverted index, connected components, cohesion pruning, summaries.

Items have ord (unique), title, excerpt, url, outlet_id, outlet, lean, country and published_at. Every sort ends with ord.

Scale: terms are long rows; document frequencies and norms are combined map-side. Only terms in 2 to max_block items make
pairs, which bounds any term's pairs; the exact cosine of the pairs that are left uses all shared terms. Components are
found by minimum labels with pointer jumping on written tables; pruning is one grouped task a component, of components
larger than two only, in memory in proportion to its terms.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as X
from tessera.storage import Stored

THRESHOLD, FLOOR, WINDOW_HOURS, MAX_BLOCK = 0.36, 0.30, 72, 120


def exclude(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items that tell of an event, items that are boilerplate or digests)."""
    bad = X.is_boilerplate(F.col("title")) | X.is_digest(F.col("title"), F.col("url"))
    return items.where(~bad), items.where(bad)


def vectors(items: DataFrame, title_weight: int = 3) -> DataFrame:
    """(ord, term, tf, df, w): (1 + ln tf) * (ln((n + 1) / (df + 1)) + 1), normalised to length 1."""
    title = X.tokenise(X.normalise_title(F.col("title")))
    weighed = F.concat(F.transform(title, lambda t: F.struct(t.alias("t"), F.lit(title_weight).alias("k"))), F.transform(X.tokenise(F.col("excerpt")), lambda t: F.struct(t.alias("t"), F.lit(1).alias("k"))))
    tf = items.select("ord", F.explode(weighed).alias("x")).groupBy("ord", F.col("x.t").alias("term")).agg(F.sum("x.k").alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = items.agg(F.count(F.lit(1)).alias("n"))  # one row
    raw = tf.join(df, "term").join(F.broadcast(n)).withColumn("raw", (1 + F.ln("tf")) * (F.ln((F.col("n") + 1) / (F.col("df") + 1)) + 1))
    # the norm over the rows of an item that are dealt out once
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("ord")))
    return raw.select("ord", "term", "tf", "df", (F.col("raw") / norm).alias("w"))


def similar_pairs(items: DataFrame, vecs: DataFrame, threshold: float = THRESHOLD, hours: int = WINDOW_HOURS, max_block: int = MAX_BLOCK) -> DataFrame:
    """(i, j, sim), i < j: pairs of different outlets within the time window that share a blocking term, cosine at the threshold."""
    # equal outlets (null ones too) are left out; a missing time is always inside the window
    facts = items.select("ord", "outlet_id", F.unix_millis(F.col("published_at").cast("timestamp")).alias("ms"))
    post = vecs.where(f"df BETWEEN 2 AND {max_block}").select("ord", "term").join(facts, "ord")
    a = post.select("term", F.col("ord").alias("i"), F.col("outlet_id").alias("oi"), F.col("ms").alias("ti"))
    b = post.select("term", F.col("ord").alias("j"), F.col("outlet_id").alias("oj"), F.col("ms").alias("tj"))
    near = F.coalesce(F.abs(F.col("ti") - F.col("tj")) <= hours * 3_600_000, F.lit(True))
    pairs = a.join(b, "term").where((F.col("i") < F.col("j")) & ~F.col("oi").eqNullSafe(F.col("oj")) & near).select("i", "j").distinct()
    return cosine(pairs, vecs).where(F.col("sim") >= threshold)


def cosine(pairs: DataFrame, vecs: DataFrame) -> DataFrame:
    """(i, j, sim) for each pair that shares a term, over all shared terms."""
    # a term of one item only is shared by nobody
    a = vecs.where("df > 1").select(F.col("ord").alias("i"), "term", F.col("w").alias("wi"))
    b = vecs.where("df > 1").select(F.col("ord").alias("j"), "term", F.col("w").alias("wj"))
    return pairs.join(a, "i").join(b, ["j", "term"]).groupBy("i", "j").agg(F.sum(F.col("wi") * F.col("wj")).alias("sim"))


def components(vertices: DataFrame, edges: DataFrame) -> Stored:
    """(ord, cluster_id), written: the smallest ord reachable over edges (i, j)."""
    both = Stored(edges.select("i", "j").union(edges.select("j", "i")).distinct(), "edges")
    labels = Stored(both.df.groupBy(F.col("i").alias("v")).agg(F.least("i", F.min("j")).alias("c")), "labels")
    changed = labels.df.limit(1).count()
    while changed:
        at = labels.df.select("v", "c")
        near = both.df.join(at.select(F.col("v").alias("j"), "c"), "j").groupBy(F.col("i").alias("v")).agg(F.min("c").alias("near"))
        step = at.join(near, "v").select("v", F.col("c").alias("was"), F.least("c", "near").alias("via"))
        new = Stored(step.join(at.select(F.col("v").alias("via"), F.col("c").alias("far")), "via").select("v", F.least("via", "far").alias("c"), "was"), "labels")
        labels.drop()
        labels = new
        changed = new.df.where("c <> was").limit(1).count()
    found = labels.df.select(F.col("v").alias("ord"), "c")
    done = Stored(vertices.select("ord").join(found, "ord", "left").select("ord", F.coalesce("c", "ord").alias("cluster_id")), "components")
    both.drop()
    labels.drop()
    return done


def prune(members: DataFrame, vecs: DataFrame, floor: float = FLOOR) -> DataFrame:
    """(ord, cluster_id, pruned): while more than two members hold together less than the floor on average, the loosest goes.

    Dropped members are in no cluster. Grouped Python: each removal depends on the one before. The sum of all members' vectors
    tells each one's similarity to all others, so a component takes memory in proportion to its terms and needs no pairs; a removal
    touches only members that share a term with the one that goes.
    """
    sized = members.join(members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")), "cluster_id")
    large = sized.where("n > 2")
    terms = large.join(vecs, "ord").groupBy("cluster_id", "ord").agg(F.collect_list(F.struct(F.xxhash64("term").alias("t"), "w")).alias("x"))
    terms = large.select("cluster_id", "ord").join(terms, ["cluster_id", "ord"], "left").select("cluster_id", "ord", F.coalesce("x.t", F.array().cast("array<bigint>")).alias("terms"), F.coalesce("x.w", F.array().cast("array<double>")).alias("weights"))

    def keep(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        pdf = pdf.sort_values("ord")
        n_terms = pdf["terms"].map(len).to_numpy()
        rows, first = np.repeat(np.arange(len(pdf)), n_terms), np.concatenate(([0], np.cumsum(n_terms)))
        names, at = np.unique(np.concatenate(pdf["terms"].to_list()).astype(np.int64), return_inverse=True)
        w = np.concatenate(pdf["weights"].to_list()).astype(float)
        # who has a term: entries by term
        by = np.argsort(at, kind="stable")
        who, much, begin = rows[by], w[by], np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(names)))))
        whole = np.bincount(at, w, len(names))
        # a member's similarity to all others that are left
        near = np.bincount(rows, w * whole[at], len(pdf)) - np.bincount(rows, w * w, len(pdf))
        alive, n = np.ones(len(pdf), bool), len(pdf)
        while n > 2 and near[alive].sum() / (n * (n - 1)) < floor:
            # copies are equally loose whatever the order of their sums: the first goes
            worst = int(np.where(alive, np.round(near, 9), np.inf).argmin())
            alive[worst] = False
            n -= 1
            own = range(first[worst], first[worst + 1])
            if own:
                met = np.concatenate([np.arange(begin[at[e]], begin[at[e] + 1]) for e in own])
                shares = np.repeat(w[own.start : own.stop], [begin[at[e] + 1] - begin[at[e]] for e in own])
                near -= np.bincount(who[met], much[met] * shares, len(pdf))
        return pd.DataFrame({"ord": pdf["ord"].to_numpy()[alive], "cluster_id": pdf["cluster_id"].iloc[0], "pruned": len(pdf) - int(alive.sum())})

    kept = terms.groupBy("cluster_id").applyInPandas(keep, "ord bigint, cluster_id bigint, pruned int")
    return sized.where("n <= 2").select("ord", "cluster_id", F.lit(0).alias("pruned")).unionByName(kept)


def ordered_distinct(order: Column, x: Column) -> Column:
    """The distinct values that are not null, in the order of their first rows."""
    rows = F.array_sort(F.collect_list(F.when(x.isNotNull(), F.struct(order.alias("o"), x.alias("x")))))
    return F.array_distinct(F.transform(rows, lambda r: r["x"]))


def summarise(items: DataFrame, members: DataFrame, edges: DataFrame) -> DataFrame:
    """One row a cluster: items in order, outlets, countries, leans, first and last time, similarity of the surviving edges."""
    own = items.join(members, "ord")
    out = own.groupBy("cluster_id").agg(
        F.collect_list(F.struct("ord", "outlet_id", "outlet", "lean", "country", "title", "excerpt", "url", "published_at")).alias("items"),
        F.count_distinct(F.coalesce("outlet_id", "outlet")).cast("int").alias("outlet_count"),
        ordered_distinct(F.col("ord"), F.col("country")).alias("countries"),
        ordered_distinct(F.col("ord"), F.col("lean")).alias("leans"),
        F.min("published_at").alias("first_seen"), F.max("published_at").alias("last_seen"), F.min("ord").alias("min_ord"), F.max("pruned").alias("pruned"),
    ).withColumn("items", F.array_sort("items"))
    a, b = members.select(F.col("ord").alias("i"), F.col("cluster_id")), members.select(F.col("ord").alias("j"), F.col("cluster_id").alias("cj"))
    inside = edges.join(a, "i").join(b, "j").where("cluster_id = cj").groupBy("cluster_id").agg(F.min("sim").alias("min"), F.max("sim").alias("max"), F.count(F.lit(1)).cast("int").alias("pairs"))
    sims = F.struct(F.col("min"), F.col("max"), F.coalesce("pairs", F.lit(0)).alias("pairs"), F.col("pruned").cast("int").alias("pruned_for_cohesion"))
    return out.join(inside, "cluster_id", "left").withColumn("similarity", sims).drop("min", "max", "pairs", "pruned")


def cluster_items(items: DataFrame, threshold: float = THRESHOLD, floor: float = FLOOR, hours: int = WINDOW_HOURS, max_block: int = MAX_BLOCK) -> DataFrame:
    """All of it. Sort the result by outlet_count desc, size(items) desc, min_ord for the listed order."""
    included = Stored(exclude(items)[0], "included").df
    vecs = Stored(vectors(included), "vectors")
    edges = Stored(similar_pairs(included, vecs.df, threshold, hours, max_block), "pairs").df
    found = components(included, edges)
    members = Stored(prune(found.df, vecs.df, floor), "members").df
    for s in (vecs, found):
        s.drop()
    return summarise(included, members, edges)


ITEM = T.StructType([
    T.StructField("outlet_id", T.StringType()), T.StructField("outlet", T.StringType()), T.StructField("lean", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("url", T.StringType()), T.StructField("published_at", T.TimestampType()), T.StructField("excerpt", T.StringType()),
    T.StructField("retrieved_at", T.TimestampType()), T.StructField("via", T.StringType()), T.StructField("read", T.StringType()), T.StructField("ord", T.LongType()),
])


def dedupe(items: DataFrame) -> DataFrame:
    """One item per canonical url: the first, but a feed's item replaces a search hit; the group's first place is kept."""
    from tessera.functions.urls import canonical

    rows = items.withColumn("__key", canonical(F.col("url")))
    cols = [c for c in items.columns if c != "ord"]
    # the last feed item wins only over search hits, so the order is: feed first, then ord
    best = rows.groupBy("__key").agg(F.min_by(F.struct(*cols), F.struct((F.col("via") != "rss").alias("later"), F.col("ord").alias("o"))).alias("x"), F.min("ord").alias("ord"))
    return best.select("x.*", "ord").select(*items.columns)


def fresh(items: DataFrame, now, hours: int = 72) -> DataFrame:
    """Items without a time, or not older than the window."""
    cut = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    return items.where(F.col("published_at").isNull() | (F.col("published_at").cast("timestamp") >= cut))


def complete(items: DataFrame) -> DataFrame:
    """Items with a title and a url."""
    return items.where("length(title) > 0 AND length(url) > 0")
