"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of copies that brings it to its target: weight * rows wanted / rows of the source. A
document's number of copies is a Poisson variable with that mean: the inverse of the distribution function at a uniform number
that a hash of seed and id gives. So a document's copies depend on its id and its source's rate only, in any order and on any
cluster. Copies are put in a global random order by range-partitioning on a hash of seed, id and copy.

Up to TABLE_RATE a source's distribution function is a table, summed from 0. Beyond it every document sums the terms within 12
standard deviations of the rate itself (what lies outside is far below the resolution of the uniform numbers), each term in
closed form: about 24 * sqrt(rate) terms for a document that gets some rate copies. It is the same inverse, for any rate.

Scale: one pass counts rows per source (combined map-side); the rates are one row a source and are broadcast only
after their size has been summed; the copies are shuffled once, by ranges of a hash, so a hot source is spread evenly. Copies
of documents beyond TABLE_RATE (rows wanted / TABLE_RATE documents at most) are made in blocks that are dealt out to all tasks.

Defined cases: a null source is a source of its own; a null id hashes as the text 'null'; repeated rows are replicated alike;
a source without a weight gets none of the mix; an empty table gives an empty mix; other columns come along, and those that are
named copy or shuffle_key, in any case, get underscores behind their names until these are free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Saved

#: The largest rate whose distribution function is a table.
TABLE_RATE = 10_000.0
#: Copies that one task makes of a document at a time, beyond TABLE_RATE.
BLOCK = 10_000
#: Numbers in all the rates' distribution functions that may be broadcast: 8 MB.
MAX_NUMBERS = 1_000_000
_NONE = "\x00null"


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of an MD5 hash of seed and parts."""
    return F.conv(F.substring(_hash(seed, *parts), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def _hash(seed: int, *parts: Column) -> Column:
    return F.md5(F.encode(F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)), "UTF-8"))


#: The distribution function at 0, 1, 2, ... until what is left is below the resolution of the uniform numbers.
_CDF = """
transform(
  aggregate(sequence(1, int(ceil(rate + 12 * sqrt(rate) + 30))),
    named_struct('log', array(-rate), 'last', -rate),
    (a, k) -> named_struct('log', concat(a.log, array(a.last + ln(rate / k))), 'last', a.last + ln(rate / k))).log,
  x -> exp(x))"""
#: The number of k whose distribution function is at most u, for large rates. The logarithm of a term is
#: k * (log1p(d) - d) - ln(2 pi k) / 2 - 1 / 12k + 1 / 360k^3 with d = (rate - k) / k: Stirling's series, whose next member is below 1e-22.
_FAR = """
aggregate(sequence(bigint(floor(__rate - 12 * sqrt(__rate))), bigint(ceil(__rate + 12 * sqrt(__rate) + 30))),
  named_struct('u', __u, 'rate', __rate, 'c', 0D, 'n', bigint(floor(__rate - 12 * sqrt(__rate)))),
  (a, k) -> named_struct('u', a.u, 'rate', a.rate, 'c', {c}, 'n', a.n + bigint({c} <= a.u)),
  a -> a.n)""".format(c="a.c + exp(k * (log1p((a.rate - k) / k) - (a.rate - k) / k) - ln(2 * pi() * k) / 2 - 1D / (12D * k) + 1D / (360D * k * k * k))")


def rates(docs: DataFrame, weights: dict[str, float] | None = None, rows: int | None = None, group: str = "source") -> Saved:
    """(source, rate, cdf), written: the mean copies a document of each source needs; no cdf where it is 0 or beyond TABLE_RATE. ``weights`` None: all sources alike; ``rows`` None: as many as there are."""
    sources_ = Saved(docs.groupBy(F.coalesce(F.col(group).cast("string"), F.lit(_NONE)).alias("__source")).agg(F.count(F.lit(1)).alias("n")), "sources")
    counts = sources_.df
    row = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("sources")).first()
    want, sources = float(rows if rows is not None else row.total or 0), max(1, row.sources)
    if weights is None:
        weight = F.lit(1.0 / sources)
    else:
        share = sum(weights.values())
        pairs = [x for k, v in weights.items() for x in (F.lit(k if k is not None else _NONE), F.lit(v / share))]
        weight = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("__source")), F.lit(0.0))
    rate = weight * F.lit(want) / F.col("n")
    out = counts.select("__source", rate.alias("rate"))
    terms = F.expr(_CDF)
    cdf = F.expr("aggregate(terms, named_struct('s', 0D, 'out', cast(array() AS array<double>)), (a, x) -> named_struct('s', a.s + x, 'out', concat(a.out, array(a.s + x)))).out")
    tabled = (F.col("rate") > 0) & (F.col("rate") <= TABLE_RATE)
    done = Saved(out.withColumn("terms", F.when(tabled, terms)).withColumn("cdf", F.when(tabled, cdf)).select("__source", "rate", "cdf"), "rates")
    sources_.drop()
    return done


def mix(docs: DataFrame, weights: dict[str, float] | None = None, rows: int | None = None, seed: int = 42, group: str = "source", ordered: bool = True) -> DataFrame:
    """Every row of ``docs`` as often as its Poisson count says, with ``copy`` (from 1) and ``shuffle_key``, in the order of the key."""
    taken = {c.lower() for c in docs.columns}
    for c in docs.columns:
        if c.lower() in ("copy", "shuffle_key"):
            name = c + "_"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            docs, group = docs.withColumnRenamed(c, name), name if group == c else group
    source = F.coalesce(F.col(group).cast("string"), F.lit(_NONE))
    rate = rates(docs, weights, rows, group).df.select("__source", F.col("rate").alias("__rate"), F.col("cdf").alias("__cdf"))
    found = rate.agg(F.sum(F.lit(4) + F.coalesce(F.size("__cdf"), F.lit(0))).alias("size"), F.max("__rate").alias("rate")).first()
    # beyond that the join shuffles, and AQE splits hot sources
    joined = docs.withColumn("__source", source).join(F.broadcast(rate) if (found.size or 0) <= MAX_NUMBERS else rate, "__source").withColumn("__u", uniform(seed, F.col("doc_id")))
    # the number goes in as an argument: one that a lambda takes from outside is lost where the optimizer prunes the id
    count = F.when(F.col("__cdf").isNull(), F.lit(0)).otherwise(F.expr("aggregate(__cdf, named_struct('u', __u, 'n', 0), (a, c) -> named_struct('u', a.u, 'n', a.n + int(c <= a.u)), a -> a.n)"))
    counted = lambda part, n: part.withColumn("__n", n).drop("__cdf", "__rate", "__u", "__source").where("__n > 0")
    copies = counted(joined.where(F.col("__rate") <= TABLE_RATE), count).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).drop("__n")
    if (found.rate or 0) > TABLE_RATE:
        far = counted(joined.where(F.col("__rate") > TABLE_RATE), F.expr(_FAR))
        blocks = far.withColumn("__block", F.explode(F.expr(f"sequence(0L, (__n - 1) div {BLOCK})")))
        # with a number of its own: AQE would put small blocks back together
        blocks = blocks.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "__block")
        made = blocks.withColumn("copy", F.explode(F.expr(f"transform(sequence(__block * {BLOCK} + 1, least(__n, (__block + 1) * {BLOCK})), k -> int(k))")))
        copies = copies.unionByName(made.drop("__n", "__block"))
    keyed = copies.withColumn("shuffle_key", F.substring(_hash(seed + 1, F.col("doc_id"), F.col("copy")), 1, 16))
    return keyed.orderBy("shuffle_key", "doc_id", "copy") if ordered else keyed
