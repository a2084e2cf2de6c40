"""Joins and aggregates over time: the state valid at a moment, bursts, pairs within an interval, running frames.

All of them deal the rows of a key out by cells of time, so that a key with very many rows is no single task. Times are compared in
microseconds. Batch and streaming frames go through the same functions where Spark's own streaming operators say the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts that the rows of one key and cell are dealt into; the states of that cell go to each of them.
SALTS = 4


def micros(span: str) -> int:
    """'72 hours', '1 day' or '30 minutes' in microseconds."""
    n, unit = span.split()
    of = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}
    return int(n) * of[unit.rstrip("s")]


def _at(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def _floor(at: Column, width: int) -> Column:
    return F.round((at - F.pmod(at, F.lit(width))) / width).cast("bigint")


def as_of_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, cell: str = "1 day", tolerance: str | None = None, exact: bool = True, forward: bool = False, salts: int = SALTS) -> DataFrame:
    """Every row of ``left`` with the columns of the last row of ``right`` of its key that is not later (``forward``: the first not earlier).

    exact=False leaves out rows of the very same time; tolerance leaves out those further away. Of rows of ``right`` with one key and
    time, the one with the greatest values counts, column by column. Keys of ``left`` that are null, null times and rows without a match
    stay, with nulls; no row of ``right`` with a null key or time matches. Columns of ``right`` must not be named like those of ``left``.

    Both sides are merged, not joined: per key and cell of time, states are carried forward over the rows in order, and each cell starts
    with the last state of the cells before. What comes before is one row a key and cell, so the scan over a key's cells is short
    however many rows it has. One shuffle of ``left``; ``right`` is shuffled by key and time first, and in a cell copied ``salts`` times.
    """
    own = [c for c in right.columns if c not in on]
    if clash := set(own) & set(left.columns):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    width, sign = micros(cell), -1 if forward else 1
    keyed = lambda df, time: F.forall(F.array(*(F.col(c).isNotNull() for c in on)), lambda x: x) & F.col(time).isNotNull()
    state = F.struct(*own)
    # equal rows of key and time: the greatest; map-side combined
    states = right.where(keyed(right, right_time)).withColumn("__at", sign * _at(right_time)).groupBy(*on, "__at").agg(F.max_by(state, _order(right, own)).alias("__s"))
    states = states.withColumn("__cell", _floor(F.col("__at"), width))
    rows = left.withColumn("__at", F.when(keyed(left, left_time), sign * _at(left_time))).withColumn("__cell", _floor(F.col("__at"), width))
    # the last state before each cell that has rows of the left: one row a key and cell
    ends = states.groupBy(*on, "__cell").agg(F.max_by("__s", "__at").alias("__end"))
    used = rows.where("__cell IS NOT NULL").select(*on, "__cell").distinct().withColumn("__used", F.lit(True))
    both = ends.withColumn("__used", F.lit(False)).unionByName(used.withColumn("__end", F.lit(None).cast(ends.schema["__end"].dataType)))
    cells = both.groupBy(*on, "__cell").agg(F.any_value("__end", True).alias("__end"), F.max("__used").alias("__used"))
    before = F.last("__end", ignorenulls=True).over(Window.partitionBy(*on).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))
    carried = cells.withColumn("__s", before).where("__used AND __s IS NOT NULL").select(*on, "__cell", (F.col("__cell") * width).alias("__at"), F.lit(0).alias("__turn"), "__s")
    given = states.select(*on, "__cell", "__at", F.lit(1 if exact else 3).alias("__turn"), "__s")
    spread = carried.unionByName(given).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # rows that can match nothing are dealt out by all their values
    salt = F.pmod(F.xxhash64(_order(left, left.columns)), F.when(F.col("__cell").isNull(), F.lit(4096)).otherwise(F.lit(salts))).cast("int")
    kept = [c for c in left.columns if c not in on]
    asked = rows.select(*on, "__cell", "__at", F.lit(2).alias("__turn"), F.lit(None).cast(states.schema["__s"].dataType).alias("__s"), salt.alias("__salt"), F.struct(*kept, F.lit(1).alias("__row")).alias("__left"))
    merged = asked.unionByName(spread.withColumn("__left", F.lit(None).cast(asked.schema["__left"].dataType)))
    last = F.last("__s", ignorenulls=True).over(Window.partitionBy(*on, "__cell", "__salt").orderBy("__at", "__turn").rowsBetween(Window.unboundedPreceding, 0))
    found = merged.withColumn("__s", last).where("__left IS NOT NULL")
    hit = F.col("__cell").isNotNull()
    if tolerance is not None:
        hit &= F.col("__at") - sign * F.unix_micros(F.col(f"__s.{right_time}").cast("timestamp")) <= micros(tolerance)
    return found.select(*(F.col(c) if c in on else F.col(f"__left.{c}").alias(c) for c in left.columns), *(F.when(hit, F.col(f"__s.{c}")).alias(c) for c in own))


def _order(df: DataFrame, cols: list[str]) -> Column:
    """The columns as something that has an order; maps and variants have none and are compared as JSON."""
    return F.struct(*(F.to_json(F.struct(c)) if isinstance(df.schema[c].dataType, T.MapType | T.VariantType) else F.col(c) for c in cols))


def sessions(rows: DataFrame, on: list[str], time: str, gap: str, aggs: dict[str, tuple[str, str]], late: str | None = None) -> DataFrame:
    """(on..., start, end, n, aggs...): bursts of rows of a key at most ``gap`` apart, as Spark's session windows are; ``end`` is ``gap`` after the last row.

    aggs: name -> ('sum' | 'min' | 'max' | 'count', column). Rows with a null time are in no session; a null key is a key.
    Streams need ``late``, the watermark: rows that come within it join sessions or tie two together, later ones are dropped, and a
    session is given out once when the watermark has passed its end.

    Rows of one key and one cell of ``gap`` are always of one session, so they are summed up in the map tasks; what is then put in
    order is one row a key and cell that has rows.
    """
    if rows.isStreaming:
        if late is None:
            raise ValueError("a stream of sessions needs a watermark")
        w = F.session_window(time, gap)
        one = [getattr(F, f)(c).alias(name) for name, (f, c) in aggs.items()]
        return rows.withWatermark(time, late).groupBy(*on, w).agg(F.count(F.lit(1)).alias("n"), *one).select(*on, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n", *aggs)
    width = micros(gap)
    at = _at(time)
    first = [getattr(F, f)(c).alias(name) for name, (f, c) in aggs.items()]
    again = [getattr(F, "sum" if f in ("sum", "count") else f)(name).alias(name) for name, (f, _) in aggs.items()]
    cells = rows.where(F.col(time).isNotNull()).groupBy(*on, _floor(at, width).alias("__cell")).agg(F.min(at).alias("__lo"), F.max(at).alias("__hi"), F.count(F.lit(1)).alias("n"), *first)
    w = Window.partitionBy(*on).orderBy("__cell")
    starts = cells.withColumn("__new", F.coalesce(F.col("__lo") - F.lag("__hi").over(w) > width, F.lit(True)).cast("int"))
    numbered = starts.withColumn("__session", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*on, "__session").agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"), F.sum("n").alias("n"), *again)
    kind = rows.schema[time].dataType
    return merged.select(*on, F.timestamp_micros("__lo").cast(kind).alias("start"), F.timestamp_micros(F.col("__hi") + width).cast(kind).alias("end"), "n", *aggs)


def interval_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, before: str, after: str, late: tuple[str, str] | None = None) -> DataFrame:
    """Pairs of rows of one key where the right one lies from ``before`` ahead of the left one to ``after`` behind it, both included.

    Null keys and times match nothing. Streams need ``late``, the watermarks of both sides: Spark then keeps a row only as long as a
    partner within the interval can still come. Columns of ``right`` other than ``on`` must not be named like those of ``left``.

    In batch the rows meet by an equality of key and cell of time, cells being as wide as the interval: a right row stands in its own
    cell, a left row looks into the two that its interval can touch. Cells split the rows of a key; skewed ones are split by Spark.
    """
    own = [c for c in right.columns if c not in on]
    if clash := set(own) & set(left.columns):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    ahead, behind = micros(before), micros(after)
    renamed = right.select(*(F.col(c).alias(f"__r_{c}") for c in on), *own)
    same = [F.col(c) == F.col(f"__r_{c}") for c in on]
    if left.isStreaming or right.isStreaming:
        if late is None:
            raise ValueError("a join of streams needs two watermarks")
        inside = F.expr(f"{right_time} >= {left_time} - INTERVAL {ahead} MICROSECONDS AND {right_time} <= {left_time} + INTERVAL {behind} MICROSECONDS")
        cond = inside
        for s in same:
            cond &= s
        return left.withWatermark(left_time, late[0]).join(renamed.withWatermark(right_time, late[1]), cond).select(*left.columns, *own)
    width = max(1, ahead + behind)
    at, rat = _at(left_time), F.unix_micros(F.col(right_time).cast("timestamp"))
    looks = left.withColumn("__at", at).withColumn("__cell", F.explode(F.array_distinct(F.array(_floor(F.col("__at") - ahead, width), _floor(F.col("__at") + behind, width)))))
    stands = renamed.withColumn("__rat", rat).withColumn("__rcell", _floor(F.col("__rat"), width))
    cond = F.col("__cell") == F.col("__rcell")
    for s in same:
        cond &= s
    return looks.join(stands, cond).where((F.col("__rat") >= F.col("__at") - ahead) & (F.col("__rat") <= F.col("__at") + behind)).select(*left.columns, *own)


def running(rows: DataFrame, on: list[str], time: str, frame: str, aggs: dict[str, Column], cell: str | None = None) -> DataFrame:
    """Every row with ``aggs`` over the rows of its key from ``frame`` before its time up to its time, rows of the same time included.

    Rows with a null time have frames of the rows with a null time, as in SQL. Aggregates are any that Spark has for windows.

    A key's rows are dealt into cells of time at least as wide as the frame. A row is computed in its own cell and helps in the next one if
    it lies within a frame of it, so with wide cells few rows are moved twice, and a task holds one cell and the frame before it.
    """
    span = micros(frame)
    width = max(span, micros(cell) if cell else 2 * span, 1)
    at = F.col("__at")
    dealt = rows.withColumn("__at", _at(time)).withColumn("__own", _floor(at, width))
    # in the next cell only where its start is within the frame
    helps = F.when((F.col("__own") + 1) * width - at <= span, F.array(F.col("__own"), F.col("__own") + 1)).otherwise(F.array("__own"))
    spread = dealt.withColumn("__cell", F.explode(helps))
    w = Window.partitionBy(*on, "__cell").orderBy("__at").rangeBetween(-span, 0)
    return spread.select("*", *(a.over(w).alias(name) for name, a in aggs.items())).where(F.col("__cell").eqNullSafe(F.col("__own"))).select(*rows.columns, *aggs)
