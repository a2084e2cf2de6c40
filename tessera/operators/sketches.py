"""Sketch tables: distinct counts and quantiles that are kept per day and merged over any days, with stated errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^LG registers of a distinct count; its standard error is about 1.04 / sqrt(2^LG), so 1.6 %, and three of them are stated.
LG = 12
#: Size of a quantile sketch; the stated error of a rank is 1.33 % (with 99 % confidence) at 200.
K = 200


def distinct_error(lg: int = LG) -> float:
    """Relative error of a distinct count that is exceeded once in some hundred times."""
    return 3 * 1.04 / 2 ** (lg / 2)


def rank_error(k: int = K) -> float:
    """Error of a quantile's rank, as a part of all rows."""
    return 2.296 / k**0.9021


def daily(rows: DataFrame, by: list[str], time: str, distinct: Column, value: Column, lg: int = LG, k: int = K) -> DataFrame:
    """(by..., day, n, distinct_sketch, value_sketch): a few kilobytes a group and day, made in the map tasks and merged after.

    Null values are in no sketch; rows with a null time are of the day null. A day's rows are read once; later questions read the table.
    """
    day = F.to_date(F.col(time)).alias("day")
    return rows.groupBy(*by, day).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, F.lit(lg)).alias("distinct_sketch"), F.kll_sketch_agg_double(value.cast("double"), F.lit(k)).alias("value_sketch"))


def merge(days: DataFrame, by: list[str]) -> DataFrame:
    """The table's days (or groups) merged over all columns but ``by``; merged ones merge further."""
    return days.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("value_sketch").alias("value_sketch"))


def estimates(table: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """The table with ``distinct_estimate`` and ``q50``-like columns instead of its sketches; quantiles of no values are null."""
    q = [F.when(F.kll_sketch_get_n_double("value_sketch") > 0, F.kll_sketch_get_quantile_double("value_sketch", F.lit(float(x)))).alias(f"q{round(100 * x)}") for x in quantiles]
    return table.select(*(c for c in table.columns if c not in ("distinct_sketch", "value_sketch")), F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), *q)
