"""Set algebra with counts: what two runs have in common and what changed between them. Nulls equal nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(before: DataFrame, after: DataFrame) -> DataFrame:
    """Every distinct row of both with ``n_before`` and ``n_after``: one shuffle, counts are added up in the map tasks."""
    cols = before.columns
    one = lambda df, a, b: df.select(*cols, F.lit(a).cast("bigint").alias("__b"), F.lit(b).cast("bigint").alias("__a"))
    both = one(before, 1, 0).unionAll(one(after, 0, 1))
    return both.groupBy(*cols).agg(F.sum("__b").alias("n_before"), F.sum("__a").alias("n_after"))


def _times(df: DataFrame, n: Column, cols: list[str]) -> DataFrame:
    return df.where(n > 0).select(*cols, F.explode(F.sequence(F.lit(1).cast("bigint"), n)).alias("__k")).drop("__k")


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """INTERSECT ALL: each row as often as both have it."""
    return _times(counted(a, b), F.least("n_before", "n_after"), a.columns)


def missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT ALL: each row of ``a`` as often as ``b`` lacks it."""
    return _times(counted(a, b), F.col("n_before") - F.col("n_after"), a.columns)


def differences(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., status, n_before, n_after, fields): one row a key whose rows are not the same in both runs.

    status: added or removed if only one run has the key, else changed. n_before and n_after count the rows of the key that the other
    run lacks. fields: the columns with another value, in the order of ``before``, where one row stands against one; else null.
    Null keys are keys. Rows that did not change are left out before rows meet by key, so what is moved then is what changed.
    """
    others = [c for c in before.columns if c not in keys]
    c = counted(before, after)
    left = F.greatest(F.col("n_before") - F.col("n_after"), F.lit(0))
    new = F.greatest(F.col("n_after") - F.col("n_before"), F.lit(0))
    values = F.struct(*others) if others else F.struct(F.lit(0).alias("__none"))
    by_key = c.groupBy(*keys).agg(
        F.sum("n_before").alias("__nb"), F.sum("n_after").alias("__na"), F.sum(left).alias("n_before"), F.sum(new).alias("n_after"),
        # one row of either side is enough: they are compared only where there is one
        F.any_value(F.when(left > 0, values), True).alias("__was"), F.any_value(F.when(new > 0, values), True).alias("__is"),
    )
    fields = F.filter(F.array(*(F.when(~F.col(f"__was.{o}").eqNullSafe(F.col(f"__is.{o}")), F.lit(o)) for o in others)), lambda x: x.isNotNull()) if others else F.array().cast("array<string>")
    status = F.when(F.col("__nb") == 0, "added").when(F.col("__na") == 0, "removed").otherwise("changed")
    single = (F.col("n_before") == 1) & (F.col("n_after") == 1)
    return by_key.where("n_before > 0 OR n_after > 0").select(*keys, status.alias("status"), "n_before", "n_after", F.when(single, fields).alias("fields"))
