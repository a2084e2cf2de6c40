"""A cache between runs: rows by key, each counting for so many days after it was written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.storage import delete, folders


class Cache:
    """Rows of ``schema`` by its columns ``keys``, kept under ``path`` as one folder of Parquet a batch.

    Of several rows of a key the one written last counts, if it is not older than ``days``; of one time, the one of the greatest batch. A
    batch that is written again replaces itself, so a run that broke off is simply run again, and a folder that was not finished is
    not read. Rows with a null in a key are neither kept nor found. Batches are numbers; values may be of any type.

    Reading takes one pass that keeps a row a key, combined in the map tasks; ``expire`` writes the rows that still count as one batch
    and removes the others, so that the folder does not grow with the runs.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], days: int = 30):
        self.spark, self.path, self.keys, self.days = spark, path.rstrip("/"), keys, days
        self.schema = T.StructType.fromDDL(schema)
        self.values = [f.name for f in self.schema if f.name not in keys]

    def _batches(self) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in folders(self.spark, self.path, "batch="))

    def _known(self, df: DataFrame) -> DataFrame:
        return df.dropna(subset=self.keys)

    def live(self, now, before: int | None = None) -> DataFrame:
        """The rows that count at the time ``now``, with ``written_at``; ``before``: those of earlier batches only."""
        kind = T.StructType([*self.schema.fields, T.StructField("written_at", T.TimestampType()), T.StructField("batch", T.LongType())])
        paths = [f"{self.path}/batch={n}" for n in self._batches() if before is None or n < before]
        rows = self.spark.read.schema(kind).option("basePath", self.path).parquet(*paths) if paths else self.spark.createDataFrame([], kind)
        at = F.lit(now).cast("timestamp")
        seen = rows.where(F.col("written_at") <= at).groupBy(*self.keys).agg(F.max_by(F.struct(*self.values, "written_at"), F.struct("written_at", "batch")).alias("x"))
        return seen.select(*self.keys, "x.*").where(F.col("written_at") >= at - F.make_interval(days=F.lit(self.days)))

    def set(self, rows: DataFrame, now, batch: int) -> None:
        """Writes ``rows``; of equal keys within a batch the greatest values count, where they have an order."""
        own = self._known(rows.select(*self.schema.names))
        flat = [f.name for f in self.schema if f.name in self.values and isinstance(f.dataType, T.AtomicType)]
        one = own.groupBy(*self.keys).agg(F.max_by(F.struct(*self.values), F.struct(*flat) if flat else F.lit(0)).alias("x")).select(*self.keys, "x.*")
        one.withColumn("written_at", F.lit(now).cast("timestamp")).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def get(self, wanted: DataFrame, now, before: int | None = None) -> DataFrame:
        """Every row of ``wanted`` with the values of its key and ``written_at``; nulls where the cache has none."""
        found = self.live(now, before).select(*(F.col(c).alias(f"__{c}") for c in self.keys), *self.values, "written_at")
        cond = F.lit(True)
        for c in self.keys:
            cond &= F.col(c) == F.col(f"__{c}")
        return wanted.join(found, cond, "left").select(*wanted.columns, *self.values, "written_at")

    def missing(self, wanted: DataFrame, now) -> DataFrame:
        """Keys of ``wanted`` that the cache has no row for, once each."""
        return self._known(wanted.select(*self.keys)).distinct().join(self.live(now).select(*self.keys), self.keys, "left_anti")

    def wrap(self, wanted: DataFrame, produce: Callable[[DataFrame], DataFrame], now, batch: int) -> DataFrame:
        """``get``, after ``produce`` has made rows for the missing keys and they were written."""
        self.set(produce(self.missing(wanted, now)), now, batch)
        return self.get(wanted, now)

    def expire(self, now) -> None:
        """Leaves only the rows that count at ``now``, as one batch."""
        old = self._batches()
        if old:
            new = old[-1] + 1
            self.live(now).write.mode("overwrite").parquet(f"{self.path}/batch={new}")
            for n in old:
                delete(self.spark, f"{self.path}/batch={n}")

    def drop(self) -> None:
        delete(self.spark, self.path)
