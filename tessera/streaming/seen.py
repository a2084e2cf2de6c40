"""An extra: a stream of items without urls that were seen within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.urls import canonical


def unseen(items: DataFrame, within: str = "72 hours") -> DataFrame:
    """Streaming items (url, published_at, ...) whose canonical url has not come within the watermark; state is dropped after it."""
    return items.withColumn("__key", canonical(F.col("url"))).withWatermark("published_at", within).dropDuplicatesWithinWatermark(["__key"]).drop("__key")
