"""What the operators of this subpackage share: inputs, written tables, splits and size-checked joins."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.storage import Stored as Saved  # noqa: F401
from tessera.storage import shared_dir  # noqa: F401

#: Ids that a join may broadcast: 8 bytes each and their hash slots, so 32 MB at most.
BROADCAST_IDS = 1_000_000
#: Bytes in an Arrow batch.
BATCH_BYTES = 8_000_000

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def by_ids(df: DataFrame, ids: DataFrame, key: str, how: str, limit: int = BROADCAST_IDS) -> DataFrame:
    """Join ``df`` with ``ids`` (already written, so that counting is cheap): broadcast up to ``limit`` rows, else a shuffle join."""
    n = ids.limit(limit + 1).count()
    return df.join(F.broadcast(ids) if n <= limit else ids, key, how)


def modest(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES at most, unless the session asks for less: long texts must not fill an executor."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", str(spark.conf.get(key, "64m")).lower())
    if not now or not 0 < int(now[1]) * 1024 ** " kmgt".index(now[2] or " ") <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def batches_of(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Slices of ``rows`` rows; memory that Arrow has freed goes back after each batch, so that workers stay small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
        del b
        pa.default_memory_pool().release_unused()


def split_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; null ids are in part -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(-1))


def labelled(labels: DataFrame, label: str, parts: int, held: int, per_class: int) -> DataFrame:
    """At most ``per_class`` rows (doc_id, y) of either class outside the held-out part, the first by a hash of the id.

    Repeated labels of an id: the smallest; null ids and labels other than 0 and 1 teach nothing.
    """
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)
    )
    rows = rows.where(split_of(F.col("doc_id"), parts) != held).groupBy("doc_id").agg(F.min("y").alias("y"))
    part = [rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return part[0].unionByName(part[1])


def sampled(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, per_class: int) -> DataFrame:
    """(doc_id, y, text): the rows of ``docs`` that teach, at most ``per_class`` of either class, the first by a hash of id and text.

    Rows of one labelled id all teach, as far as the bound goes. The ids that are broadcast are 2 * per_class at most.
    """
    ids = labelled(labels, label, parts, held, per_class)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    nth = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text"))
    return rows.withColumn("nth", nth).where(F.col("nth") <= per_class).select("doc_id", "y", "text")
