"""Tables written to the folder that all executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where that is unset and all runs on one machine (tests), a folder of our own."""
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir") or _own.get("dir")
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = _own["dir"] = "file://" + tempfile.mkdtemp(prefix="tessera-")
    return d.rstrip("/")


class Stored:
    def __init__(self, df: DataFrame, tag: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/{tag}-{uuid.uuid4().hex}"
        schema = df.schema
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        """Only once no plan that is yet to run reads it."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the finished folders under ``path`` (those that a writer has marked), sorted."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    done = lambda n: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))
    return sorted(n for n in names if n.startswith(prefix) and done(n))


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
