"""Session settings that the engine expects; nothing here is needed on a cluster that sets them itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.jsonGenerator.ignoreNullFields": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str = "local[8]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    b = SparkSession.builder.master(master).appName("tessera")
    for k, v in (SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "8g"} | extra).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
