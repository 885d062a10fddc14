"""Session settings shared by the tests, the bench and interactive use."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution splits skewed joins and merges small shuffle partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "12g", **extra: str) -> SparkSession:
    """A local session; on a cluster the submitter's own configuration is used instead."""
    conf = DEFAULTS | {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(partitions)} | extra
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("loadweave").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
