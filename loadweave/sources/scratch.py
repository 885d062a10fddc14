"""Tables that a plan writes and reads again, in a folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, deleted when the driver ends.

    A temporary one of this machine only where that is unset and the master is a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that all hosts share")
        root = tempfile.mkdtemp(prefix="loadweave-")
    new = f"{root.rstrip('/')}/scratch-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(new)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return new


def written(df: DataFrame) -> DataFrame:
    """df, computed once and written; lost executors cost no recomputation, and every reader sees the same rows."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
