"""The driver's tables in the roles of the pipeline: line items as weighted building rows and as loads, events as an hourly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import hour_end


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ts (day), nation, ref, reg: gross and net value shipped, in millions."""
    items = read(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").alias("ts"), "l_extendedprice", "l_discount", "l_tax")
    suppliers = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    # Sums by supplier first: suppliers are few beside items, so the join meets partial totals.
    by_supplier = items.groupBy("l_suppkey", "ts").agg(F.sum("l_extendedprice").alias("a"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("b"))
    return by_supplier.join(suppliers, "l_suppkey").groupBy("ts", "nation").agg((F.sum("a") / 1e6).alias("ref"), (F.sum("b") / 1e6).alias("reg"))


PAIRS = """pairs AS (SELECT l_shipdate AS ts, s_nationkey AS nation, sum(l_extendedprice) / 1e6 AS ref, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) / 1e6 AS reg
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kind (event type), ts (hour's end), v (total value), n."""
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), hour_end(F.col("ts")).alias("ts"), "value")
    return e.groupBy("kind", "ts").agg(F.sum("value").alias("v"), F.count(F.lit(1)).alias("n"))


HOURLY = """hourly AS (SELECT event_type AS kind, date_trunc('hour', ts + INTERVAL 59 MINUTE) AS ts, sum(value) AS v, count(*) AS n FROM events GROUP BY ALL)"""
