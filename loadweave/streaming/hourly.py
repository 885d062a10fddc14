"""Hourly totals of a stream of readings, with late rows and repeated readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_totals(readings: DataFrame, keys: list[str], value: str, ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """Totals by keys and hour, stamped at the hour's end; rows later than `late` are left out. Works on streams and on tables."""
    # A reading at the full hour belongs to the hour that it ends.
    stamp = F.col(ts).cast("timestamp")
    rows = readings.select(*keys, value, stamp.alias("_ts"), (stamp - F.expr("interval 1 microsecond")).alias("_in"))
    if readings.isStreaming:
        rows = rows.withWatermark("_in", late)
    out = rows.groupBy(*keys, F.window("_in", "1 hour").alias("_w")).agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("_w.end").cast("timestamp_ntz").alias("ts"), value, "n")


def without_repeats(readings: DataFrame, keys: list[str], ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """Each reading once; repeats within `late` are dropped, and the state stays bounded."""
    if not readings.isStreaming:
        return readings.dropDuplicates(keys)
    return readings.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
