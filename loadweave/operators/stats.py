"""Comparison statistics of aligned series: tables with columns ref and reg, one row for each entity and stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import correlation, pct_diff, safe_div, total
from .series import by_day_of, by_month_of


def _group(df: DataFrame, keys: list[str]):
    return df.groupBy(*keys) if keys else df.groupBy()


def errors(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """MAE, NMAE (MAE over the mean of ref), RMSE of each entity, or of all rows without keys."""
    gap = F.col("ref") - F.col("reg")
    mae = F.avg(F.abs(gap))
    return _group(pairs, keys).agg(mae.alias("mae"), safe_div(mae, F.avg("ref")).alias("nmae"), F.sqrt(F.avg(gap * gap)).alias("rmse"))


def annual_pct_diff(pairs: DataFrame, keys: list[str]) -> DataFrame:
    sums = _group(pairs, keys).agg(total("ref").alias("ref"), total("reg").alias("reg"))
    return sums.withColumn("pct_diff", pct_diff(F.col("ref"), F.col("reg")))


def across(df: DataFrame, value: str, key: str, keys: list[str] | None = None) -> DataFrame:
    """Mean, median, extremes of a value over entities, and which entities have them (smaller key if tied)."""
    known = df.where(F.col(value).isNotNull())
    return _group(known, keys or []).agg(
        F.avg(value).alias("mean"), F.median(value).alias("median"), F.max(value).alias("max"), F.min(value).alias("min"),
        F.min_by(key, F.struct(-F.col(value), F.col(key))).alias("max_at"), F.min_by(key, F.struct(value, key)).alias("min_at"),
    )


def month_mape(pairs: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """Mean and median, over entities and months with a total in ref, of the relative gap between monthly totals, in percent."""
    gap = F.abs(pct_diff(F.col("ref"), F.col("reg")))
    return by_month_of(pairs, keys, ["ref", "reg"], ts).select(gap.alias("ape")).agg(F.avg("ape").alias("mape_mean"), F.median("ape").alias("mape_median"))


def hourly_correlation(pairs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return _group(pairs, keys or []).agg(correlation(F.col("ref"), F.col("reg")).alias("correlation"))


def daily_correlation(pairs: DataFrame, keys: list[str] | None = None, ts: str = "ts") -> DataFrame:
    """Correlation of daily totals; days without rows count as 0."""
    return hourly_correlation(by_day_of(pairs, keys or [], ["ref", "reg"], ts), keys)


def diurnal_correlation(pairs: DataFrame, period: Column, hour: Column) -> DataFrame:
    """For each period (month), the correlation of the two mean daily profiles."""
    profile = pairs.groupBy(period.alias("period"), hour.alias("hour")).agg(F.avg("ref").alias("ref"), F.avg("reg").alias("reg"))
    return profile.groupBy("period").agg(correlation(F.col("ref"), F.col("reg")).alias("correlation"))


def peaks(pairs: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """Each side's peak and its first stamp, the other side's value then, percent difference of peaks, load factors over ref's hours."""
    first = lambda v: F.struct(F.col(v), -F.unix_micros(F.col(ts).cast("timestamp")))
    known = lambda v, x: F.when(F.col(v).isNotNull(), x)
    out = _group(pairs, keys).agg(
        F.max("ref").alias("ref_peak"), F.max("reg").alias("reg_peak"),
        F.max_by(ts, known("ref", first("ref"))).alias("ref_peak_at"), F.max_by(ts, known("reg", first("reg"))).alias("reg_peak_at"),
        F.max_by("reg", known("ref", first("ref"))).alias("reg_at_ref_peak"), F.max_by("ref", known("reg", first("reg"))).alias("ref_at_reg_peak"),
        total("ref").alias("_ref"), total("reg").alias("_reg"), F.count(F.lit(1)).alias("_n"),
    )
    return out.select(
        *keys, "ref_peak", "reg_peak", "ref_peak_at", "reg_peak_at", "reg_at_ref_peak", "ref_at_reg_peak",
        pct_diff(F.col("ref_peak"), F.col("reg_peak")).alias("peak_pct_diff"),
        safe_div(F.col("_ref"), F.col("ref_peak") * F.col("_n")).alias("ref_load_factor"), safe_div(F.col("_reg"), F.col("reg_peak") * F.col("_n")).alias("reg_load_factor"),
    )


def model_metrics(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    """MAE, MSE and R2 of a prediction; R2 is NULL where the actual values do not vary."""
    both = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    gap = F.col(actual) - F.col(predicted)
    out = _group(both, keys).agg(F.avg(F.abs(gap)).alias("mae"), F.avg(gap * gap).alias("mse"), F.var_pop(actual).alias("_v"))
    return out.select(*keys, "mae", "mse", (F.lit(1.0) - safe_div(F.col("mse"), F.col("_v"))).alias("r2"))


def state_lists(zones: DataFrame, zone: str, state: str) -> DataFrame:
    """Each zone's states in order, and whether it has several."""
    states = F.sort_array(F.collect_set(state))
    return zones.where(F.col(zone).isNotNull()).groupBy(zone).agg(F.array_join(states, ",").alias("states"), (F.size(states) > 1).alias("several"))
