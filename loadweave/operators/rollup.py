"""Weighted rollups of building metadata and of load series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import hour_end
from ..functions.numeric import kwh_to_mwh, row_sum, total
from .ranking import with_rank


def keep_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all known: groups with a missing key are left out."""
    return df.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))


def group_totals(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Sums of measures by keys, in one shuffle of partial sums."""
    return keep_keys(df, keys).groupBy(*keys).agg(*[total(m).alias(m) for m in measures])


def metadata_rollup(buildings: DataFrame, keys: list[str], electric: list[str], gas: list[str], area: str | None = None, weight: str = "weight", applied_only: bool = False, applicable: str = "applicability") -> DataFrame:
    """Weighted annual totals of each group in MWh: electric uses together as hvac_mwh, gas uses as gas_mwh, and floor area."""
    if applied_only:
        buildings = buildings.where(F.col(applicable))
    w = F.coalesce(F.col(weight), F.lit(0.0))
    measures = {"hvac_mwh": row_sum(*electric) * w, "gas_mwh": row_sum(*gas) * w} | ({"area": F.coalesce(F.col(area), F.lit(0.0)) * w} if area else {})
    out = group_totals(buildings.select(*keys, *[c.alias(n) for n, c in measures.items()]), keys, list(measures))
    return out.withColumns({n: kwh_to_mwh(F.col(n)) for n in ("hvac_mwh", "gas_mwh")})


def hourly_rollup(loads: DataFrame, keys: list[str], measures: list[str], ts: str = "ts", weight: str | None = None, already_hourly: bool = False) -> DataFrame:
    """Totals of each group and hour, stamped at the hour's end. Weights multiply before sums; only sums are shuffled."""
    stamp = F.col(ts) if already_hourly else hour_end(F.col(ts))
    w = F.col(weight) if weight else F.lit(1.0)
    rows = loads.select(*keys, stamp.alias("ts"), *[(F.col(m) * w).alias(m) for m in measures])
    return group_totals(rows, [*keys, "ts"], measures)


def with_baseline(series: DataFrame, keys: list[str], ts: str, upgrade: str, measures: list[str], baseline: int = 0) -> DataFrame:
    """For each upgrade's row the baseline's value, its own, and what it saves. Baseline and upgrades are joined on keys and time."""
    base = series.where(F.col(upgrade) == baseline).select(*keys, ts, *[F.col(m).alias(f"{m}_baseline") for m in measures])
    other = series.where(F.col(upgrade) != baseline).select(*keys, ts, upgrade, *[F.col(m).alias(f"{m}_upgrade") for m in measures])
    return base.join(other, [*keys, ts]).withColumns({f"{m}_savings": F.col(f"{m}_baseline") - F.col(f"{m}_upgrade") for m in measures})


def savings_rollup(series: DataFrame, keys: list[str], ts: str, upgrade: str, measures: list[str], baseline: int = 0) -> DataFrame:
    """with_baseline, summed by keys, upgrade and time first, so that the join meets one row on each side."""
    return with_baseline(group_totals(series, [*keys, ts, upgrade], measures), keys, ts, upgrade, measures, baseline)


def _one_value(lookup: DataFrame, on: str, value: str) -> DataFrame:
    """(on, value), one row a key. A key with two values is an error when the plan runs, rather than either of them by chance."""
    clash = F.count_distinct(F.struct(value)) > 1
    error = F.raise_error(F.concat(F.lit(f"{on} has more than one {value}: "), F.coalesce(F.col(on).cast("string"), F.lit("null"))))
    return lookup.groupBy(on).agg(F.when(clash, error.cast(lookup.schema[value].dataType)).otherwise(F.min(value)).alias(value))


def rolled_up(series: DataFrame, to: DataFrame, on: str, parent: str, ts: str, value: str, unmapped: str | None = None) -> DataFrame:
    return rolled_up_all(series, to, on, parent, ts, [value], unmapped)


def rolled_up_all(series: DataFrame, to: DataFrame, on: str, parent: str, ts: str, values: list[str], unmapped: str | None = None) -> DataFrame:
    """Totals of all values by parent and time, in one join and one aggregation. to: (on, parent), of any size, an error if an
    entity has two parents; entities without a parent are dropped, or gathered under `unmapped`."""
    joined = series.join(_one_value(to, on, parent), on, "left" if unmapped is not None else "inner")
    if unmapped is not None:
        joined = joined.withColumn(parent, F.coalesce(F.col(parent), F.lit(unmapped)))
    return joined.groupBy(parent, ts).agg(*[total(v).alias(v) for v in values])


def chunked(groups: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Distinct keys with the number of their chunk of `size` in key order. Ranks are dealt by range, without one task for all rows."""
    ranked = with_rank(groups.select(*keys).distinct(), keys, "_rank")
    return ranked.select(*keys, F.floor((F.col("_rank") - 1) / size).cast("int").alias("chunk"))


def labelled(df: DataFrame, lookup: DataFrame, on: str, label: str, fallback: Column) -> DataFrame:
    """df with a label from lookup, or the fallback where there is none."""
    return df.join(_one_value(lookup, on, label), on, "left").withColumn(label, F.coalesce(F.col(label), fallback))
