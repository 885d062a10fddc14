"""Load series of a baseline and of upgrades, side by side, from one pass over the loads.

Upgrades apply to some buildings each. An upgrade's savings are what those buildings use without it less what they use with it,
so a baseline row counts for every upgrade that applies to its building. Metadata tell which: one row for each building, with
its group, its weight and its upgrades. Loads are joined to it by building, and then every upgrade is a few columns of one
aggregation. Baseline and upgrades are not joined with each other, the loads are read once, and only sums by group and hour
are shuffled after the join (which broadcasts the metadata if Spark finds them small)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import hour_end
from .rollup import keep_keys

#: Column names of the wide table: total and baseline sums and row counts of upgrade u.
_TOTAL, _BASE, _ROWS, _BASE_ROWS = "_t{u}_{m}", "_b{u}_{m}", "_nt{u}", "_nb{u}"


def by_building(metadata: DataFrame, building: str, upgrade: str, keys: list[str], weight: str | None, applicable: str | None) -> DataFrame:
    """building, keys, _weight, _applied: a row for each building; _applied are the upgrades that it has and that apply to it.

    Without an `applicable` column every upgrade that a building has a row of applies. A building whose rows name different
    groups or weights is an error when the plan runs."""
    applies = F.col(applicable) if applicable else F.lit(True)
    w = F.coalesce(F.col(weight), F.lit(0.0)) if weight else F.lit(1.0)
    of = F.struct(*keys, w.cast("double").alias("_weight"))
    clash = F.min(of) != F.max(of)
    error = F.raise_error(F.concat(F.lit("groups or weights differ between the upgrades of building "), F.coalesce(F.col(building).cast("string"), F.lit("null"))))
    applied = F.collect_set(F.when(applies, F.col(upgrade)))
    kind = metadata.select(of.alias("x")).schema["x"].dataType
    rows = metadata.where(F.col(building).isNotNull()).groupBy(building).agg(F.when(clash, error.cast(kind)).otherwise(F.min(of)).alias("x"), applied.alias("_applied"))
    return rows.select(building, *[F.col(f"x.{k}").alias(k) for k in keys], F.col("x._weight").alias("_weight"), "_applied")


def wide_totals(loads: DataFrame, metadata: DataFrame, building: str, upgrade: str, keys: list[str], measures: dict[str, Column], upgrades: list[int], baseline: int = 0, ts: str = "ts", weight: str | None = "weight", applicable: str | None = None, already_hourly: bool = False, applied_only: bool = False) -> DataFrame:
    """keys, ts, and for each upgrade weighted totals, baseline totals of its buildings, and how many rows each sum has.

    One aggregation; a measure is an expression over columns of loads. With applied_only an upgrade's total leaves out rows of
    buildings that it does not apply to."""
    of = by_building(metadata, building, upgrade, keys, weight, applicable)
    stamp = F.col(ts) if already_hourly else hour_end(F.col(ts))
    wanted = loads.where(F.col(upgrade).isin(baseline, *upgrades))
    rows = wanted.select(F.col(building), F.col(upgrade).alias("_u"), stamp.alias("_ts"), *[c.alias(f"_m_{m}") for m, c in measures.items()])
    rows = keep_keys(rows.join(of, building), keys)
    columns = []
    for u in upgrades:
        own = F.col("_u") == u
        if applied_only and u != baseline:
            own = own & F.array_contains("_applied", u)
        base = (F.col("_u") == baseline) & F.array_contains("_applied", u)
        for m in measures:
            x = F.coalesce(F.col(f"_m_{m}"), F.lit(0.0)) * F.col("_weight")
            columns.append(F.sum(F.when(own, x)).alias(_TOTAL.format(u=u, m=m)))
            if u != baseline:
                columns.append(F.sum(F.when(base, x)).alias(_BASE.format(u=u, m=m)))
        columns.append(F.count(F.when(own, 1)).alias(_ROWS.format(u=u)))
        if u != baseline:
            columns.append(F.count(F.when(base, 1)).alias(_BASE_ROWS.format(u=u)))
    return rows.groupBy(*keys, F.col("_ts").alias(ts)).agg(*columns)


def _unfolded(wide: DataFrame, keys: list[str], ts: str, upgrade: str, rows: list[Column]) -> DataFrame:
    out = wide.select(*keys, ts, F.explode(F.array(*rows)).alias("x"))
    fields = [f.name for f in out.schema["x"].dataType.fields]
    return out.where("x._kept").select(*keys, F.col(f"x.{upgrade}").alias(upgrade), ts, *[F.col(f"x.{f}").alias(f) for f in fields if f not in (upgrade, "_kept")])


def totals(wide: DataFrame, keys: list[str], measures: list[str], upgrades: list[int], ts: str = "ts", upgrade: str = "upgrade") -> DataFrame:
    """keys, upgrade, ts, measures: the hours that each upgrade has rows of."""
    row = lambda u: F.struct(F.lit(u).alias(upgrade), *[F.col(_TOTAL.format(u=u, m=m)).alias(m) for m in measures], (F.col(_ROWS.format(u=u)) > 0).alias("_kept"))
    return _unfolded(wide, keys, ts, upgrade, [row(u) for u in upgrades])


def savings(wide: DataFrame, keys: list[str], measures: list[str], upgrades: list[int], baseline: int = 0, ts: str = "ts", upgrade: str = "upgrade") -> DataFrame:
    """keys, upgrade, ts, then {m}_baseline, {m}_upgrade, {m}_savings of each measure, rows_baseline, rows_upgrade.

    Of every upgrade but the baseline, the hours that both sides have rows of; sums are over the upgrade's buildings on both
    sides if the wide table was made with applied_only. Where the two counts of rows differ, a side lacks loads of the other."""

    def row(u: int) -> Column:
        base, own = (lambda m: F.col(_BASE.format(u=u, m=m))), (lambda m: F.col(_TOTAL.format(u=u, m=m)))
        values = [c for m in measures for c in (base(m).alias(f"{m}_baseline"), own(m).alias(f"{m}_upgrade"), (base(m) - own(m)).alias(f"{m}_savings"))]
        counts = (F.col(_BASE_ROWS.format(u=u)), F.col(_ROWS.format(u=u)))
        both = reduce(lambda a, b: a & b, (c > 0 for c in counts))
        return F.struct(F.lit(u).alias(upgrade), *values, counts[0].alias("rows_baseline"), counts[1].alias("rows_upgrade"), both.alias("_kept"))

    others = [u for u in upgrades if u != baseline]
    if not others:
        raise ValueError("no upgrade besides the baseline")
    return _unfolded(wide, keys, ts, upgrade, [row(u) for u in others])
