"""The whole pipeline: rollups of metadata and loads, weather features, regression to the target year, reconciliation, county totals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.numeric import mwh_to_gwh, row_sum
from ..operators import reconcile, regress, relational, rollup, savings, series, weather
from ..sources import scratch, writers
from ..sources.readers import RunConfig

TARGETS = ["hvac_mwh", "gas_mwh"]


@dataclass(frozen=True)
class Result:
    """Tables of a run. `upgrade` is one of the keys if the inputs have it; savings is None without upgrades to compare."""

    meta: DataFrame
    series: DataFrame
    savings: DataFrame | None
    profiles: DataFrame
    fits: DataFrame
    reconciled: DataFrame
    counties: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: df for name, df in vars(self).items() if df is not None}


def _hourly(config: RunConfig, buildings: DataFrame, loads: DataFrame, keys: list[str], electric: list[str], gas: list[str], weight: str) -> tuple[DataFrame, DataFrame | None]:
    """Hourly totals by keys, and savings of upgrades; both from one scan of loads, and both of one table of sums, written once."""
    measures = {"hvac_mwh": row_sum(*electric) / 1000, "gas_mwh": row_sum(*gas) / 1000}
    building = config.building_column
    rounded = [F.bround(t, 6).alias(t) for t in TARGETS]
    # Savings need the baseline's loads: asked for, or there anyway.
    others = [u for u in config.upgrades if u != config.baseline] if config.savings or config.baseline in config.upgrades else []
    if building in buildings.columns and building in loads.columns and "upgrade" in keys:
        groups = [k for k in keys if k != "upgrade"]
        applicable = "applicability" if "applicability" in buildings.columns else None
        wide = savings.wide_totals(loads, buildings, building, "upgrade", groups, measures, list(config.upgrades), config.baseline, weight=weight if weight in buildings.columns else None, applicable=applicable, applied_only=config.applied_only or config.savings)
        wide = scratch.written(wide)
        hourly = savings.totals(wide, groups, TARGETS, list(config.upgrades))
        saved = savings.savings(wide, groups, TARGETS, list(config.upgrades), config.baseline) if others else None
        return hourly.select(*keys, "ts", *rounded), saved
    rows = loads.select(*keys, "ts", *([weight] if weight in loads.columns else []), *[c.alias(m) for m, c in measures.items()])
    hourly = rollup.hourly_rollup(rows, keys, TARGETS, weight=weight if weight in loads.columns else None)
    hourly = scratch.written(hourly)
    saved = None
    if "upgrade" in keys and others:
        groups = [k for k in keys if k != "upgrade"]
        saved = rollup.with_baseline(hourly, groups, "ts", "upgrade", TARGETS, config.baseline)
    return hourly.select(*keys, "ts", *rounded), saved


def run(config: RunConfig, buildings: DataFrame, loads: DataFrame, hourly_weather: DataFrame, keys: list[str], electric: list[str], gas: list[str], weight: str = "weight", settings: regress.Settings | None = None) -> Result:
    """buildings: keys, a weight, a column for each end use (kWh). loads: ts, a column for each end use, and either the building
    and upgrade (then groups and weights come from buildings), or keys and a weight. hourly_weather: county, year, ts, measures.

    If both have a column upgrade, those of the configuration are taken, and upgrade is one of the keys. keys have the county
    column; weather is looked up by the county that the configuration names.

    Hourly sums are written once, and fits are kept, so nothing is summed or fitted twice; the rest are lazy plans. A group
    without a profile (no base weather, or too few hours) has missing values in reconciled, and counties counts such groups."""
    county = config.weather_county()
    if "upgrade" in buildings.columns and "upgrade" in loads.columns:
        # The upgrades of this run, side by side: each is a group of its own.
        wanted = list(dict.fromkeys([*config.upgrades, *([config.baseline] if config.savings else [])]))
        buildings, loads = (df.where(F.col("upgrade").isin(*wanted)) for df in (buildings, loads))
        keys = list(dict.fromkeys(["upgrade", *keys]))
    scoped = config.scope(buildings) if "state" in buildings.columns else buildings
    meta = rollup.metadata_rollup(scoped, keys, electric, gas, weight=weight, applied_only=config.applied_only)
    hourly, saved = _hourly(config, scoped, loads, keys, electric, gas, weight)
    # Sums first, then the groups in scope: the join meets a row for each group and hour, not raw loads.
    hourly = hourly.join(meta.select(*keys).distinct(), keys, "left_semi")
    measures = [c for c in weather.MEASURES if c in hourly_weather.columns]
    features = weather.weather_features(hourly_weather.withColumnRenamed("county", county), [county, "year"], measures, list(config.lags))
    of_year = lambda y: series.without_leap_day(features.where(F.col("year") == y).drop("year"), [county])
    names = weather.feature_names(measures, list(config.lags), "dry_bulb")
    settings = settings or regress.Settings(folds=config.folds)
    profiles, fits = regress.translate(hourly, of_year(config.base_year), of_year(config.target_year), keys, [county], TARGETS, names, "dry_bulb", settings)
    profiles = profiles.withColumn("value", F.bround("value", 6))
    # A sum of missing values is missing; groups whose loads are zero have zeros in their profile.
    year = series.first_rows(profiles, [*keys, "target"]).groupBy(*keys)
    regressed = year.agg(*[F.sum(F.when(F.col("target") == t, F.col("value"))).alias(t) for t in TARGETS])
    reconciled = reconcile.reconcile(meta, series.annual(hourly, keys, TARGETS), regressed, keys, TARGETS)
    of_county = [*(["upgrade"] if "upgrade" in keys else []), config.county_column]
    gwh = mwh_to_gwh(F.sum("value")).alias("gwh")
    counties = profiles.where(F.col("target") == TARGETS[0]).groupBy(*of_county, "ts").agg(gwh, F.count(F.when(F.col("value").isNull(), 1)).alias("groups_without_profile"))
    return Result(meta, hourly, saved, profiles, fits, reconciled, counties)


def save(result: Result, folder: str) -> None:
    """Every table under folder/{name}, by upgrade where it has one. A run of some upgrades replaces theirs and leaves the others."""
    for name, df in result.tables().items():
        writers.replace_partitions(df, f"{folder}/{name}", ["upgrade"] if "upgrade" in df.columns else [])


def export(result: Result, config: RunConfig, keys: list[str], folder: str) -> list[str]:
    """The CSV files that other tools take, and their names. Repeated, it replaces them.

    By upgrade: the metadata rollup, and county profiles in GWh by county number. By upgrade and chunk of counties
    (config.chunk_size): reconciled totals, and profiles in MWh with a column for each group."""
    prefix = {"commercial": "com_", "residential": "res_"}[config.stock]
    county, groups = config.county_column, [k for k in keys if k != "upgrade"]
    at = lambda df: df if "upgrade" in df.columns else df.withColumn("upgrade", F.lit(config.baseline))
    named = F.coalesce(*[F.when(F.col("upgrade") == int(u), F.lit(n)) for u, n in config.upgrade_names.items()], F.col("upgrade").cast("string"))
    file = lambda kind: F.concat(F.lit(f"{prefix}{kind}_upgrade"), F.col("upgrade").cast("string"), F.lit(".csv")).alias("_file")
    meta, reconciled, profiles = at(result.meta), at(result.reconciled), at(result.profiles).where(F.col("target") == TARGETS[0])
    done = writers.named_csv(meta.select(*meta.columns, file("meta_master")), folder, "_file", groups)
    chunks = rollup.chunked(meta, [county], config.chunk_size)
    # Gas heating stands next to the keys too, and the upgrade's name after the upgrade.
    wide = relational.inserted(reconciled.select("upgrade", *groups, *[c for c in reconciled.columns if c not in ("upgrade", *groups)]), len(groups) + 1, "gas_heating_mwh", F.col(f"{TARGETS[1]}_reg"))
    done += writers.chunk_tables(relational.inserted(wide, 1, "upgrade_name", named), chunks, [county], config.chunk_size, folder, prefix)
    loads = profiles.select("upgrade", *groups, "ts", text.key_text(*groups).alias("name"), "value")
    done += writers.chunk_loads(loads, chunks, [county], config.chunk_size, folder, prefix)
    counties = at(result.counties).select(file("agg_eulp_hvac_elec_GWh"), "ts", F.coalesce(text.county_fips(F.col(county)).cast("string"), F.col(county).cast("string")).alias("name"), "gwh")
    return done + writers.named_wide(counties, folder, "_file", "name", "gwh")
