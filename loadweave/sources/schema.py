"""One set of column names for metadata and loads of all stocks and releases.

Releases name the same things differently. A rule gives each of our names the names that it may have in the inputs, best first;
what a table has of them becomes our column. So everything after the reader is the same for all stocks and releases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import kbtu_to_kwh
from .readers import ELECTRIC_USES, RunConfig

# Our name, and names in the inputs by stock ("*": both).
NAMES = {
    "bldg_id": {"*": ["bldg_id", "building_id"]},
    "upgrade": {"*": ["upgrade"]},
    "weight": {"*": ["weight", "build_existing_model.sample_weight"]},
    "applicability": {"*": ["applicability"]},
    "state": {"*": ["in.state", "state", "build_existing_model.state"]},
    "area": {"*": ["in.sqft..ft2", "in.sqft"]},
    "county": {"commercial": ["in.nhgis_county_gisjoin", "nhgis_county_gisjoin", "county"], "residential": ["in.county", "county", "build_existing_model.county"]},
    "county_name": {"*": ["in.county_name", "county_name"]},
    "building_type": {"commercial": ["in.comstock_building_type"], "residential": ["in.geometry_building_type_recs", "build_existing_model.geometry_building_type_recs"]},
    "heating_fuel": {"*": ["in.heating_fuel", "build_existing_model.heating_fuel"]},
    "ts": {"*": ["timestamp", "time"]},
}
# In this release of this stock weather is that of the county a building was simulated in.
SIMULATED_COUNTY = ["in.as_simulated_nhgis_county_gisjoin", "as_simulated_nhgis_county_gisjoin"]
SIMULATED_IN = {("commercial", "2025.2")}
# End uses with other names outside the public releases.
OTHER_USES = {"heating_hp_bkup": "heating_heat_pump_backup", "heating_hp_bkup_fa": "heating_heat_pump_backup_fans_pumps"}
REQUIRED = ("bldg_id", "weight", "county")


@dataclass(frozen=True)
class Found:
    """A table under our names; electric and gas: its end uses, all in kWh; missing: our names that it has no column for."""

    df: DataFrame
    electric: list[str]
    gas: list[str]
    missing: list[str]


def _use_names(fuel: str, use: str, unit: str = "kwh") -> list[str]:
    plain = f"{fuel}.{use}.energy_consumption"
    return [f"out.{plain}..{unit}", f"out.{plain}", f"{plain}..{unit}", plain, f"end_use__{fuel}__{OTHER_USES.get(use, use)}__{unit}"]


def candidates(stock: str, release: str) -> dict[str, list[str]]:
    """Our names with the names to look for, best first."""
    if stock not in ELECTRIC_USES:
        raise ValueError(f"no such stock: {stock}")
    out = {ours: by.get(stock) or by["*"] for ours, by in NAMES.items()}
    own = out["county"]
    # Where buildings of a county were simulated elsewhere, their weather is that place's.
    out["weather_county"] = [*SIMULATED_COUNTY, *own] if (stock, release) in SIMULATED_IN else own
    out |= {f"electric_{use}": _use_names("electricity", use) for use in ELECTRIC_USES[stock]}
    return out | {"gas_heating": _use_names("natural_gas", "heating"), "gas_heating_kbtu": _use_names("natural_gas", "heating", "kbtu")[-1:]}


def resolve(df: DataFrame, config: RunConfig, required: tuple[str, ...] = REQUIRED) -> Found:
    """df under our names, and nothing else. Where it has several columns for one name, the first that is not missing counts, row by row.

    A required name without a column is an error that says what was looked for. Gas in kBtu becomes kWh."""
    columns, missing = {}, []
    for ours, theirs in candidates(config.stock, config.release).items():
        there = [F.col(f"`{c}`") for c in theirs if c in df.columns]
        if there:
            columns[ours] = F.coalesce(*there) if len(there) > 1 else there[0]
        else:
            missing.append(ours)
    lost = [f"{ours} (any of {candidates(config.stock, config.release)[ours]})" for ours in required if ours in missing]
    if lost:
        raise ValueError(f"no column for {', '.join(lost)}")
    kbtu = columns.pop("gas_heating_kbtu", None)
    if kbtu is not None:
        columns["gas_heating"] = F.coalesce(*[c for c in (columns.get("gas_heating"),) if c is not None], kbtu_to_kwh(kbtu.cast("double")))
    out = df.select(*[c.alias(ours) for ours, c in columns.items()])
    missing = [m for m in missing if m != "gas_heating_kbtu" and m not in columns]
    return Found(out, [c for c in columns if c.startswith("electric_")], [c for c in columns if c.startswith("gas_")], missing)
