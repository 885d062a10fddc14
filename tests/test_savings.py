"""Savings of upgrades, the flow over several upgrades, and tables that are written by upgrade."""

from __future__ import annotations

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from loadweave.operators import regress, savings
from loadweave.plans import flow
from loadweave.sources import readers

T0 = dt.datetime(2018, 1, 1, 1)
H = dt.timedelta(hours=1)
#: Building, upgrade, group, weight, applies.
META = [(1, 0, "a", 2.0, True), (1, 1, "a", 2.0, True), (2, 0, "a", 1.0, True), (2, 1, "a", 1.0, False), (3, 0, "b", None, True), (3, 2, "b", None, True), (None, 0, "b", 1.0, True), (4, 0, None, 1.0, True)]
LOADS = [(b, u, T0 + dt.timedelta(minutes=15 * q), float(10 * b + u)) for b in (1, 2, 3, 4) for u in (0, 1, 2) for q in range(-3, 5)] + [(None, 0, T0, 1.0), (9, 0, T0, 1.0)]


@pytest.fixture
def inputs(spark):
    meta = spark.createDataFrame(META, "bldg_id int, upgrade int, g string, weight double, applicability boolean")
    return spark.createDataFrame(LOADS, "bldg_id int, upgrade int, ts timestamp_ntz, e double"), meta


def brute(applied_only):
    """Per group, upgrade and hour: totals, and baseline totals of the buildings that the upgrade applies to."""
    group = {b: (g, w or 0.0) for b, _, g, w, _ in META if b and g}
    applied = {(b, u) for b, u, _, _, ok in META if ok}
    total, base = {}, {}
    for b, u, ts, e in LOADS:
        if b in group:
            g, w = group[b]
            hour = (ts + dt.timedelta(minutes=59)).replace(minute=0)
            if not applied_only or u == 0 or (b, u) in applied:
                total[g, u, hour] = total.get((g, u, hour), 0) + w * e
            if u == 0:
                for v in (1, 2):
                    if (b, v) in applied:
                        base[g, v, hour] = base.get((g, v, hour), 0) + w * e
    return total, base


def test_savings_are_of_buildings_that_an_upgrade_applies_to(inputs):
    loads, meta = inputs
    for applied_only in (False, True):
        total, base = brute(applied_only)
        wide = savings.wide_totals(loads, meta, "bldg_id", "upgrade", ["g"], {"e": F.col("e")}, [0, 1, 2], applicable="applicability", applied_only=applied_only)
        assert {(r["g"], r["upgrade"], r["ts"]): r["e"] for r in savings.totals(wide, ["g"], ["e"], [0, 1, 2]).collect()} == total
        got = {(r["g"], r["upgrade"], r["ts"]): (r["e_baseline"], r["e_upgrade"], r["e_savings"]) for r in savings.savings(wide, ["g"], ["e"], [0, 1, 2]).collect()}
        assert got == {k: (v, total[k], v - total[k]) for k, v in base.items() if k in total}
    assert got["a", 1, T0][0] == 2 * 10.0 * 4  # building 1 only, four quarters of weight 2


def test_loads_are_read_once(inputs, spark, tmp_path):
    loads, meta = inputs
    loads.write.parquet(str(tmp_path / "loads"))
    wide = savings.wide_totals(spark.read.parquet(str(tmp_path / "loads")), meta, "bldg_id", "upgrade", ["g"], {"e": F.col("e")}, [0, 1, 2], applicable="applicability")
    plan = savings.savings(wide, ["g"], ["e"], [0, 1, 2])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert "PushedFilters: [In(upgrade, [0,1,2])" in plan


def test_two_groups_of_one_building_are_an_error(inputs, spark):
    loads, meta = inputs
    other = meta.union(spark.createDataFrame([(1, 2, "b", 2.0, True)], meta.schema))
    with pytest.raises(Exception, match="upgrades of building 1"):
        savings.wide_totals(loads, other, "bldg_id", "upgrade", ["g"], {"e": F.col("e")}, [0, 1]).collect()
    with pytest.raises(ValueError):
        savings.savings(loads, ["g"], ["e"], [0])


def _weather(spark, n, counties=("c",)):
    return spark.createDataFrame([(c, y, dt.datetime(y, 1, 1, 1) + k * H, 10 + 5 * math.sin(k / 4)) for c in counties for y in (2018, 2012) for k in range(n)], "county string, year int, ts timestamp_ntz, dry_bulb double")


SMALL = regress.Settings(trees=3, depth=3, epochs=1)


def test_flow_gives_savings_and_replaces_upgrades(spark, tmp_path):
    n = 48
    b = spark.createDataFrame([(i, u, "c", "VT", 2.0, 1000.0 * (u + 1), 0.0, i == 1 or u == 0) for i in (1, 2) for u in (0, 1, 2)], "bldg_id int, upgrade int, county string, state string, weight double, e double, g double, applicability boolean")
    loads = spark.createDataFrame([(i, u, T0 + k * H, 1000.0 * (10 - u), 500.0) for i in (1, 2) for u in (0, 1, 2) for k in range(n)], "bldg_id int, upgrade int, ts timestamp_ntz, e double, g double")
    config = readers.RunConfig.of({"upgrades": [0, 1, 2], "savings": True})
    r = flow.run(config, b, loads, _weather(spark, n), ["county"], ["e"], ["g"], settings=SMALL)
    got = {(x["upgrade"], x["hvac_mwh_baseline"], x["hvac_mwh_upgrade"], x["hvac_mwh_savings"], x["gas_mwh_savings"]) for x in r.savings.collect()}
    assert got == {(1, 20.0, 18.0, 2.0, 0.0), (2, 20.0, 16.0, 4.0, 0.0)} and r.savings.count() == 2 * n
    assert {(x["upgrade"], x["hvac_mwh"]) for x in r.series.collect()} == {(0, 40.0), (1, 18.0), (2, 16.0)}
    flow.save(r, str(tmp_path / "out"))
    again = flow.run(readers.RunConfig.of({"upgrades": [2]}), b, loads.withColumn("e", F.lit(0.0)), _weather(spark, n), ["county"], ["e"], ["g"], settings=SMALL)
    assert again.savings is None
    flow.save(again, str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out" / "series"))
    assert {(x["upgrade"], x["hvac_mwh"]) for x in stored.collect()} == {(0, 40.0), (1, 18.0), (2, 0.0)} and stored.count() == 3 * n
    assert {x["upgrade"] for x in spark.read.parquet(str(tmp_path / "out" / "reconciled")).collect()} == {0, 1, 2}


def test_missing_profiles_stay_missing_in_reconciliation(spark):
    """County d has loads but no base weather: its regressed total is missing, not 0, and so are ratios; counties say how many groups lack one."""
    n = 48
    b = spark.createDataFrame([(c, "VT", 1.0, 900_000.0, 0.0) for c in "cd"], "county string, state string, weight double, e double, g double")
    loads = spark.createDataFrame([(c, T0 + k * H, 1.0, 1000.0 + k, 0.0) for c in "cd" for k in range(n)], "county string, ts timestamp_ntz, weight double, e double, g double")
    w = _weather(spark, n, "cd").where("county = 'c' OR year = 2012")
    r = flow.run(readers.RunConfig(), b, loads, w, ["county"], ["e"], ["g"], settings=SMALL)
    rows = {x["county"]: x for x in r.reconciled.collect()}
    assert rows["d"]["hvac_mwh_reg"] is None and rows["d"]["ratio_hvac_mwh_reg_meta"] is None and rows["d"]["diff_hvac_mwh_reg_meta"] is None
    assert rows["c"]["hvac_mwh_reg"] > 0 and rows["d"]["gas_mwh_reg"] == 0.0
    assert {(x["county"], x["groups_without_profile"]) for x in r.counties.collect()} == {("c", 0), ("d", 1)}
