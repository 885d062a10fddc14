"""Warehouse scans, names by stock and release, snapshots of runs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loadweave.functions.numeric import row_sum
from loadweave.operators import rollup
from loadweave.sources import readers, schema, snapshot, warehouse


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    rows = [(k, "VT" if k % 3 else "NH", k % 2, float(k), "Gas" if k % 4 else None) for k in range(40)]
    df = spark.createDataFrame(rows, "bldg_id long, state string, upgrade int, kwh double, fuel string")
    warehouse.save(df, "loads_saved", ["state", "upgrade"], str(tmp_path_factory.mktemp("w") / "t"))
    yield rows
    spark.sql("DROP TABLE loads_saved")


def test_scan_with_given_conditions(spark, saved):
    df = warehouse.scan(spark, "loads_saved", ["bldg_id"], [("state", ["VT"]), ("upgrade", [1])], ["kwh > 10", "fuel = 'Gas' OR fuel = 'a;b'"])
    assert sorted(r[0] for r in df.collect()) == [k for k, s, u, v, f in saved if s == "VT" and u == 1 and v > 10 and f == "Gas"]
    how = warehouse.pushed(df)
    assert "state" in how["PartitionFilters"] and "upgrade" in how["PartitionFilters"]
    assert "GreaterThan(kwh,10.0)" in how["PushedFilters"] and "fuel" in how["PushedFilters"]
    assert how["ReadSchema"].startswith("struct<bldg_id:bigint,kwh:double,fuel:string")
    read = lambda **k: sorted(r["bldg_id"] for r in warehouse.scan(spark, "loads_saved", **k).collect())
    assert read(restrict=[("fuel", [None])]) == [k for k, *_, f in saved if f is None]
    assert read(restrict=[("fuel", ["Gas", None])]) == list(range(40)) and read(restrict=[("fuel", [])]) == []


@pytest.mark.parametrize("bad", ["kwh", "kwh > 1; drop", "", "other = 1", "rand() > 0.5", "kwh > (SELECT 1)", "max(kwh) > 1", "state IN (SELECT 'a')", "row_number() OVER (ORDER BY kwh) = 1"])
def test_conditions_are_checked(spark, saved, bad):
    with pytest.raises(Exception):
        warehouse.scan(spark, "loads_saved", where=[bad])
    with pytest.raises(ValueError):
        warehouse.scan(spark, "loads_saved", restrict=[("none", [1])])


def test_releases_give_one_result(spark):
    """The same buildings as two releases name them: one rollup."""
    old = spark.createDataFrame(
        [(1, 2.0, "VT", "Addison", 10.0, 4.0, 100.0), (2, 1.0, "VT", "Bennington", 5.0, None, 0.0)],
        "building_id long, `build_existing_model.sample_weight` double, `build_existing_model.state` string, `build_existing_model.county` string, end_use__electricity__heating__kwh double, end_use__electricity__heating_heat_pump_backup__kwh double, end_use__natural_gas__heating__kbtu double",
    )
    new = spark.createDataFrame(
        [(1, 2.0, "VT", "Addison", 10.0, 4.0, 100.0 * 0.293071), (2, 1.0, "VT", "Bennington", 5.0, None, 0.0)],
        "bldg_id long, weight double, `in.state` string, `in.county` string, `out.electricity.heating.energy_consumption..kwh` double, `out.electricity.heating_hp_bkup.energy_consumption..kwh` double, `out.natural_gas.heating.energy_consumption..kwh` double",
    )
    results = []
    for df, release in ((old, "2024.2"), (new, "2025.1")):
        found = schema.resolve(df, readers.RunConfig.of({"stock": "residential", "release": release}))
        assert found.electric == ["electric_heating", "electric_heating_hp_bkup"] and found.gas == ["gas_heating"]
        assert {"upgrade", "electric_cooling", "area"} <= set(found.missing)
        out = rollup.metadata_rollup(found.df, ["state", "county"], found.electric, found.gas)
        results.append(sorted(tuple(r) for r in out.collect()))
    assert results[0] == results[1] == [("VT", "Addison", 0.028, 0.058614), ("VT", "Bennington", 0.005, 0.0)]


def test_two_columns_for_one_name_and_none(spark):
    df = spark.createDataFrame([(1, 1.0, "G1", None, "S1"), (2, 1.0, None, "G2", None)], "bldg_id long, weight double, `in.nhgis_county_gisjoin` string, county string, `in.as_simulated_nhgis_county_gisjoin` string")
    of = lambda release: [tuple(r) for r in schema.resolve(df, readers.RunConfig(release=release)).df.select("county", "weather_county").orderBy("bldg_id").collect()]
    assert of("2025.2") == [("G1", "S1"), ("G2", "G2")] and of("2024.1") == [("G1", "G1"), ("G2", "G2")]
    with pytest.raises(ValueError, match="county .any of .'in.county'"):
        schema.resolve(df.drop("county"), readers.RunConfig(stock="residential"))
    with pytest.raises(ValueError, match="no such stock"):
        schema.candidates("industrial", "1")
    assert row_sum is not None and F is not None


def test_snapshot_is_compared(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x\n1\n")
    (tmp_path / "one.json").write_text("{}")
    code = tmp_path / "code" / ".git"
    (code / "refs" / "heads").mkdir(parents=True)
    (code / "HEAD").write_text("ref: refs/heads/main\n")
    (code / "refs" / "heads" / "main").write_text("abc123\n")
    run = str(tmp_path / "run")
    path = snapshot.take(spark, run, {"lookups": str(tmp_path / "in"), "config.json": str(tmp_path / "one.json")}, str(tmp_path / "code"), upgrades=[0, 1])
    said = json.loads(open(path).read())
    assert said["commit"] == "abc123" and said["settings"] == {"upgrades": [0, 1]} and set(said["inputs"]) == {"lookups/a.csv", "config.json"}
    assert snapshot.compare(spark, run) == {"changed": [], "lost": [], "new": []}
    with pytest.raises(FileExistsError):
        snapshot.take(spark, run, {})
    copies = tmp_path / "run" / "inputs"
    (copies / "lookups" / ".a.csv.crc").unlink(missing_ok=True)
    (copies / "lookups" / "a.csv").write_text("x\n2\n")
    (copies / "config.json").unlink()
    (copies / "b.csv").write_text("y")
    assert snapshot.compare(spark, run) == {"changed": ["lookups/a.csv"], "lost": ["config.json"], "new": ["b.csv"]}
    assert snapshot.commit_of(str(tmp_path)) is None
