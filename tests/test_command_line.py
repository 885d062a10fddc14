"""One run from files to files through the command line, and the checks of what it wrote."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest

from loadweave import __main__ as command
from loadweave.operators import regress, relational
from loadweave.sources import readers, snapshot

T0 = dt.datetime(2018, 1, 1, 1)
H = dt.timedelta(hours=1)
USE = "`out.electricity.heating.energy_consumption..kwh` double, `out.natural_gas.heating.energy_consumption..kwh` double"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    counties = ["G5000010", "G5000030", "G5000050"]
    meta = [(b, u, 2.0, "VT", c, 500.0 * (10 - u), 0.0) for b, c in enumerate(counties) for u in (0, 1)]
    spark.createDataFrame(meta, f"bldg_id long, upgrade int, weight double, `in.state` string, `in.county` string, {USE}").write.parquet(f"{root}/meta")
    n = 48
    loads = [(b, u, T0 + k * H, float(10 - u + k % 24), 0.0) for b in range(3) for u in (0, 1) for k in range(n)]
    spark.createDataFrame(loads, f"bldg_id long, upgrade int, timestamp timestamp_ntz, {USE}").write.parquet(f"{root}/loads")
    (root / "w" / "state=VT").mkdir(parents=True)
    head = "date_time," + ",".join(readers.WEATHER_COLUMNS)
    for c in counties:
        for y in (2018, 2012):
            lines = [f"{dt.datetime(y, 1, 1, 1) + k * H},{10 + 5 * math.sin(k / 4):.3f},50,1,1,1,1,1" for k in range(n)]
            (root / "w" / "state=VT" / f"{c}_{y}.csv").write_text("\n".join([head, *lines]) + "\n")
    (root / "config.json").write_text(json.dumps({"stock": "residential", "release": "2025.1", "upgrades": [0, 1], "savings": True, "chunk_size": 2, "upgrade_names": {"1": "heat pumps"}}))
    return root


def test_run_from_files_to_files(spark, inputs, monkeypatch):
    monkeypatch.setattr(regress, "Settings", lambda **k: _SMALL)
    args = ["run", f"{inputs}/config.json", f"{inputs}/meta", f"{inputs}/loads", f"{inputs}/w", f"{inputs}/out", "--counties", "G5000010_G5000030_G5000050"]
    names = command.main(args, spark)
    chunks = ["0000-0002", "0002-0004"]
    expected = {f"res_{kind}_upgrade{u}_{c}.csv" for kind in ("meta", "eulp_hvac_elec_MWh") for u in (0, 1) for c in chunks} | {f"res_{k}_upgrade{u}.csv" for k in ("meta_master", "agg_eulp_hvac_elec_GWh") for u in (0, 1)}
    assert set(names) == expected
    lines = (inputs / "out" / "csv" / "res_meta_upgrade1_0000-0002.csv").read_text().splitlines()
    assert lines[0].startswith("upgrade,upgrade_name,county,state,gas_heating_mwh,hvac_mwh_meta,gas_mwh_meta") and lines[1].startswith("1,heat pumps,G5000010,VT,0.0,9.0,0.0") and len(lines) == 3
    assert (inputs / "out" / "csv" / "res_agg_eulp_hvac_elec_GWh_upgrade0.csv").read_text().splitlines()[0] == "timestamp_EST,50001,50003,50005"
    saved = spark.read.parquet(f"{inputs}/out/tables/savings")
    assert {round(r["hvac_mwh_savings"], 9) for r in saved.collect()} == {0.002} and saved.count() == 3 * 48
    assert snapshot.compare(spark, f"{inputs}/out/run") == {"changed": [], "lost": [], "new": []}
    lines = command.main(["files", f"{inputs}/out/csv", "--step", "2", "--output", f"{inputs}/out/check"], spark)
    assert "Results for res_meta (upgrade 1):" in lines and "Total files found: 2" in lines and not any(x.startswith("M") for x in lines)
    (inputs / "out" / "csv" / "res_meta_upgrade1_0000-0002.csv").unlink()
    (inputs / "z.csv").write_text("FIPS,ba,county_name,state\n50001,p1,x,VT\n50003,p1,y,VT\n")
    gwh = f"{inputs}/out/csv/res_agg_eulp_hvac_elec_GWh_upgrade0.csv"
    command.main(["report", gwh, gwh, f"{inputs}/z.csv", f"{inputs}/out/report", "--targets", "p1"], spark)
    html = "".join(r[0] for r in spark.read.text(f"{inputs}/out/report").collect())
    assert "Target zone scatters: 50001" in html and "counties without a zone" in html


_SMALL = regress.Settings(trees=3, depth=3, epochs=1)


def test_arguments_are_needed():
    with pytest.raises(SystemExit):
        command.parser().parse_args(["run", "config.json"])


def test_a_column_at_its_place(spark):
    df = spark.range(1).selectExpr("id AS a", "id AS `b.c`")
    assert relational.inserted(df, 1, "x", df["a"] + 1).columns == ["a", "x", "b.c"]
    with pytest.raises(ValueError):
        relational.inserted(df, 0, "a", df["a"])
