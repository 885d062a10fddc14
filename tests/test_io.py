"""Readers and writers over files in a temporary folder, the whole flow, the report, and streams."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from loadweave.operators import regress
from loadweave.plans import flow, validation
from loadweave.sources import readers, writers
from loadweave.streaming import hourly as stream

T0 = dt.datetime(2018, 1, 1, 1)
H = dt.timedelta(hours=1)


def test_wide_series_keeps_last_stamp_and_reads_mixed_stamps(spark, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,1001,1003\n2018-01-01 01:00:00,1,2\n1/1/2018 2:00,3,\n2018-01-01 01:00:00,5,6\n")
    got = sorted((r["ts"].hour, r["fips"], r["gwh"]) for r in readers.wide_series(spark, str(tmp_path / "a.csv")).collect())
    assert got == [(1, "1001", 5.0), (1, "1003", 6.0), (2, "1001", 3.0), (2, "1003", None)]
    (tmp_path / "bad.csv").write_text("timestamp,1001\nsoon,1\n")
    with pytest.raises(ValueError, match="soon"):
        readers.wide_series(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "empty.csv").write_text("timestamp,1001\n")
    with pytest.raises(ValueError):
        readers.wide_series(spark, str(tmp_path / "empty.csv"))


def test_weather_files(spark, tmp_path):
    (tmp_path / "state=VT").mkdir()
    head = "date_time," + ",".join(readers.WEATHER_COLUMNS)
    (tmp_path / "state=VT" / "G5000030_2018.csv").write_text(head + "\n2018-01-01 01:00:00,1,2,3,4,5,6,7\n")
    (tmp_path / "state=VT" / "G5000030_2012.csv").write_text(head + "\n2012-01-01 01:00:00,9,2,3,4,5,6,7\n")
    rows = readers.weather(spark, str(tmp_path), 2018).collect()
    assert [(r["state"], r["county"], r["year"], r["dry_bulb"]) for r in rows] == [("VT", "G5000030", 2018, 1.0)]


def test_buildings_prune_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0, "VT", "a"), (2, 1.0, "NH", "b")], "bldg_id long, weight double, state string, county string")
    writers.to_parquet(df, str(tmp_path / "m"), ["state", "county"])
    got = readers.buildings(spark, str(tmp_path / "m"), "bldg_id long, weight double, state string, county string", states=["VT"])
    assert [r["bldg_id"] for r in got.collect()] == [1]
    assert "PartitionFilters: [isnotnull(state" in got._jdf.queryExecution().toString()
    with pytest.raises(FileNotFoundError):
        readers.require(got, spark.createDataFrame([("ME",)], "state string"), ["state"])
    with pytest.raises(Exception):
        writers.to_parquet(df, str(tmp_path / "m"))


def test_chunks_of_one_upgrade(spark, tmp_path):
    for u, v in ((1, 10), (18, 99)):
        (tmp_path / f"run_upgrade{u}_0000-0149.csv").write_text(f"timestamp_EST,a{u}\n2018-01-01 01:00:00,{v}\n")
    (tmp_path / "run_upgrade1_0150-0299.csv").write_text("timestamp_EST,b\n2018-01-01 01:00:00,20\n")
    got = sorted((r["bldg_id"], r["mwh"]) for r in readers.chunk_series(spark, str(tmp_path), "run", 1).collect())
    assert got == [("a1", 10.0), ("b", 20.0)]


def test_zones_and_lookup(spark, tmp_path):
    (tmp_path / "z.csv").write_text("FIPS,ba,county_name,state\n01001,p1,AUTAUGA,AL\n01001,p1,AUTAUGA,AL\n")
    assert [tuple(r) for r in readers.zones(spark, str(tmp_path / "z.csv")).collect()] == [("1001", "p1", "Autauga", "AL")]
    (tmp_path / "two.csv").write_text("FIPS,ba,county_name,state\n01001,p2,ALPHA,AL\n1001,p1,O'BETA,WY\n")
    assert [tuple(r) for r in readers.zones(spark, str(tmp_path / "two.csv")).collect()] == [("1001", "p2", "Alpha", "AL")]
    assert [tuple(r) for r in readers.lookup(spark, str(tmp_path / "z.csv"), {"FIPS": "code"}).collect()] == [("01001",)]


def test_plain_names_and_metrics(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0)], "`out.electricity.heating.energy_consumption..kwh` double, `x__baseline` double")
    assert readers.plain_names(df).columns == ["electricity_heating_energy_consumption", "x"]
    for v in (1.0, 3.0):
        writers.append_metrics(spark.createDataFrame([("a", v)], "id string, mae double"), str(tmp_path / "m"))
    assert writers.mean_metrics(spark.read.parquet(str(tmp_path / "m")), ["id"]).first()["mae"] == 2.0


def test_flow_and_report(spark, tmp_path):
    n = 72
    b = spark.createDataFrame([(1, "G5000030", "VT", 2.0, 1000.0, 0.0), (2, "G0200010", "AK", 1.0, 1.0, 1.0)], "bldg_id long, county string, state string, weight double, e double, g double")
    loads = spark.createDataFrame([("G5000030", T0 + k * H, 2.0, float(5 + k % 24), 0.0) for k in range(n)], "county string, ts timestamp_ntz, weight double, e double, g double")
    w = spark.createDataFrame([("G5000030", y, dt.datetime(y, 1, 1, 1) + k * H, 10 + 5 * math.sin(k / 4)) for y in (2018, 2012) for k in range(n)], "county string, year int, ts timestamp_ntz, dry_bulb double")
    config = readers.RunConfig.of({"states": ["VT"]})
    r = flow.run(config, b, loads, w, ["county"], ["e"], ["g"], settings=regress.Settings(trees=5, depth=4, epochs=2))
    assert [x["hvac_mwh_meta"] for x in r.reconciled.collect()] == [2.0]
    assert r.profiles.where("target = 'hvac_mwh'").count() == n and r.counties.count() == n
    assert r.profiles.agg(F.min("ts")).first()[0] == dt.datetime(2012, 1, 1, 1)
    writers.wide_loads(r.profiles.where("target = 'hvac_mwh'"), str(tmp_path / "w"), "county", "value", ["G5000030"])
    assert spark.read.option("header", True).csv(str(tmp_path / "w")).columns == ["timestamp_EST", "G5000030"]
    side = r.counties.select("ts", F.lit("50003").alias("fips"), "gwh")
    zones = spark.createDataFrame([("50003", "p<1>", "X", "VT")], "fips string, ba string, county string, state string")
    html = validation.report(side, side.withColumn("gwh", F.col("gwh") * 2), zones, "t")
    assert "p&lt;1&gt;" in html and "100.000" in html
    kinds = {"monthly bars", "top counties", "daily scatter", "hourly scatter", "profile by month", "ranked scatters"}
    assert set(validation.chart_data(side, side)) == kinds
    assert set(validation.chart_data(side, side, zones, ["P<1>"])) == kinds | {"target zone scatters"}


def test_flow_keeps_upgrades_apart(spark):
    n = 48
    b = spark.createDataFrame([(u, "G5000030", "VT", 2.0, 1000.0 * (u + 1), 0.0) for u in (0, 1, 2)], "upgrade int, county string, state string, weight double, e double, g double")
    loads = spark.createDataFrame([(u, "G5000030", T0 + k * H, 2.0, float(u + 1), 0.0) for u in (0, 1, 2) for k in range(n)], "upgrade int, county string, ts timestamp_ntz, weight double, e double, g double")
    w = spark.createDataFrame([("G5000030", y, dt.datetime(y, 1, 1, 1) + k * H, 10 + 5 * math.sin(k / 4)) for y in (2018, 2012) for k in range(n)], "county string, year int, ts timestamp_ntz, dry_bulb double")
    r = flow.run(readers.RunConfig.of({"upgrades": [0, 2]}), b, loads, w, ["county"], ["e"], ["g"], settings=regress.Settings(trees=3, depth=3, epochs=1))
    assert {(x["upgrade"], x["hvac_mwh_meta"]) for x in r.reconciled.collect()} == {(0, 2.0), (2, 6.0)}
    assert {x["upgrade"]: x["n"] for x in r.counties.groupBy("upgrade").agg(F.count("*").alias("n")).collect()} == {0: n, 2: n}


def test_retries(spark):
    calls = []

    def action():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return spark.range(1)

    assert readers.retried(action, 5, 0).count() == 1 and len(calls) == 3
    with pytest.raises(OSError):
        readers.retried(lambda: (_ for _ in ()).throw(OSError()), 2, 0)


def test_only_passing_errors_are_tried_again():
    class Answer(Exception):
        def __init__(self, code):
            self.code = code

    for error, times in ((Answer(503), 3), (Answer(404), 1), (TypeError(), 1), (FileNotFoundError(), 1), (ConnectionResetError(), 3), (RuntimeError("java.net.SocketTimeoutException: x"), 3), (RuntimeError("Status Code: 500; Error"), 3), (RuntimeError("Status Code: 403"), 1)):
        calls = []

        def action(error=error, calls=calls):
            calls.append(1)
            raise error

        with pytest.raises(type(error)):
            readers.retried(action, 3, 0)
        assert len(calls) == times, error


def test_stream_gives_what_the_table_gives(spark, tmp_path):
    rows = [(k, "a", dt.datetime(2024, 1, 1, k // 4, 15 * (k % 4)), float(k)) for k in range(40)]
    df = spark.createDataFrame(rows, "id long, kind string, ts timestamp_ntz, v double")
    df.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = stream.hourly_totals(s, ["kind"], "v")
    run = q.writeStream.outputMode("complete").format("memory").queryName("hours").option("checkpointLocation", str(tmp_path / "c")).start()
    run.processAllAvailable()
    run.stop()
    key = lambda r: (r["kind"], r["ts"], r["v"], r["n"])
    assert sorted(map(key, spark.table("hours").collect())) == sorted(map(key, stream.hourly_totals(df, ["kind"], "v").collect()))
