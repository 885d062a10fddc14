"""Charts by their elements, the report around them, header checks, and the report on chunk files."""

from __future__ import annotations

import datetime as dt
import os
import re
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from loadweave.plans import charts, validation

T0 = dt.datetime(2018, 1, 1, 1)
H = dt.timedelta(hours=1)
SVG = "{http://www.w3.org/2000/svg}"


def count(svg, tag):
    return sum(1 for _ in ET.fromstring(f"<x>{svg}</x>").iter(f"{SVG}{tag}"))


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(f"{c}", T0 + k * 9 * H, 10.0 + c + k % 24, 10.0 + c * 1.1 + (k * 7) % 24) for c in range(12) for k in range(900)]
    return spark.createDataFrame(rows, "fips string, ts timestamp_ntz, ref double, reg double").persist()


def test_every_chart_has_its_elements(spark, pairs):
    national = validation.national(pairs)
    zones = spark.createDataFrame([(f"{c}", "p1" if c < 3 else "p2") for c in range(13)], "fips string, ba string")
    points = charts.points(pairs, national, zones, ["P1"])
    assert len(points) == 7
    bars = charts.draw("monthly bars", points["monthly bars"])
    months = {r["month"]: r["pct"] for r in points["monthly bars"].collect()}
    assert count(bars, "rect") == sum(v is not None for v in months.values()) and count(bars, "text") == 12 + 3
    assert count(charts.draw("top counties", points["top counties"]), "rect") == 10
    for name, scatters in (("daily scatter", 1), ("hourly scatter", 1), ("ranked scatters", 9), ("target zone scatters", 3)):
        svg = charts.draw(name, points[name])
        assert count(svg, "svg") == scatters and count(svg, "rect") == points[name].count() <= scatters * charts.CELLS**2
    assert points["hourly scatter"].agg(F.sum("n")).first()[0] == national.count()
    assert {r["of"] for r in points["target zone scatters"].collect()} == {"0", "1", "2"}
    groups = [r["of"].split(" ")[1] for r in points["ranked scatters"].select("of").distinct().collect()]
    assert sorted(groups) == sorted(["(best)", "(middle)", "(worst)"] * 3)
    panels = charts.draw("profile by month", points["profile by month"])
    assert count(panels, "polyline") == 2 * national.select(F.month("ts")).distinct().count()


def test_cells_hold_all_points(spark):
    rows = [(0.0, 0.0), (10.0, 10.0), (10.0, 0.0), (5.0, 5.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "ref double, reg double")
    got = {(r["x"], r["y"]): r["n"] for r in charts.cells(df, F.lit("a"), 10).collect()}
    assert got == {(0, 0): 1, (9, 9): 1, (9, 0): 1, (5, 5): 1}
    same = charts.cells(spark.createDataFrame([(2.0, 2.0)] * 3, df.schema), F.lit("a")).collect()
    assert [(r["x"], r["y"], r["n"], r["mae"]) for r in same] == [(0, 0, 3, 0.0)]
    assert charts.draw("hourly scatter", charts.cells(df.limit(0), F.lit("a"))) == ""


def test_cells_read_the_same_points_for_limits_and_places(spark):
    """Values that differ in their last digits each time they are computed, as sums of doubles may."""
    noisy = F.udf(lambda v: v + int.from_bytes(os.urandom(2)) * 1e-13, "double").asNondeterministic()
    df = spark.range(400).select((F.col("id") % 40).alias("of"), noisy((F.col("id") / 40).cast("int") + F.lit(1.0)).alias("ref"), F.lit(20.0).alias("reg"))
    got = charts.cells(df, F.col("of")).collect()
    assert sum(r["n"] for r in got) == 400
    assert {(r["x"], r["y"]) for r in got if r["x"] < 3} == {(0, 59)} and all(0 <= r["x"] < charts.CELLS for r in got)
    assert sum(r["x"] == 0 for r in got) == 40


def test_fit_charts(spark):
    df = spark.createDataFrame([("g", "hvac", T0 + k * H, float(k), float(k + 1)) for k in range(50)], "k string, target string, ts timestamp_ntz, predicted double, actual double")
    points = charts.fit_points(df)
    assert count(charts.draw("predicted over actual", points["predicted over actual"]), "rect") >= 50 // 2
    assert count(charts.draw("fit by month", points["fit by month"]), "polyline") == 2


def test_report_has_charts_and_warnings(spark, pairs):
    side = lambda v: pairs.select("ts", "fips", F.col(v).alias("gwh"))
    zones = spark.createDataFrame([(f"{c}", "p1" if c < 3 else "p2", "n", "VT") for c in range(11)], "fips string, ba string, county string, state string")
    html = validation.report(side("ref").where("fips <> '11'"), side("reg"), zones, "a < b", ["p1", "p9"])
    assert html.count("<figure>") == 7 and "a &lt; b" in html and "no county of zone p9" in html and "no county of zone p1" not in html
    assert "0 counties only in the reference, 1 only in the regression" in html
    assert re.search(r"<h2>counties</h2><table><tr><th>common</th><th>ref_only</th><th>reg_only</th></tr><tr><td>11</td><td>0</td><td>1</td>", html)


def test_pairs_of_files_need_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t,01001,2\n2018-01-01,1,2\n")
    (tmp_path / "b.csv").write_text("t,2,01001\n2018-01-01,2,1\n")
    ref, reg = validation.read_pair(spark, str(tmp_path / "a.csv"), str(tmp_path / "a.csv"))
    assert sorted(r["fips"] for r in ref.collect()) == ["1001", "2"]
    with pytest.raises(ValueError, match="position 0"):
        validation.read_pair(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))


def test_report_on_chunk_files(spark):
    rows = [("res_meta", 1, 0, 15), ("res_meta", 1, 15, 30), ("res_meta", 1, 60, 75), ("res_meta", 1, 70, 85), ("com", 0, 0, 15)]
    lines = [r["line"] for r in validation.files_report(spark.createDataFrame(rows, "prefix string, upgrade int, start int, end int"), 15).collect()]
    assert lines == [
        "Results for com (upgrade 0):", "Total files found: 1", "First file: com_upgrade0_0000-0015.csv", "Last file: com_upgrade0_0000-0015.csv",
        "Results for res_meta (upgrade 1):", "Total files found: 4", "First file: res_meta_upgrade1_0000-0015.csv", "Last file: res_meta_upgrade1_0070-0085.csv",
        "Missing: res_meta_upgrade1_0030-0045.csv", "Missing: res_meta_upgrade1_0045-0060.csv",
        "Misaligned: res_meta_upgrade1_0015-0030.csv -> res_meta_upgrade1_0060-0075.csv", "Misaligned: res_meta_upgrade1_0060-0075.csv -> res_meta_upgrade1_0070-0085.csv",
    ]


def test_far_apart_files_are_reported_by_many_tasks(spark):
    """One gap of 120,000 missing ranges: lines in their order, made by more than one task."""
    far = 120_000 * 15 + 15
    lines = validation.files_report(spark.createDataFrame([("a", 1, 0, 15), ("a", 1, far + 5, far + 20), ("b", 0, 0, 15)], "prefix string, upgrade int, start int, end int"), 15)
    got = [r["line"] for r in lines.collect()]
    missing = [f"Missing: a_upgrade1_{k:04}-{min(k + 15, far + 5):04}.csv" for k in range(15, far + 5, 15)]
    assert got[:4] == ["Results for a (upgrade 1):", "Total files found: 2", "First file: a_upgrade1_0000-0015.csv", f"Last file: a_upgrade1_{far + 5}-{far + 20}.csv"]
    assert got[4:-5] == missing and got[-5] == f"Misaligned: a_upgrade1_0000-0015.csv -> a_upgrade1_{far + 5}-{far + 20}.csv"
    by_task = [r["count"] for r in lines.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(by_task) > 1 and max(by_task) < 0.7 * len(got)
