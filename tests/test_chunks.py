"""Chunk files, broken files, metrics that are added once, number and CSV rules."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadweave.operators import rollup
from loadweave.sources import readers, wide, writers

T0 = dt.datetime(2018, 1, 1, 1)
H = dt.timedelta(hours=1)


def test_fields_of_csv(spark):
    lines = ["a,b", ",,", "", '"x, y",1,"say ""no"""', "('a', 1)", ' p ,"",q', '"unclosed,1']
    got = [r[0] for r in spark.createDataFrame([(x,) for x in lines], "t string").select(wide.csv_fields(F.col("t"))).collect()]
    assert got == [["a", "b"], ["", "", ""], [""], ["x, y", "1", 'say "no"'], ["('a'", "1)"], ["p", "", "q"], ['"unclosed', "1"]] or got[:-1] == [["a", "b"], ["", "", ""], [""], ["x, y", "1", 'say "no"'], ["('a'", "1)"], ["p", "", "q"]]
    texts = ["plain", "a,b", 'q"q', "", None, " pad "]
    df = spark.createDataFrame([(x,) for x in texts], "t string").select("t", wide.csv_fields(wide.csv_text(F.col("t")))[0].alias("back"))
    assert all((r["t"] or "") == r["back"] for r in df.collect())


def test_chunk_files_with_columns_of_their_own(spark, tmp_path):
    (tmp_path / "run_upgrade1_0000-0150.csv").write_text("timestamp_EST,\"('G1', 'a, b')\",x\r\n2018-01-01 01:00:00,1.5,\r\n1/1/2018 2:00,2,nan\r\n2018-01-01 01:00:00,7,8\r\n")
    (tmp_path / "run_upgrade1_0150-0300.csv").write_text("timestamp_EST,y\n2018-01-01 01:00:00,20\n")
    (tmp_path / "run_upgrade18_0000-0150.csv").write_text("timestamp_EST,z\n2018-01-01 01:00:00,99\n")
    got = sorted((tuple(r) for r in readers.chunk_series(spark, str(tmp_path), "run", 1).collect()), key=repr)
    assert got == sorted([(T0, "('G1', 'a, b')", 7.0), (T0, "x", 8.0), (T0 + H, "('G1', 'a, b')", 2.0), (T0 + H, "x", None), (T0, "y", 20.0)], key=repr)
    with pytest.raises(FileNotFoundError):
        readers.chunk_series(spark, str(tmp_path), "run", 2)
    for name, text, message in (("bad_upgrade1_0-1.csv", "t,a\nsoon,1\n", "soon"), ("num_upgrade1_0-1.csv", "t,a\n2018-01-01,one\n", "not a number: one"), ("len_upgrade1_0-1.csv", "t,a,b\n2018-01-01,1\n", "other fields")):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match=message):
            readers.chunk_series(spark, str(tmp_path), name.partition("_")[0], 1).collect()


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for k in range(n):
            (folder / f"r_upgrade0_{k:04}-{k + 1:04}.csv").write_text(f"timestamp_EST,s{k}\n2018-01-01 01:00:00,{k}\n")
        spark.sparkContext.setJobGroup(f"files-{n}", "")
        try:
            rows = readers.chunk_series(spark, str(folder), "r", 0).collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sorted((r["bldg_id"], r["mwh"]) for r in rows) == sorted((f"s{k}", float(k)) for k in range(n))
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files-{n}"))

    assert jobs(1000) <= jobs(4) + 2  # listing many files is a job of its own


def test_numbers_that_cannot_be_read_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,1001\n2018-01-01,1\n2018-01-02,x1\n")
    with pytest.raises(Exception, match="not a number: x1"):
        readers.wide_series(spark, str(tmp_path / "a.csv")).collect()


def test_broken_files_are_skipped_and_named(spark, tmp_path):
    df = spark.createDataFrame([(1, "VT", "a b"), (2, "NH", "b"), (3, "ME", "c")], "bldg_id long, state string, county string")
    root = tmp_path / "m"
    writers.to_parquet(df, str(root), ["state", "county"])
    for file in (root / "state=NH" / "county=b").glob("*.parquet"):
        file.write_bytes(b"no parquet")
    schema = "bldg_id long, state string, county string"
    rows, skipped = readers.readable(spark, str(root), schema)
    assert sorted(r["bldg_id"] for r in rows.collect()) == [1, 3]
    assert [(r["state"], r["county"]) for r in skipped.collect()] == [("NH", "b")]
    for file in root.rglob("*.parquet"):
        file.write_bytes(b"no parquet")
    with pytest.raises(FileNotFoundError):
        readers.readable(spark, str(root), schema)


def test_metrics_are_added_once(spark, tmp_path):
    path = str(tmp_path / "m")
    of = lambda *rows: spark.createDataFrame(rows, "id string, mae double")
    writers.append_metrics(of(("a", 1.0)), path, "r1", 0)
    writers.append_metrics(of(("b, c", 3.0)), path, "r1", 1)
    writers.append_metrics(of(("b, c", 5.0)), path, "r1", 1)
    assert sorted((r["id"], r["mae"]) for r in spark.read.parquet(path).collect()) == [("a", 1.0), ("b, c", 5.0)]
    for _ in range(2):
        writers.metrics_csv(spark, path, str(tmp_path / "out" / "metrics.csv"))
    assert (tmp_path / "out" / "metrics.csv").read_text() == 'run,chunk,id,mae\nr1,0,a,1.0\nr1,1,"b, c",5.0\n'
    assert [x.name for x in (tmp_path / "out").iterdir() if not x.name.startswith(".")] == ["metrics.csv"]


def test_chunks_are_written_under_their_names_and_read_again(spark, tmp_path):
    counties = [f"G{k}" for k in range(5)]
    meta = spark.createDataFrame([(u, c, float(u) + k) for u in (0, 18) for k, c in enumerate(counties)], "upgrade int, county string, mwh double")
    chunks = rollup.chunked(meta, ["county"], 2)
    for _ in range(2):
        names = writers.chunk_tables(meta, chunks, ["county"], 2, str(tmp_path), "res_")
    assert sorted(names) == [f"res_meta_upgrade{u}_{s:04}-{s + 2:04}.csv" for u in (0, 18) for s in (0, 2, 4)]
    assert (tmp_path / "res_meta_upgrade18_0002-0004.csv").read_text() == "upgrade,county,mwh\n18,G2,20.0\n18,G3,21.0\n"
    loads = spark.createDataFrame([(u, c, f"('{c}', 'x')", T0 + h * H, 1 / 3 + u + h) for u in (0, 18) for c in counties for h in range(3) if (c, h) != ("G1", 1)], "upgrade int, county string, name string, ts timestamp_ntz, value double")
    writers.chunk_loads(loads, chunks, ["county"], 2, str(tmp_path), "res_")
    assert (tmp_path / "res_eulp_hvac_elec_MWh_upgrade0_0000-0002.csv").read_text().splitlines()[:3] == ["timestamp_EST,\"('G0', 'x')\",\"('G1', 'x')\"", "2018-01-01 01:00:00,0.333333,0.333333", "2018-01-01 02:00:00,1.333333,"]
    back = readers.chunk_series(spark, str(tmp_path), "res_eulp_hvac_elec_MWh", 18).where("mwh IS NOT NULL")
    assert sorted((r["bldg_id"], r["ts"], r["mwh"]) for r in back.collect()) == sorted((r["name"], r["ts"], round(r["value"], 6)) for r in loads.where("upgrade = 18").collect())
    assert sorted((r["upgrade"], r["start"], r["end"]) for r in readers.chunk_files(spark, str(tmp_path)).where("prefix = 'res_meta'").collect()) == [(u, s, s + 2) for u in (0, 18) for s in (0, 2, 4)]
    assert not [x for x in tmp_path.iterdir() if x.name.startswith("_stage")]


def test_long_tables_say_how_many_rows_they_have(spark):
    html = writers.html_table(spark.range(7).select(F.col("id").alias("<n>")), "t", at_most=5)
    assert "5 of 7 rows" in html and html.count("<td>") == 5 and "&lt;n&gt;" in html
    assert "rows)" not in writers.html_table(spark.range(5), "t", at_most=5)
