"""Operators on small tables made by hand: missing keys, zeros, ties, gaps, leap days, sub-hourly stamps."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadweave.functions import dates, numeric, text
from loadweave.operators import learners, ranking, reconcile, regress, relational, rollup, series, stats, weather
from loadweave.sources import readers

H = dt.timedelta(hours=1)
T0 = dt.datetime(2018, 1, 1, 1)


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def hourly(spark, n, key="a", start=T0, f=lambda k: float(k)):
    return spark.createDataFrame([(key, start + k * H, f(k)) for k in range(n)], "key string, ts timestamp_ntz, v double")


def test_rollup_skips_missing_keys_and_values(spark):
    df = spark.createDataFrame([("x", 2.0, 1000.0, None), ("x", 1.0, None, 500.0), (None, 1.0, 9.0, 9.0), ("y", None, 5.0, 5.0)], "k string, weight double, e double, g double")
    assert values(rollup.metadata_rollup(df, ["k"], ["e"], ["g"]), "k", "hvac_mwh", "gas_mwh") == [("x", 2.0, 0.5), ("y", 0.0, 0.0)]


def test_hour_end(spark):
    stamps = [dt.datetime(2018, 1, 1, 0, m) for m in (0, 15, 30, 45)] + [dt.datetime(2018, 1, 1, 1)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    assert [r[0].hour for r in df.orderBy("ts").select(dates.hour_end(F.col("ts"))).collect()] == [0, 1, 1, 1, 1]


def test_fips(spark):
    df = spark.createDataFrame([("G5000030", "00012"), ("G0100010", "000"), (None, None), ("G9900010", " 7 ")], "c string, f string")
    got = df.select(text.county_fips(F.col("c")), text.state_of(F.col("c")), text.normal_fips(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [(50003, "VT", "12"), (1001, "AL", "0"), (None, None, None), (99001, None, "7")]


def test_not_in_keeps_missing(spark):
    df = spark.createDataFrame([("AK",), ("VT",), (None,)], "s string")
    assert values(df.where(relational.not_in(F.col("s"), "AK", "HI")), "s") == [("VT",), (None,)]


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, 3.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.pct_diff(F.col("a"), F.col("b"))).collect()] == [None, 50.0, None]


def test_correlation_of_constants_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "ref double, reg double")
    assert stats.hourly_correlation(df).first()[0] is None


def test_lookup_with_two_values_is_an_error(spark):
    df, lk = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        relational.lookup_join(df, lk, ["k"], ["v"])


def test_first_peak_of_ties(spark):
    df = spark.createDataFrame([("a", T0, 5.0, 1.0), ("a", T0 + H, 5.0, 7.0), ("a", T0 + 2 * H, None, 7.0)], "fips string, ts timestamp_ntz, ref double, reg double")
    r = stats.peaks(df, ["fips"]).first()
    assert (r["ref_peak_at"], r["reg_peak_at"], r["reg_at_ref_peak"]) == (T0, T0 + H, 1.0)


def test_leap_year_loses_its_last_day(spark):
    assert series.without_leap_day(hourly(spark, 8784), ["key"]).count() == 8760
    assert series.without_leap_day(hourly(spark, 8783), ["key"]).count() == 8783


def test_fill_like_pandas(spark):
    raw = [None, 1.0, None, None, 4.0, None]
    df = spark.createDataFrame([("a", T0 + k * H, v) for k, v in enumerate(raw)], "key string, ts timestamp_ntz, v double")
    got = [r[0] for r in series.filled(df, ["key"], ["v"]).orderBy("ts").select("v").collect()]
    assert got == pd.Series(raw).bfill().ffill().tolist()


def test_daily_totals_fill_gaps(spark):
    df = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + 50 * H, 2.0)], "key string, ts timestamp_ntz, v double")
    assert [r[0] for r in series.by_day(df, ["key"], "v").orderBy("day").select("v").collect()] == [1.0, 0.0, 2.0]


def test_months_without_rows_are_zero(spark):
    got = series.by_month(hourly(spark, 3), ["key"], "v").orderBy("month").select("v").collect()
    assert [r[0] for r in got] == [3.0] + [0.0] * 11
    assert [r[0] for r in series.by_month(hourly(spark, 3), [], "v").orderBy("month").select("v").collect()] == [3.0] + [0.0] * 11


def test_gaps(spark):
    df = spark.createDataFrame([(0, 15), (15, 30), (60, 75), (80, 95)], "s int, e int")
    assert values(series.gaps(df, "s", "e", 15), "gap_start", "gap_end", "whole") == [(30, 45, True), (45, 60, True), (75, 80, False)]


@pytest.mark.parametrize("keys", [None, ["k"]])
def test_large_gap_is_dealt_out(spark, keys):
    """A gap of 60,001 ranges between two neighbours, the last one cut short; no task has it to itself."""
    df = spark.createDataFrame([(1, 0, 15), (1, 900_020, 900_035)], "k int, s int, e int")
    out = series.gaps(df, "s", "e", 15, keys)
    assert dict(out.dtypes) | {"k": "int"} == {"k": "int", "gap_start": "int", "gap_end": "int", "whole": "boolean"}
    assert sorted(tuple(r) for r in out.select("gap_start", "gap_end", "whole").collect()) == [(g, min(g + 15, 900_020), False) for g in range(15, 900_020, 15)]
    by_task = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(by_task) > 1


def test_chunks_follow_key_order(spark):
    df = spark.createDataFrame([(f"k{i:03}",) for i in range(100)] * 2, "k string").repartition(7)
    assert values(rollup.chunked(df, ["k"], 30), "k", "chunk") == [(f"k{i:03}", i // 30) for i in range(100)]


def test_identical_series_have_no_error(spark):
    df = hourly(spark, 100, f=lambda k: float(k % 24)).select(F.col("key").alias("fips"), "ts", F.col("v").alias("ref"), F.col("v").alias("reg"))
    assert tuple(stats.errors(df, []).first()) == (0.0, 0.0, 0.0)
    assert stats.hourly_correlation(df).first()[0] == pytest.approx(1.0)
    assert stats.month_mape(df, ["fips"]).first()["mape_mean"] == 0.0


def test_best_middle_worst(spark):
    df = spark.createDataFrame([(f"k{i}", float(i)) for i in range(9)] + [("none", None)], "fips string, v double")
    assert values(relational.best_middle_worst(df, "v", "fips"), "group", "rank") == [("best", 1), ("best", 2), ("best", 3), ("middle", 4), ("middle", 5), ("middle", 6), ("worst", 7), ("worst", 8), ("worst", 9)]


def test_reconcile_keeps_groups_that_others_lack(spark):
    a = spark.createDataFrame([("x", 2.0, 0.0), ("y", 1.0, 1.0)], "k string, h double, g double")
    b = spark.createDataFrame([("x", 1.0, 1.0)], "k string, h double, g double")
    rows = {r["k"]: r for r in reconcile.reconcile(a, b, b, ["k"], ["h", "g"]).collect()}
    assert rows["x"]["ratio_h_series_meta"] == 0.5 and rows["x"]["diff_h_series_meta"] == -50.0 and rows["x"]["ratio_g_series_meta"] is None
    assert rows["y"]["ratio_h_series_meta"] is None and rows["x"]["ratio_h_reg_series"] == 1.0


def test_forest_and_network_learn():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (1500, 4))
    y = np.sin(3 * x[:, 0]) + x[:, 1] ** 2
    r2 = lambda p: 1 - ((y[1200:] - p) ** 2).mean() / y[1200:].var()
    forest = learners.Forest(30, 8).fit(x[:1200], y[:1200])
    assert r2(forest.predict(x[1200:])) > 0.9 and forest.importances[:2].sum() > 0.9
    assert r2(learners.Network(epochs=20).fit(x[:1200], y[:1200]).predict(x[1200:])) > 0.9
    assert np.array_equal(learners.Forest(3, 4).fit(x, y).predict(x), learners.Forest(3, 4).fit(x, y).predict(x))


def _brute_tree(x, y, w):
    """(value,) or (value, feature, threshold, left, right): splits by trying every feature and every place."""
    rows = np.flatnonzero(w > 0)
    value = np.average(y[rows], weights=w[rows])
    best = None
    for k in range(x.shape[1] if len(set(y[rows])) > 1 else 0):
        places = np.unique(x[rows, k])
        for low, high in zip(places, places[1:]):
            at = low + (high - low) / 2
            sides = [rows[x[rows, k] <= at], rows[x[rows, k] > at]]
            error = sum((w[s] * (y[s] - np.average(y[s], weights=w[s])) ** 2).sum() for s in sides)
            if best is None or error < best[0] - 1e-9 * max(1, best[0]):
                best = (error, k, at)
    if best is None:
        return (value,)
    _, k, at = best
    return value, k, at, _brute_tree(x, y, np.where(x[:, k] <= at, w, 0)), _brute_tree(x, y, np.where(x[:, k] > at, w, 0))


def _same_tree(tree, node, brute):
    if tree.value[node] != pytest.approx(brute[0], abs=1e-9) or (tree.feature[node] < 0) != (len(brute) == 1):
        return False
    if len(brute) == 1:
        return True
    k, at = tree.feature[node], tree.threshold[node]
    return (k, at) == (brute[1], pytest.approx(brute[2])) and _same_tree(tree, tree.left[node], brute[3]) and _same_tree(tree, tree.right[node], brute[4])


@pytest.mark.parametrize(("n", "places", "seed"), [(500, 6, 1), (300, 1, 2), (40, 0, 3), (1, 3, 4)])
def test_trees_split_like_brute_force(n, places, seed):
    """Every distinct value is a place to split at, and depth has no bound; with few places many values tie."""
    rng = np.random.default_rng(seed)
    x, y = rng.normal(size=(n, 3)).round(places), rng.normal(size=n).round(3)
    w = rng.multinomial(n, np.full(n, 1 / n)).astype(float)
    tree = learners.Tree.grow(x, np.argsort(x, 0, kind="stable").T, y, w, None)
    assert _same_tree(tree, 0, _brute_tree(x, y, w))


def test_forests_without_bound_fit_every_row():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(600, 2)), rng.normal(size=600)
    whole = learners.Forest(1, bootstrap=False).fit(x, y)
    assert np.allclose(whole.predict(x), y, atol=1e-9)
    chain = learners.Forest(1, bootstrap=False).fit(np.arange(24.0)[:, None], 2.0 ** np.arange(24))
    assert np.allclose(chain.predict(np.arange(24.0)[:, None]), 2.0 ** np.arange(24), rtol=1e-9)
    assert not learners.Forest(3).fit(np.ones((9, 2)), np.arange(9.0)).importances.any()


def _one_group(n=120, folds=0, outside=5):
    rng = np.random.default_rng(6)
    base = pd.DataFrame({"dry_bulb": rng.uniform(0, 20, n), "hour": rng.integers(0, 24, n)})
    target = pd.DataFrame({"hour_no": range(1, 11), "dry_bulb": [10.0] * (10 - outside) + [40.0] * outside, "hour": range(10)})
    rows = pd.DataFrame({"y": 2 * base["dry_bulb"] + rng.normal(size=n), "fold": np.arange(n) % max(2, folds), "held_out": np.arange(n) % 5 == 0})
    return rows, base, target, ["dry_bulb", "hour"], "dry_bulb", regress.Settings(trees=5, epochs=2, folds=folds)


def test_with_folds_the_model_that_predicts_has_seen_all_rows(monkeypatch):
    seen = []

    class Seen(learners.Forest):
        def fit(self, x, y):
            seen.append(len(y))
            return super().fit(x, y)

    monkeypatch.setattr(learners, "Forest", Seen)
    out = regress._fit_one(*_one_group(folds=4))
    assert seen == [90] * 4 + [120]
    names = set(out[out["what"] == "metric"]["name"])
    assert {"cv_mse", "cv_mae", "mae_in_sample", "mse_in_sample", "r2_in_sample", "share_extrapolated"} <= names and "mae" not in names
    value = out.set_index("name")["value"]
    assert value["mae_in_sample"] < value["cv_mae"]
    seen.clear()
    names = set(regress._fit_one(*_one_group())["name"])
    assert seen == [96] and {"mae", "mse", "r2"} <= names and not any("in_sample" in x or x.startswith("cv_") for x in names)


def test_the_network_goes_on_from_fold_to_fold(monkeypatch):
    made, steps = [], []

    class Seen(learners.Network):
        def scaled(self, x, y):
            made.append(len(y))
            return super().scaled(x, y)

        def train(self, x, y):
            before = getattr(self, "steps", 0)
            super().train(x, y)
            steps.append((before, self.steps))
            return self

    monkeypatch.setattr(learners, "Network", Seen)
    out = regress._fit_one(*_one_group(folds=4))
    # One network, standardised by all rows, trained 4 times 2 epochs of 9 batches without a new start.
    assert made == [120] and steps == [(0, 18), (18, 36), (36, 54), (54, 72)]
    folds = out[out["name"].str.startswith("network_fold_mse_")]
    assert sorted(folds["name"]) == [f"network_fold_mse_{k}" for k in range(1, 5)] and folds["value"].iloc[-1] < folds["value"].iloc[0]
    made.clear()
    regress._fit_one(*_one_group(folds=4, outside=0))
    assert not made


def test_translation(spark):
    """Load follows the weather of the hour before; a warmer target year needs the network; a zero load stays zero."""
    n = 240
    temp = lambda k: 10 + 8 * np.sin(k / 24 * 2 * np.pi) + k % 5
    weather_rows = [("c", 2018, T0 + k * H, float(temp(k))) for k in range(n)] + [("c", 2012, T0 + k * H, float(temp(k) + (15 if k < 5 else 0))) for k in range(n)]
    w = spark.createDataFrame(weather_rows, "county string, year int, ts timestamp_ntz, dry_bulb double")
    features = weather.weather_features(w, ["county", "year"], ["dry_bulb"], [1])
    of = lambda y: features.where(F.col("year") == y).drop("year")
    load = spark.createDataFrame([("c", T0 + k * H, float(2 * temp(k - 1)) if k else 0.0, 0.0) for k in range(n)], "county string, ts timestamp_ntz, hvac double, gas double")
    profiles, fits = regress.translate(load, of(2018), of(2012), ["county"], ["county"], ["hvac", "gas"], weather.feature_names(["dry_bulb"], [1], "dry_bulb"), "dry_bulb", regress.Settings(trees=20, depth=8, epochs=5))
    rows = {(r["target"], r["ts"]): r["value"] for r in profiles.collect()}
    assert len(rows) == 2 * n and all(v == 0.0 for (t, _), v in rows.items() if t == "gas")
    assert rows["hvac", T0] == rows["hvac", T0 + H]
    later = [(rows["hvac", T0 + k * H], 2 * temp(k - 1)) for k in range(10, n)]
    assert np.mean([abs(a - b) for a, b in later]) < 2.0
    metrics = {r["name"]: r["value"] for r in fits.collect() if r["target"] == "hvac"}
    assert metrics["r2"] > 0.8 and 0 < metrics["share_extrapolated"] < 5


def test_groups_without_weather_have_no_profile(spark):
    w = spark.createDataFrame([("c", y, T0 + k * H, float(k % 24)) for k in range(100) for y in (2018, 2012)] + [("d", 2012, T0 + k * H, 1.0) for k in range(100)], "county string, year int, ts timestamp_ntz, dry_bulb double")
    of = lambda y: w.where(F.col("year") == y).drop("year")
    load = spark.createDataFrame([(c, T0 + k * H, float(k % 24), 0.0) for k in range(100) for c in "cd"], "county string, ts timestamp_ntz, hvac double, gas double")
    profiles, _ = regress.translate(load, of(2018), of(2012), ["county"], ["county"], ["hvac", "gas"], ["dry_bulb"], "dry_bulb", regress.Settings(trees=5, depth=4, epochs=2))
    got = {(r["county"], r["target"]): (r["n"], r["known"], r["s"]) for r in profiles.groupBy("county", "target").agg(F.count("*").alias("n"), F.count("value").alias("known"), F.sum("value").alias("s")).collect()}
    assert got["d", "hvac"] == (100, 0, None) and got["d", "gas"] == got["c", "gas"] == (100, 100, 0.0)
    assert got["c", "hvac"][:2] == (100, 100) and got["c", "hvac"][2] > 0


def test_two_parents_or_labels_are_an_error(spark):
    df = spark.createDataFrame([("x", T0, 1.0), ("y", T0, 2.0)], "k string, ts timestamp_ntz, v double")
    once = spark.createDataFrame([("x", "p1"), ("x", "p1")], "k string, p string")
    assert values(rollup.rolled_up(df, once, "k", "p", "ts", "v", "none"), "p", "v") == [("none", 2.0), ("p1", 1.0)]
    twice = once.union(spark.createDataFrame([("x", "p2")], "k string, p string"))
    for run in (lambda: rollup.rolled_up(df, twice, "k", "p", "ts", "v"), lambda: rollup.labelled(df, twice, "k", "p", F.lit("f"))):
        with pytest.raises(Exception, match="more than one p: x"):
            run().collect()


def test_config_rejects_one_year_for_both():
    with pytest.raises(ValueError):
        readers.RunConfig.of({"base_year": 2018, "target_year": 2018})
    assert readers.RunConfig.of({"upgrades": [0, 4], "other": 1}).upgrades == (0, 4)


def test_chunk_names(spark):
    df = spark.createDataFrame([("/d/x_upgrade1_0000-0149.csv",), ("/d/x_upgrade18_0150-0299.csv",), ("/d/notes.txt",)], "path string")
    assert values(readers.parsed_chunk_names(df, "path"), "prefix", "upgrade", "start", "end") == [("x", 1, 0, 149), ("x", 18, 150, 299)]


def test_target_year_test(spark):
    profiles = spark.createDataFrame([("c", "hvac", T0 + k * H, float(k)) for k in range(5)], "county string, target string, ts timestamp_ntz, value double")
    actual = spark.createDataFrame([("c", T0 + k * H, float(k + 1)) for k in range(1, 9)], "county string, ts timestamp_ntz, hvac double")
    r = regress.target_year_test(profiles, actual, ["county"], ["hvac"]).first()
    assert (r["mae"], r["mse"]) == (1.0, 1.0) and r["r2"] == pytest.approx(1 - 1 / 1.25)


def test_series_summary(spark):
    df = spark.createDataFrame([("a", 150, 299), ("a", 0, 149), ("b", 7, 9), (None, 1, 2)], "series string, start long, end long")
    got = {r["series"]: tuple(r)[1:] for r in series.summary(df, "start", "end", ["series"]).collect()}
    assert got == {"a": (2, 0, 149, 150, 299), "b": (1, 7, 9, 7, 9), None: (1, 1, 2, 1, 2)}
    assert tuple(series.summary(df.where("series = 'none'"), "start", "end").first()) == (0, None, None, None, None)


def test_series_that_all_tables_have(spark):
    wanted, ref, reg = (spark.createDataFrame([(x,) for x in rows], "k string") for rows in (["a", "a", "b", None], ["a", "a", "c"], ["c", "a"]))
    assert [r["k"] for r in relational.in_all(wanted, ["k"], ref, reg).collect()] == ["a"]


def test_same_columns_in_the_same_order(spark):
    a = spark.range(1).select(F.lit(1).alias("x"), F.lit(2).alias("y"))
    relational.require_same_columns(a, a)
    for other in (a.select("y", "x"), a.select("x"), a.withColumn("z", F.lit(3))):
        with pytest.raises(ValueError, match="position"):
            relational.require_same_columns(a, other)


@pytest.mark.parametrize("n", range(1, 13))
def test_middle_of_even_and_odd_counts(spark, n):
    def places(k=3):
        if n <= k:
            return set(range(n))
        end = min(n, max(0, n // 2 - k // 2) + k)
        return set(range(max(0, end - k), end))

    df = spark.createDataFrame([(f"k{i:02}", float(i)) for i in range(n)], "fips string, v double")
    got = relational.best_middle_worst(df, "v", "fips").collect()
    assert {r["rank"] - 1 for r in got if r["group"] == "middle"} == places()
    assert {r["rank"] - 1 for r in got if r["group"] == "worst"} == set(range(max(0, n - 3), n))


def test_ranks_and_quantiles_like_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [("a", float(v)) for v in rng.integers(0, 5, 400)] + [("b", float(v)) for v in rng.normal(size=301)] + [(None, 1.0), (None, 2.0), ("c", None), ("d", 7.0), ("e", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    at = (0.0, 0.25, 0.5, 0.9, 0.99, 1.0)
    got = {(r["k"], r["q"]): r["v"] for r in ranking.quantiles(df, "v", ["k"], at).collect()}
    for k in ("a", "b", None, "d"):
        for q in at:
            assert got[k, q] == pytest.approx(np.quantile([v for x, v in rows if x == k], q), abs=1e-12)
    assert len(got) == 4 * len(at)
    whole = [v for _, v in rows if v is not None and v == v]
    assert [r["v"] for r in ranking.quantiles(df, "v", [], (0.37,)).collect()] == pytest.approx([np.quantile(whole, 0.37)])
    ranked = ranking.with_rank(df.where("v IS NOT NULL AND NOT isnan(v)"), ["v", "k"], n="n").collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, len(whole) + 1)) and {r["n"] for r in ranked} == {len(whole)}
    assert [r["v"] for r in sorted(ranked, key=lambda r: r["rank"])] == sorted(whole)
    assert ranking.quantiles(df.limit(0), "v", [], (0.5,)).count() == 0


def test_wide_form_loses_no_name(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", None)], "i int, name string, v double")
    assert values(relational.pivoted(df, ["i"], "name", "v", ["a", "b"]), "i", "a", "b") == [(1, 1.0, 2.0), (2, None, None)]
    for bad, names in ((df, ["a"]), (df.union(df.limit(1)), ["a", "b"]), (df.union(spark.createDataFrame([(3, None, 1.0)], df.schema)), ["a", "b"])):
        with pytest.raises(Exception, match="no column for|repeated"):
            relational.pivoted(bad, ["i"], "name", "v", names).collect()


def test_keys_as_text_do_not_clash(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a', 'b", "c"), ("a", "b', 'c"), ("None", None), ("\\", "'")], "x string, y string")
    got = [r[0] for r in df.select(text.key_text("x", "y")).collect()]
    assert len(set(got)) == len(got) and got[:2] == ["('a', None)", "(None, 'a')"]


def test_title_case_and_number_formats(spark):
    df = spark.createDataFrame([("o'BRIEN-smith of x2y",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(text.title_case(F.col("s"))).collect()] == ["O'Brien-Smith Of X2Y", "", None]
    numbers = [0.0, 1.0, -1234.5678, 0.00012345, 1e-7, 999.6, 12.0, 123456789.0, 0.5, 130500.0, -131500.0, 900.5, 901.5, 10.25, 10.75, 1.125, 1.375, 0.0009765625, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    got = [r[0] for r in df.select(text.significant(F.col("v"))).collect()]
    assert got == [None if v is None or v != v else f"{v:.3g}" for v in numbers]
    df = spark.createDataFrame([(v,) for v in numbers[:-1]], "v double")
    assert [r[0] for r in df.select(text.fixed(F.col("v"), 3, grouped=True)).collect()] == [None if v is None else f"{v:,.3f}" for v in numbers[:-1]]
    assert [r[0] for r in df.select(text.fixed(F.col("v"), 2)).collect()] == [None if v is None else f"{v:.2f}" for v in numbers[:-1]]


def test_gaps_without_keys_across_ranges(spark):
    """Every range of starts in another partition, so that each neighbour lies in the next."""
    starts = [k * 10 for k in range(400) if k % 7 and not 100 <= k < 130]
    rows = spark.createDataFrame([(s, s + 10) for s in starts], "start long, `end` long").repartition(5)
    got = {(r["gap_start"], r["gap_end"], r["whole"]) for r in series.gaps(rows, "start", "end", 10).collect()}
    there = set(starts)
    assert got == {(s, s + 10, True) for s in range(starts[0], starts[-1], 10) if s not in there}
    none = spark.createDataFrame([], "start long, `end` long")
    assert series.gaps(none, "start", "end", 10).count() == 0
    missing = spark.createDataFrame([(None, 5), (0, 10), (20, 30)], "start long, `end` long")
    assert [tuple(r) for r in series.gaps(missing, "start", "end", 10).collect()] == [(10, 20, True)]


def test_scales_are_of_all_base_rows():
    rng = np.random.default_rng(0)
    base = pd.DataFrame({"t": rng.normal(10, 3, 60), "flat": 1.0})
    target = pd.DataFrame({"t": [10.0, 99.0], "flat": 1.0, "hour_no": [1, 2]})
    rows = pd.DataFrame({"y": base["t"] * 2 + 1, "fold": np.arange(60) % 3, "held_out": np.arange(60) % 5 == 0})
    out = regress._fit_one(rows, base, target, ["t", "flat"], "t", regress.Settings(trees=1, epochs=1))
    of = {(r["what"], r["name"]): r["value"] for _, r in out.iterrows()}
    assert np.isclose(of["scale_mean", "t"], base["t"].mean()) and np.isclose(of["scale_spread", "t"], base["t"].std(ddof=0))
    assert of["scale_mean", "flat"] == 1.0 and of["scale_spread", "flat"] == 1.0
    assert np.isclose(of["scale_mean", "y"], rows["y"].mean()) and np.isclose(of["scale_spread", "y"], rows["y"].std(ddof=0))
    assert list(out[out["what"] == "prediction"]["name"]) == ["forest", "network"]
