"""Translation of load profiles from one weather year to another, one regression for each group and target.

Weather is instantaneous and load stamps end their hour, so weather row k explains load row k + 1; predictions for the hours
of the target year are stamped one hour later, the first hour repeats, and the last row drops.

Groups whose load sums to ZERO_LOAD or less never reach Python. The others are dealt into parts of about GROUPS_AT_ONCE
groups that share their weather, and each part is one grouped-map call: it gets its groups' loads, a number an hour, and one
copy of the weather, rather than a row of features for every hour of every group. Parts are independent, so they spread over
any number of executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip_low, total
from ..sources.scratch import written
from .series import drop_ends, numbered, shifted_with_edge
from .stats import model_metrics

#: Loads of a year that sum to this or less give a year of zeros.
ZERO_LOAD = 0.01
#: Groups of one county that are fitted in one call, about.
GROUPS_AT_ONCE = 8


@dataclass(frozen=True)
class Settings:
    """depth None: trees grow until their leaves are pure. folds > 1: models are validated over that many folds, and the forest that
    predicts is fitted on all rows; else both are fitted without the held-out share. epochs: of the network, for each fold."""

    trees: int = 100
    depth: int | None = None
    epochs: int = 50
    hold_out: float = 0.2
    folds: int = 0
    seed: int = 42


def split_fold(keys: list[str], parts: int, seed: int = 42):
    """The part, from 0, that a row belongs to: a hash of its key and hour, the same in every run and in other engines too.

    The first 32 bits of the MD5 of key, hour and seed as text, joined by |."""
    name = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in (*keys, "hour_no")], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(parts)).cast("int")


def fit_predict(load: DataFrame, base_weather: DataFrame, target_weather: DataFrame, keys: list[str], weather_keys: list[str], features: list[str], temperature: str, settings: Settings | None = None, ts: str = "ts") -> DataFrame:
    """(keys, what, hour_no, value, name): predictions of every target hour, and the fit's metrics.

    load: keys, weather_keys, ts, y. Load loses its first row and base weather its last, and rows pair by place.

    what `prediction`: value at hour_no, name the model used; what `importance`: each feature's. what `metric`: without folds mae, mse,
    r2 on held-out rows, which no model was fitted on. With folds cv_mse and cv_mae (means over folds, each predicted by a forest of
    the others), then one forest of all rows predicts, and its mae_in_sample, mse_in_sample, r2_in_sample are on the same held-out
    rows, which it has seen. share_extrapolated: percent of target hours whose temperature is outside those of base hours. These
    come from the network, which is trained only for groups that need it: without folds on rows not held out, with folds on all
    rows but one fold, and then on, with the weights and the optimiser as they are, on all but the next;
    network_fold_mse_1 and so on are the errors on the fold left out, after each. what `scale_mean`, `scale_spread`: by which each
    feature, and the load (`y`), is standardised for the network, over all base rows."""
    settings = settings or Settings()
    every = list(dict.fromkeys([*keys, *weather_keys]))
    held = int(round(10 * settings.hold_out))
    own = numbered(drop_ends(load.where(F.col("y").isNotNull()), keys, first=1, ts=ts), keys, ts, "hour_no").select(*every, "hour_no", "y")
    own = own.withColumns({"fold": split_fold(keys, max(2, settings.folds or 2), settings.seed + 1), "held_out": split_fold(keys, 10, settings.seed) < held})
    groups = load.select(*every).distinct()
    parts = groups.groupBy(*weather_keys).agg(F.ceil(F.count(F.lit(1)) / GROUPS_AT_ONCE).alias("_parts"))
    own = own.join(parts, weather_keys).withColumn("_part", F.pmod(F.xxhash64(*keys), F.col("_parts")).cast("int")).drop("_parts")
    place = lambda df, role: numbered(df, weather_keys, ts, "hour_no").select(*weather_keys, "hour_no", *features, F.lit(role).alias("role"))
    weather = place(drop_ends(base_weather, weather_keys, last=1, ts=ts), "base").unionByName(place(target_weather, "target"))
    weather = weather.join(parts, weather_keys).withColumn("_part", F.explode(F.sequence(F.lit(0), (F.col("_parts") - 1).cast("int")))).drop("_parts")
    # Columns of its own, since both sides of the grouping may come from one table.
    weather = weather.toDF(*weather.columns)
    schema = ", ".join([*(f"`{c}` {t}" for c, t in load.select(*keys).dtypes), "what string", "hour_no int", "value double", "name string"])

    def part(loads: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        base = around[around["role"] == "base"].set_index("hour_no")[features]
        target = around[around["role"] == "target"].sort_values("hour_no")
        found = []
        for key, rows in loads.groupby(keys, dropna=False, sort=True):
            rows = rows.sort_values("hour_no")
            rows = rows[rows["hour_no"].isin(base.index)]
            if len(rows):
                frame = _fit_one(rows, base.loc[rows["hour_no"]], target, features, temperature, settings)
                for c, v in zip(keys, key, strict=True):
                    frame[c] = v
                found.append(frame[[*keys, "what", "hour_no", "value", "name"]])
        return pd.concat(found) if found else pd.DataFrame(columns=[*keys, "what", "hour_no", "value", "name"])

    by = [*weather_keys, "_part"]
    return own.groupBy(*by).cogroup(weather.groupBy(*by)).applyInPandas(part, schema)


def _fit_one(rows: pd.DataFrame, base: pd.DataFrame, target: pd.DataFrame, features: list[str], temperature: str, settings: Settings) -> pd.DataFrame:
    """One group: rows (y, fold, held_out) beside base weather, and the target weather."""
    import numpy as np

    from .learners import Forest, Network

    # Two phases with folds: first what the folds tell, then one model of all rows.
    x, y, held = base[features].to_numpy(float), rows["y"].to_numpy(float), rows["held_out"].to_numpy(bool)
    train = ~held if 0 < held.sum() < len(y) else np.ones(len(y), bool)
    test = ~train if (~train).any() else train
    forest = lambda some: Forest(settings.trees, settings.depth, seed=settings.seed).fit(x[some], y[some])
    metric = lambda name, value: ("metric", 0, float(value), name)
    out: list[tuple[str, int, float, str]] = []
    folds = [np.flatnonzero(rows["fold"].to_numpy() == k) for k in range(settings.folds)] if settings.folds > 1 else []
    folds = [some for some in folds if 0 < len(some) < len(y)]
    others = [np.setdiff1d(np.arange(len(y)), some) for some in folds]
    if folds:
        gaps = [y[some] - forest(rest).predict(x[some]) for some, rest in zip(folds, others, strict=True)]
        out += [metric("cv_mse", np.mean([(g**2).mean() for g in gaps])), metric("cv_mae", np.mean([np.abs(g).mean() for g in gaps]))]
        train = np.ones(len(y), bool)
    seen_too = "_in_sample" if train[test].any() else ""
    model = forest(train)
    gap = y[test] - model.predict(x[test])
    spread = y[test].var()
    out += [metric(f"mae{seen_too}", np.abs(gap).mean()), metric(f"mse{seen_too}", (gap**2).mean()), metric(f"r2{seen_too}", 1 - (gap**2).mean() / spread if spread > 0 else np.nan)]
    out += [("importance", 0, float(v), f) for f, v in zip(features, model.importances, strict=True)]
    tx, t, seen = target[features].to_numpy(float), target[temperature].to_numpy(float), base[temperature].to_numpy(float)
    outside = (t < seen.min()) | (t > seen.max())
    predicted = model.predict(tx) if len(tx) else np.zeros(0)
    if outside.any():
        # Standardised by all base rows, whatever the network is trained on.
        network = Network(epochs=settings.epochs, seed=settings.seed).scaled(x, y)
        scales = zip([*features, "y"], [*network.mean, network.level], [*network.spread, network.scale], strict=True)
        out += [(what, 0, float(v), f) for f, *both in scales for what, v in zip(("scale_mean", "scale_spread"), both, strict=True)]
        for k, (some, rest) in enumerate(zip(folds, others, strict=True), 1):
            network.train(x[rest], y[rest])
            out.append(metric(f"network_fold_mse_{k}", ((y[some] - network.predict(x[some])) ** 2).mean()))
        if not folds:
            network.train(x[train], y[train])
        predicted[outside] = network.predict(tx[outside])
    out.append(metric("share_extrapolated", outside.mean() * 100 if len(outside) else 0.0))
    out += [("prediction", int(n), float(v), "network" if o else "forest") for n, v, o in zip(target["hour_no"], predicted, outside, strict=True)]
    return pd.DataFrame(out, columns=["what", "hour_no", "value", "name"])


def translate(load: DataFrame, base_weather: DataFrame, target_weather: DataFrame, keys: list[str], weather_keys: list[str], targets: list[str], features: list[str], temperature: str, settings: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """(profiles, fits), fitted when this is called. profiles: keys, target, ts, value for the target year; fits: keys, target, what,
    name, value.

    load: keys, ts and a column for each target; each key has one weather key (a column of load too)."""
    every = list(dict.fromkeys([*keys, *weather_keys]))
    long = load.select(*every, "ts", F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y")) for t in targets])).alias("x")).select(*every, "ts", "x.target", "x.y")
    # Sums decide which groups are fitted; they are few rows, and the join is by the same keys as the grouping that follows.
    own = [*keys, "target"]
    sums = long.groupBy(*own).agg(total("y").alias("_sum"))
    zero = sums.where(F.col("_sum") <= ZERO_LOAD)
    fitted = long.join(zero.select(*own), own, "left_anti")
    found = fit_predict(fitted, base_weather, target_weather, own, weather_keys, features, temperature, settings)
    # Written, so that profiles and metrics come from one fit, which a lost executor does not repeat.
    found = written(found)
    hours = numbered(target_weather, weather_keys, "ts", "hour_no").select(*weather_keys, "ts", "hour_no")
    groups = long.select(*dict.fromkeys([*own, *weather_keys])).distinct()
    stamped = groups.join(hours, weather_keys)
    predicted = found.where("what = 'prediction'").select(*own, "hour_no", "value")
    # Only groups whose loads sum to nothing are zero; a group that could not be fitted (no base weather) stays missing.
    nothing = zero.select(*own, F.lit(0.0).alias("_none"))
    raw = stamped.join(predicted, [*own, "hour_no"], "left").join(nothing, own, "left")
    raw = raw.withColumn("value", F.when(F.coalesce("value", "_none").isNotNull(), clip_low(F.coalesce("value", "_none"))))
    # Stamped an hour later, with the first hour repeated and the last dropped: each stamp keeps the value of the hour before.
    profiles = shifted_with_edge(raw.select(*own, "ts", "value"), own, "value")
    return profiles, found.where("what <> 'prediction'").select(*own, "what", "name", "value")


def against_actual(profiles: DataFrame, actual: DataFrame, keys: list[str], targets: list[str]) -> DataFrame:
    """keys, target, ts, predicted, actual of hours that both sides have: the points of a scatter chart, and what metrics are taken of.

    Groups whose load is zero take part like others."""
    long = actual.select(*keys, "ts", F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("actual")) for t in targets])).alias("x"))
    return profiles.withColumnRenamed("value", "predicted").join(long.select(*keys, "ts", "x.target", "x.actual"), [*keys, "target", "ts"])


def target_year_test(profiles: DataFrame, actual: DataFrame, keys: list[str], targets: list[str]) -> DataFrame:
    """MAE, MSE and R2 of profiles against loads that were metered in the target year."""
    return model_metrics(against_actual(profiles, actual, keys, targets), [*keys, "target"], "actual", "predicted")
