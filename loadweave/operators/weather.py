"""Features of weather for the regression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_weekend
from .series import filled, lagged

#: Hours back (negative: ahead) of the temperature that models see.
LAGS = [-1, 1, 3, 6, 12]
MEASURES = ["dry_bulb", "humidity", "wind_speed", "wind_direction", "global_radiation", "direct_radiation", "diffuse_radiation"]


def weather_features(weather: DataFrame, keys: list[str], measures: list[str] | None = None, lags: list[int] | None = None, temperature: str = "dry_bulb", ts: str = "ts") -> DataFrame:
    """Measures, hour of day, weekend flag and lagged temperatures; gaps take the next known value, then the last."""
    measures, lags = measures or MEASURES, LAGS if lags is None else lags
    df = lagged(weather.select(*keys, ts, *measures), keys, temperature, lags, ts)
    df = filled(df, keys, [c for c in df.columns if c not in (*keys, ts)], ts)
    return df.withColumns({"hour": F.hour(ts), "weekend": is_weekend(F.col(ts))})


def feature_names(measures: list[str], lags: list[int], temperature: str) -> list[str]:
    return [*measures, "hour", "weekend", *[f"{temperature}_lag_{'m' if k < 0 else ''}{abs(k)}" for k in lags]]
