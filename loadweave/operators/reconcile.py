"""Reconciliation of annual totals from metadata, from load series and from the regression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct_diff, ratio

_PAIRS = (("series", "meta"), ("reg", "meta"), ("reg", "series"))


def reconcile(meta: DataFrame, series: DataFrame, regressed: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """meta's rows with the totals of the other two, six ratios and six percent differences for two measures.

    Columns: {measure}_meta, _series, _reg, ratio_{measure}_{a}_{b}, diff_{measure}_{a}_{b}. Groups that the others lack
    keep their row with NULLs. All three sides are grouped by the same keys, so their joins need no shuffle of their own
    beyond the grouping."""
    side = lambda df, name: df.select(*keys, *[F.col(m).alias(f"{m}_{name}") for m in measures])
    out = side(meta, "meta").join(side(series, "series"), keys, "left").join(side(regressed, "reg"), keys, "left")
    new = {f"ratio_{m}_{a}_{b}": ratio(F.col(f"{m}_{a}"), F.col(f"{m}_{b}")) for m in measures for a, b in _PAIRS}
    new |= {f"diff_{m}_{a}_{b}": F.bround(pct_diff(F.col(f"{m}_{b}"), F.col(f"{m}_{a}")), 4) for m in measures for a, b in _PAIRS}
    return out.withColumns(new)
