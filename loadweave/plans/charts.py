"""Charts of a comparison as SVG, drawn from tables that Spark has made small first.

Scatters are counts of points in cells of a grid, so their size does not grow with the hours; other charts have a point for each
month, county shown, or hour of a month. `points` gives each chart's table, `draw` its picture."""

from __future__ import annotations

from html import escape

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct_diff
from ..operators import relational, series, stats
from ..sources.scratch import written

#: Cells of a scatter in each direction.
CELLS = 60
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_W, _H, _M = 480, 360, 46


def cells(pairs: DataFrame, of: Column, bins: int = CELLS) -> DataFrame:
    """of, x, y, n, low, high, mae, nmae: how many points (ref, reg) of each scatter lie in each cell of its grid from low to high.

    Only points with both values. `of` tells the scatters apart; a scatter whose values are all one has one cell.
    Points are written when this is called: sums of doubles that are computed twice may differ in the last digit, and the lowest
    point would then lie below its own grid."""
    known = written(pairs.select(of.alias("of"), "ref", "reg").where(F.col("ref").isNotNull() & F.col("reg").isNotNull()))
    errors = stats.errors(known, ["of"]).select("of", "mae", "nmae")
    limits = known.groupBy("of").agg(F.min(F.least("ref", "reg")).alias("low"), F.max(F.greatest("ref", "reg")).alias("high"))
    cell = lambda v: F.when(F.col("high") > F.col("low"), F.least(F.lit(bins - 1), F.floor((F.col(v) - F.col("low")) / (F.col("high") - F.col("low")) * bins))).otherwise(0).cast("int")
    placed = known.join(limits, "of").groupBy("of", "low", "high", cell("ref").alias("x"), cell("reg").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return placed.join(errors, "of")


def ranked(pairs: DataFrame, entity: str, by: DataFrame, value: str) -> DataFrame:
    """cells of the best, middle and worst entities by a value; `of` is the entity and its group."""
    chosen = relational.best_middle_worst(by, value, entity).select(entity, "group")
    # An entity may be in two groups when there are few.
    return cells(pairs.join(chosen, entity), F.concat(F.col(entity).cast("string"), F.lit(" ("), "group", F.lit(")")))


def chosen(pairs: DataFrame, entity: str, wanted: DataFrame) -> DataFrame:
    """cells of wanted entities that have points."""
    there = relational.in_all(wanted, [entity], pairs)
    return cells(pairs.join(there, entity, "left_semi"), F.col(entity).cast("string"))


def profile(pairs: DataFrame, ts: str = "ts") -> DataFrame:
    """month, hour_of_month, ref, reg: the first year's hours of each month, at most 744 a month."""
    known = pairs.where(F.col("ref").isNotNull() & F.col("reg").isNotNull())
    place = F.row_number().over(Window.partitionBy(F.month(ts)).orderBy(ts)) - 1
    return known.select(F.month(ts).alias("month"), place.alias("hour_of_month"), "ref", "reg").where("hour_of_month < 744")


def points(pairs: DataFrame, national: DataFrame, zones: DataFrame | None = None, targets: list[str] | None = None, entity: str = "fips") -> dict[str, DataFrame]:
    """The table of each chart. pairs: entity, ts, ref, reg; national: ts, ref, reg; zones: entity, ba; targets: zones whose counties
    get scatters of their own, whatever the case of their letters."""
    pct = stats.annual_pct_diff(pairs, [entity])
    errors = stats.errors(pairs, [entity])
    out = {
        "monthly bars": series.by_month_of(national, [], ["ref", "reg"]).withColumn("pct", pct_diff(F.col("ref"), F.col("reg"))),
        "top counties": relational.extremes(pct, "pct_diff", entity),
        "daily scatter": cells(series.by_day_of(national, [], ["ref", "reg"]), F.lit("daily totals")),
        "hourly scatter": cells(national, F.lit("hourly totals")),
        "profile by month": profile(national),
        "ranked scatters": ranked(pairs, entity, errors, "nmae"),
    }
    if zones is not None and targets:
        wanted = zones.where(F.lower("ba").isin(*[t.lower() for t in targets])).select(entity)
        out["target zone scatters"] = chosen(pairs, entity, wanted)
    return out


def fit_points(profiles: DataFrame) -> dict[str, DataFrame]:
    """Charts of predictions beside what was metered. profiles: keys, target, ts, predicted, actual (regress.against_actual)."""
    pairs = profiles.select("target", "ts", F.col("actual").alias("ref"), F.col("predicted").alias("reg"))
    by_hour = pairs.groupBy("ts").agg(F.sum("ref").alias("ref"), F.sum("reg").alias("reg"))
    return {"predicted over actual": cells(pairs, F.col("target")), "fit by month": profile(by_hour)}


def _svg(body: str, title: str, width: int = _W, height: int = _H) -> str:
    return f"<svg xmlns='http://www.w3.org/2000/svg' viewBox='0 0 {width} {height}' width='{width}' height='{height}'><text x='{width / 2}' y='18' text-anchor='middle' font-size='13'>{escape(title)}</text>{body}</svg>"


def _text(x: float, y: float, s: str, anchor: str = "middle") -> str:
    return f"<text x='{x:.1f}' y='{y:.1f}' font-size='10' text-anchor='{anchor}'>{escape(s)}</text>"


def _line(x1: float, y1: float, x2: float, y2: float, style: str = "stroke='#444'") -> str:
    return f"<line x1='{x1:.1f}' y1='{y1:.1f}' x2='{x2:.1f}' y2='{y2:.1f}' {style}/>"


def _bars(rows: list, title: str) -> str:
    """Percent differences by month, up or down from zero; a month without a reference has none."""
    values = [(r["month"], r["pct"]) for r in sorted(rows, key=lambda r: r["month"])]
    most = max([abs(v) for _, v in values if v is not None], default=0) or 1.0
    half, middle, wide = (_H - 2 * _M) / 2, _H / 2, (_W - 2 * _M) / 12
    body = _line(_M, middle, _W - _M, middle)
    for month, v in values:
        x = _M + (month - 1) * wide
        body += _text(x + wide / 2, _H - _M + 14, MONTHS[month - 1])
        if v is not None:
            size = abs(v) / most * half
            body += f"<rect x='{x + 3:.1f}' y='{middle - size if v > 0 else middle:.1f}' width='{wide - 6:.1f}' height='{size:.1f}' fill='#3b82f6'><title>{v:.2f} %</title></rect>"
    return _svg(body + _text(_M - 4, _M, f"{most:.3g} %", "end") + _text(_M - 4, _H - _M, f"-{most:.3g} %", "end"), title)


def _side_bars(rows: list, title: str) -> str:
    """Percent differences of counties, the highest on top."""
    key = next(k for k in rows[0].asDict() if k not in ("pct_diff", "side", "ref", "reg")) if rows else ""
    shown = sorted({(r["pct_diff"], str(r[key])) for r in rows}, reverse=True)
    most = max([abs(v) for v, _ in shown], default=0) or 1.0
    high, middle, half = (_H - 2 * _M) / max(1, len(shown)), _W / 2, _W / 2 - 2 * _M
    body = _line(middle, _M, middle, _H - _M)
    for k, (v, name) in enumerate(shown):
        size, y = abs(v) / most * half, _M + k * high
        body += f"<rect x='{middle if v >= 0 else middle - size:.1f}' y='{y + 1:.1f}' width='{size:.1f}' height='{high - 2:.1f}' fill='{'#16a34a' if v >= 0 else '#dc2626'}'/>"
        body += _text(4, y + high / 2 + 3, name, "start") + _text(_W - 4, y + high / 2 + 3, f"{v:.2f} %", "end")
    return _svg(body, title)


def _scatter(rows: list, title: str) -> str:
    """Cells as squares, darker the more points they hold, and the line where both sides are equal."""
    first, most, side = rows[0], max(r["n"] for r in rows), (_H - 2 * _M) / CELLS
    edge = _M + CELLS * side
    body = _line(_M, edge, edge, _M, "stroke='#000' stroke-dasharray='4 3'")
    for r in rows:
        body += f"<rect x='{_M + r['x'] * side:.1f}' y='{edge - (r['y'] + 1) * side:.1f}' width='{side:.1f}' height='{side:.1f}' fill='#4338ca' fill-opacity='{0.25 + 0.75 * r['n'] / most:.2f}'><title>{r['n']}</title></rect>"
    note = f"MAE {first['mae']:.3f}" + (f", NMAE {100 * first['nmae']:.2f} %" if first["nmae"] is not None else "")
    body += _text(_M, edge + 14, f"{first['low']:.3g}") + _text(edge, edge + 14, f"{first['high']:.3g}") + _text((_M + edge) / 2, edge + 26, "reference, regression upwards") + _text(_M + 4, _M + 10, note, "start")
    return _svg(body, title)


def _scatters(rows: list, title: str) -> str:
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r["of"], []).append(r)
    return "".join(_scatter(own, f"{title}: {name}") for name, own in sorted(by.items()))


def _panels(rows: list, title: str) -> str:
    """Twelve panels, one below the other, with a line for each side; a month without hours says so."""
    high, width = 70, 900
    body = ""
    for month in range(1, 13):
        own = sorted((r for r in rows if r["month"] == month), key=lambda r: r["hour_of_month"])
        top = _M + (month - 1) * high
        body += _text(4, top + high / 2, MONTHS[month - 1], "start")
        if not own:
            body += _text(width / 2, top + high / 2, "no data")
            continue
        low, most = min(min(r["ref"], r["reg"]) for r in own), max(max(r["ref"], r["reg"]) for r in own)
        at = lambda r, v: f"{_M + r['hour_of_month'] / 744 * (width - 2 * _M):.1f},{top + high - 6 - (r[v] - low) / ((most - low) or 1) * (high - 12):.1f}"  # noqa: E731, B023
        for v, color in (("ref", "#111827"), ("reg", "#2563eb")):
            body += f"<polyline fill='none' stroke='{color}' stroke-width='0.8' points='{' '.join(at(r, v) for r in own)}'/>"
    return _svg(body + _text(width / 2, _M + 12 * high + 14, "hour of month; black: reference, blue: regression"), title, width, _M * 2 + 12 * high)


_DRAWN = {"monthly bars": _bars, "top counties": _side_bars, "profile by month": _panels, "fit by month": _panels}


def draw(name: str, df: DataFrame) -> str:
    """The picture of a chart's table; empty without rows."""
    rows = df.collect()
    return _DRAWN.get(name, _scatters)(rows, name[:1].upper() + name[1:]) if rows else ""
