"""Comparison of a regressed profile with a reference profile: tables for reports and charts, and the report itself."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normal_fips
from ..operators import ranking, relational, rollup, series, stats
from ..sources import readers, writers
from ..sources.scratch import written
from ..sources.writers import html_table
from . import charts


def national(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("ts").agg(F.sum("ref").alias("ref"), F.sum("reg").alias("reg"))


def of_zones(pairs: DataFrame, zones: DataFrame) -> DataFrame:
    """zone, ts, ref, reg; counties without a zone are one zone, `unmapped`."""
    return rollup.rolled_up_all(pairs.select("fips", "ts", "ref", "reg"), zones, "fips", "ba", "ts", ["ref", "reg"], unmapped="unmapped")


def tables(ref: DataFrame, reg: DataFrame, zones: DataFrame, given: tuple[DataFrame, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All tables by name. ref, reg: ts, fips, gwh; zones: fips, ba, county, state. given: both sides as they came, if ref and reg are
    aligned already; alignment is counted on them."""
    given = given or (ref, reg)
    pairs = relational.aligned(ref, reg, ["ts", "fips"], "gwh")
    whole, ba = national(pairs), of_zones(pairs, zones)
    county_errors, county_pct = stats.errors(pairs, ["fips"]), stats.annual_pct_diff(pairs, ["fips"])
    return {
        "stamps": relational.alignment(*given, ["ts"]),
        "counties": relational.alignment(*given, ["fips"]),
        "unmapped counties": pairs.select("fips").distinct().join(zones, "fips", "left_anti"),
        "zones by state": stats.state_lists(zones, "ba", "state"),
        "national total": stats.annual_pct_diff(whole, []),
        "national by month": series.by_month_of(whole, [], ["ref", "reg"]),
        "national by season": series.by_season_of(whole, [], ["ref", "reg"]),
        "national errors": stats.errors(whole, []),
        "national hourly correlation": stats.hourly_correlation(whole),
        "national daily correlation": stats.daily_correlation(whole),
        "diurnal correlation by month": stats.diurnal_correlation(whole, F.month("ts"), F.hour("ts")),
        "national peaks": stats.peaks(whole, []),
        "national percentiles": ranking.percentiles(whole),
        "county percent difference": stats.across(county_pct, "pct_diff", "fips"),
        "county extremes": relational.extremes(county_pct, "pct_diff", "fips"),
        "county errors": stats.across(county_errors, "nmae", "fips"),
        "county month error": stats.month_mape(pairs, ["fips"]),
        "county peaks": stats.across(stats.peaks(pairs, ["fips"]).select("fips", "peak_pct_diff"), "peak_pct_diff", "fips"),
        "counties, best, middle, worst": relational.best_middle_worst(county_errors.select("fips", "nmae"), "nmae", "fips"),
        "zone percent difference": stats.annual_pct_diff(ba, ["ba"]),
        "zone errors": stats.errors(ba, ["ba"]),
        "zone peaks": stats.peaks(ba, ["ba"]),
    }


def chart_data(ref: DataFrame, reg: DataFrame, zones: DataFrame | None = None, targets: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables of all charts (charts.points): bounded by months, counties shown, cells of a grid, or hours of a month."""
    pairs = relational.aligned(ref, reg, ["ts", "fips"], "gwh")
    return charts.points(pairs, national(pairs), zones, targets)


def read_pair(spark: SparkSession, ref: str, reg: str) -> tuple[DataFrame, DataFrame]:
    """Two wide CSV files as ts, fips, gwh; an error unless their headers name the same series in the same order."""
    heads = [spark.read.option("header", True).option("escape", '"').csv(path) for path in (ref, reg)]
    relational.require_same_columns(*[df.select(*[F.col(f"`{c}`") for c in df.columns[1:]]) for df in heads])
    sides = [readers.wide_series(spark, path) for path in (ref, reg)]
    return tuple(df.withColumn("fips", normal_fips(F.col("fips"))) for df in sides)


def warnings(ref: DataFrame, reg: DataFrame, zones: DataFrame, targets: list[str] | None = None) -> list[str]:
    out = []
    found = {r[0] for r in zones.where(F.lower("ba").isin(*[t.lower() for t in targets])).join(ref, "fips", "left_semi").select(F.lower("ba")).distinct().collect()} if targets else set()
    out += [f"no county of zone {t} in the inputs" for t in targets or [] if t.lower() not in found]
    for what, keys in (("stamps", ["ts"]), ("counties", ["fips"])):
        r = relational.alignment(ref, reg, keys).first()
        if r["ref_only"] or r["reg_only"]:
            out.append(f"{r['ref_only']} {what} only in the reference, {r['reg_only']} only in the regression")
    lost = ref.select("fips").distinct().join(zones, "fips", "left_anti").orderBy("fips").limit(5).collect()
    if lost:
        out.append(f"counties without a zone, such as {[x[0] for x in lost]}")
    return out


def report(ref: DataFrame, reg: DataFrame, zones: DataFrame, title: str, targets: list[str] | None = None) -> str:
    """The report as HTML, with tables and charts. Only tables of bounded size reach the driver.

    targets: zones whose counties get scatters of their own. Every series is in the comparison only if both sides have it."""
    notes = "".join(f"<li>{escape(w)}</li>" for w in warnings(ref, reg, zones, targets)) or "<li>none</li>"
    # Read by every table: written once.
    pairs = written(relational.aligned(ref, reg, ["ts", "fips"], "gwh"))
    sides = [pairs.select("ts", "fips", F.col(v).alias("gwh")) for v in ("ref", "reg")]
    body = "".join(html_table(df, name) for name, df in tables(*sides, zones, (ref, reg)).items())
    pictures = "".join(f"<figure>{charts.draw(name, df)}</figure>" for name, df in charts.points(pairs, national(pairs), zones, targets).items())
    head = f"<head><meta charset='utf-8'><title>{escape(title)}</title></head>"
    return f"<!doctype html><html>{head}<body><h1>{escape(title)}</h1><h2>Warnings</h2><ul>{notes}</ul>{body}<h2>Charts</h2>{pictures}</body></html>"


def files_report(files: DataFrame, step: int) -> DataFrame:
    """line, by prefix and upgrade: how many chunk files there are, the first and the last, the ranges that are missing, and places where
    a file does not end where the next one begins. files: prefix, upgrade, start, end (readers.chunk_files).

    Rows are sorted while one of them still stands for a stretch of missing ranges; their lines follow in place."""
    keys = ["prefix", "upgrade"]
    name = lambda a, b: writers.chunk_name("", "", F.col("upgrade"), F.col(a), F.col(b))
    named = lambda a, b: F.concat("prefix", name(a, b))
    of = series.summary(files, "start", "end", keys)
    heads = F.array(
        F.concat(F.lit("Results for "), "prefix", F.lit(" (upgrade "), F.col("upgrade").cast("string"), F.lit("):")),
        F.concat(F.lit("Total files found: "), F.col("n").cast("string")),
        F.concat(F.lit("First file: "), named("first_start", "first_end")), F.concat(F.lit("Last file: "), named("last_start", "last_end")),
    )
    whole = lambda c: F.col(c).cast("long").alias(c)
    row = lambda df, part, text: df.select(*keys, F.lit(part).alias("part"), whole("_from"), whole("_to"), whole("_next"), text.alias("text"))
    line = lambda df, part, at: row(df.withColumns({"_from": F.col(at), "_to": F.col(at), "_next": F.lit(None)}), part, F.col("text"))
    rows = line(of.select(*keys, F.posexplode(heads).alias("at", "text")), 0, "at")
    rows = rows.unionByName(row(series.stretches(files, "start", "end", step, keys), 1, F.lit(None).cast("string")))
    neighbours = files.withColumns({c: F.lead(d).over(Window.partitionBy(*keys).orderBy("start")) for c, d in (("next_start", "start"), ("next_end", "end"))})
    off = neighbours.where("next_start <> end").withColumn("text", F.concat(F.lit("Misaligned: "), named("start", "end"), F.lit(" -> "), named("next_start", "next_end")))
    rows = rows.unionByName(line(off, 2, "start"))
    order = [*keys, "part", "_from"]
    dealt = rows.repartitionByRange(series.partitions(files.sparkSession), *order).sortWithinPartitions(*order)
    each = dealt.withColumn("gap_start", F.explode_outer(F.sequence("_from", "_to", F.lit(step)))).withColumn("gap_end", F.least(F.col("gap_start") + step, F.col("_next")))
    return each.select(F.when(F.col("part") == 1, F.concat(F.lit("Missing: "), named("gap_start", "gap_end"))).otherwise(F.col("text")).alias("line"))
