"""The command line: `python -m loadweave run ...` for one run, `report ...` for a comparison, `files ...` for a check of chunk files."""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import flow, validation
from .sources import readers, schema, snapshot, writers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loadweave", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="roll up, regress to the target year, reconcile and write")
    run.add_argument("config", help="JSON file of settings")
    run.add_argument("buildings", help="Parquet metadata")
    run.add_argument("loads", help="Parquet loads")
    run.add_argument("weather", help="folder of weather CSV files")
    run.add_argument("output", help="folder to write to")
    run.add_argument("--keys", default="county,state", help="grouping columns, joined by commas")
    run.add_argument("--counties", help="counties of this run, joined by _; all without it")
    run.add_argument("--code", help="working folder of the code, for the commit in the snapshot")
    report = commands.add_parser("report", help="compare two wide CSV files as HTML")
    for name in ("reference", "regression", "zones", "output"):
        report.add_argument(name)
    report.add_argument("--title", default="comparison")
    report.add_argument("--targets", default="", help="zones with scatters of their own, joined by commas")
    files = commands.add_parser("files", help="missing and misaligned chunk files")
    files.add_argument("folder")
    files.add_argument("--step", type=int, default=readers.RunConfig.chunk_size)
    files.add_argument("--output", help="text file to write the lines to")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    """Runs a command and gives the names or lines it wrote."""
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("loadweave").getOrCreate()
    if a.command == "report":
        ref, reg = validation.read_pair(spark, a.reference, a.regression)
        html = validation.report(ref, reg, readers.zones(spark, a.zones), a.title, [t for t in a.targets.split(",") if t])
        writers.write_text(spark, [html], a.output)
        return [a.output]
    if a.command == "files":
        lines = [r["line"] for r in validation.files_report(readers.chunk_files(spark, a.folder).drop("path"), a.step).collect()]
        if a.output:
            writers.write_text(spark, lines, a.output)
        return lines
    config = readers.RunConfig.load(a.config)
    snapshot.take(spark, f"{a.output.rstrip('/')}/run", {"config.json": a.config}, a.code, **dataclasses.asdict(config))
    meta = schema.resolve(spark.read.parquet(a.buildings), config)
    if a.counties:
        meta = dataclasses.replace(meta, df=meta.df.where(F.col("county").isin(*a.counties.split("_"))))
    loads = schema.resolve(spark.read.parquet(a.loads), config, ("bldg_id", "ts"))
    weather = readers.weather(spark, a.weather)
    if "weather_county" in a.keys.split(","):
        config = dataclasses.replace(config, weather_county_column="weather_county")
    # What metadata say of a building is taken from there.
    only = [c for c in ("bldg_id", "upgrade", "ts", *loads.electric, *loads.gas) if c in loads.df.columns]
    result = flow.run(config, meta.df, loads.df.select(*only), weather, a.keys.split(","), loads.electric, loads.gas)
    flow.save(result, f"{a.output.rstrip('/')}/tables")
    return flow.export(result, config, a.keys.split(","), f"{a.output.rstrip('/')}/csv")


if __name__ == "__main__":
    print("\n".join(main()))
