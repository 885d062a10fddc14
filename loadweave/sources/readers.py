"""Readers. Schemas are given, not inferred, so no file is read twice; partitions and columns are pruned by the planner."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parsed
from ..functions.text import normal_fips, title_case
from ..operators.relational import keep_last
from .wide import number, wide_files


def buildings(spark: SparkSession, root: str, schema: T.StructType | str, states: list[str] | None = None, counties: list[str] | None = None, state: str = "state", county: str = "county") -> DataFrame:
    """Building metadata under directories state=../county=.. (also URL-escaped); state and county become columns, and filters on them skip directories."""
    df = spark.read.schema(schema).option("basePath", root).option("ignoreMissingFiles", "true").parquet(root)
    if states:
        df = df.where(F.col(state).isin(*states))
    if counties:
        df = df.where(F.col(county).isin(*counties))
    return df


def readable(spark: SparkSession, root: str, schema: T.StructType | str, state: str = "state", county: str = "county") -> tuple[DataFrame, DataFrame]:
    """(rows, skipped): buildings() without the files that cannot be read, and the names of these, (file, state, county).

    Files that are there are compared with files that rows came from, so a file is skipped if no row of it was read: it is broken,
    or gone meanwhile, or has no rows. One that breaks off later gives the rows before that. An error if no file gives a row."""
    reader = spark.read.schema(schema).option("basePath", root).option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    df = reader.parquet(root)
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.col("path").alias("file"), "length")
    there = there.where(~F.col("file").rlike(r"/[._][^/=]*(/|$)"))
    plain = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    read = df.select(plain(F.col("_metadata.file_path")).alias("of")).distinct()
    if read.isEmpty():
        raise FileNotFoundError(f"no file under {root} can be read")
    part = lambda k: F.url_decode(F.regexp_extract("file", rf"/{k}(?:=|%3D)([^/]*)/", 1)).alias(k)
    skipped = there.withColumn("of", plain(F.col("file"))).join(read, "of", "left_anti").select("file", part(state), part(county))
    return df, skipped


def require(df: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """df, if it has rows of every expected partition; else an error that names some that are missing."""
    missing = expected.select(*on).distinct().join(df.select(*on).distinct(), on, "left_anti").orderBy(*on).limit(5).collect()
    if missing:
        raise FileNotFoundError(f"no rows of {[tuple(r) for r in missing]}")
    return df


def with_path_values(df: DataFrame, **patterns: str) -> DataFrame:
    """Columns from the path of the file each row comes from: name = pattern with one group."""
    return df.withColumns({name: F.regexp_extract(F.input_file_name(), pattern, 1) for name, pattern in patterns.items()})


def lookup(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Some columns of a CSV with a header, renamed: {file's name: our name}; all are text."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    return df.select(*[F.trim(F.col(f"`{a}`")).alias(b) for a, b in columns.items()]).distinct()


def zones(spark: SparkSession, path: str) -> DataFrame:
    """County-to-zone table: fips without leading zeros, zone, county, state; one row for each county, the first in the file."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    cols = {c.lower(): c for c in df.columns}
    place = F.struct(F.input_file_name(), F.monotonically_increasing_id())
    trimmed = lambda name: F.trim(F.col(f"`{cols[name]}`"))
    values = F.struct(trimmed("ba").alias("ba"), title_case(trimmed("county_name")).alias("county"), trimmed("state").alias("state"))
    picked = df.select(normal_fips(F.col(cols["fips"])).alias("fips"), values.alias("x"), place.alias("at"))
    return picked.groupBy("fips").agg(F.min_by("x", "at").alias("x")).select("fips", "x.*")


# Columns of weather files, and our names.
WEATHER_COLUMNS = {
    "Dry Bulb Temperature [°C]": "dry_bulb", "Relative Humidity [%]": "humidity", "Wind Speed [m/s]": "wind_speed", "Wind Direction [Deg]": "wind_direction",
    "Global Horizontal Radiation [W/m2]": "global_radiation", "Direct Normal Radiation [W/m2]": "direct_radiation", "Diffuse Horizontal Radiation [W/m2]": "diffuse_radiation",
}


def weather(spark: SparkSession, root: str, year: int | None = None) -> DataFrame:
    """Hourly weather of files state=XX/{county}_{year}.csv: state, county, year, ts, measures. One scan over all files."""
    schema = T.StructType([T.StructField("date_time", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in WEATHER_COLUMNS]])
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("basePath", root).option("pathGlobFilter", f"*_{year}.csv" if year else "*.csv").csv(root)
    df = with_path_values(df, county=r"([^/]+)_\d{4}\.csv", year=r"_(\d{4})\.csv")
    measures = [F.when(~F.isnan(F.col(f"`{a}`")), F.col(f"`{a}`")).alias(b) for a, b in WEATHER_COLUMNS.items()]
    state = [F.col("state")] if "state" in df.columns else []
    return df.select(*state, "county", F.col("year").cast("int").alias("year"), parsed(F.col("date_time")).alias("ts"), *measures)


def wide_series(spark: SparkSession, path: str, name: str = "fips", value: str = "gwh", formats: tuple[str, ...] = ("M/d/yyyy H:mm", "M/d/yyyy")) -> DataFrame:
    """A wide CSV (stamps, then a column for each series) as a long table (ts, name, value).

    Of rows with the same stamp the last counts. Stamps that no format fits are an error with samples, as is a file without rows;
    fields that are no numbers are an error when the plan runs."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    first, *series = raw.columns
    if not series:
        raise ValueError(f"{path} has no series")
    rows = raw.withColumn("_at", F.struct(F.input_file_name(), F.monotonically_increasing_id())).withColumn("ts", parsed(F.col(f"`{first}`"), *formats))
    bad = [r[0] for r in rows.where(F.col("ts").isNull()).select(F.col(f"`{first}`")).limit(5).collect()]
    if bad:
        raise ValueError(f"{path}: stamps that cannot be read, such as {bad}")
    rows = keep_last(rows, ["ts"], "_at")
    if rows.isEmpty():
        raise ValueError(f"{path} has no rows")
    long = rows.select("ts", *[F.col(f"`{c}`") for c in series]).unpivot(["ts"], [F.col(f"`{c}`") for c in series], name, value)
    return long.withColumn(value, number(F.col(value), F.col(name)))


def chunk_series(spark: SparkSession, folder: str, prefix: str, upgrade: int) -> DataFrame:
    """(ts, bldg_id, mwh) of all chunk files of exactly this upgrade; each file has columns of its own (wide.wide_files)."""
    return wide_files(spark, folder, f"{prefix}_upgrade{upgrade}_*-*.csv", "bldg_id", "mwh").drop("file")


def chunk_files(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk files in a folder that Spark can list: path, prefix, upgrade, start, end, from names {prefix}_upgrade{u}_{start}-{end}.csv."""
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*_upgrade*_*-*.csv").load(folder).select("path")
    return parsed_chunk_names(paths, "path")


def parsed_chunk_names(df: DataFrame, path: str) -> DataFrame:
    part = lambda k: F.regexp_extract(path, r"([^/]*?)_upgrade(\d+)_(\d{4,})-(\d{4,})\.csv$", k)
    found = df.where(F.col(path).rlike(r"_upgrade\d+_\d{4,}-\d{4,}\.csv$"))
    return found.select(path, part(1).alias("prefix"), part(2).cast("int").alias("upgrade"), part(3).cast("int").alias("start"), part(4).cast("int").alias("end"))


#: Answers of a server that may be better a little later.
PASSING_CODES = (500, 503)


def passing(error: BaseException) -> bool:
    """Whether trying again may help: connections and timeouts, and the codes above; not wrong names, types, plans or rights."""
    code = getattr(error, "code", None) or getattr(getattr(error, "response", None), "status_code", None)
    if isinstance(code, int):
        return code in PASSING_CODES
    if isinstance(error, (FileNotFoundError, FileExistsError, PermissionError, IsADirectoryError, NotADirectoryError)):
        return False
    if isinstance(error, OSError):
        return True
    # What Java threw reaches Python as text only.
    known = r"SocketTimeoutException|ConnectException|UnknownHostException|ConnectionReset|NoHttpResponse|SocketException"
    return bool(re.search(rf"{known}|[Ss]tatus [Cc]ode:? (?:{'|'.join(map(str, PASSING_CODES))})\b", str(error)))


def retried(action: Callable[[], DataFrame], times: int = 5, wait: float = 10.0) -> DataFrame:
    """The result of an action on a remote source, tried again after a pause if the error is a passing one.

    Tasks have Spark's own retries besides."""
    for k in range(times):
        try:
            return action()
        except Exception as error:
            if k == times - 1 or not passing(error):
                raise
            time.sleep(wait)
    raise ValueError("times must be at least 1")


@dataclass(frozen=True)
class RunConfig:
    """One run's settings, from a JSON file; names that a file does not have keep their defaults."""

    stock: str = "commercial"
    release: str = "2025.2"
    upgrades: tuple[int, ...] = (0,)
    baseline: int = 0
    savings: bool = False
    building_column: str = "bldg_id"
    county_column: str = "county"
    weather_county_column: str | None = None
    base_year: int = 2018
    target_year: int = 2012
    applied_only: bool = False
    lags: tuple[int, ...] = (-1, 1, 3, 6, 12)
    folds: int = 0
    chunk_size: int = 150
    states: tuple[str, ...] = ()
    test_mode: bool = False
    upgrade_names: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> RunConfig:
        with open(path) as f:
            return cls.of(json.load(f))

    @classmethod
    def of(cls, values: dict) -> RunConfig:
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in cls.__dataclass_fields__}
        config = cls(**known)
        if config.base_year == config.target_year:
            raise ValueError("base and target year are the same")
        return config

    def weather_county(self) -> str:
        return self.weather_county_column or self.county_column

    def scope(self, df: DataFrame, state: str = "state") -> DataFrame:
        """df in the states of this run; a test run takes one small state. Alaska and Hawaii are never in."""
        from ..operators.relational import not_in

        df = df.where(not_in(F.col(state), "AK", "HI"))
        if self.test_mode:
            return df.where(F.col(state) == "VT")
        return df.where(F.col(state).isin(*self.states)) if self.states else df


# End uses by stock.
ELECTRIC_USES = {
    "commercial": ["heating", "cooling", "fans", "heat_recovery", "heat_rejection", "pumps"],
    "residential": ["heating", "heating_fans_pumps", "heating_hp_bkup", "heating_hp_bkup_fa", "cooling", "cooling_fans_pumps"],
}
GAS_USES = {"commercial": ["heating"], "residential": ["heating"]}


def end_uses(stock: str, suffix: str = "..kwh", prefix: str = "out.") -> tuple[list[str], list[str]]:
    """Columns of a stock's electric and gas end uses."""
    name = lambda fuel, use: f"{prefix}{fuel}.{use}.energy_consumption{suffix}"
    return [name("electricity", u) for u in ELECTRIC_USES[stock]], [name("natural_gas", u) for u in GAS_USES[stock]]


def plain_names(df: DataFrame) -> DataFrame:
    """Column names without `out.`, `..kwh` and `__baseline`, and with _ for the dots that are left."""
    def plain(c: str) -> str:
        return c.removesuffix("__baseline").removeprefix("out.").replace("..kwh", "").replace("..", "_").replace(".", "_")

    return df.toDF(*map(plain, df.columns))
