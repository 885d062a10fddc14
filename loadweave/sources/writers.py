"""Writers. Large results are partitioned Parquet; CSV is for people and other tools."""

from __future__ import annotations

import json
import time
import uuid
from html import escape
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fixed, html_escape, padded
from ..operators.relational import pivoted
from . import files
from .wide import csv_text


def to_parquet(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Rows of a partition are brought together first, so each partition has few files. The default mode never overwrites."""
    if by:
        df = df.repartition(*by)
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Writes df by partition; partitions that df has rows of are replaced, all others stay. Without `by` the whole table is replaced.

    Written again by the same run, a table is the same as before."""
    if not by:
        df.write.mode("overwrite").parquet(path)
        return
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def to_csv(df: DataFrame, path: str, single: bool = False, mode: str = "errorifexists", header: bool = True) -> None:
    (df.coalesce(1) if single else df).write.mode(mode).option("header", header).option("escape", '"').csv(path)


def append_metrics(df: DataFrame, path: str, run: str | None = None, chunk: int = 0) -> None:
    """Adds the metrics of one chunk of one run. A task that is repeated replaces its own rows, so they are there once.

    run and chunk become columns; a run's name is any text, without one a new name is made up."""
    run = run or f"run-{uuid.uuid4().hex}"
    replace_partitions(df.withColumns({"run": F.lit(run), "chunk": F.lit(chunk)}), path, ["run", "chunk"])


def metrics_csv(spark: SparkSession, path: str, file: str) -> None:
    """All metrics that were added under path as one CSV file with one header, ordered by run, chunk and the other columns."""
    df = spark.read.parquet(path)
    first = ["run", "chunk"]
    df = df.select(*first, *[c for c in df.columns if c not in first])
    folder, _, name = file.rpartition("/")
    named_csv(df.withColumn("_file", F.lit(name)), folder, "_file", list(df.columns))


def chunk_name(prefix: str, kind: str, upgrade: Column, start: Column, end: Column) -> Column:
    """{prefix}{kind}_upgrade{u}_{start}-{end}.csv, start and end with four digits at least."""
    return F.concat(F.lit(f"{prefix}{kind}_upgrade"), upgrade.cast("string"), F.lit("_"), padded(start), F.lit("-"), padded(end), F.lit(".csv"))


def _commit(df: DataFrame, folder: str, file: str) -> list[str]:
    """Lines (file, at, text) as one file for each value of `file`, by `at`. Everything is written beside the folder first and
    renamed at the end, so a file is there whole or not at all, and a repeated run replaces it. Gives the names."""
    spark = df.sparkSession
    stage = f"{folder.rstrip('/')}/_stage-{uuid.uuid4().hex}"
    try:
        dealt = df.repartition(file).sortWithinPartitions(file, "at").select(file, "text")
        dealt.write.partitionBy(file).option("maxRecordsPerFile", 0).text(stage)
        done = []
        for part in files.names(spark, stage):
            if "=" in part:
                name = unquote(part.partition("=")[2])
                (only,) = [x for x in files.names(spark, f"{stage}/{part}") if x.startswith("part-")]
                files.move(spark, f"{stage}/{part}/{only}", f"{folder}/{name}")
                done.append(name)
        return done
    finally:
        files.delete(spark, stage)


def named_csv(df: DataFrame, folder: str, file: str, order: list[str]) -> list[str]:
    """df as CSV files named by a column, each with a header and its rows in order. Gives the names; a file is one task's work, so
    rows of one name should be bounded (a chunk, a metrics table)."""
    columns = [c for c in df.columns if c != file]
    line = F.concat_ws(",", *[csv_text(F.col(f"`{c}`")) for c in columns])
    head = ",".join('"' + c.replace('"', '""') + '"' if set(c) & set(',"') else c for c in columns)
    rows = df.select(F.col(file), F.struct(F.lit(1).alias("n"), *[F.col(f"`{c}`") for c in order]).alias("at"), line.alias("text"))
    heads = df.select(file).distinct().select(file, F.struct(F.lit(0).alias("n"), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order]).alias("at"), F.lit(head).alias("text"))
    return _commit(heads.unionByName(rows), folder, file)


def chunk_tables(df: DataFrame, chunks: DataFrame, keys: list[str], size: int, folder: str, prefix: str, kind: str = "meta", upgrade: str = "upgrade") -> list[str]:
    """One CSV file for each upgrade and chunk, {prefix}{kind}_upgrade{u}_{start}-{end}.csv. chunks: keys and `chunk` (rollup.chunked)."""
    start = F.col("chunk") * size
    of = df.join(chunks, keys).withColumn("_file", chunk_name(prefix, kind, F.col(upgrade), start, start + size))
    return named_csv(of.select(*df.columns, "_file"), folder, "_file", keys)


def chunk_loads(df: DataFrame, chunks: DataFrame, keys: list[str], size: int, folder: str, prefix: str, kind: str = "eulp_hvac_elec_MWh", name: str = "name", value: str = "value", upgrade: str = "upgrade", ts: str = "ts", places: int = 6) -> list[str]:
    """Wide load files, one for each upgrade and chunk, each with the columns of its own series: stamps, then values with so many
    places; a stamp that a series lacks is an empty field. df: keys, name, upgrade, ts, value, one row each."""
    start = F.col("chunk") * size
    of = df.join(chunks, keys).withColumn("_file", chunk_name(prefix, kind, F.col(upgrade), start, start + size))
    return named_wide(of, folder, "_file", name, value, ts, places)


def named_wide(df: DataFrame, folder: str, file: str, name: str, value: str, ts: str = "ts", places: int = 6) -> list[str]:
    """Wide CSV files named by a column, each with the columns of its own series in order of their names. A line is as wide as its
    file has series, so files should have a bounded number of them (a chunk, the counties of a country)."""
    of = df.select(F.col(file).alias("_file"), ts, name, value)
    cell = F.struct(F.col(name).alias("k"), F.bround(value, places).alias("v"))
    lines = of.groupBy("_file", ts).agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))
    heads = of.groupBy("_file").agg(F.sort_array(F.collect_set(name)).alias("names"))
    body = lines.join(heads, "_file").select("_file", F.col(ts).cast("string").alias("at"), F.concat_ws(",", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.array_join(F.transform("names", lambda k: csv_text(F.col("cells")[k])), ",")).alias("text"))
    first = heads.select("_file", F.lit("").alias("at"), F.concat_ws(",", F.lit("timestamp_EST"), F.array_join(F.transform("names", csv_text), ",")).alias("text"))
    return _commit(first.unionByName(body), folder, "_file")


def mean_metrics(df: DataFrame, skip: list[str], places: int = 6) -> DataFrame:
    return df.agg(*[F.bround(F.avg(c), places).alias(c) for c, t in df.dtypes if c not in (*skip, "run", "chunk") and t in ("double", "float", "int", "bigint")])


def wide_loads(profiles: DataFrame, path: str, name: str, value: str, names: list[str], places: int = 6) -> None:
    """The wide CSV that other tools expect: stamps, then a column for each series."""
    wide = pivoted(profiles.select("ts", name, F.bround(value, places).alias(value)), ["ts"], name, value, names)
    to_csv(wide.withColumnRenamed("ts", "timestamp_EST").orderBy("timestamp_EST"), path, single=True)


def write_text(spark: SparkSession, lines: list[str], path: str) -> None:
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def manifest(spark: SparkSession, path: str, **values: object) -> None:
    """What a run used, as JSON beside its outputs."""
    write_text(spark, [json.dumps(values | {"written": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}, default=str, sort_keys=True)], path)


def html_table(df: DataFrame, title: str, at_most: int = 200) -> str:
    """A table as HTML; cells are escaped in the plan. Of longer tables the first rows are shown, and the heading says of how many."""
    shown = lambda c, t: fixed(F.col(f"`{c}`"), 3, grouped=True) if t in ("double", "float") else F.col(f"`{c}`").cast("string")
    cells = [F.coalesce(html_escape(shown(c, t)), F.lit("n/a")).alias(c) for c, t in df.dtypes]
    rows = df.select(*cells).limit(at_most + 1).collect()
    if len(rows) > at_most:
        title, rows = f"{title} ({at_most} of {df.count()} rows)", rows[:at_most]
    head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{v}</td>" for v in r) + "</tr>" for r in rows)
    return f"<section><h2>{escape(title)}</h2><table><tr>{head}</tr>{body}</table></section>"
