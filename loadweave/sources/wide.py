"""Wide CSV files (a column of stamps, then one for each series), each with columns of its own, read as one long table.

All files are one scan of text lines. The first line of each file names its columns; it becomes a side table of one row a file,
and the fields of every other line are paired with it by place. So the number of jobs does not grow with the number of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parsed

#: Texts that stand for a missing number.
MISSING = ("", "NA", "N/A", "nan", "NaN", "NULL", "null", "None")
FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy")


def csv_fields(line: Column) -> Column:
    """The fields of a line of CSV; quoted ones may hold commas and doubled quotes."""
    # A comma in front of the line, so that every field follows one and none is matched by nothing.
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("[^"]*(?:""[^"]*)*"|[^,]*)'), 1)
    bare = lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda x: F.when(x.startswith('"'), bare(x)).otherwise(F.trim(x)))


def csv_text(c: Column) -> Column:
    """A field of CSV, quoted if it must be; a missing value is empty."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(r'[",\r\n]|^\s|\s$'), quoted).otherwise(text)


def number(text: Column, what: Column) -> Column:
    """A number; missing for the texts that stand for that; any other text is an error when the plan runs."""
    value = F.trim(text).try_cast("double")
    error = F.raise_error(F.concat(F.lit("not a number: "), text, F.lit(" in "), what)).cast("double")
    known = F.when(value.isNotNull(), value).otherwise(error)
    return F.when(text.isNull() | F.trim(text).isin(*MISSING) | F.isnan(value), None).otherwise(known)


def wide_files(spark: SparkSession, folder: str, pattern: str, name: str, value: str, formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """(file, ts, name, value) of all files in a folder whose names fit a pattern with * and ?.

    Of lines of one file with the same stamp the last counts. When the plan runs, errors are: a stamp that no format fits, a
    field that is no number, a line with more or fewer fields than its header. No file at all is an error at once. Files are
    CSV without line breaks inside fields."""
    text = spark.read.option("pathGlobFilter", pattern).text(folder)
    if not text.inputFiles():
        raise FileNotFoundError(f"no file {pattern} in {folder}")
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = text.select(F.col("_metadata.file_path").alias("file"), at.alias("at"), F.regexp_replace("value", "^﻿|\r$", "").alias("text")).where("text <> ''")
    # The first line stands in the block that starts the file.
    heads = lines.where("at.block = 0").groupBy("file").agg(F.min_by("text", "at").alias("head"))
    rows = lines.join(heads, "file").where("text <> head").select("file", "at", csv_fields(F.col("text")).alias("fields"), "head")
    stamp = parsed(F.col("fields")[0], *formats)
    bad = F.raise_error(F.concat(F.lit("stamps that cannot be read, such as "), F.col("fields")[0], F.lit(" in "), F.col("file"))).cast("timestamp_ntz")
    rows = rows.withColumn("ts", F.coalesce(stamp, bad))
    last = rows.groupBy("file", "ts").agg(F.max_by("fields", "at").alias("fields"), F.first("head").alias("head"))
    names = F.slice(csv_fields(F.col("head")), 2, 1_000_000)
    values = F.slice("fields", 2, 1_000_000)
    size = F.raise_error(F.concat(F.lit("a line with other fields than its header in "), F.col("file"))).cast("array<struct<n:string,v:string>>")
    pairs = F.when(F.size(names) == F.size(values), F.arrays_zip(names.alias("n"), values.alias("v"))).otherwise(size)
    each = last.select("file", "ts", F.explode(pairs).alias("x"))
    return each.select("file", "ts", F.col("x.n").alias(name), number(F.col("x.v"), F.col("file")).alias(value))
