"""Scans of catalogue tables with predicates that callers give: lists of values, and conditions as text.

Conditions are checked against the table before they are used: they must be one boolean expression over its columns. They become
ordinary filters, so the planner prunes partitions and pushes the rest to the files; `pushed` tells what it did."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check(df: DataFrame, condition: str) -> None:
    """An error unless the text is one boolean expression over df's columns, the same for a row each time, without subqueries."""
    if ";" in re.sub(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"", "", condition):
        raise ValueError(f"more than one expression: {condition}")
    if not condition.strip():
        raise ValueError("an empty condition")
    plan = df.select(F.expr(condition).alias("c"))  # names that df lacks are an error here
    if not isinstance(plan.schema["c"].dataType, T.BooleanType):
        raise ValueError(f"not a condition but {plan.schema['c'].dataType.simpleString()}: {condition}")
    expressions = plan._jdf.queryExecution().analyzed().expressions().head()
    if not expressions.deterministic():
        raise ValueError(f"not the same each time: {condition}")
    if re.search(r"-subquery#|scalar-subquery|exists#|list#\d+ \[|aggregate|window", expressions.toString().lower()):
        raise ValueError(f"more than a condition on a row: {condition}")


def scan(spark: SparkSession, table: str, columns: list[str] | None = None, restrict: list[tuple[str, list]] | None = None, where: list[str] | None = None) -> DataFrame:
    """Columns of a catalogue table (all by default), of rows that fit every restriction.

    restrict: (column, values), as in [("state", ["VT"]), ("upgrade", [0, 4])]; an empty list of values fits no row, None among
    them fits missing values. where: conditions as SQL text. Columns that the table lacks are an error."""
    df = spark.table(table)
    for name, values in restrict or []:
        if name not in df.columns:
            raise ValueError(f"{table} has no column {name}")
        known = [v for v in values if v is not None]
        fits = F.col(f"`{name}`").isin(*known) if known else F.lit(False)
        df = df.where(fits | F.col(f"`{name}`").isNull() if len(known) < len(values) else fits)
    for condition in where or []:
        check(df, condition)
        df = df.where(F.expr(condition))
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def pushed(df: DataFrame) -> dict[str, str]:
    """What the plan's first file scan prunes and reads: PartitionFilters, PushedFilters, ReadSchema."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = {k: re.search(rf"{k}: (\[[^\]]*\]|\S+)", plan) for k in ("PartitionFilters", "PushedFilters", "ReadSchema")}
    return {k: m[1] for k, m in found.items() if m}


def save(df: DataFrame, table: str, by: list[str], path: str | None = None, mode: str = "errorifexists") -> None:
    """A catalogue table in partitions, under the warehouse or a path of its own."""
    writer = df.repartition(*by).write.mode(mode).partitionBy(*by).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
