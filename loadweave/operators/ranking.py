"""Ranks and exact quantiles of any number of rows, without a task that sees them all.

Rows are dealt by range of their order, so every partition holds a stretch of it. A rank is the place inside the partition plus
the rows of the partitions before, which a table of one row for each partition (and group) tells. What was dealt is written once,
as ranges are drawn from a sample and two readers must see the same ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct_diff
from ..sources.scratch import written

_BEFORE = Window.unboundedPreceding


def with_rank(df: DataFrame, order: list[str], rank: str = "rank", n: str | None = None) -> DataFrame:
    """df with the rank of each row (from 1, long) in ascending order, missing values first; n: how many rows there are.

    Ties in all order columns get different ranks, in no given order."""
    dealt = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").count()
    before = sizes.select(
        "_part",
        F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(_BEFORE, -1)), F.lit(0)).alias("_before"),
        F.sum("count").over(Window.partitionBy()).alias("_all"),
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # A row for each partition: as many as there are tasks, whatever the number of rows.
    ranked = dealt.withColumn("_place", place).join(F.broadcast(before), "_part")
    out = ranked.withColumn(rank, F.col("_place") + F.col("_before"))
    return (out.withColumn(n, F.col("_all")) if n else out).drop("_part", "_place", "_before", "_all")


def with_next(df: DataFrame, order: str, following: str) -> DataFrame:
    """df with the next row's value of order, missing for the last row; missing values come first.

    The last row of a range gets the first of the next range that has rows, from a table of one row for each range."""
    dealt = written(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    ranges = dealt.groupBy("_part").agg(F.min(order).alias("_first"))
    after = ranges.select("_part", F.lead("_first").over(Window.orderBy("_part")).alias("_after"))
    inside = F.lead(order).over(Window.partitionBy("_part").orderBy(order))
    rows = dealt.withColumn("_inside", inside).join(F.broadcast(after), "_part")
    return rows.withColumn(following, F.coalesce("_inside", "_after")).drop("_part", "_inside", "_after")


def quantiles(df: DataFrame, value: str, keys: list[str], at: tuple[float, ...]) -> DataFrame:
    """keys, q, value: exact quantiles of known values, with linear interpolation between neighbours.

    Equal values are counted first, so a value that a third of all rows hold is one row from there on. Groups without a known
    value give no rows; NaN counts as missing."""
    known = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counts = known.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    dealt = written(counts.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()))
    # The same names with a prefix, so that missing keys can be compared too.
    marks = {k: f"_of_{k}" for k in keys}
    parts = dealt.groupBy("_part", *[F.col(k).alias(m) for k, m in marks.items()]).agg(F.sum("_c").alias("_c_part"))
    group = Window.partitionBy(*marks.values())
    offsets = parts.select(
        F.col("_part").alias("_of_part"), *marks.values(),
        F.coalesce(F.sum("_c_part").over(group.orderBy("_part").rowsBetween(_BEFORE, -1)), F.lit(0)).alias("_before"),
        F.sum("_c_part").over(group).alias("_n"),
    )
    upto = F.sum("_c").over(Window.partitionBy("_part", *keys).orderBy("_v").rowsBetween(_BEFORE, 0))
    on = F.col("_part") == F.col("_of_part")
    for k, m in marks.items():
        on = on & F.col(k).eqNullSafe(F.col(m))
    placed = dealt.withColumn("_upto", upto).join(offsets, on)
    last = F.col("_before") + F.col("_upto")
    first = last - F.col("_c")
    # Place q * (n - 1), from 0, lies between two whole places; their values are picked as rows pass by.
    found, out = [], []
    for i, q in enumerate(at):
        place = F.lit(float(q)) * (F.col("_n") - 1)
        for side, at_place in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            found.append(F.max(F.when((first <= at_place) & (at_place < last), F.col("_v"))).alias(f"_{side}{i}"))
        share = place - F.floor(place)
        mixed = F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share
        out.append(F.struct(F.lit(float(q)).alias("q"), mixed.alias(value)))
    picked = placed.groupBy(*keys, "_n").agg(*found)
    return picked.select(*keys, F.explode(F.array(*out)).alias("x")).select(*keys, "x.q", f"x.{value}")


def percentiles(pairs: DataFrame, keys: list[str] | None = None, at: tuple[float, ...] = (0.90, 0.95, 0.99)) -> DataFrame:
    """keys, q, ref, reg, pct_diff: exact percentiles of both sides."""
    keys = keys or []
    sides = pairs.select(*keys, F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(s).cast("double").alias("v")) for s in ("ref", "reg")])).alias("x"))
    found = quantiles(sides.select(*keys, "x.s", "x.v"), "v", [*keys, "s"], at)
    side = lambda s: F.max(F.when(F.col("s") == s, F.col("v"))).alias(s)
    return found.groupBy(*keys, "q").agg(side("ref"), side("reg")).withColumn("pct_diff", pct_diff(F.col("ref"), F.col("reg")))
