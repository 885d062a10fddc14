"""Time-series operators on long tables. Positions come from stamps, never from the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.dates import SEASONS, season
from ..functions.numeric import total
from .ranking import with_next

#: Hours of a year without a leap day.
YEAR_HOURS = 8760
#: Missing ranges that a row stands for at most while they are dealt out.
STRETCH = 10_000


def along(keys: list[str], ts: str = "ts") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(ts)


def lagged(df: DataFrame, keys: list[str], value: str, lags: list[int], ts: str = "ts") -> DataFrame:
    """value as it was so many rows ago (negative: will be), one column for each lag; all lags share one sort."""
    w = along(keys, ts)
    return df.withColumns({f"{value}_lag_{'m' if k < 0 else ''}{abs(k)}": F.lag(value, k).over(w) for k in lags})


def filled(df: DataFrame, keys: list[str], columns: list[str], ts: str = "ts") -> DataFrame:
    """Missing values take the next known value, and past the last one the last known."""
    w = along(keys, ts)
    after, before = w.rowsBetween(0, Window.unboundedFollowing), w.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.coalesce(F.first(c, ignorenulls=True).over(after), F.last(c, ignorenulls=True).over(before)) for c in columns})


def numbered(df: DataFrame, keys: list[str], ts: str = "ts", name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(along(keys, ts)))


def first_rows(df: DataFrame, keys: list[str], n: int = YEAR_HOURS, ts: str = "ts") -> DataFrame:
    return numbered(df, keys, ts, "_n").where(F.col("_n") <= n).drop("_n")


def drop_ends(df: DataFrame, keys: list[str], first: int = 0, last: int = 0, ts: str = "ts") -> DataFrame:
    """Each series without its first and last rows."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    out = numbered(df, keys, ts, "_n").withColumn("_of", size)
    return out.where((F.col("_n") > first) & (F.col("_n") <= F.col("_of") - last)).drop("_n", "_of")


def without_leap_day(df: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """Series of exactly 8784 rows lose their last 24."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    out = numbered(df, keys, ts, "_n").withColumn("_of", size)
    return out.where((F.col("_of") != YEAR_HOURS + 24) | (F.col("_n") <= YEAR_HOURS)).drop("_n", "_of")


def annual(df: DataFrame, keys: list[str], values: list[str], n: int = YEAR_HOURS, ts: str = "ts") -> DataFrame:
    """Totals of the first n rows of each series."""
    return first_rows(df, keys, n, ts).groupBy(*keys).agg(*[total(v).alias(v) for v in values])


def zipped(left: DataFrame, right: DataFrame, keys: list[str], shift: int = 0, ts: str = "ts") -> DataFrame:
    """Rows of left with the rows of right that stand `shift` places further on in their series. right's stamp becomes right_ts."""
    a = numbered(left, keys, ts, "_n")
    b = numbered(right, keys, ts, "_n").withColumn("_n", F.col("_n") - shift).withColumnRenamed(ts, f"right_{ts}")
    return a.join(b, [*keys, "_n"]).drop("_n")


def shifted_with_edge(df: DataFrame, keys: list[str], value: str, ts: str = "ts") -> DataFrame:
    """Every value one row later; the first row keeps its own."""
    w = along(keys, ts)
    return df.withColumn(value, F.coalesce(F.lag(value, 1).over(w), F.col(value)))


def hours(df: DataFrame, start: str, end: str) -> DataFrame:
    """df's rows, one for each hour from column start to column end."""
    return df.withColumn("ts", F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 hour"))))


def _spread(df: DataFrame, keys: list[str], values: list[str], cells: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """Totals of all values in each cell (a condition, and columns that name it), 0 where a cell has no rows.

    Cells are columns of one partial aggregation, so no spine is joined and both sides of a comparison are summed at once."""
    sums = [F.coalesce(F.sum(F.when(when, F.col(v))), F.lit(0.0)).alias(f"_{k}_{v}") for k, (when, _) in enumerate(cells) for v in values]
    rows = [F.struct(*[c.alias(n) for n, c in names.items()], *[F.col(f"_{k}_{v}").alias(v) for v in values]) for k, (_, names) in enumerate(cells)]
    return df.groupBy(*keys).agg(*sums).select(*keys, F.explode(F.array(*rows)).alias("x")).select(*keys, "x.*")


def by_month_of(df: DataFrame, keys: list[str], values: list[str], ts: str = "ts") -> DataFrame:
    """keys, month, values: totals of all twelve months of each series; months without rows are 0."""
    return _spread(df, keys, values, [(F.month(ts) == m, {"month": F.lit(m)}) for m in range(1, 13)])


def by_month(df: DataFrame, keys: list[str], value: str, ts: str = "ts") -> DataFrame:
    return by_month_of(df, keys, [value], ts)


def by_season_of(df: DataFrame, keys: list[str], values: list[str], ts: str = "ts") -> DataFrame:
    """keys, season_no, season, values: totals of all four seasons of each series; seasons without rows are 0."""
    return _spread(df, keys, values, [(season(F.col(ts)) == s, {"season_no": F.lit(k), "season": F.lit(s)}) for k, s in enumerate(SEASONS)])


def by_season(df: DataFrame, keys: list[str], value: str, ts: str = "ts") -> DataFrame:
    return by_season_of(df, keys, [value], ts)


def by_day_of(df: DataFrame, keys: list[str], values: list[str], ts: str = "ts") -> DataFrame:
    """keys, day, values: daily totals from each series' first day to its last; days without rows are 0."""
    sums = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(*[total(v).alias(v) for v in values])
    ends = sums.groupBy(*keys).agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
    spine = ends.withColumn("day", F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")
    return spine.join(sums, [*keys, "day"], "left").withColumns({v: F.coalesce(v, F.lit(0.0)) for v in values})


def by_day(df: DataFrame, keys: list[str], value: str, ts: str = "ts") -> DataFrame:
    return by_day_of(df, keys, [value], ts)


def summary(ranges: DataFrame, start: str, end: str, keys: list[str] | None = None) -> DataFrame:
    """keys, n, first_start, first_end, last_start, last_end: how many ranges each series has, and its first and last one.

    Without keys one row; without ranges n is 0 and the others are missing."""
    at = F.struct(start, end)
    of = ranges.groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("a"), F.max(at).alias("z"))
    return of.select(*(keys or []), "n", F.col(f"a.{start}").alias("first_start"), F.col(f"a.{end}").alias("first_end"), F.col(f"z.{start}").alias("last_start"), F.col(f"z.{end}").alias("last_end"))


def stretches(ranges: DataFrame, start: str, end: str, step: int, keys: list[str] | None = None) -> DataFrame:
    """keys, _end, _next, _from, _to: what is missing between neighbours (one's end, the next one's start), cut into stretches; each stands
    for _from, _from + step, and so on up to _to.

    Neighbours may be far apart, and a stretch has STRETCH steps at most, so stretches can be dealt out evenly. Without keys neighbours
    are found by ranges of start, which are written when this is called, so no task sees all rows."""
    if keys:
        nexts = ranges.withColumn("_next", F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))
    else:
        nexts = with_next(ranges, start, "_next")
    last, steps = F.col("_next") - 1, max(1, min(STRETCH, (2**31 - 1) // step))
    out = nexts.where(F.col("_next") > F.col(end)).withColumn("_from", F.explode(F.sequence(F.col(end), last, F.lit(step * steps))))
    return out.select(*(keys or []), F.col(end).alias("_end"), "_next", "_from", (F.col("_from") + F.least(last - F.col("_from"), F.lit(step * (steps - 1)))).alias("_to"))


def gaps(ranges: DataFrame, start: str, end: str, step: int, keys: list[str] | None = None) -> DataFrame:
    """Start and end of every range that is missing between neighbours, in steps; `whole` tells if the last of them ends where the next begins.

    Stretches are dealt out to a given number of tasks, which adaptive execution does not merge though they are small."""
    found = stretches(ranges, start, end, step, keys)
    dealt = found.repartition(partitions(found.sparkSession), *(keys or []), "_from")
    out = dealt.withColumn("gap_start", F.explode(F.sequence("_from", "_to", F.lit(step))))
    return out.select(*(keys or []), "gap_start", F.least(F.col("gap_start") + step, F.col("_next")).alias("gap_end"), ((F.col("_next") - F.col("_end")) % step == 0).alias("whole"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
