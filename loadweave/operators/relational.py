"""Joins, set comparison, reshaping and row selection where the default needs care."""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import with_rank


def lookup_join(df: DataFrame, lookup: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Left join to a lookup without repeated rows. A key with several values is an error, since it would double df's rows."""
    small = lookup.select(*on, *columns).distinct()
    repeated = small.groupBy(*on).count().where("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"lookup keys with several values: {[tuple(r)[:-1] for r in repeated]}")
    return df.join(small, on, "left")


def last_value_join(df: DataFrame, lookup: DataFrame, on: str, value: str, position: str) -> DataFrame:
    """Left join to a lookup whose last row counts where a key repeats."""
    return df.join(lookup.groupBy(on).agg(F.max_by(value, position).alias(value)), on, "left")


def keep_last(df: DataFrame, keys: list[str], position: str | list[str]) -> DataFrame:
    """Of rows that share keys, the one with the highest position."""
    order = [F.desc(p) for p in ([position] if isinstance(position, str) else position)]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def not_in(c: Column, *values: object) -> Column:
    """Neither of the values; a missing value is none of them."""
    return c.isNull() | ~c.isin(*values)


def in_all(wanted: DataFrame, keys: list[str], *tables: DataFrame) -> DataFrame:
    """The wanted keys, each once, that every table has."""
    found = wanted.select(*keys).distinct()
    for df in tables:
        found = found.join(df.select(*keys), keys, "left_semi")
    return found


def require_same_columns(ref: DataFrame, reg: DataFrame) -> None:
    """An error unless both have the same columns in the same order; it names the first place where they differ."""
    for n, (a, b) in enumerate(zip_longest(ref.columns, reg.columns)):
        if a != b:
            raise ValueError(f"columns differ at position {n}: {a!r} and {b!r}")


def alignment(ref: DataFrame, reg: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many keys both sides have, only the first, only the second, in one full join of distinct keys."""
    a = ref.select(*keys).distinct().withColumn("_a", F.lit(1))
    b = reg.select(*keys).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, keys, "full")
    return both.agg(
        F.count(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1)).alias("common"),
        F.count(F.when(F.col("_b").isNull(), 1)).alias("ref_only"),
        F.count(F.when(F.col("_a").isNull(), 1)).alias("reg_only"),
    )


def aligned(ref: DataFrame, reg: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, ref, reg of keys that both sides have."""
    return ref.select(*keys, F.col(value).alias("ref")).join(reg.select(*keys, F.col(value).alias("reg")), keys)


def pair_sets(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """One row of counts: different values on each side, on both, on one only, and different pairs."""
    values = lambda c, flag: pairs.select(F.col(c).alias("v")).where(F.col("v").isNotNull()).distinct().withColumn(flag, F.lit(1))
    sides = values(left, "a").join(values(right, "b"), "v", "full").agg(
        F.count("a").alias("n_left"), F.count("b").alias("n_right"),
        F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("n_both"),
        F.count(F.when(F.col("b").isNull(), 1)).alias("left_only"), F.count(F.when(F.col("a").isNull(), 1)).alias("right_only"),
    )
    distinct = pairs.select(left, right).distinct().agg(F.count(F.lit(1)).alias("n_pairs"), F.count(F.when(F.col(left) == F.col(right), 1)).alias("n_same"))
    return sides.join(distinct, F.lit(True))  # one row each


def unpivoted(wide: DataFrame, ids: list[str], name: str, value: str) -> DataFrame:
    columns = [c for c in wide.columns if c not in ids]
    return wide.unpivot(ids, columns, name, value)


def pivoted(long: DataFrame, ids: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """Wide form for sinks, when the plan runs an error for a name that repeats for the same ids, as no single value would be
    right, and for a name that is not among `names`, as its values would be lost."""
    shown = F.coalesce(F.col(name).cast("string"), F.lit("null"))
    stray = F.raise_error(F.concat(F.lit("no column for: "), shown))
    known = F.col(name).isin(*names) & F.col(name).isNotNull()
    twice = F.raise_error(F.concat(F.lit("repeated: "), F.max(shown))).cast(long.schema[value].dataType)
    of = long.withColumn(name, F.when(known, F.col(name)).otherwise(stray.cast(long.schema[name].dataType)))
    cells = {n: F.col(name) == F.lit(n) for n in names}
    one = lambda c: F.when(F.count(F.when(c, 1)) > 1, twice).otherwise(F.max(F.when(c, F.col(value))))
    return of.groupBy(*ids).agg(*[one(c).alias(str(n)) for n, c in cells.items()])


def inserted(df: DataFrame, place: int, name: str, column: Column) -> DataFrame:
    """df with one more column at a place from 0; one that has the name already is an error."""
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    old = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*old[:place], column.alias(name), *old[place:])


def extremes(df: DataFrame, by: str, key: str, k: int = 5) -> DataFrame:
    """The k highest and k lowest rows, each side without sorting all rows; `side` tells which. Ties go to the smaller key."""
    known = df.where(F.col(by).isNotNull())
    top = known.orderBy(F.desc(by), key).limit(k).withColumn("side", F.lit("top"))
    return top.unionByName(known.orderBy(F.asc(by), key).limit(k).withColumn("side", F.lit("bottom")))


def best_middle_worst(df: DataFrame, by: str, key: str, k: int = 3) -> DataFrame:
    """The k lowest values, the k around the middle and the k highest, by rank among known values.

    The middle starts k // 2 places before place n // 2 (from 0), and earlier if it would run over the end. Ranks are dealt by
    range (ranking.with_rank), so no task sees all rows."""
    ranked = with_rank(df.where(F.col(by).isNotNull()), [by, key], "rank", "n")
    end = F.least(F.col("n"), F.greatest(F.lit(0), F.floor(F.col("n") / 2) - k // 2) + k)
    start = F.greatest(F.lit(0), end - k)
    flags = {"best": F.col("rank") <= k, "middle": (F.col("rank") > start) & (F.col("rank") <= end), "worst": F.col("rank") > F.col("n") - k}
    tagged = ranked.withColumn("group", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(g)) for g, c in flags.items()]))))
    return tagged.select(key, by, F.col("rank").cast("int").alias("rank"), "group")
