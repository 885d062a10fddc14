"""Time functions. Stamps have no zone and mark the end of their hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seasons by month.
SEASONS = ("DJF", "MAM", "JJA", "SON")
SEASON_BY_MONTH = {m: SEASONS[m % 12 // 3] for m in range(1, 13)}


def hour_end(ts: Column) -> Column:
    """The end of the hour that a stamp belongs to: 00:15 to 01:00 give 01:00."""
    return F.date_trunc("hour", ts + F.expr("interval 59 minutes")).cast("timestamp_ntz")


def hour_begin_to_end(ts: Column) -> Column:
    return (ts + F.expr("interval 1 hour")).cast("timestamp_ntz")


def from_epoch_nanos(n: Column) -> Column:
    # Integer division: a double does not hold today's nanoseconds.
    return F.timestamp_micros(F.call_function("div", n, F.lit(1000))).cast("timestamp_ntz")


def is_weekend(ts: Column) -> Column:
    """1 on Saturdays and Sundays, else 0."""
    return F.weekday(ts).isin(5, 6).cast("int")


def season(ts: Column) -> Column:
    months = F.create_map(*[F.lit(x) for kv in SEASON_BY_MONTH.items() for x in kv])
    return F.element_at(months, F.month(ts))


def parsed(c: Column, *formats: str) -> Column:
    """A stamp without zone from text: ISO forms first, then the given formats; NULL if none fits."""
    tries = [F.try_to_timestamp(c), *[F.try_to_timestamp(c, F.lit(f)) for f in formats]]
    return F.coalesce(*tries).cast("timestamp_ntz")
