"""Calendar columns (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def season_of_month(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .otherwise("fall")
    )


def season(ts: Column) -> Column:
    return season_of_month(F.month(ts))


def time_of_day(ts: Column) -> Column:
    hour = F.hour(ts)
    return F.when(hour < 12, "morning").when(hour < 17, "afternoon").otherwise("evening")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def week_start(ts: Column) -> Column:
    return F.date_trunc("week", ts)


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24 h periods between two timestamps, rounded down like a timedelta's days."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000.0)).cast("long")
