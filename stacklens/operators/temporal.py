"""Per-patron borrowing features over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.functions import calendar as cal
from stacklens.functions.numeric import first_max_label
from stacklens.schemas import SEASONS, TIMES_OF_DAY

TRAILING_DAYS = (30, 60, 90)
TEMPORAL_COLUMNS = ("patron_id", "book_id", "checkout_date", "loan_duration_days", "times_renewed", "loan_status")


def calendar_fields(loans: DataFrame) -> DataFrame:
    ts = F.col("checkout_date")
    return loans.select(
        "patron_id", "book_id", "checkout_date",
        cal.weekday(ts).alias("checkout_dayofweek"),
        F.month(ts).alias("checkout_month"),
        F.hour(ts).alias("checkout_hour"),
        cal.is_weekend(ts).alias("is_weekend"),
        cal.season(ts).alias("season"),
        cal.time_of_day(ts).alias("time_of_day"),
    )


def _mode_counts() -> dict[str, dict]:
    """Counters per value of each calendar field; modes are read off them after the aggregation."""
    ts = F.col("checkout_date")
    return {
        "dow": {d: F.count_if(cal.weekday(ts) == d) for d in range(7)},
        "month": {m: F.count_if(F.month(ts) == m) for m in range(1, 13)},
        "tod": {t: F.count_if(cal.time_of_day(ts) == t) for t in TIMES_OF_DAY},
    }


def _mode(field: str, labels: list) -> Column:
    return first_max_label([F.col(f"{field}_{x}") for x in labels], labels)


def _season_mode() -> Column:
    months = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "fall": (9, 10, 11)}
    sums = [sum((F.col(f"month_{m}") for m in months[s]), F.lit(0)) for s in SEASONS]
    return first_max_label(sums, SEASONS)


def temporal_features(loans: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per patron.

    ``as_of`` defaults to the newest checkout. The modes come from plain counters,
    so the whole aggregation stays a code-generated hash aggregate with map-side
    combine: one shuffle of one fixed-width row per patron and task. Patrons
    without recent loans get 0 in the trailing counts.
    """
    if as_of is None:
        as_of = loans.agg(F.max("checkout_date")).scalar()
    ts = F.col("checkout_date")
    book = F.col("book_id").isNotNull()
    counters = _mode_counts()
    per_patron = loans.where(F.col("patron_id").isNotNull()).groupBy("patron_id").agg(
        F.count("book_id").alias("n"),
        F.max(ts).alias("last"),
        F.min(ts).alias("first"),
        F.avg("loan_duration_days").alias("duration"),
        F.avg("times_renewed").alias("renewals"),
        F.count_if(book & (cal.weekday(ts) >= 5)).alias("weekend"),
        F.count_if(book & (F.col("loan_status") == "overdue")).alias("overdue"),
        *[
            F.count_if(book & (ts >= as_of - F.make_interval(days=F.lit(d)))).alias(f"last_{d}")
            for d in TRAILING_DAYS
        ],
        *[expr.alias(f"{field}_{x}") for field, values in counters.items() for x, expr in values.items()],
    )
    n = F.col("n")
    tenure = cal.elapsed_days(F.col("last"), F.col("first"))
    months = F.when(tenure == 0, F.lit(1.0)).otherwise(tenure / 30)
    share = lambda c: F.round(F.when(n != 0, F.col(c) / n).otherwise(0.0), 3)
    return per_patron.select(
        "patron_id",
        n.alias("total_checkouts"),
        cal.elapsed_days(as_of, F.col("last")).alias("days_since_last_checkout"),
        tenure.alias("tenure_days"),
        F.round("duration", 2).alias("avg_loan_duration_days"),
        F.round("renewals", 3).alias("avg_renewals_per_checkout"),
        share("weekend").alias("weekend_borrow_ratio"),
        _mode("dow", list(range(7))).alias("preferred_day_of_week"),
        _mode("month", list(range(1, 13))).alias("preferred_month"),
        _season_mode().alias("preferred_season"),
        _mode("tod", TIMES_OF_DAY).alias("preferred_time_of_day"),
        *[F.col(f"last_{d}").alias(f"checkouts_last_{d}d") for d in TRAILING_DAYS],
        F.round(n / months, 3).alias("monthly_borrow_rate"),
        share("overdue").alias("overdue_rate"),
    )


def patron_modes(loans: DataFrame) -> DataFrame:
    """Most frequent genre, weekday and status per patron; the smallest value on ties."""
    return loans.where(F.col("patron_id").isNotNull()).groupBy("patron_id").agg(
        F.mode("genre", True).alias("modal_genre"),
        F.mode(cal.weekday(F.col("checkout_date")), True).alias("modal_day_of_week"),
        F.mode("loan_status", True).alias("modal_status"),
    )
