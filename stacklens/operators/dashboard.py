"""The staff dashboard's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.functions import calendar as cal
from stacklens.schemas import WEEKDAYS


def kpis(loans: DataFrame, rsd: float | None = None) -> DataFrame:
    """Patrons, books, checkouts, mean duration and overdue share; ``rsd`` switches to approximate counts."""
    distinct = F.count_distinct if rsd is None else lambda c: F.approx_count_distinct(c, rsd)
    return loans.agg(
        distinct("patron_id").alias("active_patrons"),
        distinct("book_id").alias("books"),
        F.count(F.lit(1)).alias("total_checkouts"),
        F.round(F.avg("loan_duration_days"), 1).alias("avg_loan_days"),
        F.round(F.avg(F.coalesce(F.col("loan_status") == "overdue", F.lit(False)).cast("int")), 4).alias("overdue_rate"),
    )


def weekly_checkouts(loans: DataFrame) -> DataFrame:
    return loans.groupBy(cal.week_start(F.col("checkout_date")).alias("week")).agg(F.count(F.lit(1)).alias("checkouts"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), column
    )


def dow_counts(loans: DataFrame) -> DataFrame:
    """All seven weekdays in order; NULL where nothing was borrowed."""
    counted = loans.groupBy(cal.day_name(F.col("checkout_date")).alias("day")).agg(F.count(F.lit(1)).alias("checkouts"))
    days = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(d).alias("day")) for i, d in enumerate(WEEKDAYS)])
    week = loans.sparkSession.range(1).select(F.inline(days))
    return week.join(counted, "day", "left").select("position", "day", "checkouts").orderBy("position")


def top_patrons(loans: DataFrame, n: int = 10) -> DataFrame:
    return (
        loans.where("patron_id IS NOT NULL").groupBy("patron_id").agg(
            F.count("book_id").alias("checkouts"),
            F.count_distinct("book_id").alias("unique_books"),
            F.round(F.avg("loan_duration_days"), 2).alias("avg_duration"),
            F.count_if(F.col("loan_status") == "overdue").alias("overdue_count"),
        ).orderBy(F.desc("checkouts"), "patron_id").limit(n)
    )


def top_books(loans: DataFrame, n: int = 15) -> DataFrame:
    return (
        loans.where("book_id IS NOT NULL AND genre IS NOT NULL").groupBy("book_id", "genre").agg(
            F.count("patron_id").alias("borrows"),
            F.count_distinct("patron_id").alias("unique_patrons"),
            F.round(F.avg("times_renewed"), 2).alias("avg_renewals"),
        ).orderBy(F.desc("borrows"), "book_id").limit(n)
    )


def genre_trend(loans: DataFrame, top: int = 5) -> DataFrame:
    """Monthly checkouts of the most borrowed genres.

    The monthly counts are made once; the overall ranking adds them up.
    """
    monthly = (
        loans.where("genre IS NOT NULL")
        .groupBy(cal.month_start(F.col("checkout_date")).alias("month"), "genre")
        .agg(F.count(F.lit(1)).alias("checkouts"))
    )
    leaders = monthly.groupBy("genre").agg(F.sum("checkouts").alias("n")).orderBy(F.desc("n"), "genre").limit(top)
    return monthly.join(leaders, "genre", "left_semi").select("month", "genre", "checkouts")


def season_genre(loans: DataFrame) -> DataFrame:
    return (
        loans.where("genre IS NOT NULL")
        .groupBy(F.initcap(cal.season(F.col("checkout_date"))).alias("season"), "genre")
        .agg(F.count(F.lit(1)).alias("checkouts"))
    )


def patron_history(loans: DataFrame, patron_id, n: int = 20) -> DataFrame:
    """Newest loans of one patron."""
    return (
        loans.where(F.col("patron_id") == patron_id)
        .select("book_id", "book_title", "genre", "checkout_date", "loan_duration_days", "loan_status")
        .orderBy(F.desc("checkout_date"), "book_id", "loan_duration_days", "loan_status")
        .limit(n)
    )
