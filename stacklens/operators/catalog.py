"""Per-book tables: metadata, genre encoding, popularity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.operators.behavioral import distinct_columns, known_genres
from stacklens.operators.quantiles import exact_quantiles, value_counts
from stacklens.session import cut_lineage


def earliest_values(df: DataFrame, key: str, values: Sequence[str], order: str) -> DataFrame:
    """For each key the values that came first by ``order`` (then the smaller value).

    Stage one reduces the rows to one per distinct value combination with a plain
    hash aggregate; only those few variants reach the ordered pick.
    """
    variants = df.where(F.col(key).isNotNull()).groupBy(key, *values).agg(F.min(order).alias("_first"))
    return variants.groupBy(key).agg(*[
        F.min(F.when(F.col(v).isNotNull(), F.struct("_first", v)))[v].alias(v) for v in values
    ])


def book_catalog(loans: DataFrame) -> DataFrame:
    """book_id, book_title, genre, total_borrows."""
    variants = loans.where(F.col("book_id").isNotNull()).groupBy("book_id", "book_title", "genre").agg(
        F.min("checkout_date").alias("_first"), F.count("patron_id").alias("_n")
    )
    first = lambda v: F.min(F.when(F.col(v).isNotNull(), F.struct("_first", v)))[v].alias(v)
    return variants.groupBy("book_id").agg(
        first("book_title"), first("genre"), F.sum("_n").alias("total_borrows")
    )


def book_metadata(loans: DataFrame) -> DataFrame:
    """One row per book with borrowing statistics."""
    stats = loans.where(F.col("book_id").isNotNull()).groupBy("book_id").agg(
        F.count("patron_id").alias("total_borrows"),
        F.count_distinct("patron_id").alias("unique_borrowers"),
        F.round(F.avg("loan_duration_days"), 2).alias("avg_loan_duration"),
        F.round(F.avg("times_renewed"), 3).alias("avg_renewals"),
        F.round(F.avg(F.coalesce(F.col("loan_status") == "overdue", F.lit(False)).cast("int")), 3).alias("overdue_rate"),
    )
    names = earliest_values(loans, "book_id", ["book_title", "genre"], "checkout_date")
    return names.join(stats, "book_id").select("book_id", "book_title", "genre", *stats.columns[1:])


def content_text(catalog: DataFrame) -> DataFrame:
    """Text the vectoriser sees (the genre counts three times) and the sentence for the encoder."""
    genre = F.col("genre")
    return catalog.select(
        "book_id",
        F.concat_ws(" ", F.col("book_title"), genre, genre, genre).alias("content_text"),
        F.concat(F.lit("A "), genre, F.lit(" book titled "), F.col("book_title")).alias("sentence"),
    )


def _borrow_counts(books: DataFrame) -> DataFrame:
    """(feature, value, n) of total_borrows, written once."""
    return cut_lineage(value_counts(books.select(
        F.lit("total_borrows").alias("feature"), F.col("total_borrows").cast("double").alias("value")
    )))


def _tier(counts: DataFrame) -> Column:
    """Popularity tier from the 10 % and 90 % quantiles (two numbers)."""
    found = exact_quantiles(counts, (0.1, 0.9), counts).first()
    low, high = found.quantiles if found else (0.0, 0.0)
    borrows = F.col("total_borrows")
    return F.when(borrows <= low, "low").when(borrows <= high, "medium").otherwise("high")


def popularity_tiers(catalog: DataFrame) -> DataFrame:
    """Books at or below the 10 % quantile of borrows are low, above the 90 % quantile high."""
    return catalog.select("book_id", "total_borrows", _tier(_borrow_counts(catalog)).alias("popularity_tier"))


def genre_encoding(metadata: DataFrame, genres: Sequence[str] | None = None) -> DataFrame:
    """0/1 column per genre plus popularity, engagement and overdue signals.

    Genres whose names differ only in case have columns of their own.
    """
    columns = distinct_columns(genres if genres is not None else known_genres(metadata), lambda g: f"genre_{g}")
    counts = _borrow_counts(metadata)
    most = counts.agg(F.max("value")).scalar()
    return metadata.select(
        "book_id",
        *[F.coalesce((F.col("genre") == g).cast("int"), F.lit(0)).alias(c) for g, c in columns.items()],
        _tier(counts).alias("popularity_tier"),
        F.round(F.col("total_borrows") / most, 4).alias("popularity_score"),
        F.round("avg_renewals", 3).alias("engagement_score"),
        "overdue_rate",
    )
