"""Per-patron genre, spending and engagement features."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklens.functions.numeric import ratio_or_zero, steady_round, steady_sum
from stacklens.schemas import TRANSACTION_TYPES

#: Genres that become columns unless a list is given: the most frequent ones.
WIDE_GENRES = 500
COUNTED_EVENTS = ("book_search", "book_view", "wishlist_add", "reservation_made", "review_submitted")


def known_genres(loans: DataFrame, limit: int = WIDE_GENRES) -> list[str]:
    """The genres that get a column, sorted: the ``limit`` most frequent (then the smaller name)."""
    counted = loans.where("genre IS NOT NULL").groupBy("genre").agg(F.count(F.lit(1)).alias("n"))
    return sorted(r.genre for r in counted.orderBy(F.desc("n"), "genre").limit(limit).collect())


def quoted(column: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    escaped = column.replace("`", "``")
    return F.col(f"`{escaped}`")


def genre_column(genre: str) -> str:
    return f"genre_{genre.lower().replace(' ', '_')}_count"


def distinct_columns(genres: Sequence[str], name: Callable[[str], str]) -> dict[str, str]:
    """Column of each genre. Names that differ in case only would clash: the later genre's gets a number, from 2 on."""
    taken = {name(g).lower() for g in genres}
    given: set[str] = set()
    columns = {}
    for genre in sorted(set(genres)):
        column = plain = name(genre)
        numbers = count(2)
        while column.lower() in (given if column == plain else taken | given):
            column = f"{plain}_{next(numbers)}"
        given.add(column.lower())
        columns[genre] = column
    return columns


def genre_counts(loans: DataFrame) -> DataFrame:
    """(patron_id, genre, n): the long form, for any number of genres."""
    kept = loans.where(F.col("patron_id").isNotNull() & F.col("genre").isNotNull())
    return kept.groupBy("patron_id", "genre").agg(F.count("book_id").alias("n"))


def genre_features(loans: DataFrame, genres: Sequence[str] | None = None) -> DataFrame:
    """Loans per listed genre; number of genres, top genre and its share over all genres, per patron.

    Of equally frequent genres the smaller name is the top one. Loans are counted by patron
    and genre first, so what is ordered per patron is one row per genre. Genres whose names differ only in case
    or between blank and underscore have columns of their own.
    """
    columns = distinct_columns(genres if genres is not None else known_genres(loans), genre_column)
    n = F.col("n")
    per_patron = genre_counts(loans).groupBy("patron_id").agg(
        *[F.sum(F.when(F.col("genre") == g, n).otherwise(0)).alias(c) for g, c in columns.items()],
        F.count_if(n > 0).alias("genre_diversity"), F.sum(n).alias("total"),
        F.min(F.struct((-n).alias("less"), "genre")).alias("top"),
    )
    return per_patron.select(
        "patron_id", *[quoted(c) for c in columns.values()], "genre_diversity", F.col("top.genre").alias("top_genre"),
        ratio_or_zero(-F.col("top.less"), F.col("total"), 3).alias("genre_concentration"),
    )


def spending_features(pos: DataFrame) -> DataFrame:
    kind, amount = F.col("transaction_type"), F.col("amount")
    # Additive sums by patron and payment method in a plain hash aggregate, then one row per patron.
    per_method = pos.where(F.col("patron_id").isNotNull()).groupBy("patron_id", "payment_method").agg(
        F.sum(amount).alias("spend"), F.count("amount").alias("n"), F.max("amount").alias("largest"),
        *[F.sum(F.when(kind == t, amount).otherwise(0.0)).alias(f"spend_{t}") for t in TRANSACTION_TYPES],
        F.max((kind == "event_ticket").cast("int")).alias("is_event_buyer"),
        F.max((kind == "donation").cast("int")).alias("is_donor"),
        F.count(F.lit(1)).alias("rows"),
    )
    used = F.when(F.col("payment_method").isNotNull(), F.struct((-F.col("rows")).alias("less"), "payment_method"))
    per_patron = per_method.groupBy("patron_id").agg(
        steady_sum(F.col("spend")).alias("spend"), F.sum("n").alias("total_pos_transactions"), F.max("largest").alias("largest"),
        *[F.sum(f"spend_{t}").alias(f"spend_{t}") for t in TRANSACTION_TYPES],
        F.max("is_event_buyer").alias("is_event_buyer"), F.max("is_donor").alias("is_donor"),
        F.min(used)["payment_method"].alias("preferred_payment"),
    )
    n = F.col("total_pos_transactions")
    return per_patron.select(
        "patron_id",
        F.round(F.coalesce("spend", F.lit(0.0)), 2).alias("total_spend"),
        "total_pos_transactions",
        steady_round(F.when(n != 0, F.col("spend") / n), 2).alias("avg_transaction_value"),
        F.round("largest", 2).alias("max_single_transaction"),
        *[F.round(f"spend_{t}", 2).alias(f"spend_{t}") for t in TRANSACTION_TYPES],
        F.coalesce("is_event_buyer", F.lit(0)).alias("is_event_buyer"),
        F.coalesce("is_donor", F.lit(0)).alias("is_donor"),
        "preferred_payment",
    )


def engagement_counts(activity: DataFrame) -> DataFrame:
    """(patron_id, event_type, device_type, n, rows): additive, so batches of a stream add up."""
    return activity.where(F.col("patron_id").isNotNull()).groupBy("patron_id", "event_type", "device_type").agg(
        F.count("event_id").alias("n"), F.count(F.lit(1)).alias("rows"))


def engagement_from_counts(counts: DataFrame) -> DataFrame:
    """Features per patron; a ratio is 0 when its denominator is 0.

    The preferred device is the most frequent of whatever devices occur, the smaller name on ties.
    """
    kind, n = F.col("event_type"), F.col("n")
    of_type = lambda t: F.sum(F.when(kind == t, n).otherwise(0))
    sums = {"total_events": F.sum(n), **{f"count_{t}": of_type(t) for t in COUNTED_EVENTS}, "total_sessions": of_type("session_start")}
    per_device = counts.groupBy("patron_id", "device_type").agg(
        *[c.alias(k) for k, c in sums.items()], F.sum("rows").alias("rows"))
    used = F.when(F.col("device_type").isNotNull(), F.struct((-F.col("rows")).alias("less"), "device_type"))
    per_patron = per_device.groupBy("patron_id").agg(*[F.sum(k).alias(k) for k in sums], F.min(used)["device_type"].alias("preferred_device"))
    count = {t: F.col(f"count_{t}") for t in COUNTED_EVENTS}
    return per_patron.select(
        "patron_id", "total_events", *count.values(),
        ratio_or_zero(count["wishlist_add"], count["book_view"], 3).alias("wishlist_conversion_rate"),
        ratio_or_zero(count["reservation_made"], count["book_search"], 3).alias("reservation_rate"),
        (count["review_submitted"] > 0).cast("int").alias("is_reviewer"),
        "preferred_device", "total_sessions",
        ratio_or_zero(F.col("total_events"), F.col("total_sessions"), 2).alias("events_per_session"),
    )


def engagement_features(activity: DataFrame) -> DataFrame:
    return engagement_from_counts(engagement_counts(activity))


def fill_by_type(df: DataFrame, key: str) -> DataFrame:
    """0 for missing numbers, "unknown" for missing text."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != key]
    fill = {**{c: F.lit(0) for c in numeric}, **{c: F.lit("unknown") for c in text}}
    return df.select(*[F.coalesce(quoted(f.name), fill[f.name].cast(f.dataType)).alias(f.name) if f.name in fill else quoted(f.name)
                       for f in df.schema.fields])


def behavioral_features(
    loans: DataFrame, pos: DataFrame, activity: DataFrame, genres: Sequence[str] | None = None
) -> DataFrame:
    """All loan patrons with genre, spending and engagement features.

    Every side is one row per patron and already partitioned by patron_id.
    """
    patrons = loans.select("patron_id").where("patron_id IS NOT NULL").distinct()
    joined = (
        patrons
        .join(genre_features(loans, genres), "patron_id", "left")
        .join(spending_features(pos), "patron_id", "left")
        .join(engagement_features(activity), "patron_id", "left")
    )
    return fill_by_type(joined, "patron_id")


def master_features(temporal: DataFrame, behavioral: DataFrame) -> DataFrame:
    return temporal.join(behavioral, "patron_id", "inner")
