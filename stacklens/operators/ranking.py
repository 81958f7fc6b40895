"""Rank, filter and re-rank candidate lists of all patrons at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stacklens.operators.interactions import with_global_rank
from stacklens.session import cut_lineage

#: Largest popularity rank up to which the ranks are broadcast, and parts of a rank beyond it.
BROADCAST_RANKS = 100_000
SALTS = 64


def exclude_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    return candidates.join(seen.select("patron_id", "book_id"), ["patron_id", "book_id"], "left_anti")


def top_n(candidates: DataFrame, n: int, score: str = "score") -> DataFrame:
    """``n`` best rows per patron: score descending, then book_id; adds ``rank``."""
    best_first = Window.partitionBy("patron_id").orderBy(F.desc(score), "book_id")
    return candidates.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n)


def popularity_ranks(catalog: DataFrame) -> DataFrame:
    """(book_id, total_borrows, popularity_rank) over the whole catalog."""
    return with_global_rank(
        catalog.select("book_id", "total_borrows"), F.desc("total_borrows"), F.asc("book_id"), name="popularity_rank"
    )


def popular_unseen(seen: DataFrame, ranked: DataFrame, n: int, patrons: DataFrame | None = None) -> DataFrame:
    """The ``n`` most borrowed books each patron has not had: (patron_id, book_id, score, rank).

    For the patrons of ``seen``, or all of ``patrons``: those without loans get the most
    borrowed books. If a patron's i-th seen book (by popularity) has popularity rank r, then r - i
    unseen books come before it. So the j-th unseen book has rank j plus the number
    of seen books with r - i < j. Only the n result rows per patron are produced;
    no patron meets the whole catalog.
    """
    seen_ranks = seen.join(ranked.select("book_id", "popularity_rank"), "book_id")
    by_rank = Window.partitionBy("patron_id").orderBy("popularity_rank")
    unseen_before = cut_lineage(
        seen_ranks.withColumn("gap", F.col("popularity_rank") - F.row_number().over(by_rank))
        .where(F.col("gap") < n)
        .groupBy("patron_id", "gap").agg(F.count(F.lit(1)).alias("seen_here"))
        .groupBy("patron_id").agg(F.collect_list(F.struct("gap", "seen_here")).alias("gaps"), F.sum("seen_here").alias("skipped"))
    )
    everyone = (seen if patrons is None else patrons).select("patron_id").where("patron_id IS NOT NULL").distinct()
    slots = everyone.join(unseen_before, "patron_id", "left").withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(n))))
    skipped = F.aggregate(
        F.filter(F.coalesce("gaps", F.array().cast("array<struct<gap:bigint,seen_here:bigint>>")),
                 lambda g: g["gap"] < F.col("rank")),
        F.lit(0).cast("long"), lambda acc, g: acc + g["seen_here"],
    )
    wanted = slots.select("patron_id", "rank", (F.col("rank") + skipped).alias("popularity_rank"))
    # All patrons want the same few ranks: no one asks for more than n and the most books any patron skips.
    deepest = n + (unseen_before.agg(F.max("skipped")).first()[0] or 0)
    asked = ranked.where(F.col("popularity_rank") <= deepest)
    if deepest <= BROADCAST_RANKS:
        found = wanted.join(F.broadcast(asked), "popularity_rank")
    else:
        # The popular ranks would meet in one task each, so both sides are dealt by a salt too.
        salt = F.pmod(F.xxhash64("patron_id"), F.lit(SALTS)).cast("int")
        salted = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = wanted.withColumn("salt", salt).join(salted, ["popularity_rank", "salt"])
    return found.select("patron_id", "book_id", F.col("total_borrows").cast("double").alias("score"), "rank")


def minmax_normalise(candidates: DataFrame, score: str = "score") -> DataFrame:
    """Scale scores to [0, 1] inside each (patron, model) list; all equal gives 1."""
    one_list = Window.partitionBy("patron_id", "model")
    low, high = F.min(score).over(one_list), F.max(score).over(one_list)
    return candidates.withColumn("_low", low).withColumn("_high", high).withColumn(
        "normalized_score",
        F.when(F.col("_high") == F.col("_low"), F.lit(1.0))
        .otherwise((F.col(score) - F.col("_low")) / (F.col("_high") - F.col("_low"))),
    ).drop("_low", "_high")


def fuse(candidates: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted sum of normalised scores per (patron, book); a model without the book adds 0."""
    weight = F.lit(0.0)
    for model, w in weights.items():
        weight = F.when(F.col("model") == model, F.lit(float(w))).otherwise(weight)
    fused = candidates.withColumn("part", weight * F.col("normalized_score")).groupBy("patron_id", "book_id")
    # Rounding to 9 digits first takes out the summation order.
    return fused.agg(F.round(F.round(F.sum("part"), 9), 4).alias("fused_score"))


def apply_boosts(
    fused: DataFrame,
    catalog: DataFrame,
    top_genres: DataFrame,
    popularity_boost: float = 0.05,
    genre_boost: float = 0.02,
) -> DataFrame:
    """Add the popularity and the favourite-genre boost: (…, combined_score, genre).

    The popularity boost is relative to the most borrowed book of the same list.
    """
    in_list = Window.partitionBy("patron_id")
    joined = (
        fused.join(catalog.select("book_id", "genre", "total_borrows"), "book_id", "left")
        .join(top_genres.select("patron_id", "modal_genre"), "patron_id", "left")
        .withColumn("_most", F.max("total_borrows").over(in_list))
    )
    boost = F.when(F.col("_most") > 0, popularity_boost * F.col("total_borrows") / F.col("_most")).otherwise(0.0)
    favourite = F.when(F.col("genre") == F.col("modal_genre"), F.lit(genre_boost)).otherwise(0.0)
    return joined.select(
        "patron_id", "book_id", "genre",
        F.round(F.col("fused_score") + F.coalesce(boost, F.lit(0.0)) + favourite, 9).alias("combined_score"),
    )


def diversity_cap(scored: DataFrame, cap: int, n: int) -> DataFrame:
    """Best ``n`` per patron with at most ``cap`` of one genre; adds ``rank``.

    Taking the cap best of each genre first and then the n best overall gives the
    same list as scanning greedily.
    """
    in_genre = Window.partitionBy("patron_id", "genre").orderBy(F.desc("combined_score"), "book_id")
    capped = scored.withColumn("_place", F.row_number().over(in_genre)).where(F.col("_place") <= cap).drop("_place")
    return top_n(capped, n, "combined_score")
