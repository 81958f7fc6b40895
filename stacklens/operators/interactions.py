"""Patron × book interaction strength and integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stacklens.session import cut_lineage

MAX_STRENGTH = 5.0


def interactions(loans: DataFrame) -> DataFrame:
    """(patron_id, book_id, interaction_score): loans plus half the renewals, at most 5.

    Grouped by the pair, so one busy patron or book spreads over all tasks.
    """
    return (
        loans.where(F.col("patron_id").isNotNull() & F.col("book_id").isNotNull())
        .groupBy("patron_id", "book_id")
        .agg((F.count("loan_status") + 0.5 * F.coalesce(F.sum("times_renewed"), F.lit(0))).alias("strength"))
        .select("patron_id", "book_id", F.least("strength", F.lit(MAX_STRENGTH)).alias("interaction_score"))
    )


def seen_pairs(loans: DataFrame) -> DataFrame:
    return loans.select("patron_id", "book_id").where("patron_id IS NOT NULL AND book_id IS NOT NULL").distinct()


def matrix_stats(strengths: DataFrame) -> DataFrame:
    """Shape, filled cells and density of the interaction matrix."""
    counts = strengths.agg(
        F.count_distinct("patron_id").alias("n_patrons"),
        F.count_distinct("book_id").alias("n_books"),
        F.count(F.lit(1)).alias("n_filled"),
    )
    return counts.withColumn(
        "density_pct", F.round(F.col("n_filled") * 100.0 / (F.col("n_patrons") * F.col("n_books")), 4)
    )


def with_global_rank(df: DataFrame, *order, name: str) -> DataFrame:
    """Number all rows 1, 2, 3 … in the given order, without a single-task window.

    A distributed sort is written out once; the position inside its partition is
    part of the row id, and the only driver-free extra is a table with one row per
    partition that holds the offsets.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort.
    offsets = sizes.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + inside + 1)
        .drop("_part", "_id", "_before")
    )


def integer_ids(keys: DataFrame, key: str) -> DataFrame:
    """(key, idx): dense integer ids 0, 1, 2 … in key order."""
    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return with_global_rank(distinct, key, name="idx").select(key, (F.col("idx") - 1).cast("int").alias("idx"))
