"""Recommendations from dense book vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stacklens.operators.block_scores import top_scores


def encode(texts: DataFrame, encoder: Callable, key: str = "book_id", text: str = "sentence") -> DataFrame:
    """(key, vector) by a caller-supplied ``encoder(list[str]) -> 2-D array``, one Arrow batch at a time."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            vectors = encoder(batch[text].tolist())
            yield pd.DataFrame({key: batch[key], "vector": [list(map(float, v)) for v in vectors]})

    return texts.select(key, text).mapInPandas(run, f"{key} string, vector array<float>")


def recency_weights(loans: DataFrame, vectors: DataFrame) -> DataFrame:
    """(patron_id, book_id, weight) for the borrowed books that have a vector.

    Books are ordered by their latest checkout (then book_id); weights rise linearly
    from 0.5 to 1 and are scaled to sum 1. A single book weighs 1.
    """
    latest = (
        loans.where(F.col("patron_id").isNotNull())
        .groupBy("patron_id", "book_id").agg(F.max("checkout_date").alias("latest"))
        .join(vectors.select("book_id"), "book_id")
    )
    by_patron = Window.partitionBy("patron_id")
    placed = latest.select(
        "patron_id", "book_id",
        F.row_number().over(by_patron.orderBy("latest", "book_id")).alias("place"),
        F.count(F.lit(1)).over(by_patron).alias("n"),
    )
    raw = 0.5 + 0.5 * (F.col("place") - 1) / (F.col("n") - 1)
    weight = F.when(F.col("n") == 1, F.lit(1.0)).otherwise(raw / (0.75 * F.col("n")))
    return placed.select("patron_id", "book_id", weight.alias("weight"))


def dimensions(vectors: DataFrame) -> int:
    first = vectors.select(F.size("vector").alias("d")).first()
    return 0 if first is None else first.d


def profiles(loans: DataFrame, vectors: DataFrame, recency: bool = True) -> DataFrame:
    """(patron_id, vector): weighted mean of the borrowed books' vectors.

    One sum per dimension in a single hash aggregate, so each task sends one row per
    patron however many books that patron had.
    """
    if recency:
        weighted = recency_weights(loans, vectors)
    else:
        weighted = loans.select("patron_id", "book_id").distinct().withColumn("weight", F.lit(1.0))
    rows = weighted.join(vectors, "book_id")
    sums = rows.groupBy("patron_id").agg(
        F.sum("weight").alias("_w"),
        *[F.sum(F.col("weight") * F.get("vector", F.lit(i))).alias(f"_{i}") for i in range(dimensions(vectors))],
    )
    return sums.select(
        "patron_id", F.array(*[F.col(f"_{i}") / F.col("_w") for i in range(len(sums.columns) - 2)]).alias("vector")
    )


def recommend(loans: DataFrame, seen: DataFrame, vectors: DataFrame, n: int, do_exclude_seen: bool = True) -> DataFrame:
    """Top ``n`` books by cosine of the recency-weighted profile; patrons without a known vector get no rows."""
    return top_scores(
        profiles(loans, vectors), vectors, "patron_id", "book_id", n,
        exclude=seen if do_exclude_seen else None, cosine=True,
        n_queries=seen.select("patron_id").distinct().count(), n_items=vectors.count(),
    )


def similar(vectors: DataFrame, n: int) -> DataFrame:
    """Exact nearest books by cosine, the book itself left out."""
    return top_scores(
        vectors, vectors.withColumnRenamed("book_id", "similar_book_id"), "book_id", "similar_book_id", n,
        exclude=vectors.select("book_id", F.col("book_id").alias("similar_book_id")), cosine=True,
    )


def save(path: str, vectors: DataFrame) -> None:
    vectors.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, vector) as saved."""
    return spark.read.parquet(path)
