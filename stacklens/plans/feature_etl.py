"""Daily feature job: read, gate, build the feature tables, write them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklens.operators import behavioral, catalog, temporal, tfidf, validation
from stacklens.sources.writers import write_table

TFIDF_FEATURES = 50


def content_docs(books: DataFrame) -> DataFrame:
    genre = F.col("genre")
    return books.select("book_id", F.concat_ws(" ", "book_title", genre, genre, genre).alias("text"))


def run(
    spark: SparkSession, loans: DataFrame, pos: DataFrame, activity: DataFrame, out: str, mode: str = "strict"
) -> dict[str, str]:
    """Write raw and feature tables under ``out``; returns name → path.

    The validated tables are written first and read back, so that all feature plans
    start from pruned column scans instead of repeating the extraction.
    """
    validation.gate(validation.check_all(loans, pos, activity), mode)
    paths = {
        "loans_raw": write_table(loans, f"{out}/loans_raw", month_of="checkout_date"),
        "pos_raw": write_table(pos, f"{out}/pos_raw"),
        "activity_raw": write_table(activity, f"{out}/activity_raw"),
    }
    loans, pos, activity = (spark.read.parquet(paths[f"{t}_raw"]) for t in ("loans", "pos", "activity"))
    genres = behavioral.known_genres(loans)

    def save(name: str, df: DataFrame) -> DataFrame:
        paths[name] = write_table(df, f"{out}/{name}")
        return spark.read.parquet(paths[name])

    timely = save("temporal_features", temporal.temporal_features(loans))
    habits = save("behavioral_features", behavioral.behavioral_features(loans, pos, activity, genres))
    # Every genre, also those beyond the wide columns.
    save("genre_counts", behavioral.genre_counts(loans))
    books = save("book_metadata", catalog.book_metadata(loans))
    save("genre_encoding", catalog.genre_encoding(books, genres))
    docs = content_docs(books)
    vocab, weighted = tfidf.fit(docs, "book_id", "text", TFIDF_FEATURES)
    save("tfidf_features", tfidf.wide(docs, weighted, vocab, "book_id"))
    save("master_features", behavioral.master_features(timely, habits))
    return paths
