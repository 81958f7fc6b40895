"""Splits and ranking metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklens.functions.numeric import steady_round


def split_by_hash(loans: DataFrame, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Split that depends on neither partitioning nor engine: by the md5 of patron, book and checkout second.

    Loans of one book by one patron at one time fall on the same side.
    """
    key = F.concat_ws("|", "patron_id", "book_id", F.unix_timestamp("checkout_date").cast("string"))
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 100
    return loans.where(bucket < train_pct), loans.where(bucket >= train_pct)


def split_by_date(loans: DataFrame, holdout_start: Column) -> tuple[DataFrame, DataFrame]:
    before = F.col("checkout_date") < holdout_start
    return loans.where(before), loans.where(~before)


def _hits(recommendations: DataFrame, holdout: DataFrame, k: int) -> DataFrame:
    """Per patron of the holdout: number of relevant books, hits in the top k, DCG."""
    relevant = holdout.select("patron_id", "book_id").distinct()
    per_patron = relevant.groupBy("patron_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    hits = (
        recommendations.where(F.col("rank") <= k)
        .join(relevant, ["patron_id", "book_id"], "left_semi")
        .groupBy("patron_id")
        .agg(
            F.count(F.lit(1)).alias("hits"),
            F.sum(F.lit(1.0) / F.log2(F.col("rank") + F.lit(1.0))).alias("dcg"),
        )
    )
    return per_patron.join(hits, "patron_id", "left").fillna(0, subset=["hits", "dcg"])


def ranking_metrics(recommendations: DataFrame, holdout: DataFrame, k: int = 10) -> DataFrame:
    """One row: means over the holdout patrons of hits/k, hits/relevant and DCG over the best possible DCG."""
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n_relevant"), F.lit(k)).cast("int")), F.lit(0.0),
        lambda acc, i: acc + F.lit(1.0) / F.log2(i + F.lit(1.0)),
    )
    return _hits(recommendations, holdout, k).agg(
        F.count(F.lit(1)).alias("n_patrons"),
        steady_round(F.avg(F.col("hits") / F.lit(float(k))), 6).alias("precision_at_k"),
        steady_round(F.avg(F.col("hits") / F.col("n_relevant")), 6).alias("recall_at_k"),
        steady_round(F.avg(F.col("dcg") / ideal), 6).alias("ndcg_at_k"),
    )


def precision_recall_at_k(recommendations: DataFrame, holdout: DataFrame, k: int = 10) -> DataFrame:
    return ranking_metrics(recommendations, holdout, k).drop("ndcg_at_k")


def ndcg_at_k(recommendations: DataFrame, holdout: DataFrame, k: int = 10) -> DataFrame:
    return ranking_metrics(recommendations, holdout, k).select("n_patrons", "ndcg_at_k")


def compare_models(lists: dict[str, DataFrame], holdout: DataFrame, k: int = 10) -> DataFrame:
    """One row per model: precision, recall and NDCG at k, from one pass over its list."""
    rows = None
    for model, recs in lists.items():
        row = ranking_metrics(recs, holdout, k).select(
            F.lit(model).alias("model"), "n_patrons", "precision_at_k", "recall_at_k", "ndcg_at_k")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def precision_over_time(recommendations: DataFrame, holdout: DataFrame, period: Column, k: int = 10) -> DataFrame:
    """Precision at k per period of the holdout, over the patrons active in that period."""
    relevant = holdout.select("patron_id", "book_id", period.alias("period")).distinct()
    active = relevant.groupBy("period").agg(F.count_distinct("patron_id").alias("n_patrons"))
    hits = (
        relevant.join(recommendations.where(F.col("rank") <= k), ["patron_id", "book_id"], "left_semi")
        .groupBy("period").agg(F.count(F.lit(1)).alias("hits"))
    )
    return active.join(hits, "period", "left").select(
        "period", "n_patrons",
        F.round(F.coalesce("hits", F.lit(0)) / (F.lit(float(k)) * F.col("n_patrons")), 6).alias("precision_at_k"),
    )
