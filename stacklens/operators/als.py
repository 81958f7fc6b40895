"""Alternating least squares on the interaction strengths: MLlib's, and beyond a size its equations block by block."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.operators import als_blocks
from stacklens.operators.factors import FactorModel, gram
from stacklens.operators.interactions import integer_ids
from stacklens.session import cut_lineage, shared_dir, shuffle_partitions

#: Strengths up to which MLlib fits: each half-step it shuffles nearly a vector per strength.
MLLIB_CELLS = 2_000_000


def fit(
    strengths: DataFrame,
    rank: int = 50,
    iterations: int = 20,
    regularization: float = 0.01,
    seed: int = 42,
    implicit: bool = False,
    alpha: float = 1.0,
) -> FactorModel:
    """Factors for all patrons and books of ``strengths``.

    ``strengths`` is read four times; the caller writes it out once. The integer ids MLlib needs come from a distributed numbering, so no id list
    passes through the driver.
    """
    spark = strengths.sparkSession
    shared_dir(spark)
    if iterations > 0 and strengths.count() > MLLIB_CELLS:
        patrons, books = (cut_lineage(integer_ids(strengths, key)) for key in ("patron_id", "book_id"))
        ratings = cut_lineage(_ratings(strengths, patrons, books))
        return als_blocks.fit(ratings, patrons, books, rank, iterations, regularization, seed, implicit, alpha)
    patrons, books = integer_ids(strengths, "patron_id"), integer_ids(strengths, "book_id")
    ratings = _ratings(strengths, patrons, books)
    blocks = shuffle_partitions(spark)
    model = ALS(
        rank=rank, maxIter=iterations, regParam=regularization, seed=seed, implicitPrefs=implicit, alpha=alpha,
        numUserBlocks=blocks, numItemBlocks=blocks, coldStartStrategy="drop",
        intermediateStorageLevel="MEMORY_AND_DISK", finalStorageLevel="MEMORY_AND_DISK",
    ).fit(ratings)

    def named(factors: DataFrame, ids: DataFrame, key: str) -> DataFrame:
        joined = factors.join(ids, factors.id == ids.idx)
        return cut_lineage(joined.select(key, F.col("features").cast("array<double>").alias("vector")))

    return FactorModel(named(model.userFactors, patrons, "patron_id"), named(model.itemFactors, books, "book_id"))


def _ratings(strengths: DataFrame, patrons: DataFrame, books: DataFrame) -> DataFrame:
    return (
        strengths.join(patrons.withColumnRenamed("idx", "user"), "patron_id")
        .join(books.withColumnRenamed("idx", "item"), "book_id")
        .select("user", "item", F.col("interaction_score").cast("float").alias("rating"))
    )


def _with_prediction(strengths: DataFrame, model: FactorModel) -> DataFrame:
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    return (
        strengths.join(model.patron_factors.withColumnRenamed("vector", "u"), "patron_id")
        .join(model.book_factors.withColumnRenamed("vector", "v"), "book_id")
        .withColumn("predicted", dot)
    )


def loss(strengths: DataFrame, model: FactorModel, rank: int) -> DataFrame:
    """One row: RMSE on the filled cells and the mean squared error over the whole matrix.

    The empty cells are never enumerated: the sum of all squared predictions is the
    trace of the product of the two rank × rank Gram matrices.
    """
    # Two arrays of rank² numbers.
    grams = strengths.sparkSession.range(1).select(
        gram(model.patron_factors, rank).scalar().alias("u"), gram(model.book_factors, rank).scalar().alias("v")
    )
    squares = grams.select(
        F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    ).scalar()
    r, p = F.col("interaction_score"), F.col("predicted")
    filled = _with_prediction(strengths, model).agg(
        F.count(F.lit(1)).alias("n_filled"),
        F.sum((r - p) * (r - p)).alias("se"),
        F.sum(r * r - 2 * r * p).alias("cross"),
        F.avg(r).alias("mean"), F.var_pop(r).alias("variance"),
    )
    cells = (
        model.patron_factors.agg(F.count(F.lit(1))).scalar() * model.book_factors.agg(F.count(F.lit(1))).scalar()
    )
    return filled.select(
        "n_filled",
        F.round(F.sqrt(F.col("se") / F.col("n_filled")), 4).alias("observed_rmse"),
        F.round(F.sqrt("variance"), 4).alias("mean_predictor_rmse"),
        F.round((F.col("cross") + squares) / cells, 4).alias("full_matrix_mse"),
    )
