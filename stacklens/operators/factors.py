"""Latent-factor models: a vector per patron and per book, scored block by block."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklens.operators.block_scores import top_scores


class NotFittedError(RuntimeError):
    """The model has no factors yet."""


@dataclass
class FactorModel:
    """(patron_id, vector) and (book_id, vector); the score is their dot product."""

    patron_factors: DataFrame | None = None
    book_factors: DataFrame | None = None

    def _check(self) -> None:
        if self.patron_factors is None or self.book_factors is None:
            raise NotFittedError("fit the model before asking for recommendations")

    def recommend(self, n: int, seen: DataFrame | None = None, patrons: DataFrame | None = None) -> DataFrame:
        """Top ``n`` unseen books for all patrons, or for those in ``patrons``; unknown ones get no rows."""
        self._check()
        queries = self.patron_factors
        if patrons is not None:
            wanted = patrons.select("patron_id").distinct()
            queries = queries.join(wanted, "patron_id", "left_semi")
            seen = seen.join(wanted, "patron_id", "left_semi") if seen is not None else None
        return top_scores(queries, self.book_factors, "patron_id", "book_id", n, exclude=seen)

    def similar(self, n: int) -> DataFrame:
        """Top ``n`` other books per book by cosine of their factors."""
        self._check()
        return top_scores(
            self.book_factors, self.book_factors.withColumnRenamed("book_id", "similar_book_id"),
            "book_id", "similar_book_id", n, cosine=True,
            exclude=self.book_factors.select("book_id", F.col("book_id").alias("similar_book_id")),
        )

    def save(self, path: str) -> None:
        self._check()
        self.patron_factors.write.mode("overwrite").parquet(f"{path}/patron_factors")
        self.book_factors.write.mode("overwrite").parquet(f"{path}/book_factors")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FactorModel:
        return cls(spark.read.parquet(f"{path}/patron_factors"), spark.read.parquet(f"{path}/book_factors"))


def gram(factors: DataFrame, dims: int) -> DataFrame:
    """One row: the dims × dims products summed over all vectors, row by row in one array.

    Each task adds up its own small matrix and sends that; the vectors stay put.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        total = np.zeros((dims, dims))
        for batch in batches:
            if len(batch):
                block = np.stack(batch["vector"].to_numpy())
                total += block.T @ block
        yield pd.DataFrame({"cell": np.arange(dims * dims), "value": total.ravel()})

    cells = factors.select("vector").mapInPandas(run, "cell int, value double").groupBy("cell").agg(
        F.sum("value").alias("value")
    )
    return cells.agg(F.array_sort(F.collect_list(F.struct("cell", "value")))["value"].alias("gram"))
