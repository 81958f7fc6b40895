"""The equations of MLlib's ALS where its messages would not fit: the ridge of a patron or book is scaled by its cells.

Cells are written once in blocks by patron and by book. A task holds one block of cells, puts their vectors into their places while it
reads those of the other side stripe by stripe, and solves, so a half-step shuffles nothing and writes one vector per patron or book.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.operators import svd
from stacklens.operators.factors import FactorModel
from stacklens.operators.svd import held_whole
from stacklens.session import cut_lineage, file_per_task

#: Cells of a block that a task holds at most, about, and of the smallest worth a task; systems solved at once.
HELD_CELLS, LEAST_CELLS = 1 << 20, 1 << 14
AT_ONCE = 1024


def start_vectors(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """(idx, vector): directions of length 1, drawn by a hash of the index and ``seed``."""
    uniform = lambda j: (F.pmod(F.xxhash64("idx", F.lit(j), F.lit(seed)), F.lit(1 << 30)) + 1) / F.lit(float(1 << 30) + 2)
    normal = [F.sqrt(-2 * F.log(uniform(2 * j))) * F.cos(2 * math.pi * uniform(2 * j + 1)) for j in range(rank)]
    drawn = ids.select("idx", F.array(*normal).alias("drawn"))
    length = F.sqrt(F.aggregate("drawn", F.lit(0.0), lambda acc, x: acc + x * x))
    return drawn.select("idx", F.transform("drawn", lambda x: x / length).alias("vector"))


def _solve(vectors: np.ndarray, weights: np.ndarray, starts: np.ndarray, every: np.ndarray, ridge: float, alpha: float | None) -> np.ndarray:
    """Vectors of rows whose cells are those from one start to the next."""
    n, rank = len(starts) - 1, vectors.shape[1]
    found, diagonal = np.zeros((n, rank)), np.arange(rank)
    for at in range(0, n, AT_ONCE):
        cuts = starts[at:at + AT_ONCE + 1].tolist()
        v, w = vectors[cuts[0]:cuts[-1]], weights[cuts[0]:cuts[-1]]
        if alpha is None:
            scaled, right, counted = v, w, np.ones(len(w))
        else:
            scaled, right, counted = v * (alpha * np.abs(w))[:, None], np.where(w > 0, 1.0 + alpha * np.abs(w), 0.0), (w > 0).astype(np.float64)
        square, sums, ends = np.empty((len(cuts) - 1, rank, rank)), np.empty((len(cuts) - 1, rank)), np.concatenate(([0.0], np.cumsum(counted)))
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            lo, hi = lo - cuts[0], hi - cuts[0]
            np.dot(scaled[lo:hi].T, v[lo:hi], out=square[i])
            np.dot(right[lo:hi], v[lo:hi], out=sums[i])
        square += every
        inside = np.array(cuts) - cuts[0]
        # Rows that no cell counts for keep a ridge, as a matrix of zeros has no single solution.
        square[:, diagonal, diagonal] += (ridge * np.maximum(ends[inside[1:]] - ends[inside[:-1]], 1.0))[:, None]
        found[at:at + AT_ONCE] = np.linalg.solve(square, sums[:, :, None])[:, :, 0]
    return found


def _solved(cells: DataFrame, vectors: DataFrame, rank: int, ridge: float, alpha: float | None, n_rows: int, blocks: int, stripes: int) -> DataFrame:
    """Vectors of the rows, in ``stripes``, from those of the columns; ``alpha`` for implicit feedback."""
    every = svd._gram(vectors, rank) if alpha is not None else np.zeros((rank, rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block, size = batch["block"][i].as_py(), batch["size"][i].as_py()
                if block not in held:
                    held[block] = np.empty((size, rank)), np.empty(size), np.zeros((n_rows - block + blocks - 1) // blocks, np.int64)
                rows, places, weights, slots, thin = (np.frombuffer(batch[c][i].as_buffer(), kind) for c, kind in (
                    ("rows", np.int32), ("places", np.int32), ("weights", np.float64), ("slots", np.int32), ("vectors", np.float64)))
                picked, strengths, counts = held[block]
                # Every cell has its slot, so vectors are held once, in order of rows.
                picked[slots] = thin.reshape(-1, rank).take(places, axis=0)
                strengths[slots] = weights
                counts += np.bincount(rows, minlength=len(counts))
        for block in list(held):
            picked, strengths, counts = held.pop(block)
            found = _solve(picked, strengths, np.concatenate(([0], np.cumsum(counts))), every, ridge, alpha)
            del picked
            yield svd.striped(blocks, stripes, {block: found})

    streamed = vectors.select(F.col("block").alias("other"), "vectors").coalesce(1).hint("shuffle_replicate_nl")
    met = streamed.join(cells, F.col("other") == F.col("stripe")).select("block", "size", "rows", "places", "weights", "slots", "vectors")
    with file_per_task(cells.sparkSession):
        return cut_lineage(met.mapInArrow(run, svd.VECTORS))


def fit(
    ratings: DataFrame, patrons: DataFrame, books: DataFrame, rank: int, iterations: int, regularization: float, seed: int,
    implicit: bool = False, alpha: float = 1.0,
) -> FactorModel:
    """Factors from ``ratings`` (user, item, rating) and the numbered ids (key, idx): items first, as MLlib does."""
    n_cells, n_patrons, n_books = ratings.count(), patrons.count(), books.count()
    wanted = 2 * ratings.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(n_cells / HELD_CELLS), min(wanted, math.ceil(n_cells / LEAST_CELLS)))
    cells = ratings.select("user", "item", F.col("rating").cast("double").alias("weight"))
    patron_stripes, book_stripes = (svd.stripes_of(n, rank, blocks) for n in (n_patrons, n_books))
    by_patron, by_book = (held_whole(svd._cell_blocks(cells, *sides, blocks, stripes, True), blocks) for *sides, stripes in (
        ("user", "item", book_stripes), ("item", "user", patron_stripes)))
    of_patrons, strength = svd._vector_blocks(start_vectors(patrons, rank, seed), patron_stripes), alpha if implicit else None
    for _ in range(iterations):
        of_books = _solved(by_book, of_patrons, rank, regularization, strength, n_books, blocks, book_stripes)
        of_patrons = _solved(by_patron, of_books, rank, regularization, strength, n_patrons, blocks, patron_stripes)
    return FactorModel(svd._named(of_patrons, np.eye(rank), patrons, "patron_id", patron_stripes),
                       svd._named(of_books, np.eye(rank), books, "book_id", book_stripes))
