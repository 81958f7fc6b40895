"""Truncated SVD of the interaction matrix by subspace iteration.

The strengths are written once as sparse row blocks: the patrons of a block with all their books, under small
integers. A step sends the thin matrix of the books to the blocks and adds up one thin matrix per task, so no strength moves.
Above a size of the thin matrix, strengths are written in blocks by patron and by book, and vectors in stripes. A task holds one
block of strengths and reads the vectors of the other side stripe by stripe, so a step shuffles nothing and writes one vector
per patron and book; only small (k + oversample)² Gram matrices reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.operators.factors import FactorModel
from stacklens.operators.interactions import integer_ids
from stacklens.session import cut_lineage, file_per_task, shuffle_partitions

#: Bytes of the thin matrix (books × columns) that is sent to all tasks; beyond it the vectors stay DataFrames.
THIN_BYTES = 8 << 20
#: Strengths of a row block, about.
BLOCK_CELLS = 1 << 14
#: Strengths of a block that a task holds at most, about, where vectors stay DataFrames, and of the smallest worth a task.
HELD_CELLS, LEAST_CELLS = 1 << 23, 1 << 14
#: Bytes of the vectors that travel as one row where they stay DataFrames, about: large rows cost the JVM several times their time.
ROW_BYTES = 1 << 20
#: Cells of a row and stripe that are added one after the other, and cells added at once: their vectors stay in the cache of a core.
TURNS, CELLS_AT_ONCE = 32, 4096
#: Books whose sums travel as one row.
BOOKS_PER_ROW = 1024


@dataclass
class SvdModel(FactorModel):
    singular_values: tuple[float, ...] = ()

    def save(self, path: str) -> None:
        super().save(path)
        spark = self.book_factors.sparkSession
        rows = spark.createDataFrame(list(enumerate(self.singular_values)), "component int, value double")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/singular_values")

    @classmethod
    def load(cls, spark, path: str) -> SvdModel:
        model = FactorModel.load(spark, path)
        values = spark.read.parquet(f"{path}/singular_values").orderBy("component").collect()
        return cls(model.patron_factors, model.book_factors, tuple(r.value for r in values))


def _gram(vectors: DataFrame, dims: int) -> np.ndarray:
    """The dims × dims products summed over all vectors of ``VECTORS`` blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            for part in batch["vectors"]:
                block = np.frombuffer(part.as_buffer()).reshape(-1, dims)
                total += block.T @ block
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims), pa.int32()), pa.array(total.ravel())], ["cell", "value"])

    cells = vectors.select("vectors").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = np.zeros(dims * dims)
    for r in cells.collect():
        found[r["cell"]] = r["value"]
    return found.reshape(dims, dims)


def _orthonormal(vectors: DataFrame, dims: int) -> np.ndarray:
    """The small matrix that makes the columns orthonormal."""
    values, rotation = np.linalg.eigh(_gram(vectors, dims))
    good = values > values.max() * 1e-14
    return rotation * np.where(good, 1.0 / np.sqrt(np.where(good, values, 1.0)), 0.0)


VECTORS = "block int, vectors binary"


def _cell_blocks(cells: DataFrame, row: str, column: str, blocks: int, stripes: int, slots: bool = False) -> DataFrame:
    """A row per block and stripe: its cells as (row within the block, place within the stripe, weight).

    Row ``i`` is in block i mod ``blocks`` at i div ``blocks``, column likewise in its stripe. A block is written to one file. First come
    the first cells of all rows, then their second cells, and so on, from ``TURNS`` on all that are left. With ``slots`` also the slot of each cell in
    its block in order of rows, and how many cells the block has.
    """

    def pack(table: pa.Table) -> pa.Table:
        rows, stripe, places, weights = (table[c].to_numpy() for c in ("row", "stripe", "place", "weight"))
        order = np.lexsort((rows, stripe))
        first = np.flatnonzero(np.concatenate(([True], (rows[order][1:] != rows[order][:-1]) | (stripe[order][1:] != stripe[order][:-1]))))
        turns = np.minimum(np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order)))), TURNS)
        order = order[np.lexsort((turns, stripe[order]))]
        starts = np.searchsorted(stripe[order], np.arange(stripes + 1))
        used = np.flatnonzero(starts[1:] > starts[:-1])
        cut = lambda values, kind: pa.array([v.tobytes() for v in np.split(values[order].astype(kind), starts[1:-1]) if len(v)], pa.binary())
        columns = {
            "block": pa.array(np.full(len(used), table["block"][0].as_py()), pa.int32()), "stripe": pa.array(used, pa.int32()),
            "rows": cut(rows, np.int32), "places": cut(places, np.int32), "weights": cut(weights, np.float64)}
        if slots:
            place = np.empty(len(rows), np.int32)
            place[np.argsort(rows, kind="stable")] = np.arange(len(rows))
            columns |= {"slots": cut(place, np.int32), "size": pa.array(np.full(len(used), len(rows)), pa.int32())}
        return pa.table(columns)

    split = lambda c, n: (F.pmod(c, F.lit(n)).cast("int"), F.floor(F.col(c) / n).cast("int"))
    (block, inside), (stripe, place) = split(row, blocks), split(column, stripes)
    dealt = cells.select(block.alias("block"), inside.alias("row"), stripe.alias("stripe"), place.alias("place"), "weight")
    schema = "block int, stripe int, rows binary, places binary, weights binary" + (", slots binary, size int" if slots else "")
    # A block is a partition before and after it is packed.
    return cut_lineage(dealt.repartitionById(blocks, F.col("block")).groupBy("block").applyInArrow(pack, schema))


def stripes_of(n_rows: int, dims: int, blocks: int) -> int:
    """Stripes in which ``n_rows`` vectors travel: some to each block, of about ``ROW_BYTES``."""
    return blocks * max(1, round(n_rows * dims * 8 / blocks / ROW_BYTES))


def striped(blocks: int, stripes: int, images: dict[int, np.ndarray]) -> pa.RecordBatch:
    """``VECTORS`` in stripes from those of whole blocks; ``stripes`` is a multiple of ``blocks``."""
    split = stripes // blocks
    return pa.RecordBatch.from_arrays([
        pa.array([block + blocks * t for block in images for t in range(split)], pa.int32()),
        pa.array([x[t::split].tobytes() for x in images.values() for t in range(split)], pa.binary())], ["block", "vectors"])


def _add_cells(image: np.ndarray, rows: np.ndarray, places: np.ndarray, weights: np.ndarray, thin: np.ndarray, buffer: np.ndarray) -> None:
    """Adds the weighted vectors of the cells to their rows of ``image``."""
    cuts = [0, *(np.flatnonzero(rows[1:] < rows[:-1]) + 1), len(rows)]
    for start, stop in zip(cuts, cuts[1:]):
        for lo in range(start, stop, len(buffer)):
            at = slice(lo, min(lo + len(buffer), stop))
            part, into = buffer[:at.stop - lo], rows[at]
            np.take(thin, places[at], axis=0, out=part, mode="clip")
            part *= weights[at, None]
            first = np.flatnonzero(np.concatenate(([True], into[1:] != into[:-1])))
            if len(first) == len(into):
                image[into] += part
            else:
                image[into[first]] += np.add.reduceat(part, first, axis=0)


def held_whole(cells: DataFrame, blocks: int) -> DataFrame:
    """``cells`` with every block in one partition; only where a file is read in several parts they are shuffled for it."""
    places = cells.select("block", F.spark_partition_id().alias("part")).distinct()
    return cells.repartitionById(blocks, F.col("block")) if places.count() > places.select("block").distinct().count() else cells


def _times(
    cells: DataFrame, vectors: DataFrame, rotation: np.ndarray, n_rows: int, blocks: int, whole: bool = False, stripes: int | None = None,
) -> DataFrame:
    """``VECTORS`` of the rows: the cells times the other side's vectors times ``rotation``; ``whole`` if each block is known to be in one partition.

    They come in as many ``stripes``, or one row per block.
    """
    dims = rotation.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        images, buffer = {}, np.empty((CELLS_AT_ONCE, dims))
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch["block"][i].as_py()
                if block not in images:
                    images[block] = np.zeros(((n_rows - block + blocks - 1) // blocks, dims))
                rows, places, weights, thin = (np.frombuffer(batch[c][i].as_buffer(), kind) for c, kind in (
                    ("rows", np.int32), ("places", np.int32), ("weights", np.float64), ("vectors", np.float64)))
                _add_cells(images[block], rows, places, weights, thin.reshape(-1, dims), buffer)
        for block in list(images):
            yield striped(blocks, stripes or blocks, {block: images.pop(block) @ rotation})

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_buffer()) for p in parts["vectors"])
        return pa.table({"block": parts["block"].combine_chunks().slice(0, 1), "vectors": pa.array([total.tobytes()], pa.binary())})

    # One partition of vectors: a task holds its cells and reads the vectors one block after the other.
    streamed = vectors.select(F.col("block").alias("other"), "vectors").coalesce(1).hint("shuffle_replicate_nl")
    with file_per_task(cells.sparkSession):
        found = cut_lineage(streamed.join(cells, F.col("other") == F.col("stripe")).select(
            "block", "rows", "places", "weights", "vectors").mapInArrow(run, VECTORS))
    # A block in several partitions is given several times.
    if not whole and found.count() > found.select("block").distinct().count():
        found = cut_lineage(found.groupBy("block").applyInArrow(add, VECTORS))
    return found


def _vector_blocks(vectors: DataFrame, blocks: int) -> DataFrame:
    """(idx, vector) as ``VECTORS``."""

    def pack(table: pa.Table) -> pa.Table:
        rows = table.sort_by("idx")
        return pa.table({"block": rows["block"].combine_chunks().slice(0, 1), "vectors": pa.array(
            [rows["vector"].combine_chunks().flatten().to_numpy().tobytes()], pa.binary())})

    dealt = vectors.select(F.pmod("idx", F.lit(blocks)).cast("int").alias("block"), "idx", "vector")
    return cut_lineage(dealt.groupBy("block").applyInArrow(pack, VECTORS))


def _named(vectors: DataFrame, rotation: np.ndarray, ids: DataFrame, key: str, blocks: int) -> DataFrame:
    """(key, vector): the vectors of the blocks times ``rotation``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, part in zip(batch["block"].to_pylist(), batch["vectors"]):
                rows = np.frombuffer(part.as_buffer()).reshape(-1, rotation.shape[0]) @ rotation
                offsets = np.arange(len(rows) + 1, dtype=np.int32) * rotation.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows)) * blocks + block, pa.int32()), pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(rows.ravel()))], ["idx", "vector"])

    return cut_lineage(vectors.mapInArrow(run, "idx int, vector array<double>").join(ids, "idx").select(key, "vector"))


BLOCK = "patrons array<string>, starts array<int>, books array<int>, weights array<double>"


def row_blocks(strengths: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per block: its patrons, where the cells of each start, and books (integers) and weights of the cells.

    A patron is in one block with all books, at most the catalog; patrons are dealt by hash.
    """
    blocks = max(1, math.ceil(strengths.count() / BLOCK_CELLS))
    # The work per byte is high, so the partition number is fixed and not left to size-based coalescing.
    tasks = min(blocks, shuffle_partitions(strengths.sparkSession))

    def pack(cells):
        import numpy as np
        import pandas as pd

        cells = cells.sort_values(["patron_id", "idx"], kind="stable")
        patrons = cells["patron_id"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], patrons[1:] != patrons[:-1])))
        return pd.DataFrame({"patrons": [patrons[starts].tolist()], "starts": [starts.astype(np.int32)],
                             "books": [cells["idx"].to_numpy(np.int32)], "weights": [cells["interaction_score"].to_numpy(np.float64)]})

    cells = strengths.join(ids, "book_id").select("patron_id", "idx", "interaction_score")
    dealt = cells.withColumn("block", F.pmod(F.xxhash64("patron_id"), F.lit(blocks)))
    return dealt.repartition(tasks, "block").groupBy("block").applyInPandas(pack, BLOCK)


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(patrons, starts, books, weights) of each block."""
    for i in range(batch.num_rows):
        values = [batch[c][i].values for c in ("patrons", "starts", "books", "weights")]
        yield values[0], *[v.to_numpy(zero_copy_only=False) for v in values[1:]]


def _image(starts: np.ndarray, books: np.ndarray, weights: np.ndarray, thin: np.ndarray) -> np.ndarray:
    """Rows of the block times the thin matrix."""
    return np.add.reduceat(weights[:, None] * thin[books], starts, axis=0)


def _sums(blocks: DataFrame, thin: np.ndarray, small: bool) -> np.ndarray:
    """With Y the strengths times ``thin``: YᵀY if ``small``, else the strengths transposed times Y.

    Each task adds up its blocks in one thin matrix; the tasks' matrices are added up by stretches of rows.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(thin)
    shape = (thin.shape[1], thin.shape[1]) if small else thin.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, thin = np.zeros(shape), shared.value
        for batch in batches:
            for _, starts, books, weights in _rows_of(batch):
                image = _image(starts, books, weights, thin)
                if small:
                    total += image.T @ image
                    continue
                row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(books))))
                order = np.argsort(books, kind="stable")
                sorted_books = books[order]
                first = np.flatnonzero(np.concatenate(([True], sorted_books[1:] != sorted_books[:-1])))
                total[sorted_books[first]] += np.add.reduceat(weights[order, None] * image[row[order]], first, axis=0)
        places = [at for at in range(0, shape[0], BOOKS_PER_ROW) if total[at:at + BOOKS_PER_ROW].any()]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(
            [total[at:at + BOOKS_PER_ROW].tobytes() for at in places], pa.binary())], ["at", "part"])

    def add(rows):
        import numpy as np
        import pandas as pd

        parts = sum(np.frombuffer(p) for p in rows["part"])
        return pd.DataFrame({"at": [rows["at"].iloc[0]], "part": [parts.tobytes()]})

    found = blocks.mapInArrow(run, "at bigint, part binary").groupBy("at").applyInPandas(add, "at bigint, part binary")
    result = np.zeros(shape)
    for r in found.collect():
        part = np.frombuffer(r["part"]).reshape(-1, shape[1])
        result[r["at"]:r["at"] + len(part)] = part
    shared.unpersist()
    return result


def _patron_vectors(blocks: DataFrame, thin: np.ndarray) -> DataFrame:
    """(patron_id, vector): the strengths times ``thin``."""
    shared = blocks.sparkSession.sparkContext.broadcast(thin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for patrons, starts, books, weights in _rows_of(batch):
                image = _image(starts, books, weights, shared.value)
                offsets = np.arange(len(image) + 1, dtype=np.int32) * image.shape[1]
                yield pa.RecordBatch.from_arrays([patrons, pa.ListArray.from_arrays(pa.array(offsets), pa.array(image.ravel()))],
                                                 ["patron_id", "vector"])

    return blocks.mapInArrow(run, "patron_id string, vector array<double>")


def _start(books: DataFrame, dims: int, seed: int) -> DataFrame:
    """``books`` with a start vector: a uniform number per book and column that depends on the book id only."""
    uniform = lambda j: F.pmod(F.xxhash64("book_id", F.lit(j), F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20)) - 0.5
    return books.select("*", F.array(*[uniform(j) for j in range(dims)]).alias("vector"))


def fit(
    strengths: DataFrame, n_components: int = 50, n_iter: int = 10, oversample: int = 10, seed: int = 42,
    thin_bytes: int = THIN_BYTES,
) -> SvdModel:
    """Patron factors UΣ and book factors V of the ``n_components`` largest singular values.

    Up to ``thin_bytes`` the matrix of all books is sent to the tasks in each step, beyond it vectors
    stay DataFrames; both give the same model but for signs and rounding.
    """
    dims = n_components + oversample
    ids = cut_lineage(integer_ids(strengths, "book_id"))
    n_books = ids.count()
    if not 0 < n_books * dims * 8 <= thin_bytes:
        return _fit_long(strengths, ids, n_books, n_components, n_iter, oversample, seed)
    spark = strengths.sparkSession
    blocks = cut_lineage(row_blocks(strengths, ids))
    thin = np.zeros((n_books, dims))
    for r in _start(ids, dims, seed).select("idx", "vector").collect():
        thin[r["idx"]] = r["vector"]
    for _ in range(n_iter):
        thin = _sums(blocks, _basis(thin), small=False)
    basis = _basis(thin)
    values, vectors = np.linalg.eigh(_sums(blocks, basis, small=True))
    largest = np.argsort(values)[::-1][:n_components]
    basis = basis @ vectors[:, largest]
    rows = pa.table({"idx": pa.array(np.arange(n_books), pa.int32()), "vector": pa.array(list(basis), pa.list_(pa.float64()))})
    books = ids.join(spark.createDataFrame(rows), "idx").select("book_id", "vector")
    return SvdModel(cut_lineage(_patron_vectors(blocks, basis)), cut_lineage(books),
                    tuple(float(np.sqrt(max(v, 0.0))) for v in values[largest]))


def _basis(thin: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span those of ``thin``, padded by zero columns where these are fewer or dependent."""
    left, values, _ = np.linalg.svd(thin, full_matrices=False)
    left = left * (values > values.max(initial=0.0) * 1e-7)
    return np.pad(left, ((0, 0), (0, thin.shape[1] - left.shape[1])))


def _fit_long(strengths: DataFrame, books: DataFrame, n_books: int, n_components: int, n_iter: int, oversample: int, seed: int) -> SvdModel:
    """The same with vectors as DataFrames; ``strengths`` is read twice."""
    dims = n_components + oversample
    patrons = cut_lineage(integer_ids(strengths, "patron_id"))
    n_patrons = patrons.count()
    cells = cut_lineage(
        strengths.join(patrons.withColumnRenamed("idx", "patron"), "patron_id").join(books.withColumnRenamed("idx", "book"), "book_id")
        .select("patron", "book", F.coalesce(F.col("interaction_score").cast("double"), F.lit(0.0)).alias("weight")))
    # Every task reads all vectors, so there are no more tasks than can run at once unless they would hold too many cells.
    n_cells, wanted = cells.count(), strengths.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(n_cells / HELD_CELLS), min(wanted, math.ceil(n_cells / LEAST_CELLS)))
    patron_stripes, book_stripes = (stripes_of(n, dims, blocks) for n in (n_patrons, n_books))
    by_patron, by_book = (held_whole(_cell_blocks(cells, *sides, blocks, stripes), blocks) for *sides, stripes in (
        ("patron", "book", book_stripes), ("book", "patron", patron_stripes)))
    of_books = _vector_blocks(_start(books, dims, seed), book_stripes)
    for _ in range(n_iter):
        of_patrons = _times(by_patron, of_books, _orthonormal(of_books, dims), n_patrons, blocks, True, patron_stripes)
        of_books = _times(by_book, of_patrons, np.eye(dims), n_books, blocks, True, book_stripes)
    basis = _orthonormal(of_books, dims)
    of_patrons = _times(by_patron, of_books, basis, n_patrons, blocks, True, patron_stripes)
    values, vectors = np.linalg.eigh(_gram(of_patrons, dims))
    largest = np.argsort(values)[::-1][:n_components]
    return SvdModel(
        _named(of_patrons, vectors[:, largest], patrons, "patron_id", patron_stripes),
        _named(of_books, basis @ vectors[:, largest], books, "book_id", book_stripes),
        tuple(float(np.sqrt(max(v, 0.0))) for v in values[largest]),
    )


def explained_variance(strengths: DataFrame, model: FactorModel, n_components: int) -> DataFrame:
    """(component, explained_variance_ratio): variance of each UΣ column over that of all matrix columns."""
    n = model.patron_factors.agg(F.count(F.lit(1))).scalar()
    per_book = strengths.groupBy("book_id").agg(
        F.sum("interaction_score").alias("s"),
        F.sum(F.col("interaction_score") * F.col("interaction_score")).alias("ss"),
    )
    total = per_book.agg(F.sum(F.col("ss") / n - (F.col("s") / n) * (F.col("s") / n))).scalar()
    columns = model.patron_factors.agg(
        F.array(*[F.var_pop(F.get("vector", F.lit(i))) for i in range(n_components)]).alias("variances")
    )
    return columns.select(F.posexplode("variances").alias("component", "variance")).select(
        "component", F.round(F.col("variance") / total, 6).alias("explained_variance_ratio")
    )
