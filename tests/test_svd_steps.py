"""Steps of the SVD in blocks: one job each, and right where the blocks are read in several parts."""

import numpy as np

from stacklens.operators import svd
from stacklens.operators.interactions import integer_ids


def _strengths(spark, patrons=60, books=40, seed=3):
    draw = np.random.default_rng(seed)
    filled = np.argwhere(draw.random((patrons, books)) < 0.3)
    rows = [(f"P{p:03d}", f"B{b:03d}", float(draw.integers(1, 11)) / 2) for p, b in filled]
    return spark.createDataFrame(rows, "patron_id string, book_id string, interaction_score double")


def _matrix(strengths):
    rows = strengths.collect()
    patrons, books = (sorted({r[key] for r in rows}) for key in ("patron_id", "book_id"))
    found = np.zeros((len(patrons), len(books)))
    for r in rows:
        found[patrons.index(r["patron_id"]), books.index(r["book_id"])] = r["interaction_score"]
    return found


def test_a_step_runs_its_own_job_only(spark):
    strengths = _strengths(spark)
    patrons, books = integer_ids(strengths, "patron_id"), integer_ids(strengths, "book_id")
    cells = (strengths.join(patrons.withColumnRenamed("idx", "patron"), "patron_id").join(books.withColumnRenamed("idx", "book"), "book_id")
             .selectExpr("patron", "book", "interaction_score AS weight"))
    blocks = svd.held_whole(svd._cell_blocks(cells, "patron", "book", 3, 3), 3)
    vectors = svd._vector_blocks(svd._start(books, 4, 42), 3)
    context = spark.sparkContext
    context.setJobGroup("one-step", "one step")
    try:
        found = svd._times(blocks, vectors, np.eye(4), patrons.count(), 3, whole=True)
        jobs = len(context.statusTracker().getJobIdsForGroup("one-step"))
        context.setJobGroup("count", "count")
        patrons.count()
        counting = len(context.statusTracker().getJobIdsForGroup("count"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 1 + counting
    assert found.count() == 3


def test_blocks_read_in_several_parts(spark, monkeypatch):
    strengths = _strengths(spark)
    packed = svd._cell_blocks
    monkeypatch.setattr(svd, "_cell_blocks", lambda *a: packed(*a).repartition(7))
    monkeypatch.setattr(svd, "LEAST_CELLS", 64)
    model = svd.fit(strengths, 5, thin_bytes=0)
    expected = np.linalg.svd(_matrix(strengths), compute_uv=False)[:5]
    assert np.allclose(model.singular_values, expected, rtol=1e-4)


def test_vectors_travel_in_rows_of_bounded_size(spark, monkeypatch):
    """Several rows of vectors per block, hot rows and all: as by NumPy, and every block in a task of its own."""
    monkeypatch.setattr(svd, "ROW_BYTES", 400, raising=False)
    monkeypatch.setattr(svd, "LEAST_CELLS", 300)
    for name, size in (("TURNS", 2), ("CELLS_AT_ONCE", 8)):
        monkeypatch.setattr(svd, name, size, raising=False)
    strengths = _strengths(spark, 70, 50)
    read, times = [], svd._times
    monkeypatch.setattr(svd, "_times", lambda cells, vectors, *a: (read.append((cells, vectors)), times(cells, vectors, *a))[1])
    model = svd.fit(strengths, 5, 8, thin_bytes=0)
    assert np.allclose(model.singular_values, np.linalg.svd(_matrix(strengths), compute_uv=False)[:5], rtol=1e-3)
    cells, vectors = read[1]
    n_blocks = cells.select("block").distinct().count()
    assert n_blocks > 1 and vectors.count() > n_blocks
    assert max(len(r.vectors) for r in vectors.collect()) <= 800
    assert len({r.block for r in model_blocks(spark, cells)}) == len(model_blocks(spark, cells))


def model_blocks(spark, cells):
    """(block, partition) pairs of the cells as a step reads them."""
    from pyspark.sql import functions as F

    from stacklens.session import file_per_task

    with file_per_task(spark):
        return cells.select("block", F.spark_partition_id().alias("part")).distinct().collect()
