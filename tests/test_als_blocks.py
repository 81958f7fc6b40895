import numpy as np
import pytest

from stacklens.operators import als, als_blocks, svd
from stacklens.operators.interactions import integer_ids


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    a = 1 + rng.random((40, 3)) @ rng.random((3, 30)) * 2
    return [(f"P{i:02}", f"B{j:02}", float(np.float32(a[i, j]))) for i in range(40) for j in range(30) if rng.random() < 0.5 or not i or not j]


@pytest.mark.parametrize("implicit", [False, True])
def test_blocks_equal_a_dense_solver(spark, monkeypatch, rows, implicit):
    monkeypatch.setattr(als, "MLLIB_CELLS", 0)
    monkeypatch.setattr(als_blocks, "HELD_CELLS", 200)
    strengths = spark.createDataFrame(rows, "patron_id string, book_id string, interaction_score double")
    model = als.fit(strengths, 4, 3, 0.05, 7, implicit, 2.0)
    a = np.zeros((40, 30))
    for p, b, s in rows:
        a[int(p[1:]), int(b[1:])] = s
    start = als_blocks.start_vectors(integer_ids(strengths, "patron_id"), 4, 7).orderBy("idx").collect()
    u = np.array([r.vector for r in start])
    assert np.linalg.norm(u, axis=1) == pytest.approx(np.ones(40))

    def half(a, v):
        out = []
        for row in a:
            seen = row > 0
            c = 2.0 * row[seen] if implicit else np.ones(seen.sum())
            square = (v.T @ v if implicit else 0) + (c[:, None] * v[seen]).T @ v[seen] + 0.05 * seen.sum() * np.eye(4)
            out.append(np.linalg.solve(square, v[seen].T @ (1 + c if implicit else row[seen])))
        return np.array(out)

    for _ in range(3):
        v = half(a.T, u)
        u = half(a, v)
    found = [np.array([r.vector for r in f.orderBy(k).collect()]) for f, k in ((model.patron_factors, "patron_id"), (model.book_factors, "book_id"))]
    assert found[0] == pytest.approx(u, abs=1e-6) and found[1] == pytest.approx(v, abs=1e-6)


def test_blocks_fit_as_well_as_mllib(spark, monkeypatch, rows):
    strengths = spark.createDataFrame(rows, "patron_id string, book_id string, interaction_score double")
    losses = [als.loss(strengths, als.fit(strengths, 4, 10, 0.01), 4).first().observed_rmse]
    monkeypatch.setattr(als, "MLLIB_CELLS", 0)
    losses.append(als.loss(strengths, als.fit(strengths, 4, 10, 0.01), 4).first().observed_rmse)
    assert losses[1] == pytest.approx(losses[0], rel=0.2)


def test_split_blocks_are_put_together(spark):
    cells = svd._cell_blocks(spark.createDataFrame([(i % 9, i // 9, 1.0) for i in range(81)], "user int, item int, weight double"), "user", "item", 3, 3)
    whole = als_blocks.held_whole(cells.repartition(9), 3)
    assert max(len({r.block for r in part}) for part in whole.rdd.glom().collect()) <= 1


def test_vectors_in_small_rows_give_the_same_factors(spark, monkeypatch, rows):
    """Whatever the rows in which vectors travel; a task keeps the vector of each of its cells once."""
    monkeypatch.setattr(als, "MLLIB_CELLS", 0)
    monkeypatch.setattr(als_blocks, "HELD_CELLS", 200)
    strengths = spark.createDataFrame(rows, "patron_id string, book_id string, interaction_score double")
    found = []
    for size in (1 << 20, 64):
        monkeypatch.setattr(svd, "ROW_BYTES", size)
        model = als.fit(strengths, 4, 2, 0.05, 7)
        found.append({r[0]: r.vector for f in (model.patron_factors, model.book_factors) for r in f.collect()})
    assert found[0].keys() == found[1].keys() and all(found[1][k] == pytest.approx(v, abs=1e-9) for k, v in found[0].items())
