import numpy as np
import pytest

from stacklens.operators import block_scores
from tests.test_recommenders import brute_force


def frame(spark, vectors, key):
    return spark.createDataFrame([(k, v.tolist()) for k, v in vectors.items()], f"{key} string, vector array<double>")


def scored(spark, monkeypatch, queries, items, k, banned=(), cosine=False, **sizes):
    for name, size in sizes.items():
        monkeypatch.setattr(block_scores, name, size)
    exclude = spark.createDataFrame(list(banned), "q string, i string") if banned else None
    found = block_scores.top_scores(frame(spark, queries, "q"), frame(spark, items, "i"), "q", "i", k, exclude, cosine)
    return found, {(r.q, r.i, r.score, r.rank) for r in found.collect()}


def test_no_row_is_copied_per_chunk_or_block(spark, monkeypatch):
    """What is shuffled grows with the rows: chunks meet blocks without an exchange after it, and nothing is exploded."""
    rng = np.random.default_rng(5)
    queries, items = ({f"{p}{i:03}": rng.normal(size=4) for i in range(300)} for p in "QI")
    found, rows = scored(spark, monkeypatch, queries, items, 5, ITEMS_PER_BLOCK=20, QUERIES_PER_CHUNK=30)
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "CartesianProduct" in final and "Generate" not in plan and "Exchange" not in final.split("CartesianProduct")[0]
    assert rows == brute_force(queries, items, 5, set(), False)


@pytest.mark.parametrize("cosine", [False, True])
def test_ties_go_to_the_smaller_ids_whatever_the_blocks(spark, monkeypatch, cosine):
    """Many equal scores, all zero for one query: as by brute force."""
    rng = np.random.default_rng(6)
    queries = {f"Q{i:02}": rng.integers(-1, 2, 3).astype(float) for i in range(12)} | {"Q00": np.zeros(3)}
    items = {f"I{i:03}": rng.integers(-1, 2, 3).astype(float) for i in range(150)}
    banned = {(q, i) for q in queries for i in items if rng.random() < 0.2}
    _, rows = scored(spark, monkeypatch, queries, items, 7, banned, cosine, ITEMS_PER_BLOCK=25, QUERIES_PER_CHUNK=5,
                     TILE_QUERIES=3, TILE_ITEMS=9, CROWDED=2)
    assert rows == brute_force(queries, items, 7, banned, cosine)


def test_close_scores_keep_their_order_in_double_precision(spark, monkeypatch):
    """Scores that single precision cannot tell apart."""
    items = {f"I{i:03}": np.array([1.0, 1e-8 * ((i * 37) % 200)]) for i in range(200)}
    _, rows = scored(spark, monkeypatch, {"Q": np.array([1.0, 1.0])}, items, 6, TILE_ITEMS=10, ITEMS_PER_BLOCK=50)
    assert {(i, rank) for _, i, _, rank in rows} == {(k, r + 1) for r, k in enumerate(sorted(items, key=lambda k: -items[k][1])[:6])}


def test_scores_of_given_pairs_shuffle_no_vector(spark, monkeypatch):
    """Products of the pairs alone, unknown ids left out; no exchange beside the packing of pairs and vectors."""
    for name, size in (("ITEMS_PER_BLOCK", 15), ("QUERIES_PER_CHUNK", 7)):
        monkeypatch.setattr(block_scores, name, size)
    rng = np.random.default_rng(8)
    queries, items = ({f"{p}{i:02}": rng.normal(size=3) for i in range(40)} for p in "QI")
    pairs = {(q, i) for q in queries for i in items if rng.random() < 0.1} | {("Q00", "none"), ("none", "I00"), (None, "I00")}
    asked = spark.createDataFrame(list(pairs), "q string, i string")
    found = block_scores.pair_scores(frame(spark, queries, "q"), frame(spark, items, "i"), asked, "q", "i")
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "CartesianProduct" in final and "Join" not in final
    got = {(r.q, r.i): r.score for r in found.collect()}
    want = {(q, i): float(queries[q] @ items[i]) for q, i in pairs if q in queries and i in items}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_a_first_block_is_screened_too(monkeypatch):
    """With many items wanted the first block is not gone through in double precision as a whole, and the lists are right."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    row = lambda n, name: {"ids": pa.array([f"{name}{i:05}" for i in range(n)]), "lengths": np.full(n, 6, np.int32).tobytes(),
                           "positions": None, "weights": rng.normal(size=(n, 6)).tobytes()}
    queries, items = row(40, "Q"), row(20_000, "I") | {"block": 0}
    banned = np.sort(rng.integers(20_000, size=80)).astype(np.int64)
    queries |= {"extra": np.zeros(40, np.int32).tobytes(), "ban_rows": np.repeat(np.arange(40), 2).astype(np.int32).tobytes(),
                "ban_starts": np.array([0, 80], np.int64).tobytes(), "ban_items": items["ids"].take(pa.array(banned))}
    best, made = block_scores._Best(queries, 50, False), []
    dense = block_scores._Vectors.dense
    monkeypatch.setattr(block_scores._Vectors, "dense", lambda self, *a: (made.append((self.size, a[3])), dense(self, *a))[1])
    best.meet(items)
    assert (20_000, np.float64) not in made
    found = best.result(["q", "i"]).to_pydict()
    scores = np.round(np.frombuffer(queries["weights"]).reshape(40, 6) @ np.frombuffer(items["weights"]).reshape(-1, 6).T, 9)
    scores[np.repeat(np.arange(40), 2), banned] = -np.inf
    want = np.argsort(-scores, axis=1, kind="stable")[:, :50]
    assert found["i"] == [f"I{i:05}" for i in want.ravel()] and found["rank"] == list(range(1, 51)) * 40


def test_items_too_short_to_reach_a_list_are_skipped(spark, monkeypatch):
    """Products are bounded by lengths, so few of the items of a later block are multiplied; lists as by brute force, ties and empty vectors too."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    lengths = rng.pareto(1.0, 400) + 0.01
    queries = {f"Q{i:02}": rng.normal(size=3) * (i % 5) for i in range(30)}
    items = {f"I{i:03}": np.round(rng.normal(size=3) * length, 1) for i, length in enumerate(lengths)}
    banned = {(q, i) for q in queries for i in items if rng.random() < 0.2}
    _, rows = scored(spark, monkeypatch, queries, items, 4, banned, ITEMS_PER_BLOCK=100, QUERIES_PER_CHUNK=7, TILE_QUERIES=3, TILE_ITEMS=20)
    assert rows == brute_force(queries, items, 4, banned, False)
    pack = lambda vectors, names: {"ids": pa.array(names), "lengths": np.full(len(names), 3, np.int32).tobytes(),
                                   "positions": None, "weights": np.array(vectors).tobytes()}
    best = block_scores._Best(pack(list(queries.values()), list(queries)) | {
        "extra": np.zeros(30, np.int32).tobytes(), "ban_rows": b"", "ban_starts": np.zeros(3, np.int64).tobytes(), "ban_items": pa.array([], pa.string())}, 4, False)
    seen, screened = [], block_scores._Best._screened
    monkeypatch.setattr(block_scores._Best, "_screened", lambda self, single, columns, *a: (seen.append(columns.shape[1]), screened(self, single, columns, *a))[1])
    names = list(items)
    for block, part in enumerate((names[:200], names[200:])):
        best.meet(pack([items[i] for i in part], part) | {"block": block})
    assert min(seen) < 100
