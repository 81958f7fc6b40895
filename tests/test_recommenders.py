import numpy as np
import pytest
from pyspark.sql import functions as F

from stacklens.operators import als, block_scores, embeddings, evaluation, hybrid, ranking, svd
from stacklens.operators.catalog import book_catalog
from stacklens.operators.factors import FactorModel, NotFittedError
from stacklens.operators.interactions import integer_ids, interactions, matrix_stats, seen_pairs, with_global_rank
from stacklens.session import cut_lineage


@pytest.fixture(scope="module")
def strengths(loans):
    return cut_lineage(interactions(loans))


@pytest.fixture(scope="module")
def als_model(strengths):
    return als.fit(strengths, 8, 5)


def brute_force(queries, items, k, banned, cosine):
    out = set()
    for q, v in queries.items():
        scored = []
        for i, w in items.items():
            if (q, i) in banned:
                continue
            s = float(np.dot(v, w))
            if cosine:
                n = np.linalg.norm(v) * np.linalg.norm(w)
                s = s / n if n else 0.0
            scored.append((-round(s, 9), i))
        out |= {(q, i, round(-s, 4) + 0.0, rank + 1) for rank, (s, i) in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize("cosine", [False, True])
def test_block_scores_equal_brute_force(spark, monkeypatch, cosine):
    """Many small blocks and chunks, tied vectors, a query with everything excluded but one."""
    monkeypatch.setattr(block_scores, "ITEMS_PER_BLOCK", 7)
    monkeypatch.setattr(block_scores, "QUERIES_PER_CHUNK", 5)
    rng = np.random.default_rng(3)
    queries = {f"Q{i:02}": rng.integers(-2, 3, 4).astype(float) for i in range(17)}
    items = {f"I{i:02}": rng.integers(-1, 2, 4).astype(float) for i in range(40)}
    banned = {(q, i) for q in queries for i in items if rng.random() < 0.3} | {("Q00", i) for i in list(items)[1:]}
    frame = lambda d, key: spark.createDataFrame([(k, v.tolist()) for k, v in d.items()], f"{key} string, vector array<double>")
    got = block_scores.top_scores(
        frame(queries, "q"), frame(items, "i"), "q", "i", 6,
        exclude=spark.createDataFrame(list(banned), "q string, i string"), cosine=cosine,
    )
    assert {(r.q, r.i, r.score, r.rank) for r in got.collect()} == brute_force(queries, items, 6, banned, cosine)


def test_hot_patron_gets_the_exact_list(spark):
    """One patron holds most pairs; the list still starts right after the seen books."""
    seen = [("HOT", f"B{i:03}") for i in range(95)] + [("P1", "B000")]
    catalog = spark.createDataFrame([(f"B{i:03}", 1000 - i) for i in range(100)], "book_id string, total_borrows long")
    out = ranking.popular_unseen(spark.createDataFrame(seen, "patron_id string, book_id string"), ranking.popularity_ranks(catalog), 10)
    lists = {}
    for r in out.orderBy("patron_id", "rank").collect():
        lists.setdefault(r.patron_id, []).append(r.book_id)
    assert lists["HOT"] == [f"B{i:03}" for i in range(95, 100)]
    assert lists["P1"] == [f"B{i:03}" for i in range(1, 11)]


def test_all_seen_patron_has_no_rows(spark):
    seen = spark.createDataFrame([("P1", "B1"), ("P1", "B2")], "patron_id string, book_id string")
    catalog = spark.createDataFrame([("B1", 2), ("B2", 1)], "book_id string, total_borrows long")
    assert ranking.popular_unseen(seen, ranking.popularity_ranks(catalog), 3).count() == 0


def test_global_rank(spark):
    frame = spark.range(1000).repartition(7).withColumn("v", F.col("id") % 13)
    got = [(r.v, r.id) for r in with_global_rank(frame, "v", "id", name="r").orderBy("r").collect()]
    assert got == sorted((i % 13, i) for i in range(1000))


def test_matrix(loans, strengths):
    stats = matrix_stats(strengths).first()
    assert stats.n_patrons == loans.select("patron_id").distinct().count()
    assert stats.n_books == loans.select("book_id").distinct().count()
    low, high = strengths.agg(F.min("interaction_score"), F.max("interaction_score")).first()
    assert low > 0 and high <= 5
    ids = sorted(r.idx for r in integer_ids(strengths, "patron_id").collect())
    assert ids == list(range(stats.n_patrons))


def check_recommendations(recs, strengths, n):
    rows = recs.orderBy("patron_id", "rank").collect()
    per_patron = {}
    for r in rows:
        per_patron.setdefault(r.patron_id, []).append(r)
    for rs in per_patron.values():
        assert len(rs) <= n and [r.rank for r in rs] == list(range(1, len(rs) + 1))
        assert [r.score for r in rs] == sorted((r.score for r in rs), reverse=True)
    assert recs.join(strengths, ["patron_id", "book_id"], "left_semi").count() == 0


def test_als(strengths, als_model):
    stats = matrix_stats(strengths).first()
    assert als_model.patron_factors.count() == stats.n_patrons
    assert als_model.book_factors.count() == stats.n_books
    assert len(als_model.book_factors.first().vector) == 8
    check_recommendations(als_model.recommend(5, seen_pairs(strengths)), strengths, 5)
    loss = als.loss(strengths, als_model, 8).first()
    assert loss.observed_rmse < loss.mean_predictor_rmse


def test_als_loss_counts_empty_cells(strengths, als_model):
    u = np.array([r.vector for r in als_model.patron_factors.orderBy("patron_id").collect()])
    v = np.array([r.vector for r in als_model.book_factors.orderBy("book_id").collect()])
    p = {r.patron_id: i for i, r in enumerate(als_model.patron_factors.orderBy("patron_id").collect())}
    b = {r.book_id: i for i, r in enumerate(als_model.book_factors.orderBy("book_id").collect())}
    full = np.zeros((len(p), len(b)))
    for r in strengths.collect():
        full[p[r.patron_id], b[r.book_id]] = r.interaction_score
    assert als.loss(strengths, als_model, 8).first().full_matrix_mse == pytest.approx(((full - u @ v.T) ** 2).mean(), abs=1e-3)


def test_unknown_patron_and_unfitted(spark, strengths, als_model):
    stranger = spark.createDataFrame([("nobody",)], "patron_id string")
    assert als_model.recommend(5, seen_pairs(strengths), stranger).count() == 0
    with pytest.raises(NotFittedError):
        FactorModel().recommend(5)
    with pytest.raises(NotFittedError):
        hybrid.HybridEngine().recommend()


def test_factor_round_trip(spark, als_model, tmp_path):
    als_model.save(str(tmp_path / "m"))
    back = FactorModel.load(spark, str(tmp_path / "m"))
    assert back.book_factors.exceptAll(als_model.book_factors).count() == 0


def test_svd_finds_the_exact_factors_of_a_low_rank_matrix(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(30, 3)) @ np.diag([9.0, 4.0, 2.0]) @ rng.normal(size=(3, 20))
    rows = [(f"P{i:02}", f"B{j:02}", float(a[i, j])) for i in range(30) for j in range(20)]
    strengths = spark.createDataFrame(rows, "patron_id string, book_id string, interaction_score double")
    model = svd.fit(strengths, 3, n_iter=2, oversample=2)
    assert model.singular_values == pytest.approx(np.linalg.svd(a, compute_uv=False)[:3])
    u = np.array([r.vector for r in model.patron_factors.orderBy("patron_id").collect()])
    v = np.array([r.vector for r in model.book_factors.orderBy("book_id").collect()])
    assert u @ v.T == pytest.approx(a, abs=1e-6)
    ratios = [r.explained_variance_ratio for r in svd.explained_variance(strengths, model, 3).collect()]
    assert 0.999 < sum(ratios) <= 1.000001
    similar = model.similar(4)
    assert similar.where("book_id = similar_book_id").count() == 0
    assert similar.where("abs(score) > 1").count() == 0


def test_svd_forms_agree(spark, monkeypatch):
    """Blocks with a thin matrix in all tasks, and joins of the long table: one model but for signs."""
    rng = np.random.default_rng(4)
    a = rng.integers(0, 4, size=(60, 45)) * (rng.random((60, 45)) < 0.3)
    rows = [(f"P{i:02}", f"B{j:02}", float(a[i, j])) for i in range(60) for j in range(45) if a[i, j]]
    strengths = spark.createDataFrame(rows, "patron_id string, book_id string, interaction_score double")
    monkeypatch.setattr(svd, "BLOCK_CELLS", 100)
    monkeypatch.setattr(svd, "BOOKS_PER_ROW", 7)
    models = [svd.fit(strengths, 4, n_iter=12, oversample=6, thin_bytes=limit) for limit in (svd.THIN_BYTES, 0)]
    assert models[0].singular_values == pytest.approx(models[1].singular_values, rel=1e-9)
    assert models[0].singular_values == pytest.approx(np.linalg.svd(a.astype(float), compute_uv=False)[:4], rel=1e-3)
    scores = []
    for model in models:
        u = np.array([r.vector for r in model.patron_factors.orderBy("patron_id").collect()])
        v = np.array([r.vector for r in model.book_factors.orderBy("book_id").collect()])
        scores.append(u @ v.T)
    assert scores[0] == pytest.approx(scores[1], abs=1e-7)


def test_svd_moves_no_strengths_in_a_step(spark):
    rows = [(f"P{i % 40:02}", f"B{i % 37:02}", 1.0 + i % 3) for i in range(1480)]
    strengths = spark.createDataFrame(rows, "patron_id string, book_id string, interaction_score double")
    blocks = cut_lineage(svd.row_blocks(strengths, integer_ids(strengths, "book_id")))
    assert sorted(p for r in blocks.collect() for p in r.patrons) == [f"P{i:02}" for i in range(40)]
    a = np.zeros((40, 37))
    for p, b, s in rows:
        a[int(p[1:]), int(b[1:])] += s
    thin = np.random.default_rng(1).normal(size=(37, 5))
    assert svd._sums(blocks, thin, small=False) == pytest.approx(a.T @ (a @ thin))
    assert svd._sums(blocks, thin, small=True) == pytest.approx((a @ thin).T @ (a @ thin))


def test_minmax_of_equal_scores_is_one(spark):
    rows = spark.createDataFrame([("P", "B1", 2.0, "m"), ("P", "B2", 2.0, "m")], "patron_id string, book_id string, score double, model string")
    assert {r.normalized_score for r in ranking.minmax_normalise(rows).collect()} == {1.0}


def test_missing_model_counts_zero(spark):
    rows = spark.createDataFrame(
        [("P", "B1", "a", 1.0), ("P", "B1", "b", 1.0), ("P", "B2", "a", 0.5)],
        "patron_id string, book_id string, model string, normalized_score double")
    got = {r.book_id: r.fused_score for r in ranking.fuse(rows, {"a": 0.6, "b": 0.4}).collect()}
    assert got == {"B1": 1.0, "B2": 0.3}


def test_cap_equals_greedy_scan(spark):
    rng = np.random.default_rng(5)
    rows = [(f"P{p}", f"B{i:02}", f"g{rng.integers(4)}", float(rng.integers(6))) for p in range(5) for i in range(30)]
    frame = spark.createDataFrame(rows, "patron_id string, book_id string, genre string, combined_score double")
    got = {}
    for r in ranking.diversity_cap(frame, 2, 6).orderBy("patron_id", "rank").collect():
        got.setdefault(r.patron_id, []).append(r.book_id)
    for p in {r[0] for r in rows}:
        taken, count = [], {}
        for _, b, g, s in sorted((r for r in rows if r[0] == p), key=lambda r: (-r[3], r[1])):
            if count.get(g, 0) < 2 and len(taken) < 6:
                taken.append(b)
                count[g] = count.get(g, 0) + 1
        assert got[p] == taken


def test_weights():
    with pytest.raises(ValueError, match="sum to 1.0"):
        hybrid.HybridSettings(weights={"als": 0.5})
    shared = hybrid.redistribute(hybrid.DEFAULT_WEIGHTS, ["als", "svd", "tfidf"])
    assert sum(shared.values()) == pytest.approx(1.0) and shared["als"] == pytest.approx(0.4375)


def test_hybrid_engine(spark, tiny, loans):
    from stacklens.sources import testdata

    engine = hybrid.HybridEngine().fit(loans, testdata.book_vectors(spark, tiny), 6, 3, 2, 100)
    recs = cut_lineage(engine.recommend(6))
    assert recs.groupBy("patron_id").count().agg(F.max("count")).first()[0] <= 6
    assert recs.groupBy("patron_id", "genre").count().agg(F.max("count")).first()[0] <= 3
    assert recs.join(engine.seen(), ["patron_id", "book_id"], "left_semi").count() == 0
    texts = engine.explain(recs.where("rank = 1"))
    assert texts.where("explanation LIKE 'Recommended because: %'").count() == recs.where("rank = 1").count()


def test_metrics_against_hand_values(spark):
    recs = spark.createDataFrame([("P1", "a", 1), ("P1", "b", 2), ("P2", "c", 1)], "patron_id string, book_id string, rank int")
    truth = spark.createDataFrame([("P1", "b"), ("P1", "z"), ("P2", "c"), ("P3", "q")], "patron_id string, book_id string")
    row = evaluation.precision_recall_at_k(recs, truth, 2).first()
    assert (row.n_patrons, row.precision_at_k, row.recall_at_k) == (3, 0.333333, 0.5)
    expected = (np.log(2) / np.log(3) / (1 + np.log(2) / np.log(3)) + 1 + 0) / 3
    assert evaluation.ndcg_at_k(recs, truth, 2).first().ndcg_at_k == pytest.approx(expected, abs=1e-6)


def test_hash_split_is_stable(loans):
    train, holdout = evaluation.split_by_hash(loans)
    again, _ = evaluation.split_by_hash(loans.repartition(5))
    assert train.exceptAll(again).count() == 0
    assert train.count() + holdout.count() == loans.count()
    assert 0.7 < train.count() / loans.count() < 0.9


def test_encoder_hook(spark):
    frame = spark.createDataFrame([("B1", "ab"), ("B2", "abc")], "book_id string, sentence string")
    out = embeddings.encode(frame, lambda texts: [[len(t), 1.0] for t in texts])
    assert {r.book_id: list(r.vector) for r in out.collect()} == {"B1": [2.0, 1.0], "B2": [3.0, 1.0]}


def test_catalog_counts(loans):
    assert book_catalog(loans).agg(F.sum("total_borrows")).first()[0] == loans.count()


def test_svd_steps_shuffle_nothing_where_vectors_are_frames(spark):
    """Cells times vectors by a product of blocks without an exchange, also where a block of cells is read in several parts."""
    rng = np.random.default_rng(8)
    a = rng.integers(0, 3, size=(23, 17)) * (rng.random((23, 17)) < 0.4)
    a[:, 0] = 1
    rows = [(i, j, float(a[i, j])) for i in range(23) for j in range(17) if a[i, j]]
    cells = svd._cell_blocks(spark.createDataFrame(rows, "p int, b int, weight double"), "p", "b", 4, 3)
    thin, rotation = rng.normal(size=(17, 5)), rng.normal(size=(5, 5))
    vectors = svd._vector_blocks(spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(thin)], "idx int, vector array<double>"), 3)
    for split in (cells, cells.repartition(7)):
        found = svd._times(split, vectors, rotation, 23, 4)
        image = np.zeros((23, 5))
        for r in found.collect():
            image[r["block"]::4] = np.frombuffer(r["vectors"]).reshape(-1, 5)
        assert image == pytest.approx(a @ thin @ rotation)
    assert svd._gram(found, 5) == pytest.approx(image.T @ image)
