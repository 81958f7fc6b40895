import re

import numpy as np
import pytest

from stacklens.operators import tfidf
from tests.test_recommenders import brute_force

TERMS = ["a", "b", "c"]


def model(spark, seed=3):
    """Books of few distinct vectors, one without terms, and patrons who have had first books, whole vectors or all books."""
    rng = np.random.default_rng(seed)
    kinds = [np.array(v, float) / np.linalg.norm(v) for v in ([1, 0, 0], [0, 1, 0], [0, 0, 1], [1, 1, 0], [0, 1, 1])] + [np.zeros(3)]
    books = {f"B{i:02}": kinds[int(rng.integers(len(kinds)))] for i in range(40)}
    names = sorted(books)
    had = {f"P{i:02}": set(rng.choice(names, int(rng.integers(1, 15)), replace=False)) for i in range(25)}
    had["P90"], had["P91"] = {b for b in names if np.array_equal(books[b], books[names[0]])}, set(names)
    had["P92"], had["P93"] = set(names[:8]), {next(b for b in names if not books[b].any())}
    weighted = spark.createDataFrame([(b, t, float(w)) for b, v in books.items() for t, w in zip(TERMS, v) if w], "book_id string, term string, weight double")
    pairs = spark.createDataFrame([(p, b) for p, bs in had.items() for b in bs], "patron_id string, book_id string")
    catalog = spark.createDataFrame([(b, "G") for b in names], "book_id string, genre string")
    profiles = {p: np.mean([books[b] for b in sorted(bs)], axis=0) for p, bs in had.items()}
    return books, had, profiles, pairs, catalog, spark.createDataFrame([(t,) for t in TERMS], "term string"), weighted


@pytest.mark.parametrize("few", [200, 0])
@pytest.mark.parametrize("unseen", [True, False])
def test_lists_equal_brute_force_and_ask_for_n_vectors(spark, monkeypatch, unseen, few):
    """A vector counts once per patron: the longest history does not lengthen everybody's list."""
    books, had, profiles, pairs, catalog, vocab, weighted = model(spark)
    asked, real = [], tfidf.top_scores
    monkeypatch.setattr(tfidf, "top_scores", lambda *a, **b: asked.append(a[4]) or real(*a, **b))
    monkeypatch.setattr(tfidf, "FEW_SEEN", few)
    found = {tuple(r) for r in tfidf.recommend(pairs, catalog, vocab, weighted, 6, unseen).select("patron_id", "book_id", "score", "rank").collect()}
    banned = {(p, b) for p, bs in had.items() for b in bs} if unseen else set()
    assert found == brute_force(profiles, books, 6, banned, True)
    assert set(asked) == {6}


def test_queries_may_want_more(spark):
    rng = np.random.default_rng(1)
    vectors = {f"I{i:03}": rng.integers(-2, 3, 3).astype(float) for i in range(200)}
    items = spark.createDataFrame([(k, v.tolist()) for k, v in vectors.items()], "i string, vector array<double>")
    more = {f"Q{i}": 7 * i for i in range(6)}
    queries = spark.createDataFrame([(q, vectors["I000"].tolist(), m) for q, m in more.items()], "q string, vector array<double>, more int")
    found = {tuple(r) for r in tfidf.top_scores(queries, items, "q", "i", 4, extra="more").collect()}
    assert found == set().union(*(brute_force({q: vectors["I000"]}, vectors, 4 + m, set(), False) for q, m in more.items()))


def test_terms_of_pairs_are_not_shuffled_one_by_one(spark):
    """A pair travels as one row; neither profiles nor explanations deal rows by patron and term."""
    books, had, profiles, pairs, catalog, _, weighted = model(spark)
    profile = tfidf.profiles(pairs, weighted)
    targets = spark.createDataFrame([("P00", "B01"), ("P91", "B00"), ("P77", "B00"), ("P00", "X")], "patron_id string, book_id string")
    told = tfidf.explain(targets, catalog, profile, weighted)
    for df in (profile, told):
        dealt = re.findall(r"hashpartitioning\(([^)]*)", df._jdf.queryExecution().executedPlan().toString())
        assert dealt and not any("patron_id" in d and ("term" in d or "position" in d) for d in dealt)
    got = {(r.patron_id, r.term): r.weight for r in profile.collect()}
    want = {(p, t): w for p, v in profiles.items() for t, w in zip(TERMS, v) if w}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    said = {(r.patron_id, r.book_id): r.explanation for r in told.collect()}
    shared = sorted((-round(profiles["P91"][i] * books["B00"][i], 9), t) for i, t in enumerate(TERMS) if profiles["P91"][i] * books["B00"][i] > 0)
    signals = f"Recommended because your reading history matches 'G' content — key signals: {', '.join(t for _, t in shared)}"
    assert said[("P91", "B00")] == (signals if shared else "Recommended based on genre match: G")
    assert said[("P77", "B00")].startswith("No borrowing history") and said[("P00", "X")] == "Book X not in catalog"
