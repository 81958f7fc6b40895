"""Hybrid ranking: candidates of several models, fused, boosted and capped per genre."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.operators import als, embeddings, ranking, requests, svd, tfidf
from stacklens.operators.catalog import book_catalog
from stacklens.operators.factors import FactorModel, NotFittedError
from stacklens.operators.interactions import interactions
from stacklens.session import cut_lineage

# Model weights, boosts and list sizes of the hybrid ranking.
DEFAULT_WEIGHTS = {"als": 0.35, "svd": 0.25, "tfidf": 0.20, "embedding": 0.20}
CANDIDATES_PER_MODEL = 50
EXPLAIN_DEPTH = 20


@dataclass(frozen=True)
class HybridSettings:
    weights: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
    diversity_cap: int = 3
    popularity_boost: float = 0.05
    genre_boost: float = 0.02

    def __post_init__(self) -> None:
        if abs(sum(self.weights.values()) - 1.0) >= 1e-6:
            raise ValueError("Model weights must sum to 1.0")


def redistribute(weights: dict[str, float], available) -> dict[str, float]:
    """Share the weight of missing models among the others in proportion to theirs."""
    kept = {m: w for m, w in weights.items() if m in set(available)}
    total = sum(kept.values())
    if total <= 0:
        raise ValueError("no model with a positive weight is available")
    return {m: w / total * sum(weights.values()) for m, w in kept.items()}


def candidates(lists: dict[str, DataFrame]) -> DataFrame:
    """(patron_id, book_id, score, rank, model) of all models."""
    rows = None
    for model, recs in lists.items():
        part = recs.select("patron_id", "book_id", "score", "rank", F.lit(model).alias("model"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def patron_top_genre(loans: DataFrame) -> DataFrame:
    counted = loans.where("patron_id IS NOT NULL").groupBy("patron_id", "genre").agg(F.count(F.lit(1)).alias("n"))
    top = F.when(F.col("genre").isNotNull(), F.struct((-F.col("n")).alias("less"), "genre"))
    return counted.groupBy("patron_id").agg(F.min(top)["genre"].alias("modal_genre"))


def score(
    lists: dict[str, DataFrame], catalog: DataFrame, top_genres: DataFrame, settings: HybridSettings
) -> DataFrame:
    """(patron_id, book_id, genre, combined_score) for every candidate."""
    weights = redistribute(settings.weights, lists)
    fused = ranking.fuse(ranking.minmax_normalise(candidates(lists)), weights)
    return ranking.apply_boosts(fused, catalog, top_genres, settings.popularity_boost, settings.genre_boost)


def recommend(
    lists: dict[str, DataFrame],
    catalog: DataFrame,
    top_genres: DataFrame,
    settings: HybridSettings | None = None,
    n: int = 10,
) -> DataFrame:
    """(patron_id, book_id, genre, combined_score, rank) for all patrons."""
    settings = settings or HybridSettings()
    return ranking.diversity_cap(score(lists, catalog, top_genres, settings), settings.diversity_cap, n)


@dataclass
class HybridEngine:
    """All component models over one loans table."""

    settings: HybridSettings = field(default_factory=HybridSettings)
    loans: DataFrame | None = None
    strengths: DataFrame | None = None
    catalog: DataFrame | None = None
    als_model: FactorModel | None = None
    svd_model: FactorModel | None = None
    vocab: DataFrame | None = None
    term_weights: DataFrame | None = None
    vectors: DataFrame | None = None

    def fit(
        self,
        loans: DataFrame,
        vectors: DataFrame | None = None,
        factors: int = 20,
        als_iterations: int = 10,
        svd_iterations: int = 10,
        max_features: int = 200,
    ) -> HybridEngine:
        """Train every component; without ``vectors`` the embedding weight goes to the others."""
        self.loans, self.vectors = loans, vectors
        self.strengths = cut_lineage(interactions(loans))
        self.catalog = cut_lineage(book_catalog(loans))
        self.als_model = als.fit(self.strengths, factors, als_iterations)
        self.svd_model = svd.fit(self.strengths, factors, svd_iterations)
        genre = F.col("genre")
        docs = self.catalog.select("book_id", F.concat_ws(" ", "book_title", genre, genre, genre).alias("text"))
        vocab, weighted = tfidf.fit(docs, "book_id", "text", max_features)
        self.vocab, self.term_weights = vocab, cut_lineage(weighted)
        return self

    def _check(self) -> None:
        if self.strengths is None:
            raise NotFittedError("fit the engine before asking for recommendations")

    def seen(self) -> DataFrame:
        return self.strengths.select("patron_id", "book_id")

    def lists(self, n: int = CANDIDATES_PER_MODEL, unseen: bool = True, patrons: DataFrame | None = None) -> dict[str, DataFrame]:
        """Candidates of every model, without the books a patron had if ``unseen``, for all or some patrons."""
        self._check()
        pairs, loans = self.seen(), self.loans
        if patrons is not None:
            wanted = patrons.select("patron_id").distinct()
            pairs, loans = (t.join(wanted, "patron_id", "left_semi") for t in (pairs, loans))
        exclude = pairs if unseen else None
        found = {
            "als": self.als_model.recommend(n, exclude, patrons),
            "svd": self.svd_model.recommend(n, exclude, patrons),
            "tfidf": tfidf.recommend(pairs, self.catalog, self.vocab, self.term_weights, n, unseen),
        }
        if self.vectors is not None:
            found["embedding"] = embeddings.recommend(loans, pairs, self.vectors, n, unseen)
        return found

    def answer(self, asked: DataFrame) -> DataFrame:
        """Answers to a table of requests from all models, each with its own size, cap and exclude flag.

        Only patrons that ask are scored, and only under the flag they ask with.
        """
        self._check()
        checked = cut_lineage(requests.validate_recommend(asked).where("status = 'ok'").select("patron_id", "exclude_seen").distinct())
        genres, scored = patron_top_genre(self.loans), None
        for unseen in (True, False):
            lists = self.lists(unseen=unseen, patrons=checked.where(F.col("exclude_seen") == unseen))
            part = score(lists, self.catalog, genres, self.settings).withColumn("exclude_seen", F.lit(unseen))
            scored = part if scored is None else scored.unionByName(part)
        return requests.recommend_batch(asked, scored)

    def weights(self) -> dict[str, float]:
        models = [m for m in self.settings.weights if m != "embedding" or self.vectors is not None]
        return redistribute(self.settings.weights, models)

    def recommend(self, n: int = 10) -> DataFrame:
        self._check()
        return recommend(self.lists(), self.catalog, patron_top_genre(self.loans), self.settings, n)

    def explain(self, targets: DataFrame) -> DataFrame:
        """Text per (patron_id, book_id) of ``targets``."""
        self._check()
        liked = self.als_model.recommend(EXPLAIN_DEPTH, self.seen(), targets)
        profile = tfidf.profiles(self.seen(), self.term_weights)
        content = tfidf.explain(targets, self.catalog, profile, self.term_weights)
        return explain(content, liked)


def explain(content: DataFrame, collaborative: DataFrame | None = None) -> DataFrame:
    """Join the collaborative and the content reason of each (patron_id, book_id)."""
    reasons = content
    if collaborative is not None:
        liked = collaborative.select("patron_id", "book_id").distinct().withColumn(
            "_liked", F.lit("patrons with similar borrowing history enjoyed this book")
        )
        reasons = content.join(liked, ["patron_id", "book_id"], "left")
    parts = ["_liked", "explanation"] if collaborative is not None else ["explanation"]
    return reasons.select(
        "patron_id", "book_id",
        F.concat(F.lit("Recommended because: "), F.concat_ws("; and ", *parts)).alias("explanation"),
    )


def model_info(weights: dict[str, float], strengths: DataFrame) -> DataFrame:
    """One row per component: weight and the size of the matrix it was trained on."""
    sizes = strengths.agg(
        F.count_distinct("patron_id").alias("n_patrons"), F.count_distinct("book_id").alias("n_books")
    )
    rows = F.array(*[
        F.struct(F.lit(m).alias("component"), F.lit(round(float(w), 6)).alias("weight")) for m, w in weights.items()
    ])
    return sizes.select(F.inline(rows), "n_patrons", "n_books")
