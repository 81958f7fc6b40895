"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stacklens.operators import (
    als, behavioral, block_scores, catalog, dashboard, drift, embeddings, evaluation, hybrid, joint_features, least_squares, monitoring,
    nearest, ranking, requests, side_features, svd, temporal, tfidf, validation,
)
from stacklens.operators.interactions import interactions, matrix_stats, seen_pairs
from stacklens.plans import feature_etl as etl
from stacklens.plans import incremental_etl, retraining
from stacklens.plans.feature_etl import content_docs
from stacklens.session import configure, cut_lineage, shared_dir
from stacklens.functions import calendar as cal
from stacklens.functions import text
from stacklens.sources import testdata as td
from stacklens.sources import readers
from stacklens.sources.readers import parse_metadata
from stacklens.streaming import activity as live
from stacklens.streaming import metrics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HYBRID_SETTINGS = hybrid.HybridSettings(weights={"popular": 0.6, "tfidf": 0.2, "embedding": 0.2})
LOAD_SPLIT = "2000-07-01"
HEALTH_AS_OF = "2001-11-04 12:00:00"
TEMPORAL = temporal.TEMPORAL_COLUMNS
CATALOG = ("patron_id", "book_id", "book_title", "genre", "checkout_date")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(*[F.round(F.round(F.col(f"`{c}`"), 12), digits).alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared location."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- sources and validation ---------------------------------------------------------------

@query
def load_loans(spark, d):
    return td.loans(spark, d)


@query
def load_loans_csv(spark, d):
    """All loans written as CSV to the shared folder and read by the CSV loader."""
    path = scratch(spark, "loans-csv")
    td.loans(spark, d).write.option("header", True).csv(path)
    return readers.load_loans(spark, "csv", path)


@query
def feature_etl(spark, d):
    """The whole daily job; the result is the master table it wrote."""
    paths = etl.run(spark, td.loans(spark, d), td.pos(spark, d), td.activity(spark, d), scratch(spark, "etl"), "warn")
    return spark.read.parquet(paths["master_features"])


@query
def incremental_etl_master(spark, d):
    """The master table after two loads, the second of which runs twice, first with the rows of some patrons only."""
    out = scratch(spark, "loads")
    # Several loads take their rows from these loans, which are joined once.
    loans = cut_lineage(td.loans(spark, d))
    tables = ((loans, "checkout_date"), (td.pos(spark, d), "transaction_date"), (td.activity(spark, d), "event_timestamp"))
    is_later = lambda ts: F.coalesce(F.col(ts) >= F.lit(LOAD_SPLIT).cast("timestamp"), F.lit(False))
    later = [df.where(is_later(ts)) for df, ts in tables]
    incremental_etl.load_day(spark, 1, *[df.where(~is_later(ts)) for df, ts in tables], out, 16)
    incremental_etl.load_day(spark, 2, *[df.where(F.pmod(F.xxhash64("patron_id"), F.lit(10)) == 0) for df in later], out)
    incremental_etl.load_day(spark, 2, *later, out)
    return incremental_etl.current_master(spark, out)


@query
def load_pos(spark, d):
    return td.pos(spark, d)


@query
def load_activity(spark, d):
    return td.activity(spark, d)


def _by_csv(spark, table, load):
    """A table written as CSV to the shared folder and read by its loader."""
    path = scratch(spark, "csv")
    table.write.option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return load(spark, "csv", path)


@query
def load_pos_csv(spark, d):
    return _by_csv(spark, td.pos(spark, d), readers.load_pos)


@query
def load_activity_csv(spark, d):
    return _by_csv(spark, td.activity(spark, d), readers.load_activity)


@query
def activity_metadata(spark, d):
    return parse_metadata(td.activity(spark, d)).select("event_id", F.col("metadata")["k"].alias("k"))


@query
def validate_loans(spark, d):
    return validation.check_loans(td.loans(spark, d, dirty=True))


@query
def validate_pos(spark, d):
    return validation.check_pos(td.pos(spark, d))


@query
def validate_activity(spark, d):
    return validation.check_activity(td.activity(spark, d))


@query
def validate_cross_source(spark, d):
    return validation.check_cross_source(
        td.loans(spark, d, ("patron_id", "checkout_date")), td.pos(spark, d), td.activity(spark, d)
    )


@query
def validate_all(spark, d):
    return validation.check_all(td.loans(spark, d, dirty=True), td.pos(spark, d), td.activity(spark, d))


@query
def validate_requests(spark, d):
    return requests.validate_recommend(td.recommend_requests(spark, d))


@query
def validate_similar_requests(spark, d):
    return requests.validate_similar(td.similar_requests(spark, d))


# --- patron features ----------------------------------------------------------------------

@query
def calendar_fields(spark, d):
    return temporal.calendar_fields(td.loans(spark, d, ("patron_id", "book_id", "checkout_date")))


@query
def temporal_features(spark, d):
    return temporal.temporal_features(td.loans(spark, d, TEMPORAL))


@query
def patron_modes(spark, d):
    return temporal.patron_modes(td.loans(spark, d, ("patron_id", "genre", "checkout_date", "loan_status")))


@query
def genre_features(spark, d):
    return behavioral.genre_features(td.loans(spark, d, ("patron_id", "book_id", "genre")), td.GENRES)


@query
def spending_features(spark, d):
    return behavioral.spending_features(td.pos(spark, d))


@query
def engagement_features(spark, d):
    return behavioral.engagement_features(td.activity(spark, d))


@query
def behavioral_features(spark, d):
    loans = td.loans(spark, d, ("patron_id", "book_id", "genre"))
    return behavioral.behavioral_features(loans, td.pos(spark, d), td.activity(spark, d), td.GENRES)


@query
def master_features(spark, d):
    return behavioral.master_features(
        temporal.temporal_features(td.loans(spark, d, TEMPORAL)),
        behavioral.behavioral_features(
            td.loans(spark, d, ("patron_id", "book_id", "genre")), td.pos(spark, d), td.activity(spark, d), td.GENRES
        ),
    )


@query
def patron_universe(spark, d):
    return td.loans(spark, d, ("patron_id",)).distinct()


@query
def patron_dim(spark, d):
    return side_features.patron_dim(td.loans(
        spark, d, ("patron_id", "checkout_date", "patron_age_group", "patron_membership_type")
    ))


# --- book features ------------------------------------------------------------------------

def _catalog(spark, d):
    return catalog.book_catalog(td.loans(spark, d, CATALOG))


@query
def book_catalog(spark, d):
    return _catalog(spark, d)


@query
def book_metadata(spark, d):
    return catalog.book_metadata(td.loans(spark, d))


@query
def content_text(spark, d):
    return catalog.content_text(_catalog(spark, d))


@query
def popularity_tiers(spark, d):
    return catalog.popularity_tiers(_catalog(spark, d))


@query
def genre_encoding(spark, d):
    return catalog.genre_encoding(catalog.book_metadata(td.loans(spark, d)), td.GENRES)


# --- dashboard ----------------------------------------------------------------------------

@query
def kpis(spark, d):
    return dashboard.kpis(td.loans(spark, d, ("patron_id", "book_id", "loan_duration_days", "loan_status")))


@query
def weekly_checkouts(spark, d):
    return dashboard.weekly_checkouts(td.loans(spark, d, ("checkout_date",)))


@query
def genre_counts(spark, d):
    return dashboard.value_counts(td.loans(spark, d, ("genre",)), "genre")


def _patron_dim(spark, d):
    return side_features.patron_dim(td.loans(
        spark, d, ("patron_id", "checkout_date", "patron_age_group", "patron_membership_type")
    ))


@query
def membership_counts(spark, d):
    return dashboard.value_counts(_patron_dim(spark, d), "patron_membership_type")


@query
def age_counts(spark, d):
    return dashboard.value_counts(_patron_dim(spark, d), "patron_age_group").orderBy("patron_age_group")


@query
def dow_counts(spark, d):
    return dashboard.dow_counts(td.loans(spark, d, ("checkout_date",)))


@query
def top_patrons(spark, d):
    return dashboard.top_patrons(td.loans(spark, d, ("patron_id", "book_id", "loan_duration_days", "loan_status")))


@query
def top_books(spark, d):
    return dashboard.top_books(td.loans(spark, d, ("patron_id", "book_id", "genre", "times_renewed")))


@query
def genre_trend(spark, d):
    return dashboard.genre_trend(td.loans(spark, d, ("genre", "checkout_date")))


@query
def season_genre(spark, d):
    return dashboard.season_genre(td.loans(spark, d, ("genre", "checkout_date")))


@query
def patron_history(spark, d):
    busiest = dashboard.top_patrons(td.loans(spark, d, TEMPORAL), 1).select("patron_id").scalar()
    return dashboard.patron_history(td.loans(spark, d), busiest)


# --- text ---------------------------------------------------------------------------------

def _docs(spark, d):
    return content_docs(_catalog(spark, d))


def _documents(spark, d):
    return td.table(spark, d, "documents").select("doc_id", "text")


@query
def tokens(spark, d):
    return _documents(spark, d).select(
        "doc_id", F.posexplode(text.tokens(F.col("text"))).alias("position", "token")
    )


@query
def ngrams(spark, d):
    return tfidf.term_counts(_documents(spark, d), "doc_id", "text")


@query
def tfidf_vocab(spark, d):
    return tfidf.vocabulary(_docs(spark, d), "book_id", "text", 100)


@query
def tfidf_weights(spark, d):
    return rounded(tfidf.fit(_docs(spark, d), "book_id", "text", 100)[1])


@query
def tfidf_vocab_documents(spark, d):
    return tfidf.vocabulary(_documents(spark, d), "doc_id", "text", 500, min_df=2)


@query
def tfidf_weights_documents(spark, d):
    return rounded(tfidf.fit(_documents(spark, d), "doc_id", "text", 500, min_df=2)[1])


@query
def tfidf_wide(spark, d):
    """Every cell of the wide export: (book_id, column, value), zeros too."""
    docs = cut_lineage(_docs(spark, d))
    vocab, weighted = tfidf.fit(docs, "book_id", "text", 50)
    table = rounded(tfidf.wide(docs, cut_lineage(weighted), vocab, "book_id"))
    columns = [c for c in table.columns if c != "book_id"]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns])
    return table.select("book_id", F.inline(cells))


def _pairs(spark, d):
    return seen_pairs(td.loans(spark, d, ("patron_id", "book_id")))


def _text_model(spark, d, max_features=200):
    """Catalog, vocabulary and weights, written once because several joins read them."""
    books = cut_lineage(_catalog(spark, d))
    vocab, weighted = tfidf.fit(content_docs(books), "book_id", "text", max_features)
    return books, vocab, cut_lineage(weighted)


@query
def tfidf_profile(spark, d):
    _, _, weighted = _text_model(spark, d)
    return rounded(tfidf.profiles(_pairs(spark, d), weighted))


@query
def tfidf_recommend(spark, d):
    return tfidf.recommend(cut_lineage(_pairs(spark, d)), *_text_model(spark, d, 500), 10)


@query
def tfidf_similar(spark, d):
    return tfidf.similar(*_text_model(spark, d, 500), 10)


@query
def tfidf_explain(spark, d):
    books, vocab, weighted = _text_model(spark, d)
    pairs = cut_lineage(_pairs(spark, d))
    best = tfidf.recommend(pairs, books, vocab, weighted, 3)
    return tfidf.explain(best, books, tfidf.profiles(pairs, weighted), weighted)


# --- interactions and ranking -------------------------------------------------------------

def _strengths(spark, d):
    return interactions(td.loans(spark, d, ("patron_id", "book_id", "loan_status", "times_renewed")))


def _split(spark, d, columns=("patron_id", "book_id", "checkout_date")):
    return evaluation.split_by_date(td.loans(spark, d, columns), F.lit(td.HOLDOUT_START).cast("timestamp"))


@query
def interaction_strength(spark, d):
    return _strengths(spark, d)


@query
def interaction_stats(spark, d):
    return matrix_stats(_strengths(spark, d))


@query
def exclude_seen(spark, d):
    train, holdout = _split(spark, d)
    return ranking.exclude_seen(seen_pairs(holdout), seen_pairs(train))


def _popular(spark, d, n, loans=None):
    loans = td.loans(spark, d, CATALOG) if loans is None else loans
    return ranking.popular_unseen(seen_pairs(loans), ranking.popularity_ranks(catalog.book_catalog(loans)), n)


@query
def topn_popular_unseen(spark, d):
    return _popular(spark, d, 10)


@query
def topn_popular_cold(spark, d):
    """All customers, those without a loan before the holdout too."""
    train, _ = _split(spark, d, CATALOG)
    patrons, _ = _patrons_and_books(spark, d)
    return ranking.popular_unseen(seen_pairs(train), ranking.popularity_ranks(catalog.book_catalog(train)), 10, patrons)


def _lists(spark, d, n=hybrid.CANDIDATES_PER_MODEL):
    """Candidate lists of the deterministic models, their catalog and the seen pairs."""
    books, vocab, weighted = _text_model(spark, d)
    pairs = cut_lineage(_pairs(spark, d))
    loans = td.loans(spark, d, ("patron_id", "book_id", "checkout_date"))
    lists = {
        "popular": ranking.popular_unseen(pairs, ranking.popularity_ranks(books), n),
        "tfidf": tfidf.recommend(pairs, books, vocab, weighted, n),
        "embedding": embeddings.recommend(loans, pairs, td.book_vectors(spark, d), n),
    }
    return lists, books


def _top_genres(spark, d):
    return hybrid.patron_top_genre(td.loans(spark, d, ("patron_id", "genre")))


@query
def candidates(spark, d):
    return hybrid.candidates(_lists(spark, d)[0])


@query
def minmax_normalise(spark, d):
    return rounded(ranking.minmax_normalise(hybrid.candidates(_lists(spark, d)[0])))


@query
def fuse_scores(spark, d):
    lists, _ = _lists(spark, d)
    return ranking.fuse(ranking.minmax_normalise(hybrid.candidates(lists)), HYBRID_SETTINGS.weights)


@query
def apply_rules(spark, d):
    lists, books = _lists(spark, d)
    return rounded(hybrid.score(lists, books, _top_genres(spark, d), HYBRID_SETTINGS))


@query
def diversity_cap(spark, d):
    """Each patron's own books ranked by strength, at most two per genre."""
    owned = _strengths(spark, d).withColumnRenamed("interaction_score", "combined_score")
    return ranking.diversity_cap(owned.join(_catalog(spark, d).select("book_id", "genre"), "book_id"), 2, 8)


@query
def hybrid_recommend(spark, d):
    lists, books = _lists(spark, d)
    return rounded(hybrid.recommend(lists, books, _top_genres(spark, d), HYBRID_SETTINGS, 10))


@query
def hybrid_explain_content(spark, d):
    books, vocab, weighted = _text_model(spark, d)
    pairs = cut_lineage(_pairs(spark, d))
    best = ranking.popular_unseen(pairs, ranking.popularity_ranks(books), 3)
    return hybrid.explain(tfidf.explain(best, books, tfidf.profiles(pairs, weighted), weighted))


@query
def model_info(spark, d):
    weights = hybrid.redistribute(hybrid.DEFAULT_WEIGHTS, ["als", "svd", "tfidf"])
    return hybrid.model_info(weights, _strengths(spark, d))


# --- embeddings ---------------------------------------------------------------------------

@query
def recency_weights(spark, d):
    loans = td.loans(spark, d, ("patron_id", "book_id", "checkout_date"))
    return rounded(embeddings.recency_weights(loans, td.book_vectors(spark, d)), 9)


@query
def emb_profile(spark, d):
    loans = td.loans(spark, d, ("patron_id", "book_id", "checkout_date"))
    profile = embeddings.profiles(loans, td.book_vectors(spark, d))
    return rounded(profile.select("patron_id", F.posexplode("vector").alias("dim", "value")))


@query
def emb_recommend(spark, d):
    loans = td.loans(spark, d, ("patron_id", "book_id", "checkout_date"))
    return embeddings.recommend(loans, cut_lineage(seen_pairs(loans)), td.book_vectors(spark, d), 10)


@query
def emb_similar(spark, d):
    return embeddings.similar(td.book_vectors(spark, d), 10)


@query
def emb_similar_lsh(spark, d):
    return nearest.similar(td.book_vectors(spark, d), 10)


@query
def emb_similar_lsh_recall(spark, d):
    """Books, pairs of the exact answer, whether nine of ten are found, and found scores that are not exact."""
    vectors = cut_lineage(td.book_vectors(spark, d))
    found, exact = cut_lineage(nearest.similar(vectors, 10)), cut_lineage(embeddings.similar(vectors, 10))
    wrong = found.alias("f").join(exact.alias("e"), ["book_id", "similar_book_id"]).where("f.score <> e.score").agg(F.count(F.lit(1)).alias("wrong"))
    return nearest.recall(found, exact).crossJoin(wrong).select(
        "books", "pairs", (F.col("found") >= 0.9 * F.col("pairs")).alias("recalled"), "wrong")


# --- factor models ------------------------------------------------------------------------

@query
def als_recommend(spark, d):
    strengths = cut_lineage(_strengths(spark, d))
    return als.fit(strengths, 20, 10).recommend(10, strengths.select("patron_id", "book_id"))


@query
def als_loss(spark, d):
    strengths = cut_lineage(_strengths(spark, d))
    return als.loss(strengths, als.fit(strengths, 20, 10), 20)


def _plain_als(strengths):
    return least_squares.fit(strengths, 2, 2, 0.1, 42)


@query
def als_plain_factors(spark, d):
    """Vectors of all patrons and books after two rounds with a plain ridge."""
    model = _plain_als(_strengths(spark, d))
    of = lambda factors, key, side: factors.select(F.lit(side).alias("side"), F.col(key).alias("id"), "vector")
    both = of(model.patron_factors, "patron_id", "patron").unionByName(of(model.book_factors, "book_id", "book"))
    return rounded(both.select("side", "id", *[F.get("vector", F.lit(i)).alias(f"f{i}") for i in range(2)]))


@query
def als_plain_recommend(spark, d):
    strengths = cut_lineage(_strengths(spark, d))
    return _plain_als(strengths).recommend(10, strengths.select("patron_id", "book_id"))


@query
def als_plain_similar(spark, d):
    return _plain_als(_strengths(spark, d)).similar(10)


@query
def als_plain_loss(spark, d):
    strengths = cut_lineage(_strengths(spark, d))
    return als.loss(strengths, _plain_als(strengths), 2)


@query
def svd_recommend(spark, d):
    strengths = cut_lineage(_strengths(spark, d))
    return svd.fit(strengths, 20).recommend(10, strengths.select("patron_id", "book_id"))


@query
def svd_similar(spark, d):
    return svd.fit(_strengths(spark, d), 20).similar(10)


@query
def svd_variance(spark, d):
    strengths = cut_lineage(_strengths(spark, d))
    return svd.explained_variance(strengths, svd.fit(strengths, 20), 20)


@query
def side_feature_tokens(spark, d):
    return side_features.entity_features(td.loans(
        spark, d, ("patron_id", "book_id", "genre", "checkout_date", "patron_age_group", "patron_membership_type")
    ))


@query
def side_feature_weights(spark, d):
    return side_features.weighted_interactions(td.loans(spark, d, ("patron_id", "book_id", "times_renewed")))


def _patrons_and_books(spark, d):
    """All patrons and books of the library, with or without loans."""
    k = F.col("c_custkey")
    patrons = td.table(spark, d, "customer").select(
        td.key("P", "c_custkey").alias("patron_id"),
        td.pick(F.col("c_nationkey") % 5, td.schemas.AGE_GROUPS).alias("patron_age_group"),
        td.pick(k % 3, td.schemas.MEMBERSHIP_TYPES).alias("patron_membership_type"),
    )
    books = td.table(spark, d, "part").select(td.key("B", "p_partkey").alias("book_id"), F.col("p_type").alias("genre"))
    return patrons, books


@query
def side_feature_recommend(spark, d):
    train, _ = _split(spark, d, ("patron_id", "book_id", "checkout_date", "times_renewed"))
    patrons, books = _patrons_and_books(spark, d)
    return side_features.fit(train, patrons, books).recommend(10, seen_pairs(train))


@query
def hybrid_full(spark, d):
    """All four models."""
    return _engine(spark, d).recommend(10)


def _engine(spark, d):
    return hybrid.HybridEngine().fit(cut_lineage(td.loans(spark, d)), td.book_vectors(spark, d))


def _explained(spark, d):
    engine = _engine(spark, d)
    return engine.explain(cut_lineage(engine.recommend(3).select("patron_id", "book_id")))


@query
def hybrid_explain(spark, d):
    """Why the three best books of the hybrid ranking: some are in the collaborative list, some not."""
    return _explained(spark, d)


# --- properties of the fitted models ------------------------------------------------------
# Their values depend on random starts and the order of sums; what must hold whatever those are is compared.

def _list_properties(recs, seen=None, n=10, key="patron_id", item="book_id", score="score"):
    """One row: lists, rows, whether ranks run from 1 without gaps and scores never rise, and rows that were seen."""
    recs = cut_lineage(recs)
    order = Window.partitionBy(key).orderBy("rank")
    before = recs.withColumn("before", F.lag(score).over(order)).withColumn("place", F.row_number().over(order))
    row = before.agg(
        F.count_distinct(key).alias("n_lists"), F.count(F.lit(1)).alias("n_rows"), F.max("rank").cast("long").alias("longest"),
        F.bool_and(F.col("rank") == F.col("place")).alias("ranks_run"),
        F.bool_and(F.col("before").isNull() | (F.col("before") >= F.col(score))).alias("scores_fall"))
    if seen is None:
        return row.withColumn("n_seen", recs.where(F.col(key) == F.col(item)).agg(F.count(F.lit(1))).scalar())
    return row.withColumn("n_seen", recs.join(seen, [key, item], "left_semi").agg(F.count(F.lit(1))).scalar())


@query
def als_properties(spark, d):
    """Lists of ALS, and its fit to the filled cells against the mean as a prediction."""
    strengths = cut_lineage(_strengths(spark, d))
    model = als.fit(strengths, 20, 10)
    fit = als.loss(strengths, model, 20).first()
    row = _list_properties(model.recommend(10, strengths.select("patron_id", "book_id")), strengths.select("patron_id", "book_id"))
    return row.select("*", F.lit(fit["n_filled"]).alias("n_filled"), F.lit(fit["observed_rmse"] < fit["mean_predictor_rmse"]).alias("beats_mean"))


@query
def svd_properties(spark, d):
    strengths = cut_lineage(_strengths(spark, d))
    model = svd.fit(strengths, 20)
    ratios = [r["explained_variance_ratio"] for r in svd.explained_variance(strengths, model, 20).orderBy("component").collect()]
    falls = all(a >= b for a, b in zip(model.singular_values, model.singular_values[1:]))
    row = _list_properties(model.recommend(10, strengths.select("patron_id", "book_id")), strengths.select("patron_id", "book_id"))
    return row.select("*", F.lit(len(ratios)).cast("long").alias("n_components"),
                      F.lit(all(0 <= r <= 1 for r in ratios) and sum(ratios) <= 1).alias("ratios_fit"), F.lit(falls).alias("values_fall"))


@query
def svd_similar_properties(spark, d):
    return _list_properties(svd.fit(cut_lineage(_strengths(spark, d)), 20).similar(10), key="book_id", item="similar_book_id")


@query
def side_feature_properties(spark, d):
    """All customers get a list, those without a loan too."""
    train, _ = _split(spark, d, ("patron_id", "book_id", "checkout_date", "times_renewed"))
    train = cut_lineage(train)
    patrons, books = _patrons_and_books(spark, d)
    return _list_properties(side_features.fit(train, patrons, books).recommend(10, seen_pairs(train)), seen_pairs(train))


@query
def side_feature_joint(spark, d):
    """Lists of all customers from the jointly trained model."""
    train, _ = _split(spark, d, ("patron_id", "book_id", "checkout_date", "times_renewed"))
    train = cut_lineage(train)
    patrons, books = _patrons_and_books(spark, d)
    return joint_features.fit(train, patrons, books, 16, 10).recommend(10, seen_pairs(train))


@query
def side_feature_joint_properties(spark, d):
    """Properties of those lists, and whether borrowed books score above the mean of all books for most loans."""
    train, _ = _split(spark, d, ("patron_id", "book_id", "checkout_date", "times_renewed"))
    train = cut_lineage(train)
    patrons, books = _patrons_and_books(spark, d)
    model = joint_features.fit(train, patrons, books, 16, 10)
    mean = model.book_factors.agg(F.array(*[F.avg(F.get("vector", F.lit(i))) for i in range(17)]).alias("mean"))
    # A book scores above the mean of all books where its distance from the mean has a positive product.
    apart = model.book_factors.crossJoin(F.broadcast(mean)).select(
        "book_id", F.zip_with("vector", "mean", lambda x, y: x - y).alias("vector"))
    seen = cut_lineage(seen_pairs(train))
    scored = block_scores.pair_scores(model.patron_factors, apart, seen, "patron_id", "book_id")
    above = scored.agg((F.avg((F.col("score") > 0).cast("double")) > 0.5).alias("above_mean"))
    return _list_properties(model.recommend(10, seen), seen).crossJoin(above)


@query
def hybrid_full_properties(spark, d):
    engine = _engine(spark, d)
    recs = cut_lineage(engine.recommend(10))
    most = recs.groupBy("patron_id", "genre").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    return _list_properties(recs, engine.seen(), score="combined_score").select(
        "n_lists", "ranks_run", "scores_fall", "n_seen", (F.col("longest") <= 10).alias("short_enough"), (most <= 3).alias("cap_kept"))


@query
def hybrid_explain_properties(spark, d):
    text = F.col("explanation")
    return _explained(spark, d).agg(
        F.count_distinct("patron_id").alias("n_patrons"), F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(text.startswith("Recommended because: ") & (F.length(text) > 25)).alias("all_have_reasons"))


@query
def challenger_properties(spark, d):
    loans = cut_lineage(td.loans(spark, d, ("patron_id", "book_id", "checkout_date", "loan_status", "times_renewed")))
    train, holdout = evaluation.split_by_hash(loans)
    row = retraining.challenger_score(als.fit(cut_lineage(interactions(train)), 20, 15), train, holdout)
    return row.select("n_patrons", (F.col("avg_score") > 0).alias("has_score"), F.col("ndcg_at_k").between(0, 1).alias("ndcg_fits"))


@query
def model_comparison_properties(spark, d):
    """Exact numbers of the popularity list; for all models that the metrics are shares."""
    lists, holdout = _model_lists(spark, d)
    share = F.col("precision_at_k").between(0, 1) & F.col("recall_at_k").between(0, 1) & F.col("ndcg_at_k").between(0, 1)
    exact = [F.when(F.col("model") == "popularity", F.col(c)).alias(c) for c in ("precision_at_k", "recall_at_k", "ndcg_at_k")]
    return evaluation.compare_models(lists, holdout).select("model", "n_patrons", share.alias("are_shares"), *exact)


@query
def retrain_properties(spark, d):
    """A due cycle promotes its challenger and starts monitoring anew; the next check finds no drift."""
    home = scratch(spark, "models")
    loans = cut_lineage(td.loans(spark, d))
    newest = _monthly_metrics(spark, d).orderBy(F.desc("month")).limit(1)
    stamp = F.lit("2001-08-02").cast("timestamp")
    paths = (home, f"{home}/registry", f"{home}/metrics", f"{home}/baseline")
    promoted = retraining.retrain_if_needed(spark, loans, newest, stamp, "v1", *paths)
    again = retraining.retrain_if_needed(spark, loans, retraining.latest_metrics(spark, paths[2]), stamp, "v2", *paths)
    baseline = spark.read.parquet(paths[3])
    return retraining.read_registry(spark, paths[1]).agg(
        F.count(F.lit(1)).alias("n_versions"), F.max("version").alias("champion"), F.bool_and("promoted").alias("promoted"),
    ).select("*", F.lit(promoted).alias("ran"), F.lit(again).alias("ran_again"),
             baseline.where("feature = 'loan_duration_days'").select("total").scalar().alias("baseline_rows"))


# --- evaluation and lifecycle -------------------------------------------------------------

@query
def holdout_split(spark, d):
    train, holdout = evaluation.split_by_hash(td.loans(spark, d))
    count = lambda df, part: df.groupBy("loan_status").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(part))
    return count(train, "train").unionByName(count(holdout, "holdout"))


def _popular_on_train(spark, d, n=10):
    train, holdout = _split(spark, d, CATALOG)
    return _popular(spark, d, n, train), holdout


@query
def precision_recall_at_k(spark, d):
    return evaluation.precision_recall_at_k(*_popular_on_train(spark, d))


@query
def ndcg_at_k(spark, d):
    return evaluation.ndcg_at_k(*_popular_on_train(spark, d))


@query
def precision_over_time(spark, d):
    recs, holdout = _popular_on_train(spark, d)
    return evaluation.precision_over_time(recs, holdout, cal.month_start(F.col("checkout_date")))


def _model_lists(spark, d):
    train, holdout = _split(spark, d, (*CATALOG, "loan_status", "times_renewed"))
    train = cut_lineage(train)
    strengths = cut_lineage(interactions(train))
    pairs = strengths.select("patron_id", "book_id")
    books = cut_lineage(catalog.book_catalog(train))
    vocab, weighted = tfidf.fit(content_docs(books), "book_id", "text", 200)
    return {
        "popularity": ranking.popular_unseen(pairs, ranking.popularity_ranks(books), 10),
        "tfidf": tfidf.recommend(pairs, books, vocab, cut_lineage(weighted), 10),
        "embedding": embeddings.recommend(train, pairs, td.book_vectors(spark, d), 10),
        "als": als.fit(strengths, 20, 10).recommend(10, pairs),
        "svd": svd.fit(strengths, 20).recommend(10, pairs),
    }, holdout


@query
def model_comparison(spark, d):
    lists, holdout = _model_lists(spark, d)
    return evaluation.compare_models(lists, holdout)


def _monthly_metrics(spark, d):
    """Mean PSI of the loan features per month after the baseline period, and the baseline's age."""
    split = F.lit(td.DRIFT_SPLIT).cast("timestamp")
    loans = td.loans(spark, d, ("checkout_date", "loan_duration_days", "times_renewed"))
    profile = drift.baseline_profile(drift.to_long(loans.where(F.col("checkout_date") < split), NUMERIC))
    current = loans.where(F.col("checkout_date") >= split).withColumn("month", cal.month_start(F.col("checkout_date")))
    by_month = drift.psi(profile, drift.to_long(current, NUMERIC, "month"), by=["month"])
    return by_month.groupBy("month").agg(
        drift.mean_psi(F.col("psi")).alias("overall_psi")
    ).withColumn("days_since_training", cal.elapsed_days(F.col("month"), split))


@query
def retrain_decision(spark, d):
    return retraining.retrain_decision(_monthly_metrics(spark, d))


@query
def promote_decision(spark, d):
    train, holdout = _split(spark, d, CATALOG)
    popular = evaluation.precision_recall_at_k(_popular(spark, d, 10, train), holdout)
    vectors = embeddings.recommend(train, seen_pairs(train), td.book_vectors(spark, d), 10)
    semantic = evaluation.precision_recall_at_k(vectors, holdout)
    return retraining.promote_decision(popular.select(
        F.col("precision_at_k").alias("challenger_score"),
        semantic.select("precision_at_k").scalar().alias("champion_score"),
    ))


@query
def challenger_score(spark, d):
    loans = cut_lineage(td.loans(spark, d, ("patron_id", "book_id", "checkout_date", "loan_status", "times_renewed")))
    train, holdout = evaluation.split_by_hash(loans)
    return retraining.challenger_score(als.fit(interactions(train), 20, 15), train, holdout)


@query
def retrain(spark, d):
    """One whole cycle; the result is the registry."""
    home = scratch(spark, "models")
    loans = cut_lineage(td.loans(spark, d))
    newest = _monthly_metrics(spark, d).orderBy(F.desc("month")).limit(1)
    retraining.retrain_if_needed(
        spark, loans, newest, F.lit("2001-08-02").cast("timestamp"), "v1", home, f"{home}/registry"
    )
    return retraining.read_registry(spark, f"{home}/registry").select("version", "trained_at", "score", "promoted")


# --- drift and monitoring -----------------------------------------------------------------

NUMERIC = ("loan_duration_days", "times_renewed")
CATEGORICAL = ("genre", "loan_status", "patron_membership_type")


def _drift_loans(spark, d):
    return td.loans(spark, d, ("checkout_date", *NUMERIC, *CATEGORICAL))


def _drift_sides(spark, d):
    loans = td.loans(spark, d, ("checkout_date", *NUMERIC))
    is_base = F.col("checkout_date") < F.lit(td.DRIFT_SPLIT).cast("timestamp")
    return drift.to_long(loans.where(is_base), NUMERIC), drift.to_long(loans.where(~is_base), NUMERIC)


def _psi(spark, d, smoothing="full"):
    base, current = _drift_sides(spark, d)
    return drift.psi(drift.baseline_profile(base), current, smoothing=smoothing)


def _categories(spark, d):
    split = F.lit(td.DRIFT_SPLIT).cast("timestamp")
    return drift.category_counts(_drift_loans(spark, d), CATEGORICAL, F.col("checkout_date") < split)


@query
def psi_drift(spark, d):
    return _psi(spark, d)


@query
def psi_drift_simple(spark, d):
    return _psi(spark, d, "simple").select("feature", "psi")


@query
def psi_by_day(spark, d):
    base, _ = _drift_sides(spark, d)
    loans = td.loans(spark, d, ("checkout_date", *NUMERIC)).where(
        F.col("checkout_date") >= F.lit(td.DRIFT_SPLIT).cast("timestamp")
    ).withColumn("day", F.to_date("checkout_date"))
    return drift.psi(drift.baseline_profile(base), drift.to_long(loans, NUMERIC, "day"), by=["day"])


@query
def kl_drift(spark, d):
    return drift.kl_drift(td.prediction_scores(spark, d))


@query
def chi2_drift(spark, d):
    return drift.chi2_drift(_categories(spark, d))


@query
def chi2_drift_proportion(spark, d):
    return drift.chi2_drift(_categories(spark, d), scale="proportion")


@query
def chi2_drift_books(spark, d):
    """Drift of the books borrowed: as many categories as there are books."""
    loans = td.loans(spark, d, ("checkout_date", "book_id"))
    split = F.lit(td.DRIFT_SPLIT).cast("timestamp")
    return drift.chi2_drift(drift.category_counts(loans, ["book_id"], F.col("checkout_date") < split))


@query
def category_shifts(spark, d):
    """Shares of all three features before and after the split that moved by more than a tenth of a percent."""
    return drift.category_shifts(_categories(spark, d), 0.001)


@query
def histogram_alignment(spark, d):
    """Events by patron and book asked for, before and after the split; many books occur on one side only."""
    events = td.activity(spark, d)
    is_base = F.col("event_timestamp") < F.lit(td.SCORE_SPLIT).cast("timestamp")
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in ("patron_id", "book_id")])
    count = lambda df: df.select(F.inline(pairs)).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
    return drift.align_histograms(count(events.where(is_base)), count(events.where(~is_base)))


def _drift_rows(spark, d):
    return drift.drift_rows(
        _psi(spark, d), drift.chi2_drift(_categories(spark, d)), drift.kl_drift(td.prediction_scores(spark, d))
    )


@query
def drift_report(spark, d):
    return _drift_rows(spark, d)


@query
def drift_summary(spark, d):
    return drift.drift_summary(_drift_rows(spark, d), days_since_baseline=14)


def _feature_drift(spark, d, loans=None):
    loans = td.loans(spark, d, TEMPORAL) if loans is None else loans
    is_base = F.col("checkout_date") < F.lit(td.DRIFT_SPLIT).cast("timestamp")
    before = temporal.temporal_features(loans.where(is_base))
    after = temporal.temporal_features(loans.where(~is_base))
    return drift.feature_drift(before, after, drift.monitored_features(after))


@query
def feature_drift(spark, d):
    return _feature_drift(spark, d)


def _health(spark, d, loans=None):
    return monitoring.table_health({
        "loans": (td.loans(spark, d, ("checkout_date",)) if loans is None else loans, "checkout_date"),
        "pos": (td.pos(spark, d), "transaction_date"),
        "activity": (td.activity(spark, d), "event_timestamp"),
        "returns": (td.loans(spark, d, ("return_date",)) if loans is None else loans, "return_date"),
    }, F.lit(HEALTH_AS_OF).cast("timestamp"))


@query
def table_health(spark, d):
    return _health(spark, d)


@query
def health_score(spark, d):
    return monitoring.health_score(_health(spark, d))


def _popular_with_genre(spark, d):
    loans = cut_lineage(td.loans(spark, d, CATALOG))
    books = cut_lineage(catalog.book_catalog(loans))
    patrons = loans.where("book_id IS NOT NULL").select("patron_id")
    popular = ranking.popular_unseen(seen_pairs(loans), ranking.popularity_ranks(books), 10, patrons)
    return popular.join(books.select("book_id", "genre"), "book_id")


@query
def rec_diversity(spark, d):
    return monitoring.diversity(_popular_with_genre(spark, d))


@query
def diversity_over_time(spark, d):
    loans = td.loans(spark, d, ("genre", "checkout_date"))
    return monitoring.diversity(loans.withColumn("month", cal.month_start(F.col("checkout_date"))), "month")


@query
def system_status(spark, d):
    # The loans are joined once for features and health, and once with their books.
    loans = cut_lineage(td.loans(spark, d, (*TEMPORAL, "return_date")))
    psi = _feature_drift(spark, d, loans).agg(drift.mean_psi(F.col("psi"))).scalar()
    health = monitoring.health_score(_health(spark, d, loans)).select("health_score").scalar()
    spread = monitoring.diversity(_popular_with_genre(spark, d)).select("diversity_score").scalar()
    return monitoring.system_status(psi, health, spread, spark.range(1))


# --- batches of requests ------------------------------------------------------------------

def _scored_lists(spark, d):
    """Scored candidates with and without the books a patron had, from the content models."""
    books, vocab, weighted = _text_model(spark, d)
    all_loans = cut_lineage(td.loans(spark, d, ("patron_id", "book_id", "checkout_date")))
    vectors, genres = td.book_vectors(spark, d), _top_genres(spark, d)
    asked = cut_lineage(requests.validate_recommend(td.recommend_requests(spark, d)).where("status = 'ok'"))
    rows = None
    for unseen_only in (True, False):
        # Only patrons that ask, under the flag they ask with.
        loans = all_loans.join(asked.where(F.col("exclude_seen") == unseen_only), "patron_id", "left_semi")
        pairs = cut_lineage(seen_pairs(loans))
        lists = {
            "tfidf": tfidf.recommend(pairs, books, vocab, weighted, 50, unseen_only),
            "embedding": embeddings.recommend(loans, pairs, vectors, 50, unseen_only),
        }
        part = hybrid.score(lists, books, genres, hybrid.HybridSettings()).withColumn("exclude_seen", F.lit(unseen_only))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def recommend_batch(spark, d):
    return rounded(requests.recommend_batch(td.recommend_requests(spark, d), _scored_lists(spark, d)))


@query
def recommend_batch_hybrid(spark, d):
    """Requests answered from all four models: how many of each status, and whether each request was honoured."""
    engine, asked = _engine(spark, d), td.recommend_requests(spark, d)
    answers = cut_lineage(engine.answer(asked))
    checked = requests.validate_recommend(asked).select("request_id", "n_recommendations", "exclude_seen", "diversity_cap")
    per_genre = answers.where("book_id IS NOT NULL").groupBy("request_id", "genre").agg(F.count(F.lit(1)).alias("n"))
    per_request = answers.groupBy("request_id", "status").agg(F.count("book_id").alias("n"), F.max("rank").alias("last"))
    seen = answers.join(engine.seen(), ["patron_id", "book_id"], "left_semi").select("request_id").distinct()
    facts = (per_request.join(checked, "request_id")
             .join(per_genre.groupBy("request_id").agg(F.max("n").alias("most")), "request_id", "left")
             .join(seen.withColumn("repeats", F.lit(True)), "request_id", "left"))
    return facts.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.bool_and((F.col("n") <= F.col("n_recommendations")) | (F.col("n") == 0)).alias("size_kept"),
        F.bool_and((F.col("n") > 0) == (F.col("status") == "ok")).alias("answered"),
        F.bool_and(F.coalesce(F.col("most") <= F.col("diversity_cap"), F.lit(True))).alias("cap_kept"),
        F.bool_and(F.coalesce(~F.col("exclude_seen") | ~F.col("repeats"), F.lit(True))).alias("exclude_kept"))


@query
def similar_batch(spark, d):
    books, vocab, weighted = _text_model(spark, d)
    by_text = tfidf.similar(books, vocab, weighted, 50).withColumn("method", F.lit("tfidf"))
    by_vector = embeddings.similar(td.book_vectors(spark, d), 50).withColumn("method", F.lit("bert"))
    return requests.similar_batch(td.similar_requests(spark, d), by_text.unionByName(by_vector))


@query
def explain_batch(spark, d):
    """Every patron asks why the most recent own loan would be recommended; unknown patrons ask too."""
    books, vocab, weighted = _text_model(spark, d)
    pairs = cut_lineage(_pairs(spark, d))
    asked = td.recommend_requests(spark, d).select("request_id", F.trim("patron_id").alias("patron_id")).join(
        td.loans(spark, d, ("patron_id", "book_id", "checkout_date")).groupBy("patron_id").agg(
            F.max(F.struct("checkout_date", "book_id"))["book_id"].alias("book_id")
        ), "patron_id", "left"
    )
    found = tfidf.explain(asked.where("book_id IS NOT NULL"), books, tfidf.profiles(pairs, weighted), weighted)
    return requests.explain_batch(asked, found)


# --- streaming ----------------------------------------------------------------------------

def _event_stream(spark, d):
    """The events as four parts that arrive in some four batches, in no order of time."""
    path = scratch(spark, "events")
    events = td.table(spark, d, "events")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for i in range(4):
        events.where(part == i).write.mode("append").parquet(path)
    files = len(spark.read.schema(events.schema).parquet(path).inputFiles())
    return live.from_files(spark, path, events.schema, max_files=max(1, files // 4)), events, path


@query
def stream_equals_batch(spark, d):
    """Events in several batches, out of order and with repeats: each comes out once."""
    out = scratch(spark, "activity")
    stream, events, path = _event_stream(spark, d)
    events.where("event_id % 10 = 3").write.mode("append").parquet(path)
    live.unique_events(td.activity_from_events(stream), out, f"{out}/checkpoint").awaitTermination()
    return live.settled_events(spark, out)


@query
def stream_engagement(spark, d):
    out = scratch(spark, "engagement")
    stream, _, _ = _event_stream(spark, d)
    live.engagement_updates(td.activity_from_events(stream), out, f"{out}/checkpoint", compact_every=2).awaitTermination()
    return live.latest_engagement(spark, out)


@query
def stream_quarantine(spark, d):
    out = scratch(spark, "quarantine")
    stream, _, _ = _event_stream(spark, d)
    live.quarantine(td.activity_from_events(stream, keep_errors=True), out, f"{out}/checkpoint").awaitTermination()
    read = lambda part: spark.read.parquet(f"{out}/{part}").withColumn("part", F.lit(part))
    return read("valid").unionByName(read("quarantine")).groupBy("part", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_psi(spark, d):
    """Daily PSI of the event value from the stream, against the profile of the first half."""
    out = scratch(spark, "psi")
    events = td.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    base = events.where(F.col("ts") < F.lit(td.SCORE_SPLIT).cast("timestamp"))
    profile = cut_lineage(drift.baseline_profile(drift.to_long(base, ["value"])))
    stream, _, _ = _event_stream(spark, d)
    metrics.psi_updates(stream, profile, "ts", ["value"], out, f"{out}/checkpoint").awaitTermination()
    return metrics.current_psi(spark, profile, out)


@query
def stream_windowed_rate(spark, d):
    """Requests per minute, counted batch by batch."""
    out = scratch(spark, "rates")
    stream, _, _ = _event_stream(spark, d)
    metrics.rate_updates(td.request_log_from_events(stream), out, f"{out}/checkpoint").awaitTermination()
    return metrics.current_rates(spark, out)


def _running_counts(spark, d, name, length="1 minute"):
    out = scratch(spark, name)
    stream, _, _ = _event_stream(spark, d)
    metrics.rate_updates(td.request_log_from_events(stream), out, f"{out}/checkpoint", length).awaitTermination()
    return out


@query
def stream_increase(spark, d):
    """Requests of the last 24 hours, every hour, from counts kept batch by batch."""
    return metrics.current_increase(spark, _running_counts(spark, d, "increase", "1 hour"))


@query
def stream_changes(spark, d):
    """Changes per hour of a counter that starts anew every day, from counts kept batch by batch."""
    return metrics.current_changes(spark, _running_counts(spark, d, "changes"))


@query
def stream_percentiles(spark, d):
    """Latencies per five minutes from value bins that are added up batch by batch."""
    out = scratch(spark, "percentiles")
    stream, _, _ = _event_stream(spark, d)
    metrics.percentile_updates(td.request_log_from_events(stream), "latency_ms", out, f"{out}/checkpoint").awaitTermination()
    found = metrics.current_percentiles(spark, out)
    return found.select("window_start", "n", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


@query
def windowed_rate(spark, d):
    return metrics.windowed_rate(td.request_log(spark, d), "1 minute")


@query
def sliding_increase(spark, d):
    """Requests of the last 24 hours, every hour."""
    return metrics.windowed_rate(td.request_log(spark, d), "24 hours", "1 hour").select("window_start", "endpoint", "requests")


@query
def windowed_percentiles(spark, d):
    return metrics.windowed_percentiles(td.request_log(spark, d), "latency_ms", "5 minutes")


@query
def score_percentiles(spark, d):
    scores = td.request_log(spark, d).withColumn("score", F.least(F.col("latency_ms") / 500, F.lit(1.0)))
    return metrics.windowed_percentiles(scores, "score", "10 minutes", (0.50, 0.90))


@query
def change_events(spark, d):
    """Changes per hour of a counter of requests that starts anew every day."""
    return metrics.counter_changes(metrics.counter_samples(td.request_log(spark, d)))
