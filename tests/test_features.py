from datetime import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stacklens import schemas
from stacklens.functions import calendar as cal
from stacklens.functions import text
from stacklens.functions.numeric import chi2_upper_tail
from stacklens.operators import behavioral, catalog, embeddings, quantiles, temporal


def loan_rows(spark, rows):
    """(patron, book, genre, date, status) tuples as loans."""
    full = [(p, b, f"title {b}", g, d, d, s, 10, 1, "18-25", "basic") for p, b, g, d, s in rows]
    return spark.createDataFrame(full, schemas.LOANS)


def test_no_recent_loan_is_zero_and_tenure_zero(spark):
    rows = [("P1", "B1", "a", dt(2020, 1, 1), "returned"), ("P2", "B1", "a", dt(2024, 1, 1), "overdue")]
    out = {r.patron_id: r for r in temporal.temporal_features(loan_rows(spark, rows)).collect()}
    assert out["P1"].checkouts_last_90d == 0 and out["P2"].checkouts_last_30d == 1
    assert out["P1"].tenure_days == 0 and out["P1"].monthly_borrow_rate == 1.0
    assert out["P2"].overdue_rate == 1.0


def test_modes_take_the_smallest_on_ties(spark):
    rows = [("P1", "B1", "b", dt(2024, 3, 5), "returned"), ("P1", "B2", "a", dt(2024, 1, 1), "returned")]
    frame = loan_rows(spark, rows)
    out = temporal.temporal_features(frame).first()
    assert (out.preferred_day_of_week, out.preferred_month, out.preferred_season) == (0, 1, "spring")
    assert behavioral.genre_features(frame).first().top_genre == "a"


def test_elapsed_days_are_whole_days(spark):
    row = spark.createDataFrame([(dt(2024, 1, 1, 23), dt(2024, 1, 2, 1))], "a timestamp, b timestamp")
    assert row.select(cal.elapsed_days(F.col("b"), F.col("a"))).first()[0] == 0


def test_null_keys_and_genres_are_dropped(spark):
    rows = [(None, "B1", "a", dt(2024, 1, 1), "returned"), ("P1", "B1", None, dt(2024, 1, 1), "returned")]
    frame = loan_rows(spark, rows)
    assert [r.patron_id for r in temporal.temporal_features(frame).collect()] == ["P1"]
    assert behavioral.genre_features(frame, ["a"]).count() == 0


def test_wishlist_without_views_is_zero(spark):
    rows = [(f"E{i}", "P1", "wishlist_add", dt(2024, 1, 1), "B1", "S", "mobile", "{}") for i in range(2)]
    out = behavioral.engagement_features(spark.createDataFrame(rows, schemas.ACTIVITY)).first()
    assert (out.count_wishlist_add, out.wishlist_conversion_rate, out.events_per_session) == (2, 0.0, 0.0)


def test_unlisted_genres_and_devices_count(spark):
    rows = [("P1", f"B{i}", g, dt(2024, 1, 1), "returned") for i, g in enumerate("AXX")]
    out = behavioral.genre_features(loan_rows(spark, rows), ["A", "B"]).first()
    assert (out.genre_a_count, out.genre_b_count, out.genre_diversity, out.top_genre) == (1, 0, 2, "X")
    assert out.genre_concentration == 0.667
    rows = [(f"E{i}", "P1", "book_view", dt(2024, 1, 1), "B1", "S", d, "{}") for i, d in enumerate(["kiosk", "kiosk", "mobile", None, None, None])]
    assert behavioral.engagement_features(spark.createDataFrame(rows, schemas.ACTIVITY)).first().preferred_device == "kiosk"


def test_many_genres_are_no_error(spark):
    rows = [("P1", "B1", f"g{i:04}", dt(2024, 1, 1), "returned") for i in range(600)] + [("P1", "B1", "g0599", dt(2024, 1, 1), "returned")]
    frame = loan_rows(spark, rows)
    listed = behavioral.known_genres(frame)
    assert len(listed) == behavioral.WIDE_GENRES and "g0599" in listed
    assert behavioral.genre_counts(frame).count() == 600
    assert behavioral.genre_features(frame, listed[:3]).first().genre_diversity == 600


def test_genre_columns_keep_hyphens():
    assert behavioral.genre_column("Non-Fiction Books") == "genre_non-fiction_books_count"


def test_missing_sides_are_filled(spark, tiny):
    from stacklens.sources import testdata

    frame = loan_rows(spark, [("P-new", "B1", "a", dt(2024, 1, 1), "returned")])
    out = behavioral.behavioral_features(frame, testdata.pos(spark, tiny), testdata.activity(spark, tiny)).first()
    assert out.total_spend == 0 and out.preferred_payment == "unknown" and out.total_events == 0


def test_single_book_has_weight_one(spark):
    frame = loan_rows(spark, [("P1", "B1", "a", dt(2024, 1, 1), "returned")])
    vectors = spark.createDataFrame([("B1", [1.0, 0.0])], "book_id string, vector array<float>")
    assert embeddings.recency_weights(frame, vectors).first().weight == 1.0


def test_recency_follows_latest_checkout(spark):
    rows = [("P1", "B1", "a", dt(2024, 1, 1), "x"), ("P1", "B2", "a", dt(2024, 2, 1), "x"), ("P1", "B1", "a", dt(2024, 3, 1), "x")]
    vectors = spark.createDataFrame([("B1", [1.0]), ("B2", [1.0])], "book_id string, vector array<float>")
    got = {r.book_id: r.weight for r in embeddings.recency_weights(loan_rows(spark, rows), vectors).collect()}
    assert got == pytest.approx({"B2": 1 / 3, "B1": 2 / 3})


def test_first_title_by_date(spark):
    rows = [("P1", "B1", "late", dt(2024, 2, 1), "x"), ("P2", "B1", "early", dt(2024, 1, 1), "x"), ("P3", "B1", None, dt(2023, 1, 1), "x")]
    assert catalog.book_metadata(loan_rows(spark, rows)).first().genre == "early"


@pytest.mark.parametrize("values", [
    [1, 1, 1, 1, 2], list(range(101)), [5.0], [0.5, 0.25, 9.0, 9.0], [7] * 5000 + list(range(5000)),
    list(np.random.default_rng(1).normal(size=5000)),
])
def test_quantiles_equal_numpy(spark, values):
    frame = spark.createDataFrame([("f", float(v)) for v in values], "feature string, value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(frame, probs).first().quantiles
    assert got == pytest.approx(np.quantile(values, probs), abs=1e-12)


@pytest.mark.parametrize("stat,dof,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (11.0705, 5, 0.05), (0.0, 3, 1.0),
                                        (16.9190, 9, 0.05), (1e6, 4, 0.0), (124.3421, 100, 0.05),
                                        # By the normal approximation of Wilson and Hilferty.
                                        (17_000, 10_000, 0.0), (10_000, 10_000, 0.4981), (10_233.75, 10_000, 0.05), (9_000, 10_000, 1.0),
                                        (1_002_327.6, 1_000_000, 0.05), (1e-9, 2, 1.0), (0.0039321, 1, 0.95)])
def test_chi2_tail(spark, stat, dof, p):
    got = spark.range(1).select(chi2_upper_tail(F.lit(stat), F.lit(dof).cast("long"))).first()[0]
    assert got == pytest.approx(p, abs=1e-4 if dof > 1000 else 1e-5)


def test_tokens_and_ngrams(spark):
    row = spark.createDataFrame([("The Élan of a_b x 42 ÉLAN",)], "t string")
    words = text.tokens(F.col("t"))
    assert row.select(words).first()[0] == ["élan", "a_b", "42", "élan"]
    assert row.select(text.ngrams(words)).first()[0][4:] == ["élan a_b", "a_b 42", "42 élan"]
    assert row.select(text.ngrams(words, (3, 3))).first()[0] == ["élan a_b 42", "a_b 42 élan"]
    short = spark.createDataFrame([("the",), ("one word",)], "t string")
    assert [r[0] for r in short.select(text.ngrams(text.tokens(F.col("t")))).collect()] == [[], ["word"]]


def test_stop_words_can_be_replaced(spark):
    row = spark.createDataFrame([("the red ring",)], "t string")
    assert row.select(text.tokens(F.col("t"), ["ring"])).first()[0] == ["the", "red"]
    assert len(text.load_stop_words()) == 318


CLASHING = ["Sci Fi", "sci_fi", "Fiction", "fiction", "fiction_count_2", "Dots. and `ticks`"]


def test_clashing_genre_names_have_columns_of_their_own(spark, tmp_path):
    rows = [(f"P{i}", f"B{k}", g, dt(2024, 1, 1 + i), "returned") for k, g in enumerate(CLASHING) for i in range(k + 1)]
    frame = loan_rows(spark, rows)
    behavioral.genre_features(frame).write.parquet(str(tmp_path / "genres"))
    out = spark.read.parquet(str(tmp_path / "genres"))
    columns = behavioral.distinct_columns(CLASHING, behavioral.genre_column)
    assert columns["Sci Fi"] == "genre_sci_fi_count" and columns["sci_fi"] == "genre_sci_fi_count_2"
    assert len({c.lower() for c in columns.values()}) == len(CLASHING) and len(out.columns) == len(CLASHING) + 4
    first = out.where("patron_id = 'P0'").first().asDict()
    third = out.where("patron_id = 'P2'").first().asDict()
    for k, g in enumerate(CLASHING):
        assert first[columns[g]] == 1 and third[columns[g]] == (k >= 2)
    filled = behavioral.fill_by_type(out.withColumn(columns["Fiction"], F.lit(None).cast("long")), "patron_id").first().asDict()
    assert filled[columns["Fiction"]] == 0
    encoded = catalog.genre_encoding(catalog.book_metadata(frame))
    encoded.write.parquet(str(tmp_path / "books"))
    books = {r["book_id"]: r.asDict() for r in spark.read.parquet(str(tmp_path / "books")).collect()}
    named = behavioral.distinct_columns(CLASHING, lambda g: f"genre_{g}")
    for k, g in enumerate(CLASHING):
        assert [books[f"B{k}"][named[h]] for h in CLASHING] == [int(h == g) for h in CLASHING]


def test_daily_job_with_clashing_genres(spark, tiny, tmp_path):
    from stacklens.plans import feature_etl
    from stacklens.sources import testdata

    genre = F.element_at(F.array(*[F.lit(g) for g in CLASHING[:4]]), F.pmod(F.xxhash64("book_id"), F.lit(4)).cast("int") + 1)
    mixed = testdata.loans(spark, tiny).withColumn("genre", genre)
    paths = feature_etl.run(spark, mixed, testdata.pos(spark, tiny), testdata.activity(spark, tiny), str(tmp_path), "warn")
    master = spark.read.parquet(paths["master_features"])
    counts = spark.read.parquet(paths["genre_counts"])
    columns = behavioral.distinct_columns(CLASHING[:4], behavioral.genre_column)
    for g, column in columns.items():
        assert master.agg(F.sum(column)).first()[0] == counts.where(F.col("genre") == g).agg(F.sum("n")).first()[0] > 0
