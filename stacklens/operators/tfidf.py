"""TF-IDF over any (id, text) table, in long form, plus the content-based recommender."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stacklens.functions.numeric import rank_score
from stacklens.functions.text import ngrams, tokens
from stacklens.operators.block_scores import top_scores
from stacklens.session import cut_lineage, shuffle_partitions

#: Characters of the texts of a task, about, and words whose n-grams are counted at once.
CHARS_PER_TASK, WORDS_AT_ONCE = 16 << 20, 1 << 20


def _grams(docs: DataFrame, key: str, text: str, ngram_range: Sequence[int], stop_words: Iterable[str] | None) -> DataFrame:
    return docs.select(key, ngrams(tokens(F.col(text), stop_words), ngram_range).alias("grams"))


def term_counts(
    docs: DataFrame,
    key: str,
    text: str,
    ngram_range: Sequence[int] = (1, 2),
    stop_words: Iterable[str] | None = None,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """(key, term, tf) of the whole texts, of vocabulary terms only when ``vocab`` is given.

    The vocabulary join happens in the task that reads the text, so just the hits
    are shuffled; without a vocabulary the texts are.
    """
    if vocab is None:
        return spread_counts(docs, key, text, ngram_range, stop_words)
    terms = _grams(docs, key, text, ngram_range, stop_words).select(key, F.explode("grams").alias("term"))
    terms = terms.join(F.broadcast(vocab.select("term")), "term")
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(
    docs: DataFrame,
    key: str,
    text: str,
    max_features: int,
    ngram_range: Sequence[int] = (1, 2),
    min_df: int = 1,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """The ``max_features`` most frequent terms: (term, corpus_count, df)."""
    return most_frequent(spread_counts(docs, key, text, ngram_range, stop_words), max_features, min_df)


def spread_counts(
    docs: DataFrame, key: str, text: str, ngram_range: Sequence[int] = (1, 2), stop_words: Iterable[str] | None = None
) -> DataFrame:
    """(key, term, tf) of the whole texts, counted where the text is.

    Texts are dealt by key into partitions of bounded size and put in order of key, so a task counts one key after the other
    and holds no table of all terms of its partition. Rows with one key count as one text.
    """
    n_chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    parts, texts = math.ceil(n_chars / CHARS_PER_TASK), docs.where(F.col(text).isNotNull()).select(key, text)
    dealt = texts.repartition(parts, key) if parts > shuffle_partitions(docs.sparkSession) else texts.repartition(key)
    words = dealt.sortWithinPartitions(key).select(key, tokens(F.col(text), stop_words).alias("words"))
    schema = StructType([words.schema[key], StructField("term", StringType()), StructField("tf", LongType(), False)])
    return words.mapInArrow(_counter(key, *ngram_range), schema)


def _counter(key: str, low: int, high: int):
    """Counts the n-grams of rows in order of key; rows of the last key wait for those that follow."""

    def counted(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        names = rows[key].combine_chunks()
        codes = names.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        lists = rows["words"].combine_chunks()
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        # Whole keys up to a number of words at a time.
        steps = np.append(ends, 0)[first - 1] // WORDS_AT_ONCE
        starts = first[np.flatnonzero(np.concatenate(([True], steps[1:] != steps[:-1])))]
        for lo, hi in zip(starts, np.append(starts[1:], len(codes))):
            part = lists.slice(lo, hi - lo)
            words, owner = part.flatten(), np.repeat(np.arange(lo, hi), part.value_lengths().to_numpy(zero_copy_only=False))
            grams, of = [], []
            for n in range(low, high + 1):
                at = np.flatnonzero(owner[:len(owner) - n + 1] == owner[n - 1:]) if n <= len(owner) else np.zeros(0, np.int64)
                grams.append(pc.binary_join_element_wise(*[words.take(pa.array(at + j)) for j in range(n)], " "))
                of.append(owner[at])
            terms = pa.concat_arrays(grams).dictionary_encode()
            place = first[np.searchsorted(first, np.concatenate(of), "right") - 1]
            found, tf = np.unique(place * max(len(terms.dictionary), 1) + terms.indices.to_numpy(), return_counts=True)
            row, code = np.divmod(found, max(len(terms.dictionary), 1))
            yield pa.RecordBatch.from_arrays([names.take(pa.array(row)), terms.dictionary.take(pa.array(code)), pa.array(tf, pa.int64())], [key, "term", "tf"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch[key][-1]
            if held and batch[key][0].equals(last) and held[-1][key][-1].equals(last):
                held.append(batch)
                continue
            rows = pa.Table.from_batches([*held, batch])
            codes = rows[key].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(np.append(True, codes != codes[-1]))[-1])
            held = rows.slice(cut).to_batches()
            if cut:
                yield from counted(rows.slice(0, cut))
        if held:
            yield from counted(pa.Table.from_batches(held))

    return run


def most_frequent(counts: DataFrame, max_features: int, min_df: int = 1) -> DataFrame:
    per_term = counts.groupBy("term").agg(F.sum("tf").alias("corpus_count"), F.count(F.lit(1)).alias("df"))
    return per_term.where(F.col("df") >= min_df).orderBy(F.desc("corpus_count"), "term").limit(max_features)


def weights(n_docs: int, counts: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """(key, term, weight): tf · (ln((1+n)/(1+df)) + 1), scaled to unit length per document.

    The vocabulary holds at most ``max_features`` rows, a parameter, so it is broadcast.
    """
    idf = F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    raw = counts.join(F.broadcast(vocab), "term").select(key, "term", (F.col("tf") * idf).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("w") / norm).alias("weight"))


def fit(
    docs: DataFrame,
    key: str,
    text: str,
    max_features: int = 500,
    ngram_range: Sequence[int] = (1, 2),
    min_df: int = 1,
    stop_words: Iterable[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, weights) of a corpus. Texts are read and tokenised once, into written counts."""
    counts = cut_lineage(spread_counts(docs, key, text, ngram_range, stop_words))
    vocab = cut_lineage(most_frequent(counts, max_features, min_df))
    return vocab, weights(docs.count(), counts, vocab, key)


def save(path: str, vocab: DataFrame, weighted: DataFrame) -> None:
    vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")
    weighted.write.mode("overwrite").parquet(f"{path}/weights")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, weights) as saved."""
    return spark.read.parquet(f"{path}/vocabulary"), spark.read.parquet(f"{path}/weights")


def wide(docs: DataFrame, weighted: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """One ``tfidf_<term>`` column per vocabulary term, 0 where absent; ``weighted`` is the long form."""
    terms = sorted(r.term for r in vocab.select("term").collect())
    present = weighted.groupBy(key).agg(*[
        F.sum(F.when(F.col("term") == t, F.col("weight")).otherwise(0.0)).alias(f"tfidf_{t}") for t in terms
    ])
    return docs.select(key).join(present, key, "left").fillna(0.0)


def profiles(pairs: DataFrame, weighted: DataFrame) -> DataFrame:
    """(patron_id, term, weight): mean vector of the distinct books of each patron.

    Books without any vocabulary term count as zero vectors. ``pairs`` holds distinct
    (patron_id, book_id) rows. A pair travels to its patron once, as one row with the numbered terms
    of its book, and the sums by term need no other shuffle.
    """
    numbered = weighted.select("term").distinct().select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("position"))
    books = weighted.join(F.broadcast(numbered), "term").groupBy("book_id").agg(F.collect_list(F.struct("position", "weight")).alias("entries"))
    books = books.select("book_id", F.col("entries.position").alias("positions"), F.col("entries.weight").alias("weights"))
    n_books = pairs.groupBy("patron_id").agg(F.count(F.lit(1)).alias("n_books"))
    dealt = pairs.join(books, "book_id").select("patron_id", "positions", "weights").repartition("patron_id")
    entries = F.inline(F.arrays_zip("positions", "weights")).alias("position", "weight")
    sums = dealt.select("patron_id", entries).groupBy("patron_id", "position").agg(F.sum("weight").alias("s"))
    return (sums.join(n_books, "patron_id").join(F.broadcast(numbered), "position")
            .select("patron_id", "term", (F.col("s") / F.col("n_books")).alias("weight")))


def as_vectors(weighted: DataFrame, vocab: DataFrame, key: str, everyone: DataFrame | None = None) -> DataFrame:
    """(key, positions, weights): sparse vectors over the alphabetically numbered vocabulary.

    A vector has at most ``max_features`` entries. Keys of ``everyone`` without terms
    get an empty vector.
    """
    numbered = vocab.select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("position"))
    vectors = (
        weighted.join(F.broadcast(numbered), "term")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("position", "weight"))).alias("entries"))
    )
    if everyone is not None:
        vectors = everyone.select(key).join(vectors, key, "left")
    return vectors.select(
        key,
        F.coalesce(F.col("entries.position"), F.array().cast("array<int>")).alias("positions"),
        F.coalesce(F.col("entries.weight"), F.array().cast("array<double>")).alias("weights"),
    )


#: Patrons who know the first book of more vectors than this are scored against every book.
FEW_SEEN = 200


def _shared(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Books with one vector stand together under the smallest of their ids.

    Returns (book_id, n_books, positions, weights) per vector and (shared_id, n_books, place, book_id) per
    book, placed by id within its vector.
    """
    vectors = cut_lineage(vectors.withColumn("key", F.transform("weights", lambda x: F.round(x, 12))))
    per_vector = cut_lineage(vectors.groupBy("positions", "key").agg(
        F.min("book_id").alias("shared_id"), F.count(F.lit(1)).alias("n_books"), F.min("weights").alias("weights")))
    by_id = Window.partitionBy("shared_id").orderBy("book_id")
    books = vectors.select("positions", "key", "book_id").join(per_vector.select("positions", "key", "shared_id", "n_books"), ["positions", "key"])
    members = cut_lineage(books.select("shared_id", "n_books", "book_id", F.row_number().over(by_id).alias("place")))
    return per_vector.select(F.col("shared_id").alias("book_id"), "n_books", "positions", "weights"), members


def _expanded(best: DataFrame, members: DataFrame, query: str, need: int) -> DataFrame:
    """Books of the best vectors of each query: enough to hold its ``need`` best books.

    ``best`` has (query, shared_id, n_books, score, rank, skipped), where ``skipped`` has the places of books that are
    not asked for. Vectors are taken in order until they have ``need`` books, with all that tie with the last
    of them; of one vector the first ``need`` books are enough, since equal scores are ordered by book.
    """
    order = Window.partitionBy(query).orderBy("rank")
    left = F.col("n_books") - F.size("skipped")
    best = best.withColumn("before", F.sum(left).over(order) - left)
    least = F.min(F.when(F.col("before") < need, F.col("score"))).over(Window.partitionBy(query))
    taken = best.withColumn("least", least).where(F.col("score") >= F.col("least"))
    first = F.sequence(F.lit(1), F.least("n_books", F.size("skipped") + need).cast("int"))
    places = F.explode(F.slice(F.array_except(first, "skipped"), 1, need))
    return taken.select(query, "shared_id", "score", places.alias("place")).join(
        members.select("shared_id", "place", "book_id"), ["shared_id", "place"]).select(query, "book_id", "score")


def _seen_places(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(patron_id, shared_id, n_books, skipped): places of the books a patron has had, vector by vector."""
    had = pairs.join(members, "book_id").select("patron_id", "shared_id", "n_books", "place").repartition("patron_id")
    return had.groupBy("patron_id", "shared_id").agg(F.min("n_books").alias("n_books"), F.collect_set("place").alias("skipped"))


def recommend(
    pairs: DataFrame,
    catalog: DataFrame,
    vocab: DataFrame,
    weighted: DataFrame,
    n: int,
    exclude_seen: bool = True,
) -> DataFrame:
    """Top ``n`` books per patron by cosine of profile and book: (patron_id, book_id, score, rank).

    Many books share a vector, so patrons are scored against distinct vectors and the best of
    these are turned into books. Vectors of which a patron has had every book are left out. Each vector before a
    book's own has a book that comes before it, its first one, unless the patron has had just that; so with m such vectors
    the n best unseen books are among the n + m best vectors. Patrons with more than ``FEW_SEEN`` such vectors are
    scored against all books instead. ``pairs`` and ``catalog`` are read several times and best materialised.
    """
    books = cut_lineage(as_vectors(weighted, vocab, "book_id", catalog))
    vectors, members = _shared(books)
    queries = as_vectors(profiles(pairs, weighted), vocab, "patron_id", pairs.select("patron_id").distinct())
    if exclude_seen:
        seen = cut_lineage(_seen_places(pairs, members))
        whole = F.size("skipped") >= F.col("n_books")
        held = seen.where(~whole & F.array_contains("skipped", 1)).groupBy("patron_id").agg(F.count(F.lit(1)).alias("n_held"))
        queries = queries.join(held, "patron_id", "left").fillna(0, ["n_held"])
    else:
        queries = queries.withColumn("n_held", F.lit(0).cast("long"))
    queries = cut_lineage(queries.where("patron_id IS NOT NULL"))
    best = top_scores(
        queries.where(F.col("n_held") <= FEW_SEEN), vectors, "patron_id", "book_id", n, cosine=True, digits=9, extra="n_held",
        exclude=seen.where(whole).select("patron_id", F.col("shared_id").alias("book_id")) if exclude_seen else None)
    sized = best.join(vectors.select("book_id", "n_books"), "book_id").withColumnRenamed("book_id", "shared_id")
    none = F.array().cast("array<int>")
    if exclude_seen:
        sized = sized.join(seen.select("patron_id", "shared_id", "skipped"), ["patron_id", "shared_id"], "left").withColumn(
            "skipped", F.coalesce("skipped", none))
    else:
        sized = sized.withColumn("skipped", none)
    order = Window.partitionBy("patron_id").orderBy(F.desc("score"), "book_id")
    ranked = _expanded(sized, members, "patron_id", n).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= n).withColumn("score", F.round("score", 4)).select("patron_id", "book_id", "score", "rank")
    many = queries.where(F.col("n_held") > FEW_SEEN)
    if many.isEmpty():
        return ranked
    rest = top_scores(
        many, books, "patron_id", "book_id", n,
        exclude=pairs.join(many, "patron_id", "left_semi") if exclude_seen else None, cosine=True)
    return ranked.unionByName(rest.select(ranked.columns))


def similar(catalog: DataFrame, vocab: DataFrame, weighted: DataFrame, n: int) -> DataFrame:
    """Top ``n`` other books per book by cosine; distinct vectors are compared, then turned into books."""
    vectors, members = _shared(as_vectors(weighted, vocab, "book_id", catalog))
    best = top_scores(vectors.withColumnRenamed("book_id", "query_id"), vectors, "query_id", "book_id", n + 1, cosine=True, digits=9)
    sized = best.join(vectors.select("book_id", "n_books"), "book_id").withColumnRenamed("book_id", "shared_id").withColumn(
        "skipped", F.array().cast("array<int>"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "book_id")
    near = _expanded(sized, members, "query_id", n + 1).withColumn("place", F.row_number().over(order)).where(F.col("place") <= n + 1)
    near = cut_lineage(near.select(F.col("query_id").alias("shared_id"), F.col("book_id").alias("similar_book_id"), "score"))
    others = members.select("shared_id", "book_id").join(near, "shared_id").where(F.col("book_id") != F.col("similar_book_id"))
    order = Window.partitionBy("book_id").orderBy(F.desc("score"), "similar_book_id")
    return others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select(
        "book_id", "similar_book_id", F.round("score", 4).alias("score"), "rank")


def explain(
    targets: DataFrame, catalog: DataFrame, profile: DataFrame, weighted: DataFrame, n_terms: int = 5
) -> DataFrame:
    """Sentence per (patron_id, book_id) of ``targets`` with the terms that drive the match.

    Joins start from the asked pairs, so the work grows with them, not with the catalog. The terms of a book and of a
    patron meet as lists in one row per asked pair.
    """
    pairs = targets.select("patron_id", "book_id").distinct()
    listed = lambda df, key, name: df.groupBy(key).agg(F.collect_list(F.struct("term", "weight")).alias(name))
    common = lambda t: F.transform(
        F.filter("tastes", lambda p: p["term"] == t["term"]),
        lambda p: F.struct((-rank_score(t["weight"] * p["weight"])).alias("less"), t["term"].alias("term")))
    best_first = F.array_sort(F.filter(F.flatten(F.transform("terms", common)), lambda x: x["less"] < 0))
    met = (
        pairs.join(listed(weighted, "book_id", "terms"), "book_id", "left")
        .join(listed(profile, "patron_id", "tastes").withColumn("has_history", F.lit(True)), "patron_id", "left")
        .select("patron_id", "book_id", "has_history", F.slice(best_first, 1, n_terms).alias("signals"))
    )
    named = F.array_join(F.col("signals.term"), ", ")
    return (
        met.join(catalog.select("book_id", "genre"), "book_id", "left")
        .select(
            "patron_id", "book_id",
            F.when(F.col("has_history").isNull(), F.lit("No borrowing history available for explanation"))
            .when(F.col("genre").isNull(), F.concat(F.lit("Book "), F.col("book_id"), F.lit(" not in catalog")))
            .when(
                F.size("signals") > 0,
                F.concat(
                    F.lit("Recommended because your reading history matches '"), F.col("genre"),
                    F.lit("' content — key signals: "), named,
                ),
            )
            .otherwise(F.concat(F.lit("Recommended based on genre match: "), F.col("genre")))
            .alias("explanation"),
        )
    )
