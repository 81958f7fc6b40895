"""The library tables, mapped from the generated star-schema parquet files.

Every mapping reads only the base tables the asked columns need: the joins to
orders, part and customer are lossless, so leaving one out keeps all rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stacklens import schemas

GENRES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
DRIFT_SPLIT = "1998-01-01"
SCORE_SPLIT = "2024-01-16"
HOLDOUT_START = "2000-07-01"

BOOK_COLUMNS = {"book_title", "genre"}
PATRON_COLUMNS = {"patron_age_group", "patron_membership_type"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key(prefix: str, column: Column | str, width: int = 5) -> Column:
    return F.format_string(f"{prefix}%0{width}d", F.col(column) if isinstance(column, str) else column)


def pick(index: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


def loans(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, dirty: bool = False) -> DataFrame:
    """Loans: one row per line item. ``dirty`` keeps raw ship dates and flags for the validators."""
    wanted = list(columns) if columns is not None else schemas.LOANS.fieldNames()
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    df = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if BOOK_COLUMNS & set(wanted):
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
        df = df.join(part, df.l_partkey == part.p_partkey)
    if PATRON_COLUMNS & set(wanted):
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        df = df.join(customer, df.o_custkey == customer.c_custkey)
    checkout = F.col("o_orderdate").cast("timestamp")
    days = F.col("l_quantity").cast("int")
    flag = F.col("l_returnflag")
    status = F.when(flag == "A", "returned").when(flag == "R", "overdue")
    status = status.otherwise(flag) if dirty else status.when(flag == "N", "lost")
    expressions = {
        "patron_id": key("P", "o_custkey"),
        "book_id": key("B", "l_partkey"),
        "book_title": F.col("p_name"),
        "genre": F.col("p_type"),
        "checkout_date": checkout,
        "return_date": F.col("l_shipdate").cast("timestamp") if dirty
        else checkout + F.make_interval(days=days),
        "loan_status": status,
        "loan_duration_days": days,
        "times_renewed": ((F.col("l_linenumber") - 1) % 5).cast("int"),
        "patron_age_group": pick(F.col("c_nationkey") % 5, schemas.AGE_GROUPS),
        "patron_membership_type": pick(F.col("c_custkey") % 3, schemas.MEMBERSHIP_TYPES),
    }
    return df.select(*[expressions[c].alias(c) for c in wanted])


def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-of-sale rows: one per order."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        key("T", "o_orderkey", 6).alias("transaction_id"),
        key("P", "o_custkey").alias("patron_id"),
        F.col("o_orderdate").cast("timestamp").alias("transaction_date"),
        pick(F.substring("o_orderpriority", 1, 1).cast("int") - 1, schemas.TRANSACTION_TYPES).alias("transaction_type"),
        F.col("o_totalprice").alias("amount"),
        F.when(status == "F", "card").when(status == "O", "cash").when(status == "P", "mobile").alias("payment_method"),
        (F.col("o_orderkey") % 3 + 1).cast("int").alias("items_purchased"),
    )


def activity_from_events(events: DataFrame, keep_errors: bool = False) -> DataFrame:
    """Activity rows from raw events (a batch or a streaming frame).

    ``keep_errors`` leaves error events with their raw, unknown type for the validators.
    """
    kind, odd = F.col("event_type"), F.col("event_id") % 2 == 1
    event_type = (
        F.when(kind == "click", "book_search")
        .when(kind == "view", "book_view")
        .when(kind == "signup", F.when(odd, "session_end").otherwise("session_start"))
        .when(kind == "purchase", F.when(odd, "reservation_cancel").otherwise("reservation_made"))
        .when(kind == "error", F.lit("error") if keep_errors
              else F.when(odd, "review_submitted").otherwise("wishlist_add"))
    )
    stamp = F.col("ts").cast("timestamp")
    return events.select(
        key("E", "event_id", 8).alias("event_id"),
        key("P", "user_id").alias("patron_id"),
        event_type.alias("event_type"),
        stamp.alias("event_timestamp"),
        F.when(kind != "signup", key("B", F.get_json_object("props", "$.k").cast("long"))).alias("book_id"),
        F.concat(F.lit("S"), F.col("user_id").cast("string"), F.date_format(stamp, "yyyyMMdd")).alias("session_id"),
        pick(F.col("event_id") % 3, schemas.DEVICE_TYPES).alias("device_type"),
        F.col("props").alias("event_metadata"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_from_events(table(spark, sf_dir, "events"))


def book_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence vectors per book."""
    return table(spark, sf_dir, "embeddings").select(key("B", "vec_id").alias("book_id"), F.col("embedding").alias("vector"))


def request_log_from_events(events: DataFrame) -> DataFrame:
    """Served requests with a latency (from a batch or a streaming frame)."""
    return events.select(
        F.col("ts").cast("timestamp").alias("request_ts"),
        F.col("event_type").alias("endpoint"),
        F.col("value").alias("latency_ms"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_log_from_events(table(spark, sf_dir, "events"))


def prediction_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores in [0, 1] with the period they belong to."""
    return table(spark, sf_dir, "events").select(
        F.least(F.col("value") / 500, F.lit(1.0)).alias("score"),
        (F.col("ts").cast("timestamp") < F.lit(SCORE_SPLIT).cast("timestamp")).alias("is_baseline"),
    )


def recommend_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recommendation request per customer; some are malformed, some name unknown patrons."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("request_id"),
        F.when(k % 40 == 7, F.lit("  "))
        .when(k % 40 == 8, F.concat(F.lit("X"), k.cast("string")))
        .otherwise(F.concat(F.lit(" "), key("P", "c_custkey"), F.lit(" "))).alias("patron_id"),
        (k % 53).cast("int").alias("n_recommendations"),
        (k % 4 != 3).alias("exclude_seen"),
        F.when(k % 10 != 9, (k % 12).cast("int")).alias("diversity_cap"),
    )


def similar_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One similar-books request per part; every fifth asks for an unsupported method."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("request_id"),
        F.when(k % 30 == 4, F.concat(F.lit("X"), k.cast("string"))).otherwise(key("B", "p_partkey")).alias("book_id"),
        (k % 13).cast("int").alias("n_similar"),
        F.when(k % 5 == 0, "word2vec").when(k % 5 < 3, "tfidf").otherwise("bert").alias("method"),
    )
