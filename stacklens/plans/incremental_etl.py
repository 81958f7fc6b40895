"""Feature tables kept current load by load: only patrons with new rows are computed anew.

Raw rows stay under ``raw/<table>/load=<n>/bucket=<b>``, features under ``<table>/bucket=<b>``; a patron's bucket is a hash of the id.
A load reads the history of the buckets it touches, computes the features of the patrons it touches, and overwrites those
buckets alone. What moves for everybody as time goes on is not stored: days since the last checkout and trailing
counts are derived on reading, the counts from the loans of the last 90 days, which file statistics single out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stacklens.functions import calendar as cal
from stacklens.operators import behavioral, temporal
from stacklens.session import cut_lineage, exists, remove

#: Buckets of a new store; a store keeps the number it was begun with.
BUCKETS = 256
TABLES = ("loans", "pos", "activity")
#: Columns that depend on the day they are read.
MOVING = ("days_since_last_checkout", *(f"checkouts_last_{d}d" for d in temporal.TRAILING_DAYS))


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64("patron_id"), F.lit(buckets)).cast("int").alias("bucket")


def _buckets(spark: SparkSession, out: str, wanted: int) -> int:
    path = f"{out}/buckets"
    if not exists(spark, f"{path}/_SUCCESS"):
        spark.range(1).select(F.lit(wanted).alias("n")).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first()["n"]


def _history(spark: SparkSession, out: str, table: str, like: DataFrame) -> DataFrame:
    folders = [T.StructField(name, T.IntegerType()) for name in ("load", "bucket")]
    return spark.read.schema(T.StructType([*like.schema.fields, *folders])).parquet(f"{out}/raw/{table}")


def _touched(spark: SparkSession, out: str, load: int, rows: dict[str, DataFrame]) -> DataFrame:
    """(patron_id): patrons of this load, and of the same load when it ran before. Written before any raw row is replaced."""
    path = f"{out}/touched/load={load}"
    found = [df.select("patron_id") for df in rows.values()]
    if exists(spark, path):
        found.append(cut_lineage(spark.read.schema("patron_id string").parquet(path)))
    patrons = found[0]
    for more in found[1:]:
        patrons = patrons.unionByName(more)
    patrons.where("patron_id IS NOT NULL").distinct().write.mode("overwrite").parquet(path)
    return spark.read.schema("patron_id string").parquet(path)


def _replace(spark: SparkSession, path: str, fresh: DataFrame, touched: DataFrame, buckets: Sequence[int], n_buckets: int) -> None:
    """The touched buckets of a table: rows of other patrons as they are, those of touched patrons from ``fresh``."""
    rows = fresh.withColumn("bucket", _bucket(n_buckets))
    if exists(spark, path):
        kept = spark.read.schema(rows.schema).parquet(path).where(F.col("bucket").isin(*buckets))
        rows = rows.unionByName(kept.join(touched, "patron_id", "left_anti").select(rows.columns))
    rows = cut_lineage(rows)
    full = {r.bucket for r in rows.select("bucket").distinct().collect()}
    (rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))
    for bucket in set(buckets) - full:
        remove(spark, f"{path}/bucket={bucket}")


def _lasting(loans: DataFrame) -> DataFrame:
    """Temporal features that do not depend on the day, and the last checkout."""
    last = loans.where("patron_id IS NOT NULL").groupBy("patron_id").agg(F.max("checkout_date").alias("last_checkout"))
    any_day = F.lit("2000-01-01").cast("timestamp")
    return temporal.temporal_features(loans, any_day).drop(*MOVING).join(last, "patron_id")


def load_day(
    spark: SparkSession, load: int, loans: DataFrame, pos: DataFrame, activity: DataFrame, out: str, buckets: int = BUCKETS
) -> list[int]:
    """Add the rows of one load and bring the features of its patrons up to date; returns the buckets it touched.

    A load that runs again replaces its rows: the result depends on the loads, not on how often or in which order they ran. Null
    patrons stay in the raw rows and have no features; an empty load touches nothing. The three tables keep their columns
    from load to load and have none named ``load`` or ``bucket``.
    """
    rows = {"loans": loans, "pos": pos, "activity": activity}
    n_buckets = _buckets(spark, out, buckets)
    touched = _touched(spark, out, load, rows)
    # At most one number per bucket.
    hit = sorted(r.bucket for r in touched.select(_bucket(n_buckets)).distinct().collect())
    for table, df in rows.items():
        (df.withColumn("bucket", _bucket(n_buckets)).hint("rebalance", "bucket").sortWithinPartitions("bucket", "patron_id")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/raw/{table}/load={load}"))
    if not hit:
        return hit

    def of_touched(table: str) -> DataFrame:
        history = _history(spark, out, table, rows[table]).where(F.col("bucket").isin(*hit))
        return history.join(touched, "patron_id", "left_semi").drop("load", "bucket")

    own = {table: of_touched(table) for table in TABLES}
    for name, fresh in {
        "temporal": _lasting(own["loans"]),
        "behavioral": behavioral.behavioral_features(own["loans"], own["pos"], own["activity"], genres=[]),
        "genre_counts": behavioral.genre_counts(own["loans"]),
    }.items():
        _replace(spark, f"{out}/{name}", fresh, touched, hit, n_buckets)
    return hit


def current_temporal(spark: SparkSession, out: str) -> DataFrame:
    """The temporal features as of the newest checkout of all loads."""
    stored = spark.read.parquet(f"{out}/temporal").drop("bucket")
    as_of = stored.agg(F.max("last_checkout")).first()[0]
    day = F.lit(as_of).cast("timestamp")
    ts = F.col("checkout_date")
    spans = {f"checkouts_last_{d}d": day - F.make_interval(days=F.lit(d)) for d in temporal.TRAILING_DAYS}
    longest = f"checkouts_last_{max(temporal.TRAILING_DAYS)}d"
    loans = spark.read.parquet(f"{out}/raw/loans").select("patron_id", "book_id", "checkout_date")
    recent = loans.where(F.col("patron_id").isNotNull() & F.col("book_id").isNotNull() & (ts >= spans[longest]))
    counts = recent.groupBy("patron_id").agg(*[F.count_if(ts >= start).alias(name) for name, start in spans.items()])
    joined = stored.join(counts, "patron_id", "left").fillna(0, list(spans))
    return joined.withColumn("days_since_last_checkout", cal.elapsed_days(day, F.col("last_checkout"))).drop("last_checkout")


def current_behavioral(spark: SparkSession, out: str, genres: Sequence[str] | None = None) -> DataFrame:
    """The behavioral features with a column per genre: of ``genres``, or of the most frequent ones."""
    stored = spark.read.parquet(f"{out}/behavioral").drop("bucket")
    counts = spark.read.parquet(f"{out}/genre_counts").drop("bucket")
    if genres is None:
        most = counts.groupBy("genre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "genre").limit(behavioral.WIDE_GENRES)
        genres = sorted(r.genre for r in most.collect())
    columns = behavioral.distinct_columns(genres, behavioral.genre_column)
    if not columns:
        return stored
    wide = counts.groupBy("patron_id").agg(
        *[F.sum(F.when(F.col("genre") == g, F.col("n")).otherwise(0)).alias(c) for g, c in columns.items()])
    rest = [behavioral.quoted(c) for c in stored.columns if c != "patron_id"]
    zero = lambda c: F.coalesce(behavioral.quoted(c), F.lit(0).cast("long")).alias(c)
    return stored.join(wide, "patron_id", "left").select("patron_id", *[zero(c) for c in columns.values()], *rest)


def current_master(spark: SparkSession, out: str, genres: Sequence[str] | None = None) -> DataFrame:
    return behavioral.master_features(current_temporal(spark, out), current_behavioral(spark, out, genres))
